"""Similarity join of documents on word shingles: a T-occurrence search by DivideSkip.

A set of n shingles shares at least T = ceil(s * n) of them with any partner
of Jaccard similarity s or more, so a partner's id occurs T times in the set's
n inverted lists. DivideSkip sets L of the lists aside, merges the others and
asks for T - L occurrences there, and probes the lists set aside only for the
candidates that are left. It runs here in three steps.

1. Screen. All sets take part, so lists are divided by hash, not by length: a
   fixed share of all lists is merged (counted), and a set goes on if enough of
   its merged lists hold other sets too. Texts that merely share a passage
   end here.
2. Groups. Of what is left each set meets one head: the set of least rank that
   most of its lists begin with. Heads that reach the similarity gather groups
   of near copies with one comparison for each member, so no pair within a
   group is listed.
3. Search. Lists with more than one group are the inverted lists of the
   search proper. A set asks for partners in other groups of its
   group's size or more; its lists, which hold groups, are ordered by length, L follows from
   T and the longest one, and the short lists are merged to T - L occurrences.
   Groups that are left are met in blocks of their own inverted lists: there
   the short lists are merged once more, which counts occurrences by member,
   and only members with T - L of them are probed in the L long lists. The
   first member that links ends the search in a block, as one link joins the groups.

Links between groups are all found, and groups are joined by links, so
components are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, discard, give_back, handing_back, sized, text_slices
from tidemark.llm.links import components
from tidemark.llm.shingles import shingle_sets

#: Share of all lists, by hash, that the screen merges.
SCREEN = 0.4
#: Postings that a task of the screen holds.
POSTINGS = 1_000_000
#: Turns of meeting heads (fewer if one finds no link), and heads that a set meets in all turns but the first.
HEAD_TURNS, HEADS = 4, 3
#: No more turns follow one in which this share of the pairs, or less, links: the search proper finds the rest.
FEW = 0.1
#: What chance adds to the (binary logarithm of the) centrality of a head at most.
CHANCE = 0.2
#: How much probing a long list costs against merging it, in the choice of L (after Li, Lu and Lu, 2008).
LONG_COST = 0.02
#: Postings of a block of a group's inverted lists, on average.
BLOCK = 1 << 15
#: Shingles probed before it is asked whether the outcome is certain.
PROBE = 64


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int64), pa.int64()))


def _arrays(column: pa.Array) -> list[np.ndarray]:
    values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(offsets, offsets[1:])]


def _keys(sets: list[np.ndarray]) -> np.ndarray:
    """Two numbers of 64 bits that stand for each set."""
    digests = b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets)
    return np.frombuffer(digests, dtype=np.int64).reshape(-1, 2)


def _sizes(docs: DataFrame) -> DataFrame:
    """doc_id, n and the two keys of the set of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 1):
            sets = shingle_sets(batch.column(1))
            keys = _keys(sets)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys[:, 0]), pa.array(keys[:, 1])], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(handing_back(run), "doc_id long, n long, k1 long, k2 long")


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal numbers begins."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)


_PACK = pa.schema([("bucket", pa.int32()), ("pack", pa.int64()), ("postings", pa.bool_()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])


def _packed(parts: list[np.ndarray], sizes: np.ndarray, keys: np.ndarray, task: int, turn: int, percent: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """The screen's postings of some sets by bucket, and what of their counts is known already.

    A list of several sets here is known to be shared; one posting, marked so,
    tells the other tasks of it.
    """
    pack = (task << 32) + turn
    _, first = np.unique(keys, axis=0, return_index=True)
    parts, sizes, keys = [parts[i] for i in first], sizes[first], keys[first, 0]
    taken = np.array([len(p) for p in parts])
    s, owner = np.concatenate(parts), np.repeat(np.arange(len(parts)), taken)
    order = np.argsort(s, kind="stable")
    s, owner = s[order], owner[order]
    at = _starts(s)
    length = np.diff(np.append(at, len(s)))
    known = np.bincount(owner[np.repeat(length > 1, length)], minlength=len(parts))
    need = taken - (sizes - -(-percent * sizes // 100))
    s, owner, several = s[at], owner[at], length > 1
    bucket_of = (s.astype(np.uint64) + np.uint64(2**63)) // np.uint64(int(SCREEN * 2**64) // buckets + 1)
    edges = _starts(bucket_of)
    rows = [((task + turn) % buckets, pack, False, keys.tobytes(), known.astype(np.int32).tobytes(), need.astype(np.int32).tobytes())]
    for x, y in zip(edges, [*edges[1:], len(s)]):
        rows.append((int(bucket_of[x]), pack, True, s[x:y].tobytes(), keys[owner[x:y]].tobytes(), several[x:y].tobytes()))
    yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), _PACK)], schema=_PACK)


_REPLY = pa.schema([("pack", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])


def _counted(table: pa.Table) -> pa.Table:
    """Of one bucket, for each pack: the keys of its sets and how many of their unmarked lists turn out to be shared."""
    kind = table.column("postings").to_numpy()
    own, rest = table.filter(pa.array(~kind)), table.filter(pa.array(kind))
    replies = list(zip(*(own.column(n).to_pylist() for n in ("pack", "a", "b", "c"))))
    if len(rest):
        a, b, c = (rest.column(n).to_pylist() for n in ("a", "b", "c"))
        s, keys, marked = (np.concatenate([np.frombuffer(x, t) for x in col]) for col, t in ((a, np.int64), (b, np.int64), (c, np.bool_)))
        pack = np.repeat(rest.column("pack").to_numpy(), [len(x) // 8 for x in a])
        order = np.argsort(s, kind="stable")
        at = _starts(s[order])
        keys, marked, pack = keys[order], marked[order], pack[order]
        shared = np.logical_or.reduceat(marked, at) | (np.minimum.reduceat(keys, at) != np.maximum.reduceat(keys, at))
        tell = np.repeat(shared, np.diff(np.append(at, len(keys)))) & ~marked
        keys, pack = keys[tell], pack[tell]
        order = np.argsort(pack, kind="stable")
        keys, pack = keys[order], pack[order]
        edges = np.append(_starts(pack), len(pack))
        for x, y in zip(edges[:-1].tolist(), edges[1:].tolist()):
            told, counts = np.unique(keys[x:y], return_counts=True)
            replies.append((int(pack[x]), told.tobytes(), counts.astype(np.int32).tobytes(), None))
    return pa.table([pa.array(list(col), f.type) for col, f in zip(zip(*replies), _REPLY)], schema=_REPLY) if replies else _REPLY.empty_table()


def _enough(table: pa.Table) -> pa.Table:
    """The keys of one pack's sets that have as many shared lists as they need."""
    a, b, c = (table.column(n).to_pylist() for n in ("a", "b", "c"))
    own = next(i for i, x in enumerate(c) if x is not None)
    mine, need = np.frombuffer(a[own], np.int64), np.frombuffer(c[own], np.int32)
    order = np.argsort(mine)
    keys, counts = np.concatenate([np.frombuffer(x, np.int64) for x in a]), np.concatenate([np.frombuffer(x, np.int32) for x in b])
    total = np.bincount(np.searchsorted(mine[order], keys), weights=counts, minlength=len(mine))
    return pa.table({"k1": mine[order][total >= need[order]]})


def _each(run: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """``run``, a function of a group, followed by ``give_back`` once its own values have gone."""

    def wrapped(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            give_back()

    return wrapped


def _screened(docs: DataFrame, percent: int, shingles: int) -> DataFrame:
    """Keys (k1) of the sets that may have partners, copies apart."""
    buckets = max(1, -(-int(SCREEN * shingles) // POSTINGS))

    limit = np.int64(int(SCREEN * 2**64) - 2**63)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, turn, held, weight = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            parts, sizes, keys = zip(*held)
            return _packed([p for ps in parts for p in ps], np.concatenate(sizes), np.concatenate(keys), task, turn, percent, buckets)

        for batch in text_slices(batches, 0):
            sets = [s for s in shingle_sets(batch.column(0)) if len(s)]
            if sets:
                parts = [s[: np.searchsorted(s, limit)].copy() for s in sets]
                held.append((parts, np.array([len(s) for s in sets]), _keys(sets)))
                weight += sum(map(len, parts))
            if weight >= POSTINGS:
                yield from flush()
                turn, held, weight = turn + 1, [], 0
        if held:
            yield from flush()

    packs = docs.where(F.col("doc_id").cast("long").isNotNull()).select("text").mapInArrow(handing_back(run), "bucket int, pack long, postings boolean, a binary, b binary, c binary")
    replies = packs.groupBy("bucket").applyInArrow(_each(_counted), "pack long, a binary, b binary, c binary")
    return replies.groupBy("pack").applyInArrow(_each(_enough), "k1 long").distinct()


def _whole_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The keys and shingles of the texts of the given documents (a written table of rep)."""
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 0):
            sets = shingle_sets(batch.column(0))
            keys = _keys(sets)
            yield pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1]), _lists(sets)], schema=schema)

    keyed = docs.select(F.col("doc_id").cast("long").alias("rep"), "text")
    return keyed.join(sized(ids), "rep", "left_semi").select("text").mapInArrow(handing_back(run), "k1 long, k2 long, shingles array<long>")


def probed(found: int, wanted: np.ndarray, held: np.ndarray, need: int) -> bool:
    """Whether ``found`` and those of the ``wanted`` shingles that are in the sorted ``held`` reach ``need``.

    Shingles are looked up by binary search, some at a time; it ends as soon as
    the outcome is certain.
    """
    left = len(wanted)
    for at in range(0, left, PROBE):
        if found >= need or found + left < need or not len(held):
            break
        some = wanted[at : at + PROBE]
        place = np.searchsorted(held, some)
        found += int((held[np.minimum(place, len(held) - 1)] == some).sum())
        left -= len(some)
    return found >= need


def _probe(pairs: DataFrame) -> DataFrame:
    """Of pairs (a, b, found, need, wanted, held) those (a, b) that ``probed`` accepts."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = (batch.column(i).to_pylist() for i in (2, 3))
            keep = [probed(f, w, h, n) for f, n, w, h in zip(*numbers, _arrays(batch.column(4)), _arrays(batch.column(5)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], schema=schema).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "found", "need", "wanted", "held").mapInArrow(handing_back(run), "a long, b long")


def _least_shared(n: Column, percent: int) -> Column:
    """T of a set of n shingles."""
    return F.ceil(n * percent / 100)


def _needed(na: Column, nb: Column, percent: int) -> Column:
    """Shared shingles that two sets of na and nb need."""
    return F.ceil((na + nb) * percent / (100 + percent)).cast("int")


def _open_pair(percent: int) -> Column:
    """Whether sets a and b of na and nb shingles, with ma and mb open lists, may link and their groups ga and gb are not one yet."""
    return (F.col("ga") != F.col("gb")) & (F.least("ma", "mb") >= _needed(F.col("na"), F.col("nb"), percent))


def _ranks(turn: int) -> list[Column]:
    """Orders of the sets for a turn, as numbers: central ones first, by their mean list length, with some chance after the first turn."""
    chance = [F.lit(0.0)] if turn == 0 else [F.pmod(F.xxhash64("x", F.lit(turn * HEADS + i)), F.lit(1 << 20)) / (1 << 20) for i in range(HEADS)]
    return [F.shiftleft(((F.log2("c") + CHANCE * u) * -1e7).cast("long"), 32) + F.pmod(F.xxhash64("x", F.lit(turn)), F.lit(1 << 32)) for u in chance]


def _links_to_heads(lists: DataFrame, sets: DataFrame, turn: int, percent: int) -> tuple[DataFrame, int]:
    """Each set of ``lists`` (s, x, n, g, m, c) with the heads that most of its lists have, where they link and are of another group; and how many such pairs met."""
    ranks = _ranks(turn)
    ranked = lists.select("s", "x", *(r.alias(f"r{i}") for i, r in enumerate(ranks)))
    firsts = ranked.groupBy("s").agg(*(F.min(f"r{i}").alias(f"h{i}") for i in range(len(ranks))))
    met = lists.select("s", "x").join(firsts, "s").select("x", F.posexplode(F.array(*(f"h{i}" for i in range(len(ranks))))).alias("i", "r"))
    most = met.groupBy("x", "i", "r").count().groupBy("x", "i").agg(F.max_by("r", F.struct("count", "r")).alias("r"))
    members = cut(lists.groupBy("x").agg(F.first("n").alias("n"), F.first("g").alias("g"), F.first("c").alias("c"), F.first("m").alias("m")), "join-members")
    heads = members.select(F.col("x").alias("b"), F.col("n").alias("nb"), F.col("g").alias("gb"), F.col("m").alias("mb"), F.explode(F.array(*ranks)).alias("r"))
    mine = members.select(F.col("x").alias("a"), F.col("n").alias("na"), F.col("g").alias("ga"), F.col("m").alias("ma"))
    pairs = most.join(heads, "r").select(F.col("x").alias("a"), "b", "nb", "gb", "mb").join(mine, "a").where(_open_pair(percent))
    pairs = cut(pairs.select("a", "b", _needed(F.col("na"), F.col("nb"), percent).alias("need")).distinct(), "join-heads")
    one = sets.select(F.col("x").alias("a"), F.col("shingles").alias("wanted"))
    two = sets.select(F.col("x").alias("b"), F.col("shingles").alias("held"))
    links = cut(_probe(pairs.join(one, "a").join(two, "b").withColumn("found", F.lit(0))), "join-links")
    met = pairs.count()
    discard(pairs, members)
    return links, met


def _open_lists(lists: DataFrame, percent: int) -> DataFrame:
    """Of (s, x, n, g) the rows of lists with several groups, of sets with at least T of them.

    m is a set's number of such lists, and c their length for each of its shingles.
    """
    mixed = lists.groupBy("s").agg(F.min("g").alias("lo"), F.max("g").alias("hi"), F.count(F.lit(1)).alias("length")).where("lo < hi").select("s", "length")
    rows = cut(lists.select("s", "x", "n", "g").join(mixed, "s"), "join-lists")
    enough = rows.groupBy("x", "n").agg(F.count(F.lit(1)).alias("m"), (F.sum("length") / F.col("n")).alias("c")).where(F.col("m") >= _least_shared(F.col("n"), percent)).select("x", "m", "c")
    out = cut(rows.select("s", "x", "n", "g").join(enough, "x"), "join-lists")
    discard(rows)
    return out


def _regrouped(lists: DataFrame, links: DataFrame) -> DataFrame:
    labels = components(links).select(F.col("id").alias("x"), F.col("component").alias("label"))
    return lists.join(labels, "x", "left").select("s", "x", "n", F.coalesce("label", "x").alias("g"))


def _blocks(lists: DataFrame, weights: DataFrame) -> DataFrame:
    """gb, part and postings (s, x, n, m) of each block of the inverted lists of the groups in ``weights`` (g, parts); a set is in one block.

    Postings are dealt by group and block, so a large group is spread.
    """
    dealt = lists.select("s", "x", "n", "m", "g").join(sized(weights), "g").withColumn("part", F.pmod(F.xxhash64("x"), F.col("parts")))
    postings = F.sort_array(F.collect_list(F.struct("s", "x", "n", "m")))
    return dealt.groupBy(F.col("g").alias("gb"), "part").agg(postings.alias("postings"))


def first_link(postings: np.ndarray, na: int, ma: int, least: int, short: np.ndarray, long: np.ndarray, percent: int) -> int | None:
    """A set of a block that links to the set with the given lists, or None.

    ``postings`` has columns s, x, n and m, ordered by s. The short lists are
    merged by counting their sets; those with ``least`` occurrences or more are
    probed in the long lists.
    """
    s = postings[0]
    sets, first, owner = np.unique(postings[1], return_index=True, return_inverse=True)
    nb, mb = postings[2][first], postings[3][first]
    need = -(-(na + nb) * percent // (100 + percent))

    def occurrences(wanted: np.ndarray) -> np.ndarray:
        lo, hi = np.searchsorted(s, wanted, "left"), np.searchsorted(s, wanted, "right")
        length = hi - lo
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
        return np.bincount(owner[at], minlength=len(sets))

    found = occurrences(short) if len(short) else np.zeros(len(sets), np.int64)
    left = (found >= least) & (np.minimum(ma, mb) >= need)
    if not left.any():
        return None
    if (found + len(long) >= need)[left].any() and len(long):
        found = found + occurrences(long)
    links = np.flatnonzero(left & (found >= need))
    return int(sets[links[0]]) if len(links) else None


def _searched(pairs: DataFrame, percent: int) -> DataFrame:
    """Links (a, b), one at most for each row (a, na, ma, least, merge, wanted, postings)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = zip(*(batch.column(i).to_pylist() for i in range(5)))
            held = batch.column(6)
            fields = [f.to_numpy(zero_copy_only=False) for f in held.values.flatten()]
            ends = held.offsets.to_numpy()
            base = ends[0]
            fields = [f[base : ends[-1]] if len(f) != ends[-1] - base else f for f in fields]
            out = []
            for (a, na, ma, least, merge), wanted, lo, hi in zip(numbers, _arrays(batch.column(5)), ends - base, ends[1:] - base):
                b = first_link([f[lo:hi] for f in fields], na, ma, least, wanted[:merge], wanted[merge:], percent)
                if b is not None:
                    out.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(2)], schema=schema)

    return pairs.select("a", "na", "ma", "least", "merge", "wanted", "postings").mapInArrow(handing_back(run), "a long, b long")


def divide_skip(lists: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join all groups which have any, from the rows (s, x, n, g, m) of the inverted lists.

    Lists hold groups. Of two groups the sets of the smaller one (of equal
    ones, of that of lesser number) ask for the other, with which they share at
    least T = ceil(s * n). Groups that the merge of the short lists leaves are
    met in blocks, see ``first_link``: rows are sets times blocks, not sets times members.
    """
    sizes = lists.groupBy("g").agg(F.countDistinct("x").alias("k"))
    lists = lists.join(sizes, "g")
    index = lists.groupBy("s", "g", "k").agg(F.min("n").alias("nb"), F.max("m").alias("mb")).select("s", F.col("g").alias("gb"), F.col("k").alias("kb"), "nb", "mb")
    lengths = index.groupBy("s").count()
    ordered = lists.join(lengths, "s").groupBy("x", "n", "g", "k", "m").agg(F.sort_array(F.collect_list(F.struct("count", "s"))).alias("ls"))
    t = _least_shared(F.col("n"), percent).cast("int")
    aside = F.floor(F.col("t") / (LONG_COST * F.log2(F.element_at("ls", -1)["count"]) + 1)).cast("int")
    asking = ordered.withColumn("t", t).withColumn("aside", F.greatest(F.lit(0), F.least(F.col("t") - 1, aside)))
    asking = cut(asking.select("x", "n", "g", "k", "m", (F.col("t") - F.col("aside")).alias("least"), (F.size("ls") - F.col("aside")).alias("merge"), F.col("ls")["s"].alias("wanted")), "join-asking")
    query = asking.select(F.col("x").alias("a"), F.col("n").alias("na"), F.col("g").alias("ga"), F.col("k").alias("ka"), F.col("m").alias("ma"), "least", F.explode(F.slice("wanted", F.lit(1), F.col("merge"))).alias("s"))
    smaller = (F.col("ka") < F.col("kb")) | ((F.col("ka") == F.col("kb")) & (F.col("ga") < F.col("gb")))
    # The least size and the most open lists of the group's members stand for those of a partner.
    met = query.join(index, "s").where(smaller & _open_pair(percent))
    merged = cut(met.groupBy("a", "na", "ma", "gb", "least").count().where(F.col("count") >= F.col("least")).drop("count"), "join-merged")
    sought = cut(merged.select(F.col("gb").alias("g")).distinct(), "join-sought")
    weights = lists.groupBy("g").count().join(sized(sought), "g").select("g", F.ceil(F.col("count") / BLOCK).alias("parts"))
    weights = cut(weights, "join-weights")
    own = asking.select(F.col("x").alias("a"), "merge", "wanted")
    parts = sized(weights).select(F.col("g").alias("gb"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    links = cut(_searched(merged.join(own, "a").join(parts, "gb").join(_blocks(lists, weights), ["gb", "part"]), percent), "join-links")
    discard(asking, merged, sought, weights)
    return links


def similarity_join(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) of every row.

    Documents link when 100 * shared >= percent * united shingles. Documents
    without words link with nothing. Rows of one doc_id are one document, which
    links as any of its texts does; a null doc_id links with nothing and has no
    component. An empty table gives no rows.
    """
    rows = cut(_sizes(docs), "join-sizes")
    total = rows.agg(F.sum("n").alias("n")).first()["n"] or 0
    linkable = rows.where("n > 0 and doc_id is not null").groupBy("k1", "k2", "doc_id", "n").count()
    firsts = linkable.groupBy("k1", "k2", "n").agg(F.min(F.struct("doc_id", "count")).alias("f"))
    # Numbers of sets; they stay as they are once written.
    firsts = cut(firsts.select("k1", "k2", "n", F.col("f.doc_id").alias("rep"), (F.col("f.count") > 1).alias("repeated")).withColumn("x", F.monotonically_increasing_id()), "join-firsts")
    left = cut(firsts.join(_screened(docs, percent, total), "k1"), "join-screened")
    reps = cut(left.select("rep").distinct(), "join-reps")
    sets = _whole_sets(docs, reps).join(sized(left.select("k1", "k2", "x", "n")), ["k1", "k2"]).select("x", "n", "shingles")
    if not left.where("repeated").isEmpty():
        sets = sets.dropDuplicates(["x"])
    sets = cut(sets, "join-sets")

    lists = _open_lists(sets.select(F.explode("shingles").alias("s"), "x", "n", F.col("x").alias("g")), percent)
    links = None
    for turn in range(HEAD_TURNS):
        new, met = _links_to_heads(lists, sets, turn, percent)
        some = new.count()
        if not some:
            break
        links = new if links is None else links.unionByName(new)
        before, lists = lists, _open_lists(_regrouped(lists, links), percent)
        discard(before)
        if some < FEW * met:
            break
    rest = divide_skip(lists, percent)
    links = rest if links is None else links.unionByName(rest)

    if not linkable.groupBy("doc_id").count().where("count > 1").isEmpty():
        # Texts of one doc_id belong together.
        texts = linkable.join(firsts, ["k1", "k2"]).select("doc_id", "x")
        first = texts.groupBy("doc_id").agg(F.min("x").alias("a"))
        links = links.unionByName(texts.join(first, "doc_id").where("a < x").select("a", F.col("x").alias("b")))
    joined = components(links).join(firsts, F.col("id") == F.col("x"))
    least = joined.groupBy("component").agg(F.min("rep").alias("least"))
    labels = joined.join(least, "component").select("x", "least")
    named = firsts.join(labels, "x", "left").select("k1", "k2", F.coalesce("least", "rep").alias("label"))
    out = rows.join(named, ["k1", "k2"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
