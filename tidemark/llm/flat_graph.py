"""Near-duplicate embeddings by a pruned flat graph on overlapping cluster shards.

Vectors of one label are spread over overlapping shards around centres that
were fitted on a bounded sample. Each shard builds a graph: of a vector's
nearest neighbours those stay that no kept one makes redundant (robust
pruning). The adjacency lists of all shards are united, and every vector is
searched in its home shard: a beam walks from the medoid and from its own place
in the graph towards it, then the
range is expanded over the graph while neighbours stay near the threshold. In
the other blocks of a crowded shard it has no place, and a dense group around
the medoid would hold the walk, so there it is compared with every node.
Links are verified in double precision, and an audit compares the counts of
some vectors of every label with brute force. Labels of which too few were
found are searched wider, and at last compared in full, block against block.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, sized
from tidemark.llm.links import components

#: Rows of a shard that are aimed at; labels of no more rows have one shard.
SHARD_ROWS = 2500
#: Rows of a graph at most, and of queries in a task: a larger shard (one dense group, say) is dealt into blocks, and its queries meet every block.
BLOCK_ROWS = 8000
#: Rows that centres are fitted on, over all labels, and rows of the sample for a centre.
SAMPLE_ROWS, ROWS_PER_CENTRE = 20_000, 8
#: A vector joins every shard whose centre is at most this much less similar than its home's, and the second nearest.
MARGIN = 0.08
#: Neighbours considered, kept, and the slack of pruning.
POOL, DEGREE, ALPHA = 48, 20, 1.2
#: Width of the walk, and how far below the threshold the range is expanded.
BEAM, SLACK = 48, 0.04
#: Audited vectors that a label should have (about), and that are enough to judge a stratum of link counts by.
AUDIT_LEAST, STRATUM_LEAST = 20, 10
#: The recall that is asked for, and how often the search may be widened before a label is compared in full.
RECALL, WIDER = 0.95, 2


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = np.asarray(vectors, dtype=np.float64)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def fit_centres(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; centres that nearly coincide become one, so a dense ball is not torn."""
    centres = x[np.random.default_rng(7).choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        home = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, x)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), centres)
    kept: list[np.ndarray] = []
    for c in centres:
        if not kept or (np.stack(kept) @ c).max() < 0.9:
            kept.append(c)
    return np.stack(kept)


def build(x: np.ndarray) -> np.ndarray:
    """Adjacency of a shard: (rows, DEGREE) positions, -1 where there is none."""
    m = len(x)
    pool = min(POOL, m - 1)
    out = np.full((m, DEGREE), -1, dtype=np.int64)
    if pool < 1:
        return out
    block = max(1, min(256, 4_000_000 // m))
    for a in range(0, m, block):
        mine = x[a : a + block]
        sims = mine @ x.T
        sims[np.arange(len(mine)), np.arange(a, a + len(mine))] = -np.inf
        near = np.argpartition(-sims, pool - 1, axis=1)[:, :pool]
        order = np.argsort(-np.take_along_axis(sims, near, axis=1), axis=1, kind="stable")
        near = np.take_along_axis(near, order, axis=1)
        far = np.sqrt(np.maximum(2 - 2 * np.take_along_axis(sims, near, axis=1), 0))
        among = np.sqrt(np.maximum(2 - 2 * np.einsum("bid,bjd->bij", x[near], x[near]), 0))
        alive, rows = np.ones(near.shape, dtype=bool), np.arange(len(mine))
        for k in range(min(DEGREE, pool)):
            pick = alive.argmax(axis=1)
            some = alive[rows, pick]
            out[a + rows[some], k] = near[rows[some], pick[some]]
            alive &= ALPHA * among[rows, pick] > far
            alive[rows, pick] = False
    return out


def search(x: np.ndarray, graph: list[np.ndarray], queries: np.ndarray, own: np.ndarray, beam: int, threshold: float) -> list[np.ndarray]:
    """Positions of similarity ``threshold`` or more for each query vector, its own position (-1: none) left out."""
    m = len(x)
    medoid = int((x @ x.mean(axis=0)).argmax())
    width = max((len(g) for g in graph), default=0)
    table = np.full((m, max(1, width)), -1, dtype=np.int64)
    for i, g in enumerate(graph):
        table[i, : len(g)] = g
    found = []
    size = max(1, min(256, 8_000_000 // m))
    for a in range(0, len(queries), size):
        q, part = queries[a : a + size], own[a : a + size]
        n = len(q)
        seen, done, sims = np.zeros((n, m), dtype=bool), np.zeros((n, m), dtype=bool), np.full((n, m), -2.0)
        rows = np.arange(n)
        seen[:, medoid], sims[:, medoid] = True, q @ x[medoid]
        active = rows
        beams = np.full((n, beam), -1, dtype=np.int64)
        scores = np.full((n, beam), -2.0)
        beams[:, 0], scores[:, 0] = medoid, sims[:, medoid]
        # A vector that is a node too has its own list as a second way in.
        node_too = rows[part >= 0]
        if beam > 1:
            second = node_too[part[node_too] != medoid]
            beams[second, 1], scores[second, 1] = part[second], 1.0
        seen[node_too, part[node_too]], sims[node_too, part[node_too]] = True, 1.0
        while len(active):
            b, s = beams[active], scores[active]
            open_ = (b >= 0) & ~done[active[:, None], np.maximum(b, 0)]
            has = open_.any(axis=1)
            active, b, s, open_ = active[has], b[has], s[has], open_[has]
            if not len(active):
                break
            pick = np.where(open_, s, -3.0).argmax(axis=1)
            node = b[np.arange(len(active)), pick]
            done[active, node] = True
            next_ = table[node]
            new = (next_ >= 0) & ~seen[active[:, None], np.maximum(next_, 0)]
            value = np.where(new, np.einsum("bkd,bd->bk", x[np.maximum(next_, 0)], q[active]), -2.0)
            r, c = np.nonzero(new)
            seen[active[r], next_[r, c]] = True
            sims[active[r], next_[r, c]] = value[r, c]
            every, score = np.concatenate([b, np.where(new, next_, -1)], axis=1), np.concatenate([s, value], axis=1)
            top = np.argpartition(-score, beam - 1, axis=1)[:, :beam]
            beams[active], scores[active] = np.take_along_axis(every, top, axis=1), np.take_along_axis(score, top, axis=1)
        for i in range(n):
            expanded = done[i]
            while True:
                front = np.flatnonzero(seen[i] & ~expanded & (sims[i] >= threshold - SLACK))
                if not len(front):
                    break
                expanded[front] = True
                near = np.unique(table[front])
                near = near[near >= 0]
                near = near[~seen[i, near]]
                seen[i, near] = True
                sims[i, near] = x[near] @ q[i]
            hits = np.flatnonzero(sims[i] >= threshold)
            found.append(hits[hits != part[i]])
    return found


def compare(x: np.ndarray, queries: np.ndarray, own: np.ndarray, threshold: float) -> Iterator[np.ndarray]:
    """What ``search`` looks for, by comparison with every position."""
    size = max(1, 4_000_000 // len(x))
    for a in range(0, len(queries), size):
        near = queries[a : a + size] @ x.T >= threshold
        for row, me in zip(near, own[a : a + size]):
            hits = np.flatnonzero(row)
            yield hits[hits != me]


def _valid(vectors: DataFrame) -> DataFrame:
    e = F.col("embedding").cast("array<double>")
    good = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.coalesce(F.size(e) > 0, F.lit(False)) & F.coalesce(F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False)) & F.coalesce(F.exists(e, lambda v: v != 0), F.lit(False))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), e.alias("v")).where(good)


def near_duplicates(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id, kept and audit_recall of every row.

    audit_recall is the mean over audited vectors with links, 1 where none has any.

    Only vectors of one non-null label are compared. A vector that is null,
    empty or zero, or holds null or non-finite components, links with nothing,
    and so does one of another length. Equal vectors are searched once.
    Repeated rows are one vector; rows of one vec_id with different vectors are
    one too, which links as any of them does: ``n_links`` counts other
    vec_ids. A null vec_id links with nothing, has no
    component and is kept false; an empty table gives no rows.
    """
    # Groups of one label and length, under one text key.
    rows = _valid(vectors).distinct().withColumn("label", F.concat_ws("|", F.size("v"), "label"))
    rows = cut(rows, "graph-vectors")
    # ``rep`` numbers the distinct vectors; the numbers stay as they are once written.
    firsts = cut(rows.groupBy("label", "v").agg(F.count(F.lit(1)).alias("copies")).withColumn("rep", F.monotonically_increasing_id()), "graph-firsts")
    large = {r["label"]: r["n"] for r in firsts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SHARD_ROWS).collect()}  # at most rows / SHARD_ROWS entries
    centres: dict[str, np.ndarray] = {}
    if large:
        sample = firsts.where(F.col("label").isin(list(large))).orderBy(F.xxhash64("rep")).limit(SAMPLE_ROWS).select("label", "v").toPandas()
        for label, part in sample.groupby("label"):
            k = min(-(-large[label] // SHARD_ROWS), max(1, len(part) // ROWS_PER_CENTRE))
            centres[label] = fit_centres(unit(np.stack(part["v"])), k)

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for label, part in frame.groupby("label"):
                c = centres.get(label)
                if c is None or len(c) == 1:
                    yield part.assign(shard=0, home=True)
                    continue
                sims = unit(np.stack(part["v"])) @ c.T
                home = sims.argmax(axis=1)
                order = np.sort(sims, axis=1)
                near = sims >= np.minimum(order[:, -2], order[:, -1] - MARGIN)[:, None]
                r, s = np.nonzero(near)
                yield part.iloc[r].assign(shard=s, home=home[r] == s)

    placed = cut(firsts.select("label", "v", "rep", "copies").mapInPandas(assign, "label string, v array<double>, rep long, copies long, shard int, home boolean"), "graph-shards")
    crowded = cut(placed.groupBy("label", "shard").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks")).where("blocks > 1"), "graph-crowded")
    placed = placed.join(sized(crowded), ["label", "shard"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))

    def edges(frame: pd.DataFrame) -> pd.DataFrame:
        ids = frame["rep"].to_numpy()
        graph = build(unit(np.stack(frame["v"])))
        r, c = np.nonzero(graph >= 0)
        return pd.DataFrame({"label": frame["label"].iloc[0], "src": ids[r], "dst": ids[graph[r, c]]})

    found = cut(placed.groupBy("label", "shard", "block").applyInPandas(edges, "label string, src long, dst long"), "graph-edges")
    both = found.union(found.select("label", F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    lists = both.groupBy("label", F.col("src").alias("rep")).agg(F.collect_list("dst").alias("near"))
    members = cut(placed.join(lists, ["label", "rep"], "left"), "graph-lists")

    def counted(done: DataFrame) -> DataFrame:
        counts = done.groupBy("label", "rep").agg(F.sum("n_links").alias("n_links"))
        per_row = rows.join(firsts.drop("copies"), ["label", "v"]).select("label", "vec_id", "rep").join(counts, ["label", "rep"], "left")
        return cut(per_row.select("label", "vec_id", "rep", F.coalesce("n_links", F.lit(0)).alias("n_links")), "graph-counts")

    repeated = cut(rows.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("vec_id"), "graph-repeated")
    true = cut(true_links(rows, threshold).join(sized(repeated), "vec_id", "left_anti"), "audit-true")
    done = _search_all(members, BEAM, threshold)
    per_row = counted(done)
    recall, short = audit(true, per_row)
    for attempt in range(1, WIDER + 2):
        if short.isEmpty():
            break
        if attempt <= WIDER:
            again = _search_all(members.join(sized(short), "label", "left_semi"), BEAM << (2 * attempt), threshold)
        else:
            # All of a label as one shard, so that its shards meet too.
            whole = firsts.join(sized(short), "label", "left_semi")
            blocks = cut(whole.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks")), "graph-whole")
            whole = whole.join(sized(blocks), "label").withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
            again = _search_all(whole.select("*", F.lit(0).alias("shard"), F.lit(True).alias("home"), F.lit(None).cast("array<long>").alias("near")), None, threshold)
        done = done.join(sized(short), "label", "left_anti").unionByName(again)
        per_row = counted(done)
        recall, short = audit(true, per_row)
    stars = done.where("rep <> head").select(F.col("rep").alias("a"), F.col("head").alias("b")).distinct()
    # Vectors of one vec_id belong together; then every component is named by its least vec_id.
    own = per_row.join(per_row.groupBy("vec_id").agg(F.min("rep").alias("b")), "vec_id").where("rep <> b").select(F.col("rep").alias("a"), "b")
    labels = components(own.unionByName(stars))
    named = per_row.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("vec_id", F.coalesce("component", "rep").alias("c"))
    component = named.join(named.groupBy("c").agg(F.min("vec_id").alias("component")), "c").groupBy("vec_id").agg(F.min("component").alias("component"))
    counts = per_row.groupBy("vec_id").agg(F.sum("n_links").alias("n_links"))
    if not repeated.isEmpty():
        counts = _by_partner(rows, repeated, counts, threshold)
    out = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).join(counts, "vec_id", "left").join(component, "vec_id", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"), F.lit(float(recall)).alias("audit_recall"))


def _by_partner(rows: DataFrame, repeated: DataFrame, counts: DataFrame, threshold: float) -> DataFrame:
    """``counts`` (vec_id, n_links) with every partner counted once, where some vec_ids have several vectors.

    The links of these are listed by comparison: one of them counts its
    partners, and the others count each of them once instead of once a vector.
    """
    asked = rows.join(sized(repeated), "vec_id")
    pairs = cut(_pairs(asked, rows, threshold).where("q <> p"), "graph-pairs")
    both = pairs.distinct()
    theirs = both.groupBy(F.col("q").alias("vec_id")).agg(F.count(F.lit(1)).alias("n_links"))
    more = pairs.groupBy("p").agg(F.count(F.lit(1)).alias("all")).join(both.groupBy("p").agg(F.count(F.lit(1)).alias("once")), "p").select(F.col("p").alias("vec_id"), (F.col("all") - F.col("once")).alias("more"))
    single = counts.join(sized(repeated), "vec_id", "left_anti").join(more, "vec_id", "left")
    return single.select("vec_id", (F.col("n_links") - F.coalesce("more", F.lit(0))).alias("n_links")).unionByName(theirs)


def _pairs(asked: DataFrame, rows: DataFrame, threshold: float) -> DataFrame:
    """(q, p) for each vector of ``asked`` and each of ``rows`` of its label that are linked, block against block."""
    sizes = rows.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks")).join(asked.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("parts")), "label")
    sizes = sized(cut(sizes, "pairs-sizes"))
    key = ["label", "block", "part"]
    nodes = rows.join(sizes, "label").withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), "blocks").cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    queries = asked.join(sizes, "label").withColumn("part", F.pmod(F.xxhash64("vec_id", "v"), "parts").cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    every = nodes.select(*key, "vec_id", "v", F.lit(True).alias("node")).unionByName(queries.select(*key, "vec_id", "v", F.lit(False).alias("node")))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        held, wanted = frame[frame["node"]], frame[~frame["node"]]
        out = []
        if len(held) and len(wanted):
            x, ids = unit(np.stack(held["v"])), held["vec_id"].to_numpy()
            near = compare(x, unit(np.stack(wanted["v"])), np.full(len(wanted), -1), threshold)
            out = [pd.DataFrame({"q": i, "p": ids[hits]}) for i, hits in zip(wanted["vec_id"], near)]
        return pd.concat(out) if out else pd.DataFrame({"q": pd.Series(dtype="int64"), "p": pd.Series(dtype="int64")})

    return every.groupBy(*key).applyInPandas(run, "q long, p long")


def _search_all(members: DataFrame, beam: int | None, threshold: float) -> DataFrame:
    """label, rep, n_links and head: parts of the link counts of all distinct vectors, and links (rep, head) enough to join what was found.

    Without a beam nothing is walked, and all are compared. A task has the nodes of one block and one part of the shard's home vectors as queries.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        nodes, asked = frame[frame["node"]], frame[~frame["node"]]
        if not len(nodes) or not len(asked):
            return pd.DataFrame({"label": pd.Series(dtype="str"), "rep": pd.Series(dtype="int64"), "n_links": pd.Series(dtype="int64"), "head": pd.Series(dtype="int64")})
        ids, copies, queries = nodes["rep"].to_numpy(), nodes["copies"].to_numpy(), asked["rep"].to_numpy()
        x, at = unit(np.stack(nodes["v"])), {v: i for i, v in enumerate(ids)}
        own = np.array([at.get(v, -1) for v in queries])
        at_home, vectors, walks = (own >= 0) & (beam is not None), unit(np.stack(asked["v"])), []
        if beam is not None:
            graph = [np.array([at[d] for d in near if d in at], dtype=np.int64) if near is not None else np.zeros(0, np.int64) for near in nodes["near"]]
            walks = search(x, graph, vectors[at_home], own[at_home], min(beam, len(x)), threshold)
        hits = chain(zip(np.flatnonzero(at_home), walks), zip(np.flatnonzero(~at_home), compare(x, vectors[~at_home], own[~at_home], threshold)))
        # Labels of all ids here, each group by its least id.
        every = np.concatenate([ids, queries])
        label = every.copy()
        label[len(ids) :][own >= 0] = ids[own[own >= 0]]
        counts = np.zeros(len(queries), dtype=np.int64)
        for q, near in hits:
            counts[q] = copies[near].sum() + (copies[own[q]] - 1 if own[q] >= 0 else 0)
            mine = label[own[q]] if own[q] >= 0 else label[len(ids) + q]
            if (label[near] != mine).any():
                groups = np.append(np.unique(label[near]), mine)
                label[np.isin(label, groups)] = groups.min()
        label[len(ids) :][own >= 0] = label[own[own >= 0]]
        return pd.DataFrame({"label": frame["label"].iloc[0], "rep": every, "n_links": np.concatenate([np.zeros(len(ids), np.int64), counts]), "head": label})

    key = ["label", "shard", "block", "part"]
    parts = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    nodes = members.withColumn("part", parts).select(*key, "rep", "copies", "v", "near", F.lit(True).alias("node"))
    asked = members.where("home").withColumn("part", F.pmod(F.xxhash64("rep", F.lit(1)), "blocks").cast("int")).drop("block").withColumn("block", parts)
    asked = asked.select(*key, "rep", "copies", "v", F.lit(None).cast("array<long>").alias("near"), F.lit(False).alias("node"))
    return cut(nodes.unionByName(asked).groupBy(*key).applyInPandas(run, "label string, rep long, n_links long, head long"), "graph-found")


def true_links(rows: DataFrame, threshold: float) -> DataFrame:
    """label, vec_id and n of the audited vectors that have links, by brute force.

    Audited are all vectors whose vec_id is divisible by 100, and in labels
    with few of those about ``AUDIT_LEAST`` others, picked by hash. A task has
    one block of them and one of the label's rows.
    """
    hundredth, few = F.col("vec_id") % 100 == 0, F.col("picked") < AUDIT_LEAST
    sizes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n_all"), F.count(F.when(hundredth, 1)).alias("picked"))
    sizes = cut(sizes.select("*", F.ceil(F.col("n_all") / BLOCK_ROWS).cast("int").alias("blocks"), F.ceil((F.col("picked") + AUDIT_LEAST) / BLOCK_ROWS).cast("int").alias("parts")), "audit-sizes")
    every = rows.join(sized(sizes), "label").withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int")).withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(1)), "parts").cast("int"))
    picked = every.where(hundredth | (few & (F.pmod(F.xxhash64("vec_id", F.lit(2)), "n_all") < AUDIT_LEAST)))
    key = ["label", "block", "part"]
    nodes = every.drop("part").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(*key, "vec_id", "v", F.lit(True).alias("node"))
    asked = picked.drop("block").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(*key, "vec_id", "v", F.lit(False).alias("node"))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        nodes, asked = frame[frame["node"]], frame[~frame["node"]]
        counts = np.zeros(len(asked), dtype=np.int64)
        if len(nodes) and len(asked):
            x, mine, ids = unit(np.stack(nodes["v"])), nodes["vec_id"].to_numpy(), asked["vec_id"].to_numpy()
            near = compare(x, unit(np.stack(asked["v"])), np.full(len(asked), -1), threshold)
            counts[:] = [int((mine[hits] != i).sum()) for i, hits in zip(ids, near)]
        return pd.DataFrame({"label": frame["label"].iloc[0], "vec_id": asked["vec_id"].to_numpy(), "n": counts})

    found = nodes.unionByName(asked).groupBy(*key).applyInPandas(run, "label string, vec_id long, n long")
    return cut(found.groupBy("label", "vec_id").agg(F.sum("n").alias("n")).where("n > 0"), "audit-true")


def audit(true: DataFrame, counts: DataFrame) -> tuple[float, DataFrame]:
    """Mean share of its links that an audited vector has, and the labels that fall short.

    Each vector counts once, however many links it has, and links that are not there count against it. A label falls short by
    its mean, or by the mean of one stratum of link counts (from a power of
    two to the next), so a dense group cannot hide what others lost.
    """
    found = true.join(counts.groupBy("label", "vec_id").agg(F.sum("n_links").alias("k")), ["label", "vec_id"])
    strata = found.groupBy("label", F.floor(F.log2("n")).alias("stratum")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.greatest(F.lit(0.0), 1 - F.abs(F.col("n") - F.col("k")) / F.col("n"))).alias("r"))
    judged = F.min(F.when(F.col("n") >= STRATUM_LEAST, F.col("r") / F.col("n")))
    labels = cut(strata.groupBy("label").agg(judged.alias("least"), F.sum("n").alias("n"), F.sum("r").alias("r")), "audit-labels")
    total = labels.agg(F.sum("n").alias("n"), F.sum("r").alias("r")).first()
    short = cut(labels.where(F.least("least", F.col("r") / F.col("n")) < RECALL).select("label"), "audit-short")
    return (total["r"] / total["n"] if total["n"] else 1.0), short
