"""Repair of the turn structure of conversations by a dynamic programme over the turns that stay.

A conversation should be ``(s?(ua)+)?`` by the initials of its roles. Edits: keep a
turn (0), give it the role user or assistant (2), delete it (3; blank and repeated turns must
go), insert an empty user or assistant turn (2); a truncated turn that stays adds 1.

The programme is over retained turns. Between two of them lies a gap: its deletions
cost a difference of prefix sums, and its insertions depend on the two roles
alone. So the cheapest way on from any place, by the role that was retained last, is a
running minimum for each role of the next retained turn. Of equally cheap repairs
the one counts whose letters (D, I, K, R, in order) are least.

Conversations may be of any length. All turns are put in order by a range
shuffle and get a position. A conversation falls into stretches of at most
``STRETCH`` turns, for which only a letter a turn is gathered. What a stretch costs
from each role to each role is a 4 x 4 matrix; these are chained over a conversation
from its end, then each stretch is solved on its own. The repaired turns are read
as a stream in order, in which no conversation is held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut

#: Turns of a stretch that one task solves at a time.
STRETCH = 1 << 16
# What edits cost.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
# White space of the contract, and the marks that end a whole text.
BLANKS, ENDS = " \t\n\x0b\x0c\r", ".!?"

#: Roles by which a state goes: none retained yet, then s, u, a.
_NONE, _S, _U, _A = range(4)
_ROLE = {_U: "user", _A: "assistant"}
_FAR = 1 << 60
#: Insertions between a retained role (row) and the next (column s, u, a), and before the end.
_BETWEEN = [[0, 0, 1], [_FAR, 0, 1], [_FAR, 1, 0], [_FAR, 0, 1]]
_AT_END = [0, 2 * INSERT, INSERT, 0]
#: The role that an insertion after each state has.
_INSERTED = [_U, _U, _A, _U]
#: Faults of a turn, as they count.
_FINE, _BLANK, _REPEATED, _CUT_OFF = range(4)


def damage(conversations: DataFrame) -> DataFrame:
    """The conversations damaged by the hash of ``conv_id:turn``; a null counts as one blank there, and in role and text.

    Of 20 rests, 0 drops a row, 1 empties its text, 2 removes its marks, 3 repeats it, and 4 makes its role user.
    """
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    key = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), shown("role").alias("role"), shown("text").alias("text"), key.alias("k")).where("k <> 0")
    text = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    copies = F.when(F.col("k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(F.col("k") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def ordered(turns: DataFrame) -> DataFrame:
    """All turns with ``pos``, which rises by conversation, turn (null first), role and the text's digest, and their fault.

    One range shuffle by all of these, so a conversation of any size is spread over tasks.
    """
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    keyed = turns.select("conv_id", "turn", role.alias("role"), text.alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    order = ["conv_id", "turn", "role", "digest"]
    placed = keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("pos", F.monotonically_increasing_id())
    return cut(placed, "turns")


def _letters(placed: DataFrame) -> DataFrame:
    """conv_id, pos and ``code`` of each turn: a letter for its initial and its fault.

    The first place of a role and text in its conversation comes from an
    aggregate, combined before the shuffle, so a turn that fills its conversation is no hot key.
    """
    left = F.rtrim("text", F.lit(BLANKS))
    firsts = placed.groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("digest").alias("_d"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("digest") == F.col("_d"))
    facts = placed.select("conv_id", "pos", "role", "digest", (left == "").alias("blank"), (~F.right(left, F.lit(1)).isin(*ENDS)).alias("cut_off"))
    fault = F.when(F.col("blank"), _BLANK).when(F.col("pos") > F.col("first"), _REPEATED).when(F.col("cut_off"), _CUT_OFF).otherwise(_FINE)
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", _S).when(first == "u", _U).when(first == "a", _A).otherwise(_NONE)
    return facts.join(firsts, same, "left").select("conv_id", "pos", F.char(F.lit(97) + initial * 4 + fault).alias("code"))


def _stretches(letters: DataFrame) -> DataFrame:
    """conv_id, pos (of the first turn) and codes of each stretch of a conversation."""
    near = F.floor(F.col("pos") / STRETCH).alias("near")
    turns = F.sort_array(F.collect_list(F.struct("pos", "code")))
    return letters.groupBy("conv_id", near).agg(turns.alias("t")).select("conv_id", F.col("t")[0]["pos"].alias("pos"), F.array_join(F.transform("t", lambda t: t["code"]), "").alias("codes"))


def _ways(code: str) -> list[tuple[int, int]]:
    """(role, cost) of each way to retain a turn."""
    initial, fault = divmod(ord(code) - 97, 4)
    if fault in (_BLANK, _REPEATED):
        return []
    more = TRUNCATED if fault == _CUT_OFF else 0
    kept = [(initial, KEEP + more)] if initial != _NONE else []
    return kept + [(role, REROLE + more) for role in (_U, _A) if role != initial]


_WAYS = {chr(97 + k): _ways(chr(97 + k)) for k in range(16)}


def onward(codes: str, end: list[int]) -> list[tuple[int, int, int, int]]:
    """The least cost from each place on (the end last), by the role retained last, if ``end`` has those at the end.

    From right to left: retaining turn k in role r costs its own cost and what follows; with the
    deletions before k added, the running minimum for r prices every gap that ends in r.
    """
    n = len(codes)
    best = [_FAR] * 4  # by the next retained role, deletions before it counted from the start
    out = [tuple(end)]
    for k in range(n - 1, -1, -1):
        after, before = out[-1], DELETE * k
        for role, cost in _WAYS[codes[k]]:
            best[role] = min(best[role], before + cost + after[role])
        rest = DELETE * (n - k)
        _, s, u, a = best
        out.append(tuple(min(rest + end[q], s - before + INSERT * i, u - before + INSERT * j, a - before + INSERT * m) for q, (i, j, m) in enumerate(_BETWEEN)))
    out.reverse()
    return out


def edits(codes: str, state: int, end: list[int]) -> tuple[str, int]:
    """The least of the cheapest edits of a stretch that is entered in ``state``, and the state at its end."""
    cost, out = onward(codes, end), []
    for k, code in enumerate(codes):
        while True:
            left = cost[k][state]
            if DELETE + cost[k + 1][state] == left:
                out.append("D")
                break
            new = _INSERTED[state]
            if INSERT + cost[k][new] == left:
                out.append("I")
                state = new
                continue
            initial = (ord(code) - 97) // 4
            allowed = [(role != initial, role) for role, own in _WAYS[code] if own + cost[k + 1][role] == left and _BETWEEN[state][role - 1] == 0]
            changed, state = min(allowed)
            out.append("R" if changed else "K")
            break
    return "".join(out), state


def last_edits(state: int) -> str:
    """Insertions after the last turn."""
    return "I" * (_AT_END[state] // INSERT)


def _map(df: DataFrame, ddl: str, schema: pa.Schema, rows: Callable[..., list[tuple]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [r for values in zip(*(c.to_pylist() for c in batch.columns)) for r in rows(*values)]
            columns = list(zip(*made)) if made else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(list(v), f.type) for v, f in zip(columns, schema)], schema=schema)

    return df.mapInArrow(run, ddl)


def _solved(stretches: DataFrame) -> DataFrame:
    """Of each stretch: conv_id, pos, codes, the edits from each role on, and the cost from here to the conversation's end."""

    def matrix(conv_id: int | None, pos: int, codes: str) -> list[tuple]:
        columns = [onward(codes, [0 if q == r else _FAR for q in range(4)])[0] for r in range(4)]
        return [(conv_id, pos, [columns[r][q] for q in range(4) for r in range(4)])]

    def chained(parts: list[dict]) -> list[tuple]:
        end, out = list(_AT_END), []
        for part in reversed(parts):
            m = part["matrix"]
            first = part is parts[0]
            here = [min(m[4 * q + r] + end[r] for r in range(4)) for q in range(4)]
            out.append((part["pos"], first, end, here[_NONE]))
            end = here
        return out

    def solve(conv_id: int | None, pos: int, codes: str, first: bool, end: list[int], cost: int) -> list[tuple]:
        return [(conv_id, pos, codes, [edits(codes, q, end)[0] for q in range(1 if first else 4)], cost if first else 0)]

    matrices = _map(stretches.select("conv_id", "pos", "codes"), "conv_id long, pos long, matrix array<long>", pa.schema([("conv_id", pa.int64()), ("pos", pa.int64()), ("matrix", pa.list_(pa.int64()))]), matrix)
    chains = matrices.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "matrix"))).alias("parts")).select("parts")
    ends = _map(chains, "pos long, first boolean, end array<long>, cost long", pa.schema([("pos", pa.int64()), ("first", pa.bool_()), ("end", pa.list_(pa.int64())), ("cost", pa.int64())]), chained)
    schema = pa.schema([("conv_id", pa.int64()), ("pos", pa.int64()), ("codes", pa.string()), ("edits", pa.list_(pa.string())), ("cost", pa.int64())])
    return _map(stretches.join(ends, "pos").select("conv_id", "pos", "codes", "first", "end", "cost"), "conv_id long, pos long, codes string, edits array<string>, cost long", schema, solve)


class _Conversation:
    """What is known of the conversation that a stream is in."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.state, self.codes, self.edits, self.at = conv_id, _NONE, "", "", 0
        self.faults, self.illegal, self.before, self.cost = [0, 0, 0, 0], 0, None, 0
        self.turns, self.low, self.high, self.turn = 0, None, None, None
        self.audit: list[str] = []
        self.hash, self.lines = hashlib.sha256(), 0

    def stretch(self, codes: str, ways: list[str], cost: int) -> None:
        self.codes, self.edits, self.at = codes, ways[self.state if len(ways) > 1 else 0], 0
        self.audit.append(self.edits)
        self.cost += cost
        for code in codes:
            initial, fault = divmod(ord(code) - 97, 4)
            self.faults[fault] += 1
            if self.before is not None and (self.before, initial) not in ((_S, _U), (_U, _A), (_A, _U)):
                self.illegal += 1
            self.before = initial
        self.code_at = 0

    def row(self, turn: int | None, role: str, text: str) -> list[tuple[str, str, str]]:
        """The repaired turns that a turn leads to: (edit, role, text)."""
        if turn is not None and (self.turns == 0 or turn != self.turn):
            self.turns, self.turn = self.turns + 1, turn
            self.low = turn if self.low is None else self.low
            self.high = turn
        out = []
        while self.edits[self.at] == "I":
            out.append(self._inserted())
            self.at += 1
        edit, code = self.edits[self.at], self.codes[self.code_at]
        self.at, self.code_at = self.at + 1, self.code_at + 1
        if edit == "D":
            return out
        if edit == "R":
            role = _ROLE[_INSERTED[self.state]]
            self.state = _INSERTED[self.state]
        else:
            self.state = (ord(code) - 97) // 4
        return [*out, (edit, role, text)]

    def _inserted(self) -> tuple[str, str, str]:
        self.state = _INSERTED[self.state]
        return "I", _ROLE[self.state], ""

    def close(self) -> list[tuple[str, str, str]]:
        last = last_edits(self.state)
        self.audit.append(last)
        return [self._inserted() for _ in last]

    def take(self, lines: list[tuple[str, str, str]]) -> None:
        for _, role, text in lines:
            self.hash.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
            self.lines += 1

    def digest(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return self.conv_id, gaps, self.faults[_BLANK], self.faults[_REPEATED], self.faults[_CUT_OFF], self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest()


def _stream(turns: DataFrame, every: Column | str) -> DataFrame:
    """Headers, solved stretches and turns of every conversation, in this order and by position, in one partition each.

    Digests and texts of a conversation are one value, which nothing can make in
    parts; it goes by as a stream, so its length costs time and no memory.
    """
    placed = ordered(turns)
    solved = _solved(cut(_stretches(_letters(placed)), "stretches"))
    none = lambda kind: F.lit(None).cast(kind)
    heads = every.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().select("conv_id", F.lit(-1).cast("long").alias("pos"), F.lit(0).alias("kind"), none("string").alias("codes"), none("array<string>").alias("edits"), none("long").alias("cost"), none("long").alias("turn"), none("string").alias("role"), none("string").alias("text"))
    parts = solved.select("conv_id", "pos", F.lit(1).alias("kind"), "codes", "edits", "cost", none("long").alias("turn"), none("string").alias("role"), none("string").alias("text"))
    rows = placed.select("conv_id", "pos", F.lit(2).alias("kind"), none("string").alias("codes"), none("array<string>").alias("edits"), none("long").alias("cost"), "turn", "role", "text")
    return heads.unionByName(parts).unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "pos", "kind")


def _told(stream: DataFrame, ddl: str, schema: pa.Schema, lines: Callable, close: Callable) -> DataFrame:
    """Rows that ``lines`` makes of the repaired turns as they come, and ``close`` of a conversation at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Conversation | None = None
        for batch in batches:
            out: list[tuple] = []
            for conv_id, _, kind, codes, ways, cost, turn, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 0:
                    if held is not None:
                        out += close(held)
                    held = _Conversation(conv_id)
                elif kind == 1:
                    held.stretch(codes, ways, cost)
                else:
                    out += lines(held, held.row(turn, role, text))
            yield _batch(out, schema)
        if held is not None:
            yield _batch(close(held), schema)

    return stream.mapInArrow(run, ddl)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(v), f.type) for v, f in zip(columns, schema)], schema=schema)


_DIGEST = pa.schema([("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])
_DIGEST_DDL = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_TURN = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])


def repair(turns: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (gapless from 0), edit (K, R or I), role and text.

    A null role or text is one blank: such a text is blank and goes, such a role has to be
    replaced. An empty role has no initial and can't be kept. Of equal turns
    numbers the order is by role, then by the digest of the text. Turns without conv_id are one conversation.
    """

    def lines(held: _Conversation, made: list[tuple[str, str, str]]) -> list[tuple]:
        first = held.lines
        held.lines += len(made)
        return [(held.conv_id, first + k, edit, role, text) for k, (edit, role, text) in enumerate(made)]

    return _told(_stream(turns, turns), "conv_id long, place long, edit string, role string, text string", _TURN, lines, lambda held: lines(held, held.close()))


def digests(turns: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """A row for each conversation of ``every`` (the turns themselves by default): its faults, and the cost, edits and digest of its repair.

    Rows as in ``repair``. A conversation of ``every`` without turns has zeros, no edits and the digest of an empty text.
    """

    def lines(held: _Conversation, made: list[tuple[str, str, str]]) -> list[tuple]:
        held.take(made)
        return []

    def close(held: _Conversation) -> list[tuple]:
        held.take(held.close())
        return [held.digest()]

    return _told(_stream(turns, turns if every is None else every), _DIGEST_DDL, _DIGEST, lines, close)
