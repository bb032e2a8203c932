"""Packing documents into token sequences of near-equal fill by Karmarkar-Karp differencing.

Documents are encoded where they are read. Their ids form one stream in each
task, which is cut into groups of ``GROUP_WINDOWS`` windows' worth of tokens;
a group is packed as soon as it is there. So a task holds one group, nothing is
shuffled, and no key, source or document can make one task's work grow.

Within a group, documents are cut into pieces of at most ``PIECES[0]`` tokens.
Every piece starts as a partial partition with one loaded window; the two
partitions of largest imbalance are merged again and again, the fullest windows
of one with the emptiest of the other, until one partition of near-equal windows
is left. If a window exceeds the capacity, pieces are cut more finely, and then
the number of windows rises until all fit.

A group takes ``SLACK`` tokens less for each window than there is room for. What
a task has left at its end, less than a window, is cut into sequences whose lengths are
powers of two, which need no padding.
"""

from __future__ import annotations

import heapq
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_slices
from tidemark.llm.dac_codes import piece_memo

#: Tokens of a sequence.
CAPACITY = 4096
#: Windows of a full group, and the tokens that each of them leaves free on average.
GROUP_WINDOWS, SLACK = 256, 12
#: Longest pieces at first and after each failure, and the number of pieces beyond which windows are added instead.
PIECES, MOST_PIECES = (512, 256, 64, 16, 4, 1), 20_000


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """The indexes of ``sizes`` in each of ``windows`` windows of near-equal sums.

    A partial partition is its window loads in falling order, less the least of
    them; windows beyond those listed are empty. Members hang together as a
    binary tree, so merging costs no more than the number of windows.
    """
    heap = [(-s, i, (s,), (i,)) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    for number in count(len(sizes)):  # ties go to the older partition
        if len(heap) <= 1:
            break
        _, _, one, ours = heapq.heappop(heap)
        _, _, two, theirs = heapq.heappop(heap)
        free = windows - len(one) - len(two)
        if free >= 0:  # no window of one need meet a window of the other
            loads, members = [*one, *two], [*ours, *theirs]
        else:
            clash = -free  # the emptiest listed windows of one meet those of the other, in opposite order
            cut, other = len(one) - clash, len(two) - clash
            loads = [*one[:cut], *two[:other], *(a + b for a, b in zip(one[cut:], reversed(two[other:])))]
            members = [*ours[:cut], *theirs[:other], *zip(ours[cut:], reversed(theirs[other:]))]
        order = sorted(range(len(loads)), key=loads.__getitem__, reverse=True)
        least = loads[order[-1]] if len(loads) == windows else 0
        loads, members = tuple(loads[i] - least for i in order), tuple(members[i] for i in order)
        heapq.heappush(heap, (-loads[0], number, loads, members))
    return [_flat(m) for m in (heap[0][3] if heap else ())]


def _flat(tree) -> list[int]:
    out, stack = [], [tree]
    while stack:
        node = stack.pop()
        if isinstance(node, tuple):
            stack.extend(node)
        else:
            out.append(node)
    return sorted(out)


def _cut(runs: list[tuple[int, int]], longest: int) -> list[tuple[int, int]]:
    """Runs (from, to) cut into pieces of at most ``longest``."""
    return [(a, min(a + longest, end)) for start, end in runs for a in range(start, end, longest)]


def pack_windows(runs: list[tuple[int, int]], capacity: int = CAPACITY, slack: int = SLACK) -> list[list[tuple[int, int]]]:
    """Windows of pieces (from, to) of the given runs of tokens, one run a document, in rising order.

    Whole windows' worth of tokens are balanced by differencing; the rest, from
    the end, makes windows whose lengths are powers of two.
    """
    total = sum(b - a for a, b in runs)
    windows = total // (capacity - slack)
    main, rest = _split(runs, windows * (capacity - slack))
    out = []
    if windows:
        for k, parts in _tries(main, windows):
            packed = difference([b - a for a, b in parts], k)
            if all(sum(parts[i][1] - parts[i][0] for i in w) <= capacity for w in packed):
                out = [[parts[i] for i in w] for w in packed]
                break
    left = sum(b - a for a, b in rest)
    while left:
        power = 1 << (left.bit_length() - 1)
        window, rest = _split(rest, power)
        out.append(window)
        left -= power
    return [_joined(w) for w in out]


def _tries(runs: list[tuple[int, int]], windows: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """Numbers of windows and pieces in the order in which they are tried: finer pieces, then more windows."""
    parts = _cut(runs, PIECES[0])
    yield windows, parts
    for longest in PIECES[1:]:
        finer = _cut(runs, longest)
        if len(finer) > MOST_PIECES:
            break
        parts = finer
        yield windows, parts
    for k in count(windows + 1):
        yield k, parts


def _split(runs: list[tuple[int, int]], at: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Runs of the first ``at`` tokens, and of the others."""
    first, others = [], []
    for a, b in runs:
        n = min(b - a, at)
        at -= n
        if n:
            first.append((a, a + n))
        if a + n < b:
            others.append((a + n, b))
    return first, others


def _joined(pieces: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Neighbouring pieces made one; runs of two documents never touch."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(pieces):
        if out and out[-1][1] == a:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


_FIELDS = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class _Group:
    """Parts of documents that wait to be packed."""

    def __init__(self):
        self.parts: list[tuple[int | None, int, int, np.ndarray]] = []
        self.tokens = 0

    def add(self, key: int | None, start: int, doc_tokens: int, ids: np.ndarray) -> None:
        self.parts.append((key, start, doc_tokens, ids))
        self.tokens += len(ids)

    def rows(self, sequence: int, with_ids: bool) -> tuple[list[list], int]:
        """Columns of the packed pieces, and the number of sequences."""
        # Between two parts a place stays free, so that pieces of different documents are no neighbours.
        begins, at = [], 0
        for _, _, _, ids in self.parts:
            begins.append(at)
            at += len(ids) + 1
        windows = pack_windows([(b, b + len(p[3])) for b, p in zip(begins, self.parts)])
        out: list[list] = [[] for _ in range(len(_FIELDS) + with_ids)]
        for k, window in enumerate(windows):
            offset = 0
            for a, b in window:
                which = bisect_right(begins, a) - 1
                key, start, doc_tokens, ids = self.parts[which]
                held = ids[a - begins[which] : b - begins[which]].tobytes()
                row = [key, start + a - begins[which], b - a, zlib.crc32(held), doc_tokens, sequence + k, offset]
                for column, value in zip(out, [*row, held] if with_ids else row):
                    column.append(value)
                offset += b - a
        return out, len(windows)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, with_ids: bool = False) -> DataFrame:
    """The pieces of all ``docs`` (doc_id, text) in sequences of at most ``CAPACITY`` tokens.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset,
    and with ``with_ids`` the ids of each piece (little-endian unsigned 32-bit).
    A null or empty text is just the end id; every row is a document of its own,
    also where rows are equal or have no doc_id. Sequence ids tell the task that
    made them and do not follow each other without gaps. A text is held whole; a
    very long one is spread over several groups.
    """
    schema = pa.schema([*_FIELDS, *([("ids", pa.binary())] if with_ids else [])])
    room = GROUP_WINDOWS * (CAPACITY - SLACK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        memo, end = piece_memo(tokenizer_path), array("I", [end_id]).tobytes()
        sequence, group = TaskContext.get().partitionId() << 40, _Group()

        def packed() -> pa.RecordBatch:
            nonlocal sequence, group
            columns, n = group.rows(sequence, with_ids)
            sequence, group = sequence + n, _Group()
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, schema)], schema=schema)

        for batch in text_slices(batches, 1):
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(memo.text(text) + end if text else end, dtype="<u4")
                at = 0
                while at < len(ids):
                    n = min(len(ids) - at, room - group.tokens)
                    group.add(key, at, len(ids), ids[at : at + n])
                    at += n
                    if group.tokens == room:
                        yield packed()
        if group.tokens:
            yield packed()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _DDL + (", ids binary" if with_ids else ""))


def filled(packed: DataFrame, pad_id: int) -> DataFrame:
    """sequence_id, n_tokens and the ids of each sequence of ``pack(..., with_ids=True)``, padded but for powers of two.

    A sequence has at most ``CAPACITY`` tokens, so no group is large.
    """
    schema = pa.schema([("sequence_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(b"".join(p["ids"] for p in parts), dtype="<u4").tolist()
                n = len(ids)
                rows.append({"sequence_id": key, "n_tokens": n, "ids": ids if n & (n - 1) == 0 else ids + [pad_id] * (CAPACITY - n)})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.mapInArrow(run, "sequence_id long, n_tokens long, ids array<long>")
