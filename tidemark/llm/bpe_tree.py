"""Byte-level BPE by a tree reduction.

A text is halved until its parts are short; parts are encoded on their own
and neighbours joined on the way up. Joining is associative, so any tree gives
the ids that the whole text has:

* The splitting pattern scans from left to right, and a piece depends on the
  text from its start to at most ``LOOKAHEAD`` characters past its end. So the
  left part's pieces that end earlier than that before the cut stand. From the
  first one that does not, the text is scanned anew in a growing window until
  a new piece starts where one of the right part does: from there both scans
  see the same text, so the rest of the right part stands too.
* Runs of at most ``LEAF_BYTES`` are leaves, which the tiktoken library encodes;
  longer pieces are cut into byte strings. Within a piece, ids are right exactly if every two neighbours, encoded
  together, give themselves (each id of the ranks encodes to itself; a test
  checks that). Two halves are joined by encoding a growing window around the
  cut until that holds at both of its edges.

Decoding concatenates the bytes of the ids up the same tree.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from itertools import chain

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_columns

#: Characters past a piece's end that decide it: "'r" waits for an "e", blanks for what follows them.
LOOKAHEAD = 2
#: Characters of a text and bytes of a piece that are encoded directly.
LEAF_CHARS, LEAF_BYTES = 4096, 48
#: Pieces remembered by one Python worker.
MEMO_PIECES = 200_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class TreeBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.names = {rank: str(rank) for rank in self.tokens}
        self.pattern = regex.compile(pattern)
        self.blank_run = re.compile(r" [\s\x85]|[\s\x85] ")
        self.leaf = tiktoken.Encoding("leaf", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.memo = _Memo(self)
        self.pairs: dict[tuple[int, int], bool] = {}

    # -- one piece ---------------------------------------------------------

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a short byte string: join the lowest-ranked pair, leftmost first, until none is left."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        ranks, parts = self.ranks, [piece[i : i + 1] for i in range(len(piece))]
        joined = [ranks.get(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            best, at = None, -1
            for i, rank in enumerate(joined):
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                return [ranks[p] for p in parts]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del joined[at]
            if at < len(joined):
                joined[at] = ranks.get(parts[at] + parts[at + 1])
            if at:
                joined[at - 1] = ranks.get(parts[at - 1] + parts[at])

    def fits(self, left: int, right: int) -> bool:
        """Whether two neighbouring ids encode to themselves."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= MEMO_PIECES:
                self.pairs.clear()
            known = self.pairs[left, right] = self.merge(self.tokens[left] + self.tokens[right]) == [left, right]
        return known

    def join_ids(self, left: list[int], right: list[int]) -> list[int]:
        """Ids of the concatenation of two parts of one piece."""
        if not left or not right:
            return left + right
        k, m = (0, 0) if self.fits(left[-1], right[0]) else (1, 1)
        while k or m:
            a, b = left[len(left) - k :], right[:m]
            window = self.merge(b"".join(map(self.tokens.__getitem__, a + b)))
            grow_left = k < len(left) and not self.fits(left[len(left) - k - 1], window[0])
            grow_right = m < len(right) and not self.fits(window[-1], right[m])
            if not (grow_left or grow_right):
                return left[: len(left) - k] + window + right[m:]
            k, m = min(len(left), 2 * k) if grow_left else k, min(len(right), 2 * m) if grow_right else m
        return left + right

    def piece(self, data: bytes) -> list[int]:
        if len(data) <= LEAF_BYTES:
            return self.merge(data)
        # Level by level, so that a long piece is copied once for each level.
        level = [self.merge(data[i : i + LEAF_BYTES]) for i in range(0, len(data), LEAF_BYTES)]
        while len(level) > 1:
            level = [self.join_ids(*level[i : i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
        return level[0]

    # -- a text ------------------------------------------------------------

    def split(self, text: str) -> list[str]:
        """A whole text in runs of the pattern's pieces: pieces never cross a run's edge."""
        level = [(i, self.runs(text[i : i + LEAF_CHARS])) for i in range(0, len(text), LEAF_CHARS)]
        while len(level) > 1:
            level = [(level[i][0], self.join_pieces(text, level[i], level[i + 1])) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
        return level[0][1] if level else []

    def runs(self, leaf: str) -> list[str]:
        """Words with the blank before them where blanks stand alone, else pieces.

        A piece holds a blank only as its first character or in a run of white
        space, so before a blank between other characters there is always an edge.
        """
        if self.blank_run.search(leaf):
            return self.pattern.findall(leaf)
        first, *rest = leaf.split(" ")
        out = [" " + word for word in rest]
        return [first, *out] if first else out

    def join_pieces(self, text: str, left: tuple[int, list[str]], right: tuple[int, list[str]]) -> list[str]:
        (_, before), (cut, after) = left, right
        before, start = list(before), cut
        while before and start > cut - LOOKAHEAD - 1:
            start -= len(before.pop())
        grown, stop = self._scan(text, start, cut + 64, cut, after)
        return before + grown + after[stop:]

    def _scan(self, text: str, start: int, end: int, cut: int, after: list[str]) -> tuple[list[str], int]:
        """Pieces from ``start`` up to a piece start of the right part, and how many of its pieces they replace."""
        total = cut + sum(map(len, after))
        while True:
            end = min(end, total)
            # Pieces that could change with the text past the window are left open.
            limit = end if end == total else end - LOOKAHEAD - 1
            pieces, at, i, edge = [], start, 0, cut
            for match in self.pattern.finditer(text, start, end):
                if match.end() > limit:
                    break
                pieces.append(match.group())
                at = match.end()
                while edge < at and i < len(after):
                    edge += len(after[i])
                    i += 1
                if edge == at:
                    return pieces, i
            end = start + 2 * (end - start)

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(map(self.memo.__getitem__, self.split(text or ""))))

    def decode(self, ids: list[int]) -> bytes:
        """The ids' bytes; halves are decoded and concatenated."""
        if len(ids) <= LEAF_CHARS:
            return b"".join(map(self.tokens.__getitem__, ids))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


class _Memo(dict):
    """Ids of a run of pieces, as a tuple, encoded on first sight."""

    def __init__(self, bpe: TreeBpe):
        self.bpe = bpe

    def __missing__(self, run: str) -> tuple[int, ...]:
        if len(run) > LEAF_BYTES:
            return tuple(chain.from_iterable(self.bpe.piece(piece.encode()) for piece in self.bpe.pattern.findall(run)))
        if len(self) >= MEMO_PIECES:
            self.clear()
        ids = self[run] = tuple(self.bpe.leaf(run))
        return ids


_ENCODERS: dict[tuple[str, str], TreeBpe] = {}


def encoder(ranks_path: str, pattern: str) -> TreeBpe:
    """The encoder of this Python worker, which outlives its tasks."""
    if (ranks_path, pattern) not in _ENCODERS:
        _ENCODERS[ranks_path, pattern] = TreeBpe(load_ranks(ranks_path), pattern)
    return _ENCODERS[ranks_path, pattern]


def encode_table(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = True) -> DataFrame:
    """Encode and decode the texts of ``docs`` (null: empty).

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256, and with ``with_ids``
    also ids (little-endian unsigned 32-bit binary) and decoded (binary). Rows
    are handled one by one, so repeated ids or texts just repeat.
    """
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        fields += [("ids", pa.binary()), ("decoded", pa.binary())]
        ddl += ", ids binary, decoded binary"
    def rows(keys: list, texts: list) -> list:
        bpe, out = encoder(ranks_path, pattern), [keys, [], [], [], [], []]
        names = bpe.names
        for text in texts:
            ids = bpe.encode(text)
            decoded = bpe.decode(ids)
            out[1].append(len(ids))
            out[2].append(hashlib.sha256(" ".join(map(names.__getitem__, ids)).encode()).hexdigest())
            out[3].append(hashlib.sha256(decoded).hexdigest())
            if with_ids:
                out[4].append(array("I", ids).tobytes())
                out[5].append(decoded)
        return out[: len(fields)]

    return map_columns(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id", "text"], pa.schema(fields), ddl, rows)
