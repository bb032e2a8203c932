"""Token ids in directly addressable codes.

An id is split into chunks of eight bits. Level k keeps chunk k of every id
that has one, as a plain byte array; a continuation bitmap over level k says
which of its entries go on in level k + 1, and a rank directory (set bits
before each block of 512) turns a position on level k into one on level k + 1.
Any id can thus be read on its own, without decoding a block.

A segment holds whole documents. Segments are stored by Spark's own writer as
rows of a Parquet table (``payload`` is the complete segment), so writes are
committed by task and work on any store that Spark reaches.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import new_path

MAGIC = b"DAC1"
CHUNK_BITS = 8
RANK_BLOCK = 512
_HEAD = struct.Struct("<4sIQ")
_LEVEL = struct.Struct("<QQQ")
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)

#: UTF-8 bytes of text in a range of doc_id, on average.
PART_BYTES = 128 << 20
#: Tokens after which a segment is closed; a longer document has one of its own.
SEGMENT_TOKENS = 1 << 18
#: Distinct text pieces remembered by one Python worker, and the longest of them.
MEMO_PIECES, MEMO_CHARS = 1_500_000, 40

#: A word of Latin letters whose case and normal form are plain, and marks after it.
_LATIN = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)([.,;:!?|]*)")


def pack(ids: np.ndarray) -> bytes:
    """A segment of the given ids (each below 2**32)."""
    rest = np.asarray(ids, dtype=np.uint32)
    levels = []
    while len(rest) or not levels:
        chunk = (rest & 0xFF).astype(np.uint8)
        goes_on = rest > 0xFF
        bitmap = np.packbits(goes_on, bitorder="little")
        pad = -len(bitmap) % (RANK_BLOCK // 8)
        counts = np.pad(_POPCOUNT[bitmap], (0, pad)).reshape(-1, RANK_BLOCK // 8).sum(axis=1, dtype=np.uint64)
        directory = np.concatenate([[0], np.cumsum(counts, dtype=np.uint64)[:-1]]).astype("<u8") if len(counts) else np.zeros(0, "<u8")
        levels.append((chunk.tobytes(), bitmap.tobytes(), directory.tobytes()))
        rest = rest[goes_on] >> CHUNK_BITS
    out = [_HEAD.pack(MAGIC, len(levels), len(ids))]
    for parts in levels:
        out.append(_LEVEL.pack(*map(len, parts)))
        out.extend(parts)
    return b"".join(out)


class Segment:
    """Read access to a packed segment."""

    def __init__(self, payload: bytes):
        magic, n_levels, self.n = _HEAD.unpack_from(payload)
        if magic != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        self.levels, at = [], _HEAD.size
        for _ in range(n_levels):
            sizes = _LEVEL.unpack_from(payload, at)
            at += _LEVEL.size
            parts = []
            for size, kind in zip(sizes, (np.uint8, np.uint8, "<u8")):
                parts.append(np.frombuffer(payload, dtype=kind, count=size // np.dtype(kind).itemsize, offset=at))
                at += size
            self.levels.append(parts)

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        """The i-th id, by one rank step for each further chunk."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for k, (chunk, bitmap, directory) in enumerate(self.levels):
            value |= int(chunk[i]) << (CHUNK_BITS * k)
            byte, bit = divmod(i, 8)
            if not bitmap[byte] >> bit & 1:
                break
            first = i // RANK_BLOCK * (RANK_BLOCK // 8)
            before = int(_POPCOUNT[bitmap[first:byte]].sum()) + int(_POPCOUNT[bitmap[byte] & ((1 << bit) - 1)])
            i = int(directory[i // RANK_BLOCK]) + before
        return value

    def all(self) -> np.ndarray:
        """Every id at once."""
        out = np.zeros(self.n, dtype="<u4")
        where = np.arange(self.n)
        for k, (chunk, bitmap, _) in enumerate(self.levels):
            out[where] |= chunk.astype(np.uint32) << np.uint32(CHUNK_BITS * k)
            where = where[np.unpackbits(bitmap, count=len(chunk), bitorder="little").astype(bool)]
        return out


def token_in_file(file: BinaryIO, i: int) -> int:
    """The i-th id of a segment in a seekable file, by a few short reads: the heads, and for each chunk its byte and one block of its bitmap."""

    def read(at: int, size: int) -> bytes:
        file.seek(at)
        return file.read(size)

    magic, n_levels, n = _HEAD.unpack(read(0, _HEAD.size))
    if magic != MAGIC:
        raise ValueError("not a segment of directly addressable codes")
    if not 0 <= i < n:
        raise IndexError(i)
    value, at = 0, _HEAD.size
    for k in range(n_levels):
        chunks, bitmap, directory = _LEVEL.unpack(read(at, _LEVEL.size))
        at += _LEVEL.size
        value |= read(at + i, 1)[0] << (CHUNK_BITS * k)
        block, within = divmod(i, RANK_BLOCK)
        byte, bit = divmod(within, 8)
        bits = read(at + chunks + block * (RANK_BLOCK // 8), byte + 1)
        if not bits[byte] >> bit & 1:
            break
        (first,) = struct.unpack("<Q", read(at + chunks + bitmap + 8 * block, 8))
        i = first + int.from_bytes(bits[:byte], "little").bit_count() + (bits[byte] & ((1 << bit) - 1)).bit_count()
        at += chunks + bitmap + directory
    return value


# The steps of a tokenizer file under which texts may be encoded piece by piece.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


def piecewise(settings: dict) -> bool:
    """Whether a tokenizer file has just the steps that ``PieceMemo`` relies on."""
    steps = settings.get("pre_tokenizer") or {}
    blank = any(c.isspace() or t["lstrip"] or t["rstrip"] or t["normalized"] for t in settings.get("added_tokens", []) for c in t["content"])
    return settings.get("normalizer") == _NORMALIZER and steps.get("pretokenizers") == [_SPLIT, _BYTES] and not blank and not any(settings.get(k) for k in ("post_processor", "truncation", "padding"))


class PieceMemo(dict):
    """Ids (little-endian bytes) of a blank-separated piece, encoded on first sight.

    The tokenizer drops white space and never joins text across it, so a text's
    ids are those of its pieces in turn. It also splits Latin letters from the
    marks after them, so such a piece has the ids of its word and its marks. A
    word of Latin letters goes to the tokenizer's model as it stands after the
    steps before it: lower case, bytes written as the byte-level alphabet.
    Texts go whole to a tokenizer whose file has other steps than these.
    """

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        with open(tokenizer_path, encoding="utf-8") as f:
            self.piecewise = piecewise(json.load(f))
        self.model = self.tokenizer.model
        self.words: dict[str, bytes] = {}
        # The byte-level alphabet: printable Latin-1 stands for itself, the other bytes follow from U+0100 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        self.alphabet = {b: 256 + i for i, b in enumerate(others)}

    def whole(self, piece: str) -> bytes:
        return array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()

    def word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            spelled = word if word.isascii() else word.encode().decode("latin-1").translate(self.alphabet)
            ids = array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()
            if len(word) <= MEMO_CHARS:
                if len(self.words) >= MEMO_PIECES:
                    self.words.clear()
                self.words[word] = ids
        return ids

    def text(self, text: str) -> bytes:
        if not self.piecewise:
            return self.whole(text)
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))

    def __missing__(self, piece: str) -> bytes:
        parts = _LATIN.fullmatch(piece)
        if parts is None:
            ids = self.whole(piece)
        else:
            marks = parts[2]
            ids = self.word(parts[1].lower()) + (self[marks] if marks else b"")
        if len(piece) <= MEMO_CHARS:
            if len(self) >= MEMO_PIECES:
                self.clear()
            self[piece] = ids
        return ids


_MEMOS: dict[str, PieceMemo] = {}


def piece_memo(tokenizer_path: str) -> PieceMemo:
    """The memo of this Python worker, which outlives its tasks."""
    if tokenizer_path not in _MEMOS:
        _MEMOS[tokenizer_path] = PieceMemo(tokenizer_path)
    return _MEMOS[tokenizer_path]


_SEGMENTS = pa.schema([("part", pa.int64()), ("seg", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("payload", pa.binary())])
_SEGMENTS_DDL = "part long, seg long, n_tokens long, doc_ids array<long>, lengths array<long>, payload binary"


def range_parts(docs: DataFrame) -> int:
    """Ranges of doc_id: the session's shuffle partitions, more where a range would exceed ``PART_BYTES`` of text."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int) -> None:
    """Encode ``docs`` and write their segments to ``path``, ascending by doc_id.

    A null or empty text is just the end id. Rows of one doc_id (null first)
    follow each other in the order of their texts.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seg, memo, end = TaskContext.get().partitionId(), 0, piece_memo(tokenizer_path), array("I", [end_id]).tobytes()
        held: list[bytes] = []
        keys: list[int | None] = []
        lengths: list[int] = []

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), dtype="<u4")
            return pa.RecordBatch.from_pylist([{"part": part, "seg": seg, "n_tokens": len(ids), "doc_ids": keys, "lengths": lengths, "payload": pack(ids)}], schema=_SEGMENTS)

        size = 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = memo.text(text) + end if text else end
                held.append(ids)
                keys.append(key)
                lengths.append(len(ids) // 4)
                size += len(ids) // 4
                if size >= SEGMENT_TOKENS:
                    yield close()
                    seg, size, held, keys, lengths = seg + 1, 0, [], [], []
        if held:
            yield close()

    n = range_parts(docs)
    (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(n, "doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
        .mapInArrow(encode, _SEGMENTS_DDL)
        .write.option("compression", "uncompressed")  # a page of codes is read as it is
        .parquet(path)
    )


def _starts(segments: DataFrame) -> DataFrame:
    """part, seg, n_tokens and seg_start (ids before it) of every segment.

    Running sums over segments within each part, and over the parts (one row
    for each task of the write).
    """
    sizes = segments.select("part", "seg", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    part_start = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    within = Window.partitionBy("part").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum("n_tokens").over(within), F.lit(0))
    return sizes.withColumn("own", own).join(part_start, "part").select("part", "seg", "n_tokens", (F.col("part_start") + F.col("own")).alias("seg_start"))


def tokens_at(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """position and id of each distinct position (long) in the whole written order; positions beyond it have no row.

    A position meets its segment by the stretch of ``SEGMENT_TOKENS`` that it
    lies in, and its id is read without decoding others.
    """
    segments = spark.read.parquet(path)
    stretch = lambda c: F.floor(c / SEGMENT_TOKENS).cast("long")
    spans = _starts(segments).where("n_tokens > 0").withColumn("stretch", F.explode(F.sequence(stretch(F.col("seg_start")), stretch(F.col("seg_start") + F.col("n_tokens") - 1))))
    asked = positions.select("position").where("position >= 0").distinct().withColumn("stretch", stretch(F.col("position")))
    inside = (F.col("position") >= F.col("seg_start")) & (F.col("position") < F.col("seg_start") + F.col("n_tokens"))
    found = asked.join(spans, "stretch").where(inside).groupBy("part", "seg", "seg_start").agg(F.collect_list("position").alias("positions"))
    schema = pa.schema([("position", pa.int64()), ("id", pa.int64())])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                start, wanted, payload = (batch.column(i)[row].as_py() for i in range(3))
                segment = Segment(payload)
                yield pa.RecordBatch.from_arrays([pa.array(wanted, pa.int64()), pa.array([segment[p - start] for p in wanted], pa.int64())], schema=schema)

    return segments.join(found, ["part", "seg"]).select("seg_start", "positions", "payload").mapInArrow(look, "position long, id long")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a written folder: doc_id, start, n_tokens, ids_crc32."""
    segments = spark.read.parquet(path)
    starts = _starts(segments).drop("n_tokens")
    schema = pa.schema([("part", pa.int64()), ("seg", pa.int64()), ("doc_id", pa.int64()), ("offset", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, seg, keys, lengths, payload = (batch.column(i)[row].as_py() for i in range(5))
                ids, ends = Segment(payload).all(), np.cumsum(lengths, dtype=np.int64)
                offsets = ends - np.asarray(lengths, dtype=np.int64)
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(offsets, ends)]
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(keys), pa.int64()), pa.array([seg] * len(keys), pa.int64()), pa.array(keys, pa.int64()), pa.array(offsets), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())], schema=schema)

    docs = segments.select("part", "seg", "doc_ids", "lengths", "payload").mapInArrow(decode, "part long, seg long, doc_id long, offset long, n_tokens long, ids_crc32 long")
    return docs.join(starts, ["part", "seg"]).select("doc_id", (F.col("seg_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def token_table(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write ``docs`` to a new folder of the shared directory and read it back."""
    path = new_path(docs.sparkSession, "dac")
    write_tokens(docs, path, tokenizer_path, end_id)
    return read_tokens(docs.sparkSession, path)
