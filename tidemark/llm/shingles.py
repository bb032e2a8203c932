"""Word shingles of whole texts as sorted 64-bit hashes, many texts at a time.

Words are runs of bytes outside ASCII white space, with A to Z lower-cased. A
word's code is a polynomial in random values of its bytes, taken from running
sums over the text, so no word becomes a Python object.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

#: Words of a shingle.
WORDS = 5
#: Bytes hashed at once.
CHUNK = 1 << 18


def _numbers(key: str, n: int) -> np.ndarray:
    """n fixed random odd numbers."""
    digests = b"".join(hashlib.blake2b(f"{key}{i}".encode(), digest_size=8).digest() for i in range(n))
    return np.frombuffer(digests, dtype=np.uint64) | np.uint64(1)


_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_VALUE = _numbers("byte", 256)
_VALUE[ord("A") : ord("Z") + 1] = _VALUE[ord("a") : ord("z") + 1]
_BASE, _MIX, _WHOLE = (int(v) for v in _numbers("base", 3))
_PLACE = _numbers("place", WORDS)


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_UP, _DOWN = _powers(_BASE, CHUNK), _powers(pow(_BASE, -1, 1 << 64), CHUNK)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(_MIX)
    return h ^ (h >> np.uint64(29))


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end, and where each begins and ends."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    every = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return every[at[0] : at[-1]], at - at[0]


def word_codes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code of every word, and the number of words of each text."""
    begins = np.zeros(len(data) + 1, dtype=bool)
    begins[at] = True
    codes, owners, start = [], [], 0
    while start < len(data):
        end = min(start + CHUNK, len(data))
        if end < len(data):  # up to the last boundary of a word; a word over a chunk is taken whole
            cuts = np.flatnonzero(_BLANK[data[start:end]] | begins[start:end])
            cuts = cuts[cuts > 0]
            if len(cuts):
                end = start + int(cuts[-1])
            else:
                later = np.flatnonzero(_BLANK[data[end:]] | begins[end:-1])
                end = end + int(later[0]) if len(later) else len(data)
        part, first = data[start:end], begins[start : end + 1]
        up, down = (_UP, _DOWN) if len(part) <= CHUNK else (_powers(_BASE, len(part)), _powers(pow(_BASE, -1, 1 << 64), len(part)))
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_VALUE[part] * up[: len(part)], out=sums[1:])
        blank = np.concatenate([[True], _BLANK[part], [True]])
        heads = np.flatnonzero(~blank[1:-1] & (blank[:-2] | first[:-1]))
        tails = np.flatnonzero(~blank[1:-1] & (blank[2:] | first[1:])) + 1
        codes.append(_mixed((sums[tails] - sums[heads]) * down[heads]))
        owners.append(np.searchsorted(at, start + heads, "right") - 1)
        start = end
    if not codes:
        return np.zeros(0, np.uint64), np.zeros(len(at) - 1, np.int64)
    return np.concatenate(codes), np.bincount(np.concatenate(owners), minlength=len(at) - 1)


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct hashes (int64) of each text's shingles.

    A text of one to four words has its whole sequence as one shingle; one
    without words, or a null one, has none.
    """
    codes, counts = word_codes(*_buffers(texts))
    ends = np.cumsum(counts)
    sums = np.zeros(max(0, len(codes) - WORDS + 1), dtype=np.uint64)
    for i in range(WORDS):
        sums += codes[i : i + len(sums)] * _PLACE[i]
    hashes = _mixed(sums).view(np.int64)
    out = []
    for n, end in zip(counts.tolist(), ends.tolist()):
        if n >= WORDS:
            every = np.sort(hashes[end - n : end - WORDS + 1])
            fresh = np.ones(len(every), dtype=bool)
            np.not_equal(every[1:], every[:-1], out=fresh[1:])
            out.append(every[fresh])
        elif n:
            whole = (codes[end - n : end] * _PLACE[:n]).sum(dtype=np.uint64, keepdims=True)
            out.append(_mixed(whole + np.uint64(n * _WHOLE % (1 << 64))).view(np.int64))
        else:
            out.append(np.zeros(0, np.int64))
    return out
