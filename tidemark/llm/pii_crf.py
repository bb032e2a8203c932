"""Personal data: fixed patterns, and a linear-chain conditional random field.

The field is trained from a small labelled table (``pii_lines.txt``: lines of
words with the spans in braces) over word-shape features and decoded by Viterbi
in numpy batches. It reads the words near a cue (a digit, ``@``, ``+`` or a word
that spells one of the signs of an address) and tags first and later words of a
span apart, so neighbours stay two spans. Its spans are checked (digits, Luhn's
sum) and added to those of the patterns where they overlap none of them: written
out addresses, national telephone numbers, cards beside other numbers.
"""

from __future__ import annotations

import hashlib
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_columns

KINDS = ("email", "ip", "card", "phone")
#: No span, the first word of a span of each kind, and its further words.
TAGS = ("other", *KINDS, *(f"more {k}" for k in KINDS))

# The patterns. Possessive repeats only keep them linear: what follows a run can
# never be inside the run.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@+]")
#: Words that spell a sign of an address, and words that hold a digit, ``@`` or ``+``.
_CUE = re.compile(r"[0-9@+]|[(\[]|(?i:\b(?:dot|punkt|punto|point)\b)")
#: Words read on either side of a cue.
NEAR = 4
_WORD = re.compile(r"[^\x20\x09-\x0D]+")

Span = tuple[str, int, int]

#: The labelled table.
LABELLED = Path(__file__).with_name("pii_lines.txt")


def labelled_words(line: str) -> tuple[list[str], list[int]]:
    """Words of a labelled line and the number of each word's tag."""
    words, tags, now, more = [], [], 0, 0
    for word in line.split():
        if word[0] == "{" and word[1:] in KINDS:
            now, more = TAGS.index(word[1:]), 0
            continue
        words.append(word.removesuffix("}") if now else word)
        tags.append(now + more)
        more = len(KINDS) if now else 0
        if now and word.endswith("}"):
            now, more = 0, 0
    return words, tags


_EDGES = ".,;:!?\"'"


def _shape(word: str) -> str:
    """Signs as they are; runs of digits, capitals and other letters as one sign each."""
    out = []
    for c in word:
        s = "9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c
        if not out or out[-1] != s or s not in "9Aa":
            out.append(s)
    return "".join(out)


def _looks(word: str) -> tuple[str, str]:
    """A word by its shape, and by itself (small letters) where it has no digit."""
    core = word.strip(_EDGES) or word
    return _shape(core), "" if _MARK.search(core) else core.lower()


def _features(looks: list[tuple[str, str]], words: list[str], i: int) -> list[str]:
    edge = ("^", "^")
    (shape, own), before, after = looks[i], looks[i - 1] if i else edge, looks[i + 1] if i + 1 < len(words) else edge
    out = ["bias", f"shape={shape}", f"before={before[0]}|{shape}", f"after={shape}|{after[0]}"]
    runs = [len(run) for run in re.findall("[0-9]+", words[i])]
    if runs:
        lengths = "-".join(map(str, runs))
        sides = [sum(c.isdigit() for c in words[j]) if 0 <= j < len(words) else -1 for j in (i - 1, i + 1)]
        out += [f"digits={sum(runs)}", f"runs={shape}|{lengths}", f"sides={sides[0]}|{lengths}|{sides[1]}", f"left={sides[0]}|{lengths}", f"right={lengths}|{sides[1]}", f"first={words[i].lstrip('(+')[:1]}|{lengths}"]
    else:
        out.append(f"word={own}")
    if before[1]:
        out.append(f"word before={before[1]}")
        if not runs and i > 1:
            out.append(f"words before={looks[i - 2][1]}|{before[1]}")
    if after[1]:
        out.append(f"word after={after[1]}")
        if not runs and i + 2 < len(words):
            out.append(f"words after={after[1]}|{looks[i + 2][1]}")
    if "@" in words[i][1:]:
        out.append("at")
    return out


def features(words: list[str]) -> list[list[str]]:
    looks = [_looks(w) for w in words]
    return [_features(looks, words, i) for i in range(len(words))]


class Crf:
    """Weights of a linear-chain field and its numpy inference."""

    def __init__(self, index: dict[str, int], emit: np.ndarray, step: np.ndarray):
        self.index, self.emit, self.step = index, emit, step

    def scores(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(TAGS)))
        for i, names in enumerate(features(words)):
            out[i] = self.emit[[k for f in names if (k := self.index.get(f)) is not None]].sum(axis=0)
        return out

    def decode(self, batch: np.ndarray) -> np.ndarray:
        """Best tags of equally long sequences: (n, length, tags) scores to (n, length)."""
        n, length, tags = batch.shape
        best, back = batch[:, 0], np.zeros((n, length, tags), dtype=np.int8)
        for t in range(1, length):
            paths = best[:, :, None] + self.step
            back[:, t] = paths.argmax(axis=1)
            best = paths.max(axis=1) + batch[:, t]
        out = np.zeros((n, length), dtype=np.int64)
        out[:, -1] = best.argmax(axis=1)
        for t in range(length - 1, 0, -1):
            out[:, t - 1] = back[np.arange(n), t, out[:, t]]
        return out


def allowed() -> np.ndarray:
    """0 where a tag may follow another: further words of a kind follow words of the kind."""
    out = np.zeros((len(TAGS), len(TAGS)))
    for k in range(1, len(KINDS) + 1):
        out[:, k + len(KINDS)] = -1e4
        out[[k, k + len(KINDS)], k + len(KINDS)] = 0
    return out


def train(lines: list[str] | None = None, rounds: int = 120, rate: float = 0.5, decay: float = 0.005) -> Crf:
    """Maximise the regularised conditional likelihood of the table by gradient ascent.

    Lines of equal length go through the forward and backward sums together.
    """
    index: dict[str, int] = {}
    by_length: dict[int, list] = {}
    for line in lines if lines is not None else LABELLED.read_text(encoding="utf-8").splitlines():
        words, gold = labelled_words(line)
        if words:
            by_length.setdefault(len(words), []).append(([[index.setdefault(f, len(index)) for f in names] for names in features(words)], gold))
    groups = []
    for length, rows in by_length.items():
        names = [f for feats, _ in rows for f in feats]
        sizes = [len(f) for f in names]
        gold = np.array([g for _, g in rows])
        groups.append((length, np.concatenate([np.array(f) for f in names]), np.concatenate([[0], np.cumsum(sizes)[:-1]]), np.repeat(np.arange(len(names)), sizes), np.eye(len(TAGS))[gold], gold))
    bars = allowed()
    emit, step = np.zeros((len(index), len(TAGS))), np.zeros((len(TAGS), len(TAGS)))
    grown_e, grown_s = np.full_like(emit, 1e-8), np.full_like(step, 1e-8)
    for _ in range(rounds):
        ge, gs, links = -decay * emit, -decay * step, step + bars
        for length, cols, starts, places, hot, gold in groups:
            n = len(gold)
            s = np.add.reduceat(emit[cols], starts).reshape(n, length, len(TAGS))
            fwd, bwd = s.copy(), np.zeros_like(s)
            for t in range(1, length):
                fwd[:, t] += np.logaddexp.reduce(fwd[:, t - 1, :, None] + links, axis=1)
            for t in range(length - 2, -1, -1):
                bwd[:, t] = np.logaddexp.reduce(links + (s[:, t + 1] + bwd[:, t + 1])[:, None, :], axis=2)
            z = np.logaddexp.reduce(fwd[:, -1], axis=1)[:, None, None]
            d = (hot - np.exp(fwd + bwd - z)).reshape(-1, len(TAGS))
            np.add.at(ge, cols, d[places])
            for t in range(1, length):
                gs -= np.exp(fwd[:, t - 1, :, None] + links + (s[:, t] + bwd[:, t])[:, None, :] - z).sum(axis=0)
                np.add.at(gs, (gold[:, t - 1], gold[:, t]), 1)
        grown_e += ge**2
        grown_s += gs**2
        emit += rate * ge / np.sqrt(grown_e)
        step += rate * gs / np.sqrt(grown_s)
    return Crf(index, emit, step + bars)


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by kind as listed, then start."""
    out: list[Span] = []
    if "@" in text:
        end = 0
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                end = m.end()
                out.append(("email", start, end))
    if not _MARK.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
                out.append(("phone", *m.span()))
    return out


def _runs(text: str) -> list[list[tuple[str, int, int]]]:
    """Stretches of words near a cue, within a line."""
    out: list[list[tuple[str, int, int]]] = []
    for line in re.finditer(r"[^\n]+", text):
        if not _CUE.search(line.group()):
            continue
        words = [(m.group(), m.start() + line.start(), m.end() + line.start()) for m in _WORD.finditer(line.group())]
        upto = 0
        for i, (word, _, _) in enumerate(words):
            if _CUE.search(word):
                if i - NEAR > upto or not upto:
                    out.append([])
                    upto = max(0, i - NEAR)
                end = min(len(words), i + NEAR + 1)
                out[-1] += words[upto:end]
                upto = end
    return out


_TRIM = ".,;:!?\"'#*$%&|<>="


def _holds(kind: str, text: str) -> bool:
    """Whether a tagged span can be of its kind."""
    digits = re.sub("[^0-9]", "", text)
    if kind == "card":
        return 13 <= len(digits) <= 19 and _luhn(digits)
    if kind == "phone":
        return 7 <= len(digits) <= 15
    if kind == "ip":
        parts = re.findall("[0-9]+", text)
        return len(parts) in (4, 5) and all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in parts[:4])
    return bool(re.search(r"[A-Za-z0-9]", text)) and bool(re.search(r"@|(?i:\b(?:at|a|arroba|arobase)\b)", text))


def crf_spans(crf: Crf, texts: list[str]) -> list[list[Span]]:
    """Spans that the field finds in each text; runs of one length are decoded together."""
    by_length: dict[int, list[tuple[int, list]]] = {}
    for n, text in enumerate(texts):
        if text and _CUE.search(text):
            for run in _runs(text):
                by_length.setdefault(len(run), []).append((n, run))
    out: list[list[Span]] = [[] for _ in texts]
    for runs in by_length.values():
        tags = crf.decode(np.stack([crf.scores([w for w, _, _ in run]) for _, run in runs]))
        for (n, run), path in zip(runs, tags):
            i = 0
            while i < len(run):
                j, tag = i + 1, path[i]
                while tag and j < len(run) and path[j] == tag + len(KINDS):
                    j += 1
                if 0 < tag <= len(KINDS):
                    start, end = run[i][1], run[j - 1][2]
                    inner = texts[n][start:end]
                    start += len(inner) - len(inner.lstrip(_TRIM))
                    end -= len(inner) - len(inner.rstrip(_TRIM))
                    if start < end and _holds(KINDS[tag - 1], texts[n][start:end]):
                        out[n].append((KINDS[tag - 1], start, end))
                i = j
    return out


def find(crf: Crf, texts: list[str | None]) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text (null: empty), each by kind, then start."""
    clean = [t or "" for t in texts]
    out = []
    for text, added in zip(clean, crf_spans(crf, clean)):
        base = base_spans(text)
        free = [s for s in added if all(s[2] <= b[1] or s[1] >= b[2] for b in base)]
        out.append((base, sorted(base + free, key=lambda s: (KINDS.index(s[0]), s[1]))))
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def pii_table(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans by kind, base_sha256 and spans of every text.

    Null and empty texts have no spans; repeated rows are handled each; an
    empty table gives no rows.
    """
    crf = train()
    schema = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string())])

    def rows(keys: list, texts: list) -> list:
        found = find(crf, texts)
        counts = [[sum(s[0] == k for s in base) for base, _ in found] for k in KINDS]
        return [keys, *counts, [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found], [joined(every) for _, every in found]]

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_columns(narrow, narrow.columns, schema, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string", rows)
