import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.llm.data import frame, odd_texts, prose
from tidemark.llm import packing, turns, whitening

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


# -- packing ----------------------------------------------------------------


def encoded(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    return [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for t in texts]


def held_to_the_contract(rows, texts):
    """Every id of every document in one piece, sequences gapless and within the capacity; the share of padding."""
    ids = defaultdict(list)
    for (key, text), e in zip(texts, encoded(t for _, t in texts)):
        ids[key].append(e)
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    assert set(pieces) == set(ids)
    for key, docs in ids.items():
        assert sum(r.length for r in pieces[key]) == sum(map(len, docs))
        starts = Counter(r.start for r in pieces[key])
        for r in pieces[key]:
            assert any(r.doc_tokens == len(d) and zlib.crc32(d[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for d in docs)
        if len(docs) == 1:
            spans = sorted((r.start, r.length) for r in pieces[key])
            assert [a for a, _ in spans] == [0, *itertools.accumulate(n for _, n in spans)][:-1] and max(starts.values()) == 1
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    padded = 0
    for parts in sequences.values():
        parts.sort()
        assert [a for a, _ in parts] == [0, *itertools.accumulate(n for _, n in parts)][:-1]
        n = sum(n for _, n in parts)
        assert n <= packing.CAPACITY
        padded += 0 if n & (n - 1) == 0 else packing.CAPACITY - n
    return padded / sum(r.length for r in rows)


def test_packing_of_odd_texts(spark):
    texts = odd_texts() + [(None, "no id"), (None, "no id"), (None, None)]
    rows = packing.pack(frame(spark, texts).repartition(3), TOKENIZER, 2).collect()
    assert held_to_the_contract(rows, texts) < 0.01
    again = packing.pack(frame(spark, texts).coalesce(1), TOKENIZER, 2).collect()
    assert held_to_the_contract(again, texts) < 0.01
    assert packing.pack(frame(spark, []), TOKENIZER, 2).collect() == []


def test_packing_of_a_table_with_a_document_of_several_groups(spark):
    rnd = random.Random(3)
    texts = [(0, prose(rnd, 600_000, 3000))] + [(i, prose(rnd, rnd.choice([5, 200, 800]))) for i in range(1, 400)]
    rows = packing.pack(frame(spark, texts).coalesce(1), TOKENIZER, 2).collect()
    assert held_to_the_contract(rows, texts) < 0.005
    assert len({r.sequence_id for r in rows if r.doc_id == 0}) > packing.GROUP_WINDOWS


def test_differencing_is_a_partition_of_near_equal_windows():
    rnd = random.Random(5)
    for windows in (1, 2, 3, 7, 40):
        sizes = [rnd.randrange(1, 500) for _ in range(windows * 9)]
        found = packing.difference(sizes, windows)
        assert sorted(i for w in found for i in w) == list(range(len(sizes))) and len(found) == windows
        sums = [sum(sizes[i] for i in w) for w in found]
        assert max(sums) - min(sums) <= 60
    # Two windows: the differences of the classic example, 8 7 6 5 4, leave 16 and 14.
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in packing.difference([8, 7, 6, 5, 4], 2)) == [14, 16]


def test_equal_documents_are_cut_finer_or_get_more_windows(monkeypatch):
    runs = [(501 * i, 501 * i + 500) for i in range(67)]
    fine = packing.pack_windows(runs)
    assert sum(b - a for w in fine for a, b in w) == 67 * 500 and all(sum(b - a for a, b in w) <= 4096 for w in fine)
    monkeypatch.setattr(packing, "MOST_PIECES", 0)  # no finer pieces: the number of windows rises
    coarse = packing.pack_windows(runs)
    assert all(sum(b - a for a, b in w) <= 4096 for w in coarse) and sum(b - a for w in coarse for a, b in w) == 67 * 500
    assert sum(sum(b - a for a, b in w) > 2048 for w in coarse) > 67 * 500 // 4084


def test_sequences_are_padded_but_for_powers_of_two(spark):
    texts = [(i, prose(random.Random(i), 60 * i)) for i in range(60)]
    full = packing.filled(packing.pack(frame(spark, texts).coalesce(2), TOKENIZER, 2, with_ids=True), 0).collect()
    assert all(len(r.ids) == (r.n_tokens if math.log2(r.n_tokens) % 1 == 0 else 4096) for r in full)
    ids = Counter(i for r in full for i in r.ids[: r.n_tokens])
    assert ids == Counter(int(i) for e in encoded(t for _, t in texts) for i in e)


# -- whitening --------------------------------------------------------------


def vectors(spark, rows):
    return spark.createDataFrame([(k, v, 1, 2, "x") for k, v in rows], "vec_id long, embedding array<float>, n long, component int, x string")


def plain(rows, top=4):
    """Whitening in one process: whole numbers for sums and deviations, one covariance."""
    usable = [(k, [math.floor(256 * float(c)) for c in v]) for k, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in usable})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[float(Fraction(c) - Fraction(s, n)) for c, s in zip(x, sums)] for x in fit])
    cov = y.T @ y / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:top], v[:, ::-1][:, :top]
    out = {}
    for _, x in usable:
        centred = np.array([c - s / n for c, s in zip(x, sums)])
        out[tuple(x)] = (n, sum((n * c - s) ** 2 for c, s in zip(x, sums)), centred @ v / np.sqrt(e), e / np.trace(cov))
    return usable, out


def test_whitening_equals_plain_computation(spark):
    rnd = np.random.default_rng(1)
    base = (rnd.normal(size=(200, 12)) * np.linspace(2, 0.3, 12) + 0.5).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(3, rows[3][1]), (900, rows[5][1]), (None, rows[7][1]), (901, [-0.0] * 12), (902, None), (903, [float("nan")] * 12), (904, [float("inf")] + [0.0] * 11), (905, [None] + [0.0] * 11), (906, [1.0, 2.0]), (907, [])]
    got = whitening.whiten(vectors(spark, rows).repartition(5)).collect()
    usable, want = plain(rows[:204])
    assert Counter(r.vec_id for r in got) == Counter({k: 4 * c for k, c in Counter(k for k, _ in usable).items()})
    by_id = {k: tuple(x) for k, x in usable}
    signs = {}
    for r in got:
        n, deviation, white, explained = want[by_id[r.vec_id]]
        c = r.component - 1
        assert (r.n, r.deviation) == (n, deviation) and r.explained == pytest.approx(explained[c], rel=1e-9) and r.identity_error < 1e-9
        if abs(white[c]) > 1e-3:
            assert abs(r.whitened) == pytest.approx(abs(white[c]), rel=1e-6)
            signs.setdefault(c, set()).add(np.sign(r.whitened) == np.sign(white[c]))
    assert all(len(s) == 1 for s in signs.values()) and len(signs) == 4


def test_whitening_without_spread_or_rows(spark):
    assert whitening.whiten(vectors(spark, [])).collect() == [] and whitening.whiten(vectors(spark, [(1, None)])).collect() == []
    one = whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, None, None)] * 4
    line = whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0])])).collect()
    assert sorted((r.vec_id, r.component, r.whitened and abs(r.whitened), r.explained) for r in line) == [(1, 1, 1.0, 1.0), (1, 2, None, 0.0), (2, 1, 1.0, 1.0), (2, 2, None, 0.0)]


def test_sums_and_deviations_of_large_numbers_are_exact(spark):
    x = [[2**61 + 3, -(2**61) - 1], [2**61, 5]]
    df = spark.createDataFrame([(v,) for v in x], "x array<long>")
    assert whitening.exact_sums(df) == (2, [2**62 + 3, -(2**61) + 4])
    assert whitening.deviations(np.array([[2**40, 0]]), 7, [1, 2]) == [(7 * 2**40 - 1) ** 2 + 4]


# -- conversations ----------------------------------------------------------

SPACE = " \t\n\x0b\x0c\r"
VALID = re.compile(r"(s?(ua)+)?")


def after_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        left = text.strip(SPACE)
        out.append("blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(rows):
    """The cheapest edits, ties to the least letters: for each row all that may be done, the best kept for equal initials."""
    faults = faults_of(rows)
    layer = [(0, "", "", [])]
    for k in range(len(rows) + 1):
        grown = list(layer)
        for _ in range(2):  # insertions before the k-th row
            grown = [(c + 2, a + "I", i + r[0], t + [(r, "")]) for c, a, i, t in grown for r in ("user", "assistant")]
            layer = layer + grown
        if k == len(rows):
            break
        _, _, role, text = rows[k]
        new = []
        for c, a, i, t in layer:
            new.append((c + 3, a + "D", i, t))
            if faults[k] not in ("blank", "duplicate"):
                more = faults[k] == "truncated"
                new.append((c + more, a + "K", i + role[:1], t + [(role, text)]))
                new += [(c + 2 + more, a + "R", i + r[0], t + [(r, text)]) for r in ("user", "assistant")]
        new = [x for x in new if VALID.fullmatch(x[2]) or VALID.fullmatch(x[2] + "a") or x[2] == "s"]
        least = {}
        for x in new:  # of equal initials the cheaper, then the lesser edits
            if x[2] not in least or x[:2] < least[x[2]][:2]:
                least[x[2]] = x
        layer = list(least.values())
    return min((x for x in layer if VALID.fullmatch(x[2])), key=lambda x: x[:2])


def expected(rows, every):
    by = defaultdict(list)
    for r in after_damage(rows):
        by[r[0]].append(r)
    out = {}
    for conv in every:
        own = sorted(by[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        faults = Counter(faults_of(own))
        cost, audit, _, kept = brute(own)
        numbered = {r[1] for r in own if r[1] is not None}
        gaps = max(numbered) - min(numbered) + 1 - len(numbered) if numbered else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        text = "\n".join(f"{r}:{t}" for r, t in kept)
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest(), kept)
    return out


def conversation_rows(seed, conversations, longest):
    rnd = random.Random(seed)
    texts = ["Yes.", "No", "why? ", " \t", "", None, "A b c!", "x\n", "Deux. trois"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None]
    rows = []
    for c in range(conversations):
        n = rnd.randrange(1, longest)
        for t in range(n):
            role = roles[t % 2] if rnd.random() < 0.6 else rnd.choice(roles)
            rows.append((c or None, None if rnd.random() < 0.05 else t * rnd.choice([1, 1, 1, 2]), role, rnd.choice(texts) if rnd.random() < 0.5 else f"text {rnd.randrange(50)}."))
    return rows + rows[:7]


@pytest.mark.parametrize("stretch", [1 << 16, 2])
def test_repair_equals_brute_force(spark, monkeypatch, stretch):
    monkeypatch.setattr(turns, "STRETCH", stretch)  # with 2 a conversation falls into many stretches
    rows = conversation_rows(stretch, 150, 9)
    df = spark.createDataFrame([(*r, "e", 1, 2) for r in rows], "conv_id long, turn long, role string, text string, edits string, pos long, kind int")
    every = {r[0] for r in rows}
    want = expected(rows, every)
    got = {r.conv_id: tuple(r)[1:] for r in turns.digests(turns.damage(df), df).collect()}
    assert set(got) == every
    for conv in every:
        assert got[conv] == want[conv][:-1], conv
    told = defaultdict(list)
    for r in turns.repair(turns.damage(df)).orderBy("conv_id", "place").collect():
        assert r.place == len(told[r.conv_id])
        told[r.conv_id].append((r.role, r.text))
    assert all(told[conv] == want[conv][-1] for conv in every)


def test_a_long_conversation_costs_as_much_in_stretches(spark, monkeypatch):
    rnd = random.Random(2)
    rows = [(1, t, rnd.choice(["user", "assistant", "tool", "system"]), f"t {rnd.randrange(2000)}{rnd.choice('.!x')}") for t in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = turns.digests(df).collect()
    monkeypatch.setattr(turns, "STRETCH", 16)
    assert turns.digests(df).collect() == whole
    assert VALID.fullmatch("".join(r.role[0] for r in turns.repair(df).orderBy("place").collect()))


def test_conversations_without_rows(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert turns.digests(turns.damage(df), df).collect() == [] and turns.repair(df).collect() == []
    one = spark.createDataFrame([(c, 0, "user", "Hi.") for c in range(60)], df.schema)
    gone = [r for r in turns.digests(turns.damage(one), one).collect() if r.audit == ""]
    assert gone and all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for r in gone)
    assert turns.digests(turns.damage(one), one).count() == 60 and one.agg(F.count("*")).first()[0] == 60
