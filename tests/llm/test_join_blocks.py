import random

import numpy as np
import pytest

from tests.llm.data import frame, prose
from tidemark.llm import ngram_join


def shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(texts):
    sets = {i: shingles(t) for i, t in texts}
    least = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            for j in sets:
                if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    least[i] = least[j] = min(least[i], least[j])
    return least


@pytest.mark.parametrize("seed", range(30))
def test_a_block_gives_a_link_if_there_is_one(seed):
    rnd = random.Random(seed)
    universe = [rnd.randrange(-(2**62), 2**62) for _ in range(130)]
    a = sorted(rnd.sample(universe, 100))
    members = {}
    for x in range(12):
        kept = rnd.sample(a, rnd.randrange(70, 100))
        members[x] = sorted(set(kept) | set(rnd.sample(universe, rnd.randrange(5, 30))))
    rows = sorted((s, x, len(v), len(v)) for x, v in members.items() for s in v)
    postings = np.array(rows, np.int64).T
    # Any lists may be set aside: here the longest of the block, L of them.
    aside = rnd.randrange(0, 79)
    length = {s: sum(s in v for v in members.values()) for s in a}
    wanted = sorted(a, key=lambda s: (length[s], s))
    short, long = (np.array(w, np.int64) for w in (wanted[: len(a) - aside], wanted[len(a) - aside :]))
    found = ngram_join.first_link(postings, len(a), len(a), 80 - aside, short, long, 80)
    linked = [x for x, v in members.items() if 100 * len(set(a) & set(v)) >= 80 * len(set(a) | set(v))]
    assert found in linked if linked else found is None


def changed(rnd, text, share):
    return " ".join(f"x{rnd.randrange(10**6)}" if rnd.random() < share else w for w in text.split())


@pytest.mark.parametrize("block", [1 << 15, 500])
def test_a_group_with_a_fringe_and_a_hot_passage(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "HEAD_TURNS", 1)  # leave work to the search
    rnd = random.Random(9)
    base, passage = prose(rnd, 150, 4000), prose(rnd, 60, 4000)
    texts = [changed(rnd, base, rnd.choice([0, 0.003, 0.01])) for _ in range(30)] + [changed(rnd, base, rnd.uniform(0.01, 0.04)) for _ in range(40)]
    other = prose(rnd, 150, 4000)
    texts += [changed(rnd, other, rnd.uniform(0.005, 0.03)) for _ in range(25)] + [f"{prose(rnd, 40, 9000)} {passage} {prose(rnd, 30, 9000)}" for _ in range(40)]
    rnd.shuffle(texts)
    texts = list(enumerate(texts))
    got = {r.doc_id: r.component_id for r in ngram_join.similarity_join(frame(spark, texts).repartition(3)).collect()}
    want = brute(texts)
    assert got == want and 5 < len(set(want.values())) < len(texts)
