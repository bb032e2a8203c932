import random

import pytest

from tests.llm import data
from tidemark.llm import pii_crf


@pytest.fixture(scope="module")
def field():
    return pii_crf.train()


#: Forms that the patterns miss, none of them a line of the labelled table.
PLANTED = {
    "email": ["rita at corner dot net", "otto (at) blue-sky (dot) org", "nina [at] fjord [dot] com", "paul(at)quince.de", "olga arroba naranja punto es", "emil @ turnip.org"],
    "phone": ["312-555-0123", "(0231) 555-8841", "0441 555 7312", "415.555.2671", "01 42 68 53 00", "0033 142 685 300"],
    "card": ["4111.1111.1111.1111", "5500/0000/0000/0004", "4012 - 8888 - 8888 - 1881"],
    "ip": ["10[.]20[.]30[.]40", "172 . 16 . 254 . 3"],
}
CONTEXTS = ["Please note {} as before", "we gave {} to the team", "Reach us under {} tomorrow", "all of them use {} now"]


def planted():
    rnd = random.Random(3)
    out = []
    for kind, forms in PLANTED.items():
        for form in forms:
            for context in CONTEXTS:
                head = data.prose(rnd, 30) + "\n" + context.split("{}")[0]
                out.append((head + form + context.split("{}")[1] + "\n" + data.prose(rnd, 30), (kind, len(head), len(head) + len(form))))
    return out


def test_added_spans_on_planted_forms(field):
    """Recall and precision of what the field adds, with the exact ends of each span."""
    texts = planted()
    found = pii_crf.find(field, [t for t, _ in texts])
    added = [set(every) - set(base) for base, every in found]
    hits = {k: [span in got for got, (_, span) in zip(added, texts) if span[0] == k] for k in PLANTED}
    right, whole = sum(map(sum, hits.values())), sum(map(len, added))
    print({k: f"{sum(h)}/{len(h)}" for k, h in hits.items()}, f"{right} of {whole} added")
    assert right >= 0.75 * len(texts) and right >= 0.9 * whole


def test_clean_numbers_stay_clean(field):
    clean = ["in 1987 about 350 of the 2000 seats at 7:45", "look at dot 12 on the map", "order 98079157628 came, 0810992847249403 did not", "version 2.14.3 of 2021-04-05", "pages 12-15, room 12b and 3-2 after 90 minutes", "he was at home and the dot is red", "| 12 | 340 | 5,600 |"]
    assert [every for _, every in pii_crf.find(field, clean)] == [[]] * len(clean)


def test_neighbours_are_two_spans(field):
    """The card pattern takes both numbers as one and fails; the telephone pattern runs into the address."""
    first, second = "4111111111111111", "5500000000000004"
    text = f"charged {first} {second} today"
    assert pii_crf.find(field, [text])[0] == ([], [("card", 8, 24), ("card", 25, 41)])
    base, every = pii_crf.find(field, ["tel. +1 (826) 555-4081 190.137.223.204 it is"])[0]
    assert [s[0] for s in base] == ["ip"] and ("phone", 5, 22) in every


def test_spans_must_hold():
    assert pii_crf._holds("card", "4111.1111.1111.1111") and not pii_crf._holds("card", "4111.1111.1111.1112")
    assert pii_crf._holds("ip", "10[.]20[.]30[.]40") and not pii_crf._holds("ip", "10[.]20[.]30[.]400")
    assert not pii_crf._holds("phone", "555-01") and not pii_crf._holds("email", "to us")


def test_likelihood_grows_and_tags_keep_their_order():
    lines = ["call {phone 312 555 0123} now", "in 1999 there were 250", "{email a at b dot org}"]
    crf = pii_crf.train(lines, rounds=80)
    for line in lines:
        words, gold = pii_crf.labelled_words(line)
        assert crf.decode(crf.scores(words)[None])[0].tolist() == gold
    assert pii_crf.labelled_words(lines[0]) == (["call", "312", "555", "0123", "now"], [0, 4, 8, 8, 0])


def test_long_lines_and_odd_rows(spark, field):
    rows = [(1, None), (1, None), (2, ""), (None, "tel. (0231) 555-8841 ok"), (3, "12 " * 50_000), (4, "1" * 100_000), (5, "é" * 40_000 + " a(at)b.de")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, spans string, n_email int")
    got = pii_crf.pii_table(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[None].spans == "phone:5:20" and by[1].spans == by[2].spans == by[4].spans == ""
