import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from barline.llm import signature_search

DOCS = "doc_id long, text string, q string, rank int"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def spelt(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, k):
    """Every document scored for every item."""
    docs = [(i, Counter(t), len(t)) for i, x in rows if (t := spelt(x))]
    n, length = len(docs), sum(d[2] for d in docs)
    df = Counter(t for d in docs for t in d[1])
    out = Counter()
    for item, text in items:
        scored = []
        for doc, tf, size in docs:
            m = 100 - 25 + 25 * size * n // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * tf[t] // (1000 * tf[t] + 12 * m)) for t in spelt(text) if tf[t])
            if s > 0:
                scored.append((-s, doc is not None, doc or 0, doc))
        out.update((item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k]))
    return out


def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)] + ["Über", "naïve", "日本"]
    text = lambda n: " ".join(rng.choices(words, [1 / (1 + i) for i in range(len(words))], k=n))
    rows = [(i, text(rng.randint(1, 200))) for i in range(400)]
    copy, again = text(60), text(40)
    rows += [(1000 + i, copy) for i in range(90)] + [(2000 + i, again + f" w{i % 7}") for i in range(90)]
    rows += [(None, None), (3000, ""), (3001, " .,;"), (7, text(50)), (None, copy), (None, text(30)), (3002, text(30000)), (3003, "ÜBER naïve w1_w2-W3")]
    items = [(i, text(25)) for i in range(30)] + [(90, copy), (91, again), (91, again), (92, ""), (93, None), (94, "nowhere at all"), (None, "w1 w1 W1 w2"), (95, "über")]
    return rows, items


@pytest.mark.parametrize("k", [1, 20])
def test_search_matches_brute_force(spark, monkeypatch, k):
    monkeypatch.setattr(signature_search, "BLOCK_DOCS", 64)
    monkeypatch.setattr(signature_search, "AT_ONCE", 5000)
    monkeypatch.setattr(signature_search, "QUERIES_AT_ONCE", 11)
    rows, items = corpus()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS).repartition(3)
    report = {}
    got = signature_search.search(docs, spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, score string"), k, report=report)
    assert Counter(map(tuple, got.collect())) == brute(rows, items, k)
    assert 0 < report["candidates"] < 0.5 * len(rows) * len(items)


def test_search_of_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert signature_search.search(docs, items).collect() == []
    assert signature_search.search(spark.createDataFrame([(1, "a b", "", 0)], DOCS), items.where("false")).collect() == []
    assert [tuple(r) for r in signature_search.search(spark.createDataFrame([(1, "a b", "", 0)], DOCS), items).select("item_id", "rank", "doc_id").collect()] == [(1, 1, 1)]


def test_bounds_hold_for_every_document():
    rng = random.Random(8)
    docs = [Counter(rng.choices([b"a", b"b", b"c", b"d", b"e"], [9, 3, 2, 1, 1], k=rng.randint(1, 60))) for _ in range(50)]
    slices, words, df, most = signature_search.sliced([(list(c), np.array(list(c.values()))) for c in docs], 256)
    query = signature_search.Query(["a b b", "c d e x"], 50, sum(c.total() for c in docs), {w: (n, m) for w, n, m in zip(words, df.tolist(), most.tolist(), strict=True)})
    m = query.scale(np.array([c.total() for c in docs]))
    bound = query.bounds(slices, m)
    exact = np.array([[query.score(c, int(x), q) for c, x in zip(docs, m, strict=True)] for q in (0, 1)])
    assert (bound >= exact).all() and bound.sum() < 1.5 * exact.sum()
