"""Ranked search against a brute-force version, with both ways to meet the vocabulary and any block size."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from corpusloom.llm import bag_search as bs

LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_force(docs, items, k=50):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    n = sum(1 for _, b in bags if b)
    length = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    rows = set()
    for i, wanted in asked.items():
        scored = []
        for d, b in bags:
            if not b:
                continue
            m = 100 - 50 + 50 * sum(b.values()) * n // length
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * b[t] // (1000 * b[t] + 20 * m))
                for t in wanted if b[t]
            )
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        rows |= {(i, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:k], 1)}
    return rows


@pytest.fixture(scope="module")
def tables():
    """Copies beyond the number ranked, a hot copy of a third of all rows, odd texts, repeated and null ids."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["École", "ÉCOLE", "straße", "漢字", "a1", "A1"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(1, 40)))) for i in range(300)]
    docs += [(1000 + i, "w1 w2 w3, w1; A1") for i in range(150)]
    docs += [(None, "w1 w2 w3 w1 a1"), (None, "w5"), (5, None), (6, ""), (7, "... \n\t"), (8, "w9 " * 50_000), (9, "w9"), (9, "w9")]
    items = [(i, " ".join(rng.choices(words, k=8))) for i in range(25)]
    items += [(3, "w1 w1 w2"), (None, "w4 w5"), (40, None), (41, "unseen words"), (42, "w3 A1 École")]
    return docs, items


@pytest.mark.parametrize("shipped, entries, cells", [(1000, 400_000, 1 << 22), (3, 400_000, 1 << 22), (1000, 97, 64)])
def test_search_equals_brute_force(spark, tables, monkeypatch, shipped, entries, cells):
    docs, items = tables
    monkeypatch.setattr(bs, "CLASS_ENTRIES", entries)
    monkeypatch.setattr(bs, "ITEM_ENTRIES", entries)
    monkeypatch.setattr(bs, "CELLS", cells)
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, score int, ids string").repartition(5)
    i = spark.createDataFrame([(*r, "y") for r in items], "item_id long, text string, term string")
    got = [tuple(r) for r in bs.search(d, i, shipped=shipped).select("item_id", "rank", "doc_id", "score").collect()]
    assert len(got) == len(set(got)) and set(got) == brute_force(docs, items)


def test_sums_beyond_doubles_stay_exact(spark, tables, monkeypatch):
    monkeypatch.setattr(bs, "EXACT", 1)
    docs, items = tables
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items[:9], "item_id long, text string")
    assert {tuple(r) for r in bs.search(d, i, k=7).collect()} == brute_force(docs, items[:9], 7)


def test_empty_tables(spark, tables):
    docs, items = tables
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert bs.search(d.where("false"), i).count() == 0
    assert bs.search(d, i.where("false")).count() == 0
    assert bs.search(d.where("text IS NULL"), i).count() == 0
    names = spark.createDataFrame([("b", "w1"), ("a", "w1"), (None, "w1")], "doc_id string, text string")
    found = bs.search(names, i.where("item_id = 3")).orderBy("rank").collect()
    assert [r["doc_id"] for r in found] == ["a", "b", None]
