"""Similarity classes against brute force, with copies, hot groups, nulls and short texts."""

from __future__ import annotations

import random
from collections import defaultdict

from corpusloom.llm import lsh_forest
from corpusloom.llm.lsh_forest import similarity_classes


def shingles(text):
    w = (text or "").split()
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def brute(rows, threshold=0.8):
    sets = [shingles(t) for _, t in rows]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a == b or len(a & b) >= threshold * len(a | b) - 1e-9 and (a or b):
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    members = defaultdict(list)
    for i, (k, _) in enumerate(rows):
        members[root(i)].append(k)
    name = {r: min((k for k in ks if k is not None), default=None) for r, ks in members.items()}
    return sorted(((k, name[root(i)], links[i]) for i, (k, _) in enumerate(rows)), key=repr)


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS class_id", "1 AS bucket")
    return sorted((tuple(r) for r in similarity_classes(df).collect()), key=repr)


def test_families_copies_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(lsh_forest, "BLOCK_ROWS", 16)  # the large family needs several blocks
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows = []
    for family, size in ((1, 60), (2, 3), (3, 2)):
        base = [word() for _ in range(150)]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(150)] = word()
            rows.append((len(rows), " ".join(w)))
    hot = " ".join(word() for _ in range(40))
    rows += [(1000 + i, hot) for i in range(80)]
    rows += [(2000 + i, " ".join(word() for _ in range(rng.randint(1, 60)))) for i in range(30)]
    rows += [(None, hot), (None, rows[0][1]), (3000, None), (3001, ""), (3002, " \t\n"), (3003, "a b"), (3004, "a  b"), (5, rows[5][1])]
    rows += [(4000, " ".join(word() for _ in range(30_000))), (None, "only null here at all now")]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_depth_meets_the_recall():
    d = lsh_forest.depth_for()
    assert 1 - (1 - 0.8**d) ** lsh_forest.TREES >= lsh_forest.RECALL > 1 - (1 - 0.8 ** (d + 1)) ** lsh_forest.TREES
