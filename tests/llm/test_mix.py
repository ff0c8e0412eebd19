"""Mixing: targets against plain water filling, taken words against the targets."""

from __future__ import annotations

import re

from corpusloom.llm.hash_mix import mix


def water(sizes: dict, share: float = 1.5, most: int = 2) -> dict:
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(sizes), share * sum(sizes.values())
    while free:
        rate = left / sum(weight[s] for s in free)
        full = {s for s in free if rate * weight[s] >= most * sizes[s]}
        if not full:
            return target | {s: rate * weight[s] for s in free}
        target |= {s: float(most * sizes[s]) for s in full}
        left -= sum(most * sizes[s] for s in full)
        free -= full
    return target


def check(rows, docs):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes: dict = {}
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + size(text)
    target = water(sizes)
    taken: dict = {}
    assert len(rows) == len(docs)
    for r in rows:
        assert abs(r["target"] - target[r["source"]]) < 1e-6 * max(1, target[r["source"]])
        assert r["source_size"] == sizes[r["source"]] and 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s, t in target.items():
        largest = max((size(x[1]) for x in docs if x[2] == s), default=0)
        assert abs(taken[s] - t) <= largest / 2 + 1, (s, taken[s], t)


def test_targets_and_taken(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source")
    first = mix(docs).collect()
    check(first, [tuple(r) for r in docs.collect()])
    again = mix(docs.repartition(5)).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))


def test_hot_null_and_empty(spark):
    docs = [(i, "word " * (i % 7), "hot" if i % 3 else ["a", "b", None][i % 9 // 3]) for i in range(300)]
    docs += [(None, "a b", "hot"), (None, None, "hot"), (1000, None, None), (1001, "", "empty"), (1002, "x " * 2000, "b")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").selectExpr("*", "'x' AS size", "1 AS taken")
    check(mix(df).collect(), docs)
    assert mix(df.where("false")).count() == 0
