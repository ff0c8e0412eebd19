"""Ranked lexical search that scores each different bag of item terms once.

A document matters to the items only through how often it holds each of their
terms and through its length factor m. Documents are therefore reduced to their
vectors over the items' vocabulary; rows with the same hash, the same vector and
the same m form a class. Each class is scored once, in blocks of classes
against blocks of items as matrix products, and only the best classes of an item
are expanded into documents, by ascending id.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from corpusloom.llm.common import map_rows
from corpusloom.operators.sampling import with_row_id
from corpusloom.session import cut_lineage

TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BEST = 50

#: A vocabulary of up to this many terms travels with the tasks; a larger one is met by a join.
SHIPPED_TERMS = 500_000

#: Entries of vectors in a block of classes and of a block of items, and cells of a dense matrix.
CLASS_ENTRIES, ITEM_ENTRIES, CELLS = 400_000, 20_000, 1 << 22

#: Rows of one key are first cut to the best ones in this many parts.
SALTS = 16

#: Whole numbers a double holds exactly.
EXACT = 1 << 53


def _bag_of() -> Callable[[str], dict[str, int]]:
    find, lower = re.compile(TERM_PATTERN).findall, {c: c + 32 for c in range(65, 91)}

    def bag(text: str) -> dict[str, int]:
        if text.isascii():
            return Counter(find(text.lower()))
        counts: dict[str, int] = {}
        for term, n in Counter(find(text)).items():
            term = term.lower() if term.isascii() else term.translate(lower)
            counts[term] = counts.get(term, 0) + n
        return counts

    return bag


def term_bags(docs: DataFrame, key: str, text: str, known: dict[str, int] | None = None) -> DataFrame:
    """``key, n`` and the text's terms with their counts: as ``terms, tfs``, or of known terms alone as ``ids, tfs`` by id.

    Null text has no terms. Repeated rows and null keys stay as they are.
    """
    kind = docs.schema[key].dataType.simpleString()

    def make():
        bag_of = _bag_of()

        def step(cols: dict) -> dict:
            out: dict[str, list] = {"key": cols["key"], "n": [], "terms": [], "ids": [], "tfs": []}
            for text in cols["text"]:
                bag = bag_of(text)
                if known is None:
                    named = sorted(bag.items())
                    out["terms"].append([t for t, _ in named])
                else:
                    named = sorted((known[t], c) for t, c in bag.items() if t in known)
                    out["ids"].append([t for t, _ in named])
                out["tfs"].append([c for _, c in named])
                out["n"].append(sum(bag.values()))
            return out

        return step

    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    names = "terms array<string>" if known is None else "ids array<long>"
    return map_rows(rows, make, f"key {kind}, n long, {names}, tfs array<long>").withColumnRenamed("key", key)


def _vectors(docs: DataFrame, vocabulary: DataFrame, key: str, text: str, shipped: int) -> DataFrame:
    """``key, n, ids, tfs`` of every row, written once: its vector over the vocabulary, sorted by term id."""
    if vocabulary.limit(shipped + 1).count() <= shipped:
        known = {r["term"]: r["id"] for r in vocabulary.collect()}
        return cut_lineage(term_bags(docs, key, text, known))
    bags = cut_lineage(term_bags(docs, key, text).withColumn("row", F.monotonically_increasing_id()))
    entries = bags.select("row", F.inline(F.arrays_zip(F.col("terms").alias("term"), F.col("tfs").alias("tf"))))
    met = entries.join(vocabulary, "term").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("id", "tf"))).alias("v"))
    joined = bags.select("row", key, "n").join(met, "row", "left")
    empty = F.coalesce(F.col("v"), F.array().cast("array<struct<id: bigint, tf: bigint>>"))
    return cut_lineage(joined.select(key, "n", empty["id"].alias("ids"), empty["tf"].alias("tfs")))


def best_rows(df: DataFrame, by: str, order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each key with their rank, over parts of the key first, so that no task ranks all of a hot key."""
    place = F.row_number().over(Window.partitionBy(by, "_salt").orderBy(*order))
    parts = df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(SALTS)))
    few = parts.withColumn("_place", place).where(F.col("_place") <= k).drop("_place", "_salt")
    return few.withColumn(rank, F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col(rank) <= k)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = BEST,
    key: str = "doc_id",
    item_key: str = "item_id",
    text: str = "text",
    shipped: int = SHIPPED_TERMS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents with a score above 0.

    Every row of ``docs`` is a document, so repeated rows are ranked one after the
    other; a null id comes last among equal scores. Null and empty texts hold no
    term. Items of one id, null included, are one item with the terms of all its
    rows. Other columns take no part, whatever their names. If either table is
    empty or no term is shared there are no rows.
    """
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    items = items.select(F.col(item_key).alias("item_id"), F.col(text).alias("text"))
    asked = cut_lineage(term_bags(items, "item_id", "text").select("item_id", F.explode("terms").alias("term")).distinct())
    words = asked.select("term").distinct().withColumn("all", F.lit(0))
    vocabulary = cut_lineage(with_row_id(words, ["all"], ["term"], "id").select("term", "id"))
    vectors = _vectors(docs, vocabulary, "doc_id", "text", shipped)

    n_docs, n_terms = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = vectors.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log((2 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    weights = cut_lineage(
        asked.join(vocabulary, "term").join(df, "id").select("item_id", "id", weight.alias("w"))
    )
    factor = F.expr(f"50 + (50 * n * {n_docs}L) div {max(n_terms, 1)}L")
    bags = vectors.where(F.size("ids") > 0).withColumn("m", factor)
    bags = bags.select("doc_id", F.xxhash64("m", "ids", "tfs").alias("hash"), "m", "ids", "tfs")
    same = ["hash", "m", "ids", "tfs"]
    classes = cut_lineage(
        bags.groupBy(*same).agg(F.min("doc_id").alias("first")).withColumn("class", F.monotonically_increasing_id())
    )

    by_score = [F.desc("score"), F.asc_nulls_last("first"), F.asc("class")]
    chosen = cut_lineage(best_rows(_scored(classes, weights, k), "item_id", by_score, k).drop("rank"))
    wanted = classes.join(chosen.select("class").distinct(), "class", "left_semi").select("class", *same)
    members = best_rows(bags.join(wanted, same).select("class", "doc_id"), "class", [F.asc_nulls_last("doc_id")], k)
    ranked = chosen.join(members.drop("rank"), "class").select("item_id", "doc_id", "score")
    found = best_rows(ranked, "item_id", [F.desc("score"), F.asc_nulls_last("doc_id")], k)
    return found.select(F.col("item_id").alias(item_key), "rank", F.col("doc_id").alias(key), "score")


def _scored(classes: DataFrame, weights: DataFrame, k: int) -> DataFrame:
    """``item_id, class, first, score``: the best classes of each item in each block of classes.

    Blocks hold a bounded number of vector entries on both sides; every block of
    classes meets every block of items once.
    """
    by_item = weights.groupBy("item_id").agg(
        F.sort_array(F.collect_list(F.struct("id", "w"))).alias("v")  # one row of a benchmark item: its own terms
    ).select("item_id", F.col("v.id").alias("ids"), F.col("v.w").alias("ws"))
    n_items = weights.count()
    n_classes = classes.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()[0]
    item_blocks, class_blocks = (max(1, -(-n // most)) for n, most in ((n_items, ITEM_ENTRIES), (n_classes, CLASS_ENTRIES)))
    left = classes.select(
        "class", "first", "m", "ids", "tfs", F.pmod("hash", F.lit(class_blocks)).alias("_class_block"),
        F.explode(F.sequence(F.lit(0), F.lit(item_blocks - 1))).alias("_item_block"),
    )
    right = by_item.withColumn("_item_block", F.pmod(F.hash("item_id"), F.lit(item_blocks))).withColumn(
        "_class_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(class_blocks - 1).cast("long")))
    )
    schema = T.StructType(
        [weights.schema["item_id"], classes.schema["class"], classes.schema["first"], T.StructField("score", T.LongType())]
    )
    blocks = ["_class_block", "_item_block"]
    return left.groupBy(*blocks).cogroup(right.groupBy(*blocks)).applyInPandas(_score_block(k), schema)


def _score_block(k: int):
    def run(classes: pd.DataFrame, items: pd.DataFrame) -> pd.DataFrame:
        classes = classes.sort_values(["first", "class"], na_position="last")  # how equal scores are ranked
        found = list(_block_best(classes, items, k)) if len(classes) and len(items) else []
        if not found:
            return pd.DataFrame({"item_id": [], "class": [], "first": [], "score": []})
        at, score, item = (np.concatenate(x) for x in zip(*found))
        rows = classes.iloc[at]
        return pd.DataFrame({
            "item_id": items["item_id"].iloc[item].to_numpy(), "class": rows["class"].to_numpy(),
            "first": rows["first"].to_numpy(), "score": score,
        })

    return run


def _block_best(classes: pd.DataFrame, items: pd.DataFrame, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows of classes, scores, rows of items): for every item its best rows of ``classes``, of equal ones the first."""
    lengths = classes["ids"].str.len().to_numpy()
    ids, tfs = np.concatenate(classes["ids"].to_numpy()), np.concatenate(classes["tfs"].to_numpy())
    m = np.repeat(classes["m"].to_numpy(), lengths)
    value = 1_000_000_000 * tfs // (1000 * tfs + 20 * m)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    item_sizes = items["ids"].str.len().to_numpy()
    width = max(1, int(CELLS // max(1, item_sizes.sum())))
    for low in range(0, len(items), width):
        sizes = item_sizes[low : low + width]
        item_ids = np.concatenate(items["ids"].to_numpy()[low : low + width])
        terms, column = np.unique(item_ids, return_inverse=True)
        ws = np.concatenate(items["ws"].to_numpy()[low : low + width])
        # A term's value is below a million, so sums stay whole numbers in doubles up to EXACT.
        kind = np.float64 if int(ws.max()) * 1_000_000 * int(sizes.max()) < EXACT else np.int64
        weight = np.zeros((len(terms), len(sizes)), dtype=kind)
        weight[column, np.repeat(np.arange(len(sizes)), sizes)] = ws
        where = np.searchsorted(terms, ids)
        hit = np.take(terms, where, mode="clip") == ids
        tall = max(1, CELLS // max(len(terms), len(sizes)))
        for top in range(0, len(classes), tall):
            span = slice(starts[top], starts[min(top + tall, len(classes))])
            entry = np.flatnonzero(hit[span]) + span.start
            row = np.searchsorted(starts, entry, side="right") - 1 - top
            block = np.zeros((min(tall, len(classes) - top), len(terms)), dtype=kind)
            block[row, where[entry]] = value[entry]
            scores = block @ weight
            for j in range(len(sizes)):
                column_ = scores[:, j]
                if len(column_) > k:
                    at = np.flatnonzero(column_ >= max(1, np.partition(column_, -k)[-k]))
                else:
                    at = np.flatnonzero(column_ > 0)
                at = at[np.argsort(-column_[at], kind="stable")][:k]
                yield top + at, column_[at].astype(np.int64), np.full(len(at), low + j)
