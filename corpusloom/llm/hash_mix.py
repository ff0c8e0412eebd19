"""Mixing sources to target weights by hash thresholds.

Every row has a pseudo-random hash. A source that needs a part of its words takes
its rows up to a hash threshold. The threshold is found from histograms: words
are summed by source and leading hash bits, the bucket in which the budget falls
is found from the sums, and only that bucket is summed again by further bits,
until it holds a single hash. Thresholds of growing budgets are nested. Nothing
is sorted but the histogram of one bucket; everything is DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm.common import word_count
from corpusloom.session import broadcast_if_small, cut_lineage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: Hash bits, and bits looked at in one histogram.
BITS, STEP = 60, 12


def row_hash(*columns: Column) -> Column:
    """60 bits of an md5 over the columns as text, the same in any engine."""
    text = F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("~")) for c in columns))
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Targets from ``source, source_size``: adds ``weight, target``.

    Sources in code-point order, null last, take the weights in turn. ``share`` of
    all words is divided by weight; a source stops at ``most`` times its size and
    the others divide its excess, so the sources that stop are those with the
    smallest ratio of limit to weight. The table has one row per source, few
    enough for one task's window.
    """
    everything = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    budget = F.sum("source_size").over(everything) * share
    t = sizes.withColumn("weight", weight).withColumn("budget", budget)
    t = t.withColumn("limit", F.col("source_size") * most)
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col("budget") - F.coalesce(F.sum("limit").over(before), F.lit(0))
    t = t.withColumn("rate", left / F.sum("weight").over(after))
    stops = F.col("limit") <= F.col("rate") * F.col("weight")
    t = t.withColumn("stops", stops)
    # The first source that does not stop sees the rate that all the others share; those after it see less.
    rate = F.max(F.when(~F.col("stops"), F.col("rate"))).over(everything)
    target = F.when(F.col("stops"), F.col("limit").cast("double")).otherwise(rate * F.col("weight"))
    return t.select("source", "source_size", "weight", F.least(target, F.col("limit").cast("double")).alias("target"))


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """Hash below which a source's rows are taken: ``source, threshold`` (rows with ``h < threshold``).

    ``sized`` has ``source, h, size``; ``budgets`` has ``source, budget`` in words. The
    threshold lies next to the hash at which the words reach the budget, on the
    side that comes nearer. One pass over ``sized`` for each 12 bits, of which each
    after the first reads one bucket of each source; it ends when buckets hold one
    hash.
    """
    spark = sized.sparkSession
    open_ = budgets.select(F.col("source").alias("s"), "budget", F.lit(0).cast("long").alias("prefix"))
    done = None
    for bits in range(STEP, BITS + 1, STEP):
        small = broadcast_if_small(open_)
        inside = sized.join(
            small,
            F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("h", BITS - bits + STEP) == F.col("prefix")),
        )
        sums = (
            inside.groupBy("s", "budget", F.shiftright("h", BITS - bits).alias("prefix"))
            .agg(F.sum("size").alias("words"), F.min("h").alias("low"), F.max("h").alias("high"))
        )
        running = Window.partitionBy("s").orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
        reached = F.sum("words").over(running)
        # One bucket a source: the first that reaches the budget. Its histogram has at most 4096 rows.
        hit = sums.withColumn("reached", reached).where("reached >= budget AND reached - words < budget")
        found = cut_lineage(
            hit.select("s", "prefix", "words", "low", "high", (F.col("budget") - F.col("reached") + F.col("words")).alias("budget"))
        )
        ended = found.where("low = high").select(
            "s", F.when(F.col("words") - F.col("budget") <= F.col("budget"), F.col("low") + 1).otherwise(F.col("low")).alias("threshold")
        )
        done = ended if done is None else done.union(ended)
        open_ = found.where("low < high").select("s", "budget", "prefix")
        if open_.isEmpty():
            break
    return cut_lineage(done.select(F.col("s").alias("source"), "threshold")) if done is not None else spark.createDataFrame([], "source string, threshold long")


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST,
) -> DataFrame:
    """How often the mix takes each document: ``key, size, source, source_size, target, times, taken``.

    ``size`` counts words (0 for a null or empty text); ``taken`` is ``times`` the
    size. A source's documents are taken as often as fits its target whole, and
    once more below the hash threshold of the rest, so its words miss the target
    by half a document at most. The hash is of id, source and size: reruns and
    repartitionings agree, rows equal in all three are taken alike. A null source
    is a source, sources without words take nothing. Other columns take no part.

    Words are counted in one pass whose result, four numbers a document, is
    written; all further passes read that. Hot sources are summed before the
    shuffle, and the joins have one row per source on the other side.
    """
    sized = docs.select(
        F.col(key).alias("key"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")
    ).withColumn("h", row_hash(F.col("key"), F.col("source"), F.col("size")))
    sized = cut_lineage(sized)
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = cut_lineage(source_targets(sizes, weights, share, most))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("whole", whole).withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
    limits = thresholds(sized, plan.where("budget > 0").select("source", "budget"))
    plan = plan.join(limits.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")
    plan = broadcast_if_small(
        plan.select(F.col("source").alias("s"), "source_size", "target", "whole", F.coalesce("threshold", F.lit(0)).alias("threshold"))
    )
    times = F.col("whole") + F.when(F.col("h") < F.col("threshold"), 1).otherwise(0)
    mixed = sized.join(plan, F.col("source").eqNullSafe(F.col("s")), "left").withColumn("times", times.cast("int"))
    return mixed.select(
        F.col("key").alias(key), "size", F.col("source").alias(source), "source_size", "target", "times",
        (F.col("size") * F.col("times")).alias("taken"),
    )
