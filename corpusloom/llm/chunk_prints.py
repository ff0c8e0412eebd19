"""Document fingerprints by content-defined chunking.

A gear hash rolls over the bytes of a text; a chunk ends where the hash has
certain bits zero. The cut is normalised: below the normal size more bits are
asked for, above it fewer, so sizes gather around it. The hash sees the last
``WINDOW`` bytes only, so an edit moves the cuts next to it and no others. The
fingerprint is the set of chunk digests with their lengths; the share of one
set's length that another set holds measures containment.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm.common import map_rows

#: Bytes the hash looks back on, and the smallest, normal and largest chunk.
WINDOW, SMALLEST, NORMAL, LARGEST = 16, 16, 32, 128
#: Bits that must be zero for a cut before and after the normal size.
HARD, EASY = 0xFE00, 0xE000
#: Documents in one range of successors, and ranges at most.
RANGE_ROWS, RANGES = 2048, 4096


def _gears() -> np.ndarray:
    return np.random.default_rng(8).integers(0, 1 << 32, 256, dtype=np.uint32)


def _cuts(data: bytes, starts: Sequence[int], gears: np.ndarray) -> list[list[int]]:
    """Chunk ends of the texts that begin at ``starts`` in ``data``; the last start is the end of all."""
    h = gears[np.frombuffer(data, np.uint8)]
    step = 1
    while step < WINDOW:
        shifted = np.zeros_like(h)
        shifted[step:] = h[:-step] << np.uint32(step)
        h = h + shifted
        step *= 2
    easy = np.flatnonzero((h & np.uint32(EASY)) == 0) + 1
    hard = easy[(h[easy - 1] & np.uint32(HARD)) == 0].tolist()
    easy = easy.tolist()
    found = []
    for at, end in zip(starts, starts[1:]):
        ends = []
        while at < end:
            middle = at + NORMAL
            i = bisect_left(hard, at + SMALLEST)
            cut = hard[i] if i < len(hard) and hard[i] < middle else None
            if cut is None:
                i = bisect_left(easy, middle)
                cut = min(easy[i] if i < len(easy) else end, at + LARGEST)
            at = min(cut, end)
            ends.append(at)
        found.append(ends)
    return found


def chunk_sets(texts: Sequence[str], gears: np.ndarray) -> list[dict[str, int]]:
    """Digest and byte length of the different chunks of each text."""
    from xxhash import xxh64_hexdigest

    coded = [t.encode() for t in texts]
    data = b"".join(coded)
    starts = np.concatenate([[0], np.cumsum([len(c) for c in coded])]).astype(int).tolist()
    found = []
    for start, ends in zip(starts, _cuts(data, starts, gears) if data else [[] for _ in texts]):
        chunks = {}
        for end in ends:
            chunks[xxh64_hexdigest(data[start:end])] = end - start
            start = end
        found.append(chunks)
    return found


def containment(a: dict[str, int], b: dict[str, int]) -> float:
    """Share of the length of ``a``'s chunks that ``b`` has too; two empty sets contain each other."""
    total = sum(a.values())
    if not total:
        return float(not b)
    return sum(size for digest, size in a.items() if digest in b) / total


def _written(chunks: dict[str, int]) -> str:
    return " ".join(f"{digest}:{size}" for digest, size in sorted(chunks.items()))


def fingerprint_texts(docs: DataFrame, key: str, text: str, others: Sequence[str] = ()) -> DataFrame:
    """Fingerprints of a text column and of further ones: ``key, fingerprint, <other>_fingerprint, near_<other>``.

    A fingerprint is ``digest:bytes`` of each different chunk, sorted; empty for
    an empty or null text. ``near_<other>`` is the share of the fingerprint's
    length that the other text's fingerprint holds, 0 to 1; 1 for two empty
    texts. Equal texts have equal fingerprints. Null keys and repeated rows stay,
    other columns take no part. One narrow pass, no shuffle.
    """
    names = ["text", *others]
    rows = docs.select(
        F.col(key).alias("key"), *(F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in zip([text, *others], names))
    )
    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, fingerprint string" + "".join(
        f", {o}_fingerprint string, near_{o} double" for o in others
    )

    def make():
        gears = _gears()

        def step(cols: dict) -> dict:
            unique = list(dict.fromkeys(t for n in names for t in cols[n]))
            sets = dict(zip(unique, chunk_sets(unique, gears)))
            strings = {t: _written(s) for t, s in sets.items()}
            out = {"key": cols["key"], "fingerprint": [strings[t] for t in cols["text"]]}
            for o in others:
                out[f"{o}_fingerprint"] = [strings[t] for t in cols[o]]
                out[f"near_{o}"] = [containment(sets[a], sets[b]) for a, b in zip(cols["text"], cols[o])]
            return out

        return step

    return map_rows(rows, make, schema).withColumnRenamed("key", key)


def with_successor(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document with the text of the next one by ascending key: ``key, text, next_text``.

    The last one's next is the first, a single one is its own next. Null keys
    come first; equal keys are ordered by a hash of their texts. Null texts count
    as empty. Documents are dealt to ranges of the key (from approximate
    quantiles, so of even size wherever ids are dense or sparse; null keys by
    their hash), the first row of each range goes to the range before it too, and
    each range is ordered on its own: the texts are shuffled once and no task sees
    more than a range. Only ranges and their first keys reach the driver.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    n = rows.count()
    parts = min(RANGES, n // RANGE_ROWS + 1)
    ranks = [i / parts for i in range(1, parts)]
    bounds = sorted(set(rows.approxQuantile("key", ranks, 0.2 / parts))) if ranks else []
    rows = rows.withColumn("range", _range_of(F.col("key"), bounds, F.col("tie")))

    firsts = rows.groupBy("range").agg(F.min(F.struct("key", "tie")).alias("first")).orderBy("range").collect()
    kind = docs.schema[key].dataType.simpleString()
    before = [(r["first"]["key"], r["first"]["tie"], firsts[i - 1]["range"]) for i, r in enumerate(firsts)]
    heads = spark.createDataFrame(before, f"head_key {kind}, head_tie bigint, before bigint")
    # At most RANGES and the 256 ranges of null keys have a head.
    headed = rows.join(
        F.broadcast(heads), F.col("key").eqNullSafe(F.col("head_key")) & (F.col("tie") == F.col("head_tie")), "left"
    )
    place = F.when(F.col("before").isNull(), F.array(F.struct(F.col("range").alias("at"), F.lit(False).alias("copy"))))
    place = place.otherwise(
        F.array(
            F.struct(F.col("range").alias("at"), F.lit(False).alias("copy")),
            F.struct(F.col("before").alias("at"), F.lit(True).alias("copy")),
        )
    )
    dealt = headed.select("key", "text", "tie", F.explode(place).alias("place")).select("key", "text", "tie", "place.*")
    order = Window.partitionBy("at").orderBy("copy", F.col("key").asc_nulls_first(), "tie")
    return (
        dealt.withColumn("next_text", F.lead("text").over(order))
        .where("NOT copy")
        .select(F.col("key").alias(key), "text", "next_text")
    )


def _range_of(key: Column, bounds: list[float], tie: Column) -> Column:
    """Number of bounds at or below the key, found in two steps; null keys by the top byte of their hash, below all."""
    width = max(1, round(len(bounds) ** 0.5))
    blocks = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    if not blocks:
        return F.when(key.isNull(), F.shiftright(tie, 56) - 1000).otherwise(F.lit(0)).cast("long")

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b <= key))

    block = below(F.array(*(F.lit(float(b[0])) for b in blocks)))
    inner = F.array(*(F.array(*(F.lit(float(x)) for x in b)) for b in blocks))
    at = F.when(block == 0, 0).otherwise((block - 1) * width + below(F.element_at(inner, F.greatest(block, F.lit(1)))))
    return F.when(key.isNull(), F.shiftright(tie, 56) - 1000).otherwise(at).cast("long")
