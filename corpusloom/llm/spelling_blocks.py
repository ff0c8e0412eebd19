"""Spelling variants: words at one edit, found by blocked products of letter counts.

The squared distance of two words' letter counts is |a|^2 + |b|^2 - 2ab, so a
product of two blocks of count vectors gives it for all their pairs at once. One
inserted or deleted letter makes it 1 and one replaced letter 2; pairs with
another distance are dropped, the rest are verified letter by letter.

Blocks hold words of one length and equal sums of counts over four groups of
letters. An edit moves these sums by one step at most, so a block meets blocks
of its own and the next length a step away, and no others.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import LoopState, cut_lineage

RUN_PATTERN = "[A-Za-zÀ-ÿ]+"
LEAST_LETTERS, LEAST_COUNT, MUCH_MORE = 6, 5, 5

#: A run loses a letter where this divides its hash.
SLIP = 199

#: Words of a block, letters of a block, and words a task holds before it passes its counts on.
BLOCK_WORDS, BLOCK_LETTERS, HELD_WORDS = 1024, 1 << 17, 200_000

#: Letters by code point modulo four: the groups whose sums name a block.
GROUPS = 4

#: Steps from a block to those it meets: change of length and of the first three sums. Each two blocks meet once.
STEPS = [(0, 0, 0, 0)]
STEPS += [(1, *(int(g == p) for g in range(GROUPS - 1))) for p in range(GROUPS)]
STEPS += [(0, *((g == p) - (g == q) for g in range(GROUPS - 1))) for p in range(GROUPS) for q in range(p + 1, GROUPS)]


def slipped_words(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n``: runs of letters with A-Z lower-cased, some with a letter lost, of all texts.

    A run loses the letter at ``hash % length`` where ``SLIP`` divides the crc32 of
    ``<key>:<run>``. Null texts have no runs, a null key counts as an empty one.
    Repeated rows count each time. Tasks add up before the shuffle, also over rows.
    """
    lower = {c: c + 32 for c in range(65, 91)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, held = re.compile(RUN_PATTERN).findall, Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = Counter(find(text))
                plain: dict[str, int] = {}
                for run, n in own.items():
                    run = run.lower() if run.isascii() else run.translate(lower)
                    plain[run] = plain.get(run, 0) + n
                start = f"{key}:".encode()
                for run, n in plain.items():
                    if len(run) < LEAST_LETTERS:
                        continue
                    h = zlib.crc32(start + run.encode())
                    if h % SLIP == 0:
                        run = run[: h % len(run)] + run[h % len(run) + 1 :]
                        if len(run) < LEAST_LETTERS:
                            continue
                    held[run] += n
                if len(held) >= HELD_WORDS:
                    yield out()
                    held.clear()
        yield out()

    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col(text).alias("text"))
    counted = rows.where("text IS NOT NULL").mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _sums() -> list[Column]:
    letters = [*range(97, 123), *range(0xC0, 0x100)]
    groups = ["".join(chr(c) for c in letters if c % GROUPS == g) for g in range(GROUPS - 1)]
    return [(F.length("word") - F.length(F.translate("word", g, ""))).alias(f"s{i}") for i, g in enumerate(groups)]


def _blocks(words: DataFrame) -> DataFrame:
    """``len, s0, s1, s2, slice, words, ns``: a row for each block, with at most some ``BLOCK_WORDS`` words."""
    cell = ["len", *(f"s{g}" for g in range(GROUPS - 1))]
    placed = words.select("word", "n", F.length("word").alias("len"), *_sums())
    most = F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.floor(BLOCK_LETTERS / F.col("len"))))
    slices = placed.groupBy(*cell).agg(F.count("*").alias("_n")).withColumn("_slices", F.ceil(F.col("_n") / most)).drop("_n")
    dealt = placed.join(slices, cell).withColumn("slice", F.pmod(F.xxhash64("word"), F.col("_slices")))
    return dealt.groupBy(*cell, "slice").agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("b")).select(
        *cell, "slice", F.col("b.word").alias("words"), F.col("b.n").alias("ns")
    )


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, form_n, form``: for words with a near one, how many there are and the most frequent (then smallest).

    ``words`` has distinct words of the letters of ``RUN_PATTERN``. Block pairs are
    rows with two bounded lists; each sends on a row for each of its words only.
    """
    blocks = cut_lineage(_blocks(words))
    cell = ["len", *(f"s{g}" for g in range(GROUPS - 1))]
    steps = F.explode(F.array(*[F.struct(*[F.lit(int(d)).alias(f"d{i}") for i, d in enumerate(s)]) for s in STEPS]))
    left = blocks.withColumn("step", steps).select(
        *[(F.col(c) + F.col(f"step.d{i}")).alias(c) for i, c in enumerate(cell)],
        F.col("slice").alias("slice_a"), F.col("words").alias("words_a"), F.col("ns").alias("ns_a"),
        F.expr(" AND ".join(f"step.d{i} = 0" for i in range(GROUPS))).alias("within"),
    )
    pairs = left.join(blocks, cell).where("NOT within OR slice_a <= slice").withColumn("same", F.expr("within AND slice_a = slice"))
    count = blocks.count()
    parts = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), count // 4)
    spread = pairs.select("words_a", "ns_a", "words", "ns", "same").repartition(parts, "words_a", "words")
    found = spread.mapInArrow(_compare, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("n"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.n")).alias("form_n"), F.col("b.form").alias("form")
    )


def _letters(words: list[str]) -> np.ndarray:
    """Code points, a row for each word of the block's length; they fit into a byte."""
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(len(words), -1)


def _counts(letters: np.ndarray) -> np.ndarray:
    """Letter counts; exact as 32-bit floats while the words are short."""
    kind = np.float32 if letters.shape[1] < 2000 else np.float64
    flat = np.arange(len(letters))[:, None] * 256 + letters
    return np.bincount(flat.ravel(), minlength=256 * len(letters)).reshape(len(letters), 256).astype(kind)


def near_pairs(a: list[str], b: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in a, in b) of the words one edit apart; b's words are as long as a's or one letter longer."""
    first, second = _letters(a), _letters(b)
    x, y = _counts(first), _counts(second)
    used = np.flatnonzero(x.any(0) | y.any(0))
    x, y = x[:, used], y[:, used]
    ones = [np.ones((len(x), 1), x.dtype), np.ones((len(y), 1), y.dtype)]
    # One product gives |a|^2 + |b|^2 - 2ab.
    left = np.hstack([-2 * x, (x * x).sum(1, keepdims=True), ones[0]])
    right = np.hstack([y, ones[1], (y * y).sum(1, keepdims=True)])
    longer = second.shape[1] - first.shape[1]
    i, j = np.divmod(np.flatnonzero((left @ right.T).ravel() == 2 - longer), len(y))
    keep = np.concatenate([_verified(first[i[s : s + 65536]], second[j[s : s + 65536]], longer) for s in range(0, max(1, len(i)), 65536)])
    return i[keep], j[keep]


def _verified(p: np.ndarray, q: np.ndarray, longer: int) -> np.ndarray:
    if not longer:
        return (p != q).sum(1) == 1
    size = p.shape[1]
    ahead = np.logical_and.accumulate(p == q[:, :size], axis=1).sum(1)
    behind = np.logical_and.accumulate(p[:, ::-1] == q[:, :0:-1], axis=1).sum(1)
    return ahead + behind >= size


def _summary(words: list[str], others: list[str], ns: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[tuple]:
    """A row for each word that has near ones in this pair of blocks; ``others`` are in order."""
    order = np.lexsort((j, -ns[j], i))
    at, starts, n = np.unique(i[order], return_index=True, return_counts=True)
    best = j[order][starts]
    return [(words[w], int(c), int(ns[f]), others[f]) for w, c, f in zip(at.tolist(), n.tolist(), best.tolist())]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = [("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())]
    for batch in batches:
        for r in range(batch.num_rows):
            row = batch.slice(r, 1).to_pylist()[0]
            a, b = row["words_a"], row["words"]
            i, j = near_pairs(a, b)
            out = _summary(a, b, np.array(row["ns"]), i, j)
            if not row["same"]:
                out += _summary(b, a, np.array(row["ns_a"]), j, i)
            columns = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], [f for f, _ in fields])


def follow_forms(words: DataFrame) -> DataFrame:
    """``word, root`` of a table ``word, form``: the last word reached by following forms.

    Each round doubles the reach of every word by an equi-join and is written; it
    ends when no word moves, which is soon, as a form is much more frequent.
    """
    state = LoopState(words.sparkSession)
    now = state.save(words.select("word", F.coalesce("form", "word").alias("root")))
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if now.join(onward, "root").where("next <> root").isEmpty():
            return now
        now = state.save(now.join(onward, "root").select("word", F.col("next").alias("root")))


def spelling_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every frequent word of the texts.

    The form is the most frequent near word (of equal ones the smallest in code-point
    order) where it occurs ``MUCH_MORE`` times as often; else it is null. Extra
    columns take no part, whatever their names; an empty table gives no rows.
    """
    words = cut_lineage(slipped_words(docs, key, text))
    joined = words.join(near_words(words), "word", "left")
    has = F.col("form_n") >= MUCH_MORE * F.col("n")
    chosen = cut_lineage(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has, F.col("form")).alias("form"), F.when(has, F.col("form_n")).alias("form_n"),
        )
    )
    return chosen.join(follow_forms(chosen), "word").select("word", "form", "root", "n", "n_near", "form_n")
