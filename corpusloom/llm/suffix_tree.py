"""Language-model scores by a probabilistic suffix tree over words.

The tree's nodes are contexts of one to ``depth`` words. Every string of words
seen ``fewest`` times takes part, however large the corpus; of these a context is
kept if its next-word distribution diverges from its suffix's by more than its
entries cost. Distributions are smoothed: repeated next words have their
discounted share, all others what is left, in proportion to the suffix's
distribution, down to the root, which covers every word. A word is scored from
the longest kept context in front of it.

All suffixes of a context end in the same word. So each place's window, its word
and the ``depth`` words in front of it, goes to the bucket of the last of these
once: there all strings of the window are counted, their contexts tested and
kept, and each different window is scored; what contexts change of its score
goes back to the chunk of texts it came from. A word in front of more windows
than fill a bucket is split by the word before it; its own distribution is an
aggregated table, and a first pass over its buckets finds whether any longer
context in them keeps it.

Windows travel as blocks of numbers, each different one of a chunk once. Buckets
hold about ``BUCKET`` windows at any size of the corpus; only two words in
a row that stand in front of more than that are not split further. What buckets
send back is written before it meets the texts, so that windows can go first.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import cut_lineage, delete_table, setting, shuffles_removed

#: Longest context, and smallest count of a string that takes part.
DEPTH, FEWEST = 3, 2
#: The most frequent words, so many at most, that tasks know by number, and other counts that they hold instead of joining them.
COMMON, HELD_COUNTS = 200_000, 4_000_000
#: Tokens of a chunk of texts, and windows of a bucket, about.
CHUNK, BUCKET = 500_000, 1_000_000
#: What contexts change of a window's log10 score is sent in steps of 1 / STEPS, so to within 3e-8.
STEPS = 1 << 24
#: Taken off each count of a next word; gain in nats that an entry of a kept context must bring on average.
DISCOUNT, PENALTY = 0.5, 1.0
END = b"\n"  # no word holds white space
NOTHING = np.iinfo(np.int64).min  # in place of a word before the first
UNSEEN = NOTHING + 1  # in place of a word seen too seldom for any string
#: Bytes of texts that are split at once, about, and texts that go to Python at once.
SLICE, TEXTS = 1 << 23, 2500
#: Different strings that a task holds before it hands their counts on.
HELD = 1_500_000


def tokens_of(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased (nothing else is), then the end."""
    return [*(text or "").encode().lower().split(), END]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of about ``SLICE`` bytes, or one row."""
    for batch in batches:
        rows = max(1, batch.num_rows * SLICE // max(1, batch.nbytes))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _release() -> None:
    """Give back what Arrow has freed: its pool keeps it, and workers stay while tasks come and go."""
    pa.default_memory_pool().release_unused()


def split_texts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """How many tokens each text has, where each token is among the different ones, and these; as ``tokens_of``."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, sizes = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False) + 1
    full = pc.not_equal(pc.binary_length(words), 0)  # white space at either end leaves an empty one
    if not pc.all(full, min_count=0).as_py():
        text = pc.list_parent_indices(lists)
        words, sizes = words.filter(full), np.bincount(text.filter(full).to_numpy(zero_copy_only=False), minlength=len(texts)) + 1
    named = words.dictionary_encode()
    different = pa.concat_arrays([named.dictionary.cast(pa.binary()), pa.array([END], pa.binary())])
    is_word = np.ones(sizes.sum(), bool)
    is_word[np.cumsum(sizes) - 1] = False
    tokens = np.full(len(is_word), len(different) - 1)
    tokens[is_word] = named.indices.to_numpy(zero_copy_only=False)
    return sizes, tokens, different


def count_words(texts: DataFrame) -> DataFrame:
    """``word, c`` over all tokens of a one-column table of texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, size = [], 0
        for part in _slices(batches):
            _, tokens, different = split_texts(part.column(0))
            seen.append(pa.table({"word": different, "c": np.bincount(tokens)}))
            size += len(different)
            if size > HELD:
                seen = [_merged(seen)]
                size = seen[0].num_rows
            if size > HELD // 2 and len(seen) == 1:
                yield from seen[0].to_batches()
                seen, size = [], 0
        if seen:
            yield from _merged(seen).to_batches()
        del seen
        _release()

    def _merged(seen: list[pa.Table]) -> pa.Table:
        found = pa.concat_tables(seen).group_by("word", use_threads=False).aggregate([("c", "sum")])
        return found.rename_columns({"c_sum": "c"}).select(["word", "c"])

    return texts.mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def held_out(key: Column) -> Column:
    """Documents not learned from: crc32 of the id as text, mod 10, is 0. A null id counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 10 == 0


_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(x)
    for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """What ``xxhash64(first, second)`` is in Spark, of two arrays of longs."""

    def turn(x: np.ndarray, n: int) -> np.ndarray:
        return (x << np.uint64(n)) | (x >> np.uint64(64 - n))

    h = np.full(len(first), 42, np.uint64)
    for x in (first, second):
        h = h + _P5 + np.uint64(8)
        h ^= turn(x.astype(np.uint64) * _P2, 31) * _P1
        h = turn(h, 27) * _P1 + _P4
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        h ^= h >> np.uint64(32)
    return h.astype(np.int64)

class Keys(dict):
    """Numbers of common words; of any other a negative 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        return -1 - (int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little") >> 1)


def pack(a: np.ndarray) -> bytes:
    """Rows of longs, compressed by their first bytes, second bytes, ..., as many as the row needs.

    Turned by a bit, numbers and the lowest longs, NOTHING and UNSEEN, need few.
    """
    x = np.ascontiguousarray(np.atleast_2d(a), np.int64).view(np.uint64)
    x = (x << np.uint64(1)) | (x >> np.uint64(63))
    need = [(int(most).bit_length() + 7) // 8 for most in x.max(axis=1, initial=0)]
    planes = [np.ascontiguousarray(row.view(np.uint8).reshape(-1, 8)[:, :k].T).tobytes() for row, k in zip(x, need) if k]
    return bytes(need) + pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def unpack(data: bytes, n: int, rows: int = 1) -> np.ndarray:
    """Rows of ``n`` longs; just the longs where there is one row."""
    need = list(data[:rows])
    planes = np.frombuffer(pa.decompress(data[rows:], decompressed_size=n * sum(need), codec="zstd", asbytes=True), np.uint8)
    x, start = np.zeros((rows, n, 8), np.uint8), 0
    for i, k in enumerate(need):
        x[i, :, :k] = planes[start : start + n * k].reshape(k, n).T
        start += n * k
    x = x.view(np.uint64)[..., 0]
    x = ((x >> np.uint64(1)) | (x << np.uint64(63))).view(np.int64)
    return x[0] if rows == 1 else x


class Plan(NamedTuple):
    """What tasks know of the corpus: numbers of common words by their bounded list, and the ways to the buckets."""

    counts: np.ndarray  # of common words
    hot: np.ndarray  # those that are split
    norm: float
    buckets: int
    depth: int
    fewest: int


class Hot(NamedTuple):
    """Split words, sorted: whether their own context passed its test, is kept, and what it leaves to the root."""

    words: np.ndarray
    passed: np.ndarray
    kept: np.ndarray
    rest: np.ndarray


def _windows(
    ids: np.ndarray, sizes: np.ndarray, depth: int, some: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Words by distance from each place that has a word in front of it (NOTHING before a text), and these places.

    ``some`` marks the words whose windows are wanted, those behind them.
    """
    place = (np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
    wanted = place > 0
    if some is not None:
        wanted[1:] &= some[:-1]
    at = np.flatnonzero(wanted)
    place = place[at]
    words = np.empty((depth + 1, len(at)), np.int64)
    for j in range(depth + 1):
        words[j] = ids[np.maximum(at - j, 0)]
        words[j][place < j] = NOTHING
    return words, at


def _seen_windows(
    ids: np.ndarray, sizes: np.ndarray, found: dict[str, np.ndarray], depth: int, only: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Windows without words that are too rare for any string: contexts end there, as last words they are all one.

    ``only`` names the last context words that are wanted, where not all are.
    """
    ids = ids.copy()
    rare = np.flatnonzero(ids < 0)
    ids[rare[_look_up(ids[rare], found) == 0]] = UNSEEN
    words, at = _windows(ids, sizes, depth, ids != UNSEEN if only is None else np.isin(ids, only))
    cut = np.zeros(len(at), bool)
    for k in range(2, depth + 1):
        cut |= words[k] == UNSEEN
        words[k][cut] = NOTHING
    return words, at


def _is_hot(words: np.ndarray, plan: Plan) -> np.ndarray:
    return np.isin(words, plan.hot)


def _different(words: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different windows in order of their bucket, their buckets, and the window of each place.

    A bucket has all windows of a last context word; of a split word, of the last two.
    """
    hot = np.flatnonzero(_is_hot(words[1], plan))
    second = words[2] if plan.depth > 1 else words[0]
    bucket = (words[1].view(np.uint64) * _P1 >> np.uint64(33)).astype(np.int64) % plan.buckets
    named = pair_keys(words[1][hot], second[hot]).astype(np.uint64) % np.uint64(plan.buckets)
    bucket[hot] = named.astype(np.int64) + plan.buckets
    order, new = _sorted([bucket, *words[1:], words[0]])
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    first = order[new]
    return words[:, first], bucket[first], which


def _sorted(rows: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The order of columns by the first of some rows, the second, ..., and which of them in this order is a new one."""
    # As many rows as fit go into one key.
    keys: list[tuple[np.ndarray, int]] = []
    for row in rows:
        row, span = _small(row)
        if keys and keys[-1][1] * span < 1 << 62:
            keys[-1] = keys[-1][0] * span + row, keys[-1][1] * span
        else:
            keys.append((row, span))
    # The place by the keys before comes in front of the next key, so that each sort is one of plain numbers.
    order = place = None
    for key, span in keys:
        if order is not None:
            key = key[order]
            if len(key) * span >= 1 << 62:
                different, key = np.unique(key, return_inverse=True)
                span = len(different)
            key = place * span + key
        by = np.argsort(key)
        order, key = by if order is None else order[by], key[by]
        new = np.append(True, key[1:] != key[:-1])[: len(key)]
        place = np.cumsum(new) - 1
    return order, new


def _small(row: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers from 0 in the order of the words, and how many there may be: as they are if they are few, else by rank."""
    high, none = int(row.max(initial=0)), row <= UNSEEN
    if high >= 1 << 28 or np.count_nonzero(row < 0) > np.count_nonzero(none):
        different, place = np.unique(row, return_inverse=True)
        return place.reshape(-1), max(1, len(different))
    small = row + 2
    small[none] = row[none] - NOTHING
    return small, high + 3


def _look_up(keys: np.ndarray, facts: dict[str, np.ndarray]) -> np.ndarray:
    """Counts of keys, 0 where unknown."""
    if not len(facts["key"]):
        return np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(facts["key"], keys), len(facts["key"]) - 1)
    return np.where(facts["key"][at] == keys, facts["c"][at], 0)


def _number(ids: np.ndarray, keys: np.ndarray, first: int) -> np.ndarray:
    """Words with those in the sorted ``keys`` numbered from ``first``."""
    if not len(keys):
        return ids
    ids, rare = ids.copy(), np.flatnonzero(ids < 0)
    at = np.minimum(np.searchsorted(keys, ids[rare]), len(keys) - 1)
    ids[rare] = np.where(keys[at] == ids[rare], first + at, ids[rare])
    return ids


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, np.ndarray, np.ndarray]]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(j)[i] for j, name in enumerate(batch.schema.names)}
            yield row, unpack(row["ids"].as_py(), row["n"].as_py()), row["sizes"].values.to_numpy().astype(np.int64)


def _trained(row: dict) -> np.ndarray:
    return ~row["held"].values.to_numpy(zero_copy_only=False).astype(bool)


def _counts(words: np.ndarray, of_rare: np.ndarray, plan: Plan) -> np.ndarray:
    return np.where(words >= 0, plan.counts[np.maximum(words, 0)], of_rare) if len(plan.counts) else of_rare


def _short(counts: np.ndarray) -> np.ndarray:
    """Counts in four bytes each if these are enough."""
    return counts.astype(np.int32) if counts.max(initial=0) < 1 << 31 else counts


def _facts(found: pa.Array | None) -> dict[str, np.ndarray]:
    if found is None or not len(found):
        return {"key": np.zeros(0, np.int64), "c": np.zeros(0, np.int64)}
    keys, counts = (found.field(i).to_numpy(zero_copy_only=False) for i in range(2))
    order = np.argsort(keys)
    return {"key": keys[order], "c": counts[order]}


def _dense(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers from 0 of pairs of numbers."""
    return pd.factorize(a * (int(b.max(initial=0)) + 1) + b)[0]


class Level(NamedTuple):
    """Contexts of one length in a bucket, and the strings in them that take part."""

    context: np.ndarray  # of each row, -1 for none
    string: np.ndarray  # of each row, -1 for none
    whole: np.ndarray  # by context
    shorter: np.ndarray  # by context: the number of its suffix
    inside: np.ndarray  # by string: its context
    count: np.ndarray  # by string
    parent: np.ndarray  # by string: the number of its suffix


def _levels(words: np.ndarray, c: np.ndarray, depth: int, fewest: int) -> list[Level]:
    """Count the strings of 2 to ``depth + 1`` words that end rows."""
    target = pd.factorize(words[0])[0]
    n = len(target)
    # Rows that have a context of this length, and rows whose string takes part, with these.
    within, contexts_of = np.arange(n), np.zeros(n, np.int64)
    rows = np.flatnonzero(words[0] != UNSEEN)
    strings_of = target[rows]
    levels = []
    for k in range(1, depth + 1):
        word = words[k][within]
        some = word != NOTHING
        within, last, word = within[some], contexts_of[some], word[some]
        if word.min(initial=0) < 0 or word.max(initial=0) >= 1 << 28:
            word = pd.factorize(word)[0]
        contexts_of = _dense(last, word)
        contexts = int(contexts_of.max(initial=-1)) + 1
        context, shorter = np.full(n, -1, np.int64), np.zeros(contexts, np.int64)
        context[within], shorter[contexts_of] = contexts_of, last
        whole = np.bincount(contexts_of, c[within], contexts)
        around = context[rows]
        some = around >= 0
        rows, around, before = rows[some], around[some], strings_of[some]
        named = _dense(around, target[rows])
        count = np.bincount(named, c[rows])
        ok = count >= fewest
        strings = int(ok.sum())
        strings_of = np.where(ok, np.cumsum(ok) - 1, -1)[named]
        some = strings_of >= 0
        rows, strings_of = rows[some], strings_of[some]
        string, inside, parent = np.full(n, -1, np.int64), np.zeros(strings, np.int64), np.zeros(strings, np.int64)
        string[rows], inside[strings_of], parent[strings_of] = strings_of, around[some], before[some]
        levels.append(Level(context, string, whole, shorter, inside, count[ok], parent))
    return levels


def _left(level: Level, p: np.ndarray) -> np.ndarray:
    return np.maximum(1 - np.bincount(level.inside, p, len(level.whole)), 1e-12)


def _solve(m: np.ndarray, plan: Plan, hot: Hot | None) -> tuple[np.ndarray, np.ndarray]:
    """What contexts change of the log10 score of each row, and the split words whose kept longer contexts need them.

    Rows of ``m``: the words of a window, its training count, the count of its last
    word unless common, that of its last two where the context's last word is split.
    ``hot`` is given where all windows are of split words.
    """
    words, c, of_word, of_pair = m[:-3], m[-3], m[-2], m[-1]
    root = (_counts(words[0], of_word, plan) + 0.1) / plan.norm
    levels = _levels(words, c, plan.depth, plan.fewest)
    base = 0 if hot is None else 1
    change = np.zeros(len(c))
    tested = closed = root
    if hot is not None:
        at = np.searchsorted(hot.words, words[1])
        seen = of_pair >= plan.fewest
        own = np.where(seen, of_pair - DISCOUNT, 1.0) / plan.counts[words[1]]
        tested = np.where(hot.passed[at] & seen, own, root)
        closed = np.where(hot.kept[at] & seen, own, root)
        change += np.where(hot.kept[at], np.where(seen, np.log10(own / root), hot.rest[at]), 0.0)

    def parents(k: int, first: np.ndarray, of: np.ndarray | None) -> np.ndarray:
        level = levels[k]
        if k > base:
            return of[level.parent]
        out = np.zeros(len(level.count))
        some = level.string >= 0
        out[level.string[some]] = first[some]
        return out

    owns = [(x.count - DISCOUNT) / x.whole[x.inside] for x in levels]
    # The divergence tests, each against the shorter contexts that have passed theirs.
    keeps: list[np.ndarray] = [np.zeros(len(x.whole), bool) for x in levels]
    of = None
    for k in range(base, plan.depth):
        level, own = levels[k], owns[k]
        parent = parents(k, tested, of)
        n = np.bincount(level.inside, minlength=len(level.whole))
        left = _left(level, own)
        gain = np.bincount(level.inside, own * np.log(own / parent), len(level.whole)) + left * np.log(left / _left(level, parent))
        # Rounded, so that the order of sums decides nothing.
        keeps[k] = (n > 0) & (np.round(level.whole * gain - PENALTY * (n + 1), 9) >= 0)
        of = np.where(keeps[k][level.inside], own, parent)
    # Suffixes of kept contexts are kept.
    for k in range(plan.depth - 1, base, -1):
        keeps[k - 1][levels[k].shorter[keeps[k]]] = True
    needed = np.zeros(0, np.int64)
    if hot is not None and plan.depth > 1:
        some = levels[1].context >= 0
        needed = np.unique(words[1][some][keeps[1][levels[1].context[some]]])
    for k in range(base, plan.depth):
        level, own, keep = levels[k], owns[k], keeps[k]
        parent = parents(k, closed, of)
        rest = np.log10(_left(level, own) / _left(level, parent))
        ratio = np.log10(own / parent)
        rows = np.flatnonzero(level.context >= 0)
        rows = rows[keep[level.context[rows]]]
        inside = level.string[rows] >= 0
        change[rows[inside]] += ratio[level.string[rows[inside]]]
        change[rows[~inside]] += rest[level.context[rows[~inside]]]
        of = np.where(keep[level.inside], own, parent)
    return change, needed


def _bucket(table: pa.Table, rows: int) -> tuple[list[int], np.ndarray]:
    """Windows of each chunk in a bucket, and all of them. Last context words come as steps from the one before."""
    sizes = table["n"].to_pylist()
    m, start = np.empty((rows, sum(sizes)), np.int64), 0
    for data, n in zip(table["data"], sizes):
        m[:, start : start + n] = unpack(data.as_py(), n, rows)
        m[1, start : start + n] = np.cumsum(m[1, start : start + n])
        start += n
    return sizes, m


def count_pairs(coded: DataFrame, plan: Plan) -> DataFrame:
    """Pairs that start with a split word and their counts in each chunk, ``part, n, data``.

    In blocks, as windows are: with a row a pair, rows would grow with the number of split words.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, ids, sizes in _chunks(batches):
            trained = _trained(row)
            place, at = _windows(ids, sizes, 1)
            pair = place[:, np.repeat(trained, sizes)[at] & _is_hot(place[1], plan)]
            part = pair_keys(pair[1], pair[0]).astype(np.uint64) % np.uint64(plan.buckets)
            order, new = _sorted([part.astype(np.int64), pair[1], pair[0]])
            n, part = np.bincount(np.cumsum(new) - 1), part[order[new]]
            m = np.vstack([pair[::-1, order[new]], n[: len(part)]])
            ends = [*np.flatnonzero(np.diff(part, prepend=-1)), len(part)] if len(part) else [0]
            spans = list(zip(ends[:-1], ends[1:]))
            arrays = [
                pa.array([int(part[a]) for a, _ in spans], pa.int64()), pa.array([int(b - a) for a, b in spans], pa.int64()),
                pa.array([pack(m[:, a:b]) for a, b in spans], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["part", "n", "data"])

    return coded.mapInArrow(count, "part long, n long, data binary")


def _split_words(coded: DataFrame, words: DataFrame, plan: Plan) -> tuple[DataFrame, Hot]:
    """Counts of the pairs that start with a split word, ``first, second, c, key``, and the words' own tests."""

    def add(table: pa.Table) -> pa.Table:
        m = np.hstack([unpack(data.as_py(), n.as_py(), 3) for data, n in zip(table["data"], table["n"])])
        order, new = _sorted(m[:2])
        c = np.add.reduceat(m[2, order], np.flatnonzero(new))
        first, second = m[:2, order[new]]
        some = c >= plan.fewest
        arrays = [x[some] for x in (first, second, c, pair_keys(first, second))]
        return pa.Table.from_arrays([pa.array(x) for x in arrays], names=["first", "second", "c", "key"])

    pairs = cut_lineage(count_pairs(coded, plan).groupBy("part").applyInArrow(add, "first long, second long, c long, key long"))
    # A pair is no more frequent than its words.
    words = words.where(F.col("c") >= plan.fewest)
    second = words.select(F.col("key").alias("second"), ((F.col("c") + 0.1) / plan.norm).alias("parent"))
    first = words.where((F.col("key") >= 0) & (F.col("c") > BUCKET // 2)).select(F.col("key").alias("first"), F.col("c").alias("whole"))
    own = pairs.join(second, "second").join(first, "first").withColumn("own", (F.col("c") - DISCOUNT) / F.col("whole"))
    tests = own.groupBy("first").agg(
        F.first("whole").alias("whole"), F.count("*").alias("n"),
        F.greatest(1 - F.sum("own"), F.lit(1e-12)).alias("left"), F.greatest(1 - F.sum("parent"), F.lit(1e-12)).alias("parent_left"),
        F.sum(F.col("own") * F.log(F.col("own") / F.col("parent"))).alias("gain"),
    )
    # One row a split word, COMMON at most.
    t = {r["first"]: r for r in tests.collect()}
    hot = plan.hot
    passed, rest = np.zeros(len(hot), bool), np.zeros(len(hot))
    for i, r in ((i, t[w]) for i, w in enumerate(hot.tolist()) if w in t):
        ratio = r["left"] / r["parent_left"]
        gain = r["whole"] * (r["gain"] + r["left"] * math.log(ratio))
        passed[i], rest[i] = round(gain - PENALTY * (r["n"] + 1), 9) >= 0, math.log10(ratio)
    return pairs, Hot(hot, passed, passed, rest)


def _drop(table: DataFrame) -> None:
    """Delete a table of ``cut_lineage`` that a written one has replaced."""
    for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        delete_table(table.sparkSession, path)


def score_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", depth: int = DEPTH, fewest: int = FEWEST
) -> DataFrame:
    """Score every whole text: ``key, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Null texts are empty ones, whose only token is the end; null keys and repeated
    rows stay, one result each; other columns take no part. Without training rows
    every token has probability 1 over the single unknown word.

    Texts are read twice, to count words and to code them as numbers, in chunks of
    about ``CHUNK`` tokens. A chunk sends its different windows to their buckets and
    gets back what contexts change of each window's score.
    """
    rows = docs.select(F.col(key).alias("key"), held_out(F.col(key)).alias("held_out"), F.col(text).alias("text"))
    spark = docs.sparkSession
    batches_of_texts = "spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXTS)
    with shuffles_removed(spark), setting(spark, *batches_of_texts):
        counted = cut_lineage(count_words(rows.where("NOT held_out").select("text")))
    sizes = {r["bits"]: r for r in counted.groupBy(F.length(F.bin("c")).alias("bits")).agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect()}
    total, different = sum(r["c"] for r in sizes.values()), sum(r["n"] for r in sizes.values())
    norm = total + 0.1 * (different + 1)
    bits = next(b for b in range(2, 66) if sum(r["n"] for k, r in sizes.items() if k >= b) <= COMMON)
    some = counted.where(F.col("c") >= F.lit(1 << (bits - 1))).toArrow().sort_by([("c", "descending"), ("word", "ascending")])
    common, counts = some["word"].to_pylist(), some["c"].to_numpy()
    split = np.flatnonzero((counts > BUCKET // 2) & np.array([w != END for w in common], bool))
    plan = Plan(counts, split, norm, max(1, math.ceil(total / BUCKET)), depth, fewest)
    kind = docs.schema[key].dataType.simpleString()

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = Keys((w, i) for i, w in enumerate(common))
        for part in batches:
            named = pa.array([keys[w] for w in part.column(0).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([named, part.column(1)], names=["key", "c"])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, rest = pa.array(common, pa.binary()), Keys()
        parts, held, size = [], [], 0

        def chunk() -> pa.RecordBatch:
            docs = pa.Table.from_batches(parts).combine_chunks()
            ids = np.concatenate(held)
            ends = pa.array([0, docs.num_rows], pa.int32())
            lists = [pa.ListArray.from_arrays(ends, docs.column(i).combine_chunks()) for i in range(3)]
            arrays = [*lists, pa.array([len(ids)], pa.int64()), pa.array([pack(ids)], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, names=["keys", "held", "sizes", "n", "ids"])

        for part in _slices(batches):
            sizes, tokens, different = split_texts(part.column(2))
            named = pc.index_in(different, numbers).fill_null(-1).to_numpy().astype(np.int64)
            rare = np.flatnonzero(named < 0)
            named[rare] = np.fromiter(map(rest.__getitem__, different.take(pa.array(rare)).to_pylist()), np.int64, len(rare))
            ids = named[tokens]
            ends, at = np.cumsum(sizes), 0
            while at < len(sizes):
                # Up to the text that fills the chunk, so that it grows beyond its size by one text at most.
                start = ends[at] - sizes[at]
                stop = min(int(np.searchsorted(ends, start + CHUNK - size)) + 1, len(sizes))
                held.append(ids[start : ends[stop - 1]])
                size += int(ends[stop - 1] - start)
                some = [part.column(0).slice(at, stop - at), part.column(1).slice(at, stop - at), pa.array(sizes[at:stop], pa.int32())]
                parts.append(pa.RecordBatch.from_arrays(some, names=["key", "held", "size"]))
                at = stop
                if size >= CHUNK:
                    yield chunk()
                    parts, held, size = [], [], 0
                    _release()
        if parts:
            yield chunk()

    words = cut_lineage(counted.mapInArrow(name, "key long, c long"))
    _drop(counted)
    coded = rows.mapInArrow(code, f"keys array<{kind}>, held array<boolean>, sizes array<int>, n long, ids binary")
    # Numbered and written in one go: the numbers hold from here on.
    with setting(spark, *batches_of_texts):
        coded = cut_lineage(coded.withColumn("chunk", F.monotonically_increasing_id()))
    known, hot = words.where((F.col("key") < 0) & (F.col("c") >= fewest)), None
    if len(split):
        with shuffles_removed(spark):
            pairs, hot = _split_words(coded, words, plan)
        known = known.union(pairs.select("key", "c"))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, ids, sizes in _chunks(batches):
            pair, _ = _windows(ids, sizes, 1)
            pair = pair[:, _is_hot(pair[1], plan)]
            yield _asked(row, np.unique(np.concatenate([ids[ids < 0], pair_keys(pair[1], pair[0])])))

    def ask_rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, ids, sizes in _chunks(batches):
            if fewest == 2:  # seen less often, a word of a text learned from was seen once
                ids = ids[np.repeat(_trained(row), sizes) == 0]
            ids, found = known_by(row, np.unique(ids[ids < 0]))
            ids = ids[ids < 0]
            yield _asked(row, ids[_look_up(ids, found) == 0])

    def _asked(row: dict, keys: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), row["chunk"].as_py())), pa.array(keys)], names=["chunk", "key"])

    def answered(asked: DataFrame, table: DataFrame) -> DataFrame:
        # At most two keys a token of the chunk.
        return asked.join(table, "key").groupBy("chunk").agg(F.collect_list(F.struct("key", "c")).alias("facts"))

    if known.count() <= HELD_COUNTS:
        # Tasks hold them all: such words get numbers too, and windows go without counts.
        rare = words.where((F.col("key") < 0) & (F.col("c") >= fewest)).toArrow().sort_by("key")
        numbered = rare["key"].to_numpy()
        plan = plan._replace(counts=_short(np.append(counts, rare["c"].to_numpy())))
        of_pairs = {"key": np.zeros(0, np.int64), "c": np.zeros(0, np.int64)}
        if hot is not None:
            of = pairs.toArrow()
            keys = pair_keys(of["first"].to_numpy(), _number(of["second"].to_numpy(), numbered, len(common)))
            order = np.argsort(keys)
            of_pairs = {"key": keys[order], "c": _short(of["c"].to_numpy()[order])}
            del of, keys, order
        del rare
        chunks = coded.withColumn("facts", F.lit(None).cast("array<struct<key: long, c: long>>"))
    else:
        numbered = of_pairs = None
        with shuffles_removed(spark):
            chunks = cut_lineage(coded.join(answered(coded.mapInArrow(ask, "chunk long, key long"), known), "chunk", "left"))
        _drop(coded)

    size = len(common)  # tasks below need no words
    # Sent to an executor once, not with each function.
    shared, shared_pairs = spark.sparkContext.broadcast((plan, numbered)), spark.sparkContext.broadcast(of_pairs)
    del numbered, of_pairs

    def known_by(row: dict, ids: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """The words, by number where tasks hold the counts, and the counts that the chunk was told."""
        _, numbered = shared.value
        return (ids, _facts(row["facts"].values)) if numbered is None else (_number(ids, numbered, size), _facts(None))

    def send(only: np.ndarray | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            plan, _ = shared.value
            for row, ids, sizes in _chunks(batches):
                trained = _trained(row)
                ids, found = known_by(row, ids)
                place, at = _seen_windows(ids, sizes, found, depth, only)
                windows, bucket, which = _different(place, plan)
                del place
                n = np.bincount(which, np.repeat(trained, sizes)[at], len(bucket)).astype(np.int64)
                # Nothing where tasks hold the counts.
                of_word, of_pair = np.zeros((2, len(bucket)), np.int64)
                if len(found["key"]):
                    of_word = np.where(windows[0] < 0, _look_up(windows[0], found), 0)
                    of_pair = np.where(_is_hot(windows[1], plan), _look_up(pair_keys(windows[1], windows[0]), found), 0)
                m = np.vstack([windows, n, of_word, of_pair])
                first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
                m[1] = np.diff(windows[1], prepend=0)
                m[1, first] = windows[1, first]
                spans = list(zip(first, np.append(first[1:], len(bucket))))
                arrays = [
                    pa.array(bucket[first]), pa.array(np.full(len(first), row["chunk"].as_py())),
                    pa.array([int(b - a) for a, b in spans], pa.int64()), pa.array([pack(m[:, a:b]) for a, b in spans], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "chunk", "n", "data"])
                del windows, m, arrays
                _release()

        return chunks.select("chunk", "held", "sizes", "n", "ids", "facts").mapInArrow(run, "bucket long, chunk long, n long, data binary")

    def bucket_of(table: pa.Table) -> tuple[list[int], np.ndarray, bool]:
        """Windows of each chunk, all of them, and whether they are of split words."""
        sizes, m = _bucket(table, depth + 4)
        is_split, of_pairs = table["bucket"][0].as_py() >= shared.value[0].buckets, shared_pairs.value
        if is_split and of_pairs is not None:
            m[-1] = _look_up(pair_keys(m[1], m[0]), of_pairs)
        return sizes, m, is_split

    if hot is not None and not hot.passed.all():
        tested = hot

        def need(table: pa.Table) -> pa.Table:
            return pa.table({"word": _solve(bucket_of(table)[1], shared.value[0], tested)[1]})

        # One row a split word.
        with shuffles_removed(spark):
            more = send(hot.words[~hot.passed]).groupBy("bucket").applyInArrow(need, "word long").distinct().toArrow()
        hot = hot._replace(kept=hot.passed | np.isin(hot.words, more["word"].to_numpy()))

    def solve(table: pa.Table) -> pa.Table:
        plan, _ = shared.value
        sizes, m, is_split = bucket_of(table)
        _release()
        change, _ = _solve(m, plan, hot if is_split else None)
        ends = np.append(0, np.cumsum(sizes))
        steps = np.rint(change * STEPS).astype(np.int64)
        steps = (steps << 1) ^ (steps >> 63)  # small numbers of either sign have few bytes
        data = [pack(steps[a:b]) for a, b in zip(ends[:-1], ends[1:])]
        return pa.table({"chunk": table["chunk"], "bucket": table["bucket"], "n": table["n"], "data": pa.array(data, pa.binary())})

    with shuffles_removed(spark):
        changes = cut_lineage(send(None).groupBy("bucket").applyInArrow(solve, "chunk long, bucket long, n long, data binary"))
    shared_pairs.destroy()

    def score(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        plan, _ = shared.value
        row, ids, sizes = next(_chunks(chunk.combine_chunks().to_batches()))
        seldom = answers.filter(pc.is_valid(answers["key"])).select(["key", "c"]).combine_chunks()
        ids, found = known_by(row, ids)
        place, at = _seen_windows(ids, sizes, found, depth)
        which = _different(place, plan)[2]
        of_rare, rare = np.zeros(len(ids), np.int64), np.flatnonzero(ids < 0)
        for facts in (found, _facts(seldom.to_struct_array().combine_chunks())):
            of_rare[rare] += _look_up(ids[rare], facts)
        of_word = _counts(ids, of_rare, plan)
        if fewest == 2:
            of_word = np.maximum(of_word, np.repeat(_trained(row), sizes))
        base = np.log10((of_word + 0.1) / norm)
        got = answers.filter(pc.is_valid(answers["data"])).sort_by("bucket")
        steps = [unpack(data.as_py(), n.as_py()) for data, n in zip(got["data"], got["n"])]
        steps = np.concatenate([np.zeros(0, np.int64), *steps])
        change = ((steps >> 1) ^ -(steps & 1)) / STEPS
        del got, steps
        _release()
        full = base.copy()
        full[at] += change[which]
        starts = np.cumsum(sizes) - sizes
        sums = [pa.array(np.add.reduceat(x, starts)) for x in ((of_word > 0).astype(np.int64), base, full)]
        names = ["key", "held_out", "n_tokens", "n_known", "base_score", "score"]
        return pa.Table.from_arrays([row["keys"].values, row["held"].values, pa.array(sizes), *sums], names=names)

    asked = chunks.select("chunk", "held", "n", "ids", "sizes", "facts").mapInArrow(ask_rare, "chunk long, key long")
    seldom = asked.join(words.where((F.col("key") < 0) & (F.col("c") < fewest)), "key")
    # Row by row, so that no list of them is built.
    answers = changes.unionByName(seldom.select("chunk", "key", "c"), allowMissingColumns=True)
    scored = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        score, f"key {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    return scored.select(
        F.col("key").alias(key), "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"
    )
