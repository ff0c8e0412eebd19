"""The suffix tree in memory, as a plain version of ``score_documents``."""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from itertools import chain, compress
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.suffix_tree import DEPTH, DISCOUNT, END, FEWEST, HELD, PENALTY, _slices, count_words, tokens_of
from corpusloom.session import cut_lineage

SHIFT = 31  # bits of a word's number in a string's key


class Tree(NamedTuple):
    """Frequent words and strings. ``keys[k]`` are the sorted keys of strings of k + 2 words:
    the number of the string without its last word, and that word."""

    words: list[bytes]
    counts: np.ndarray
    keys: list[np.ndarray]
    string_counts: list[np.ndarray]

    @property
    def end(self) -> int:
        """Number of the end; -2 where it isn't frequent, and so no context either."""
        return self.words.index(END) if END in self.words else -2


class Scores(NamedTuple):
    """Log10 probabilities: of frequent words at the root; of each string's last word in its context;
    and of the rest of each context, by context length. ``kept[k]`` marks contexts of k + 1 words."""

    root: np.ndarray
    entry: list[np.ndarray]
    rest: list[np.ndarray]
    kept: list[np.ndarray]


class Numbers(dict):
    """Numbers of frequent words, -1 for any other."""

    def __missing__(self, word: bytes) -> int:
        return -1


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of the wanted keys, -1 for those that aren't there."""
    if not len(keys):
        return np.full(len(wanted), -1, np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def _strings(ids: np.ndarray, end: int, tree: Tree) -> list[np.ndarray]:
    """For each position the numbers of the strings of 1, 2, ... words that end there, -1 where not frequent."""
    found = [ids]
    for keys in tree.keys:
        before = _context(found[-1], ids, end)
        both = np.flatnonzero((before >= 0) & (ids >= 0))
        out = np.full(len(ids), -1, np.int64)
        out[both] = _find(keys, (before[both] << SHIFT) | ids[both])
        found.append(out)
    return found


def _context(strings: np.ndarray, ids: np.ndarray, end: int) -> np.ndarray:
    """The string in front of each position; none across the end of a text."""
    before = np.full(len(strings), -1, np.int64)
    before[1:] = np.where(ids[:-1] == end, -1, strings[:-1])
    return before

def code_texts(rows: DataFrame, tree: Tree) -> DataFrame:
    """Texts as numbers of frequent words, and the other words with their counts: ``key, held_out, ids, rare``.

    ``rows`` has ``key, held_out, text``.
    """
    key = rows.schema["key"].dataType.simpleString()
    schema = f"key {key}, held_out boolean, ids array<int>, rare array<struct<word: binary, n: int>>"

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = Numbers((w, i) for i, w in enumerate(tree.words))
        for part in _slices(batches):
            tokens = [tokens_of(t) for t in part.column(2).to_pylist()]
            sizes = np.array([len(t) for t in tokens])
            flat = list(chain.from_iterable(tokens))
            ids = np.fromiter(map(number.__getitem__, flat), np.int32, len(flat))
            rest = ids < 0
            owner = np.repeat(np.arange(len(sizes)), sizes)[rest]
            rare = Counter(zip(owner.tolist(), compress(flat, rest.tolist())))  # in the order of texts
            first = np.searchsorted([i for i, _ in rare], np.arange(len(sizes) + 1))
            words = pa.array([w for _, w in rare], pa.binary())
            counted = pa.StructArray.from_arrays([words, pa.array(rare.values(), pa.int32())], ["word", "n"])
            ends = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
            lists = [
                pa.ListArray.from_arrays(ends, pa.array(ids)),
                pa.ListArray.from_arrays(pa.array(first, pa.int32()), counted),
            ]
            names = ["key", "held_out", "ids", "rare"]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *lists], names=names)

    return rows.mapInArrow(code, schema)


def count_strings(coded: DataFrame, tree: Tree) -> DataFrame:
    """``key, c`` of the strings one word longer than the tree's longest whose parts are all frequent.

    ``coded`` has the one column ``ids``.
    """
    end, tree = tree.end, tree._replace(words=[])  # tasks need numbers only

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in _slices(batches):
            ids = part.column(0).flatten().to_numpy().astype(np.int64)
            found = _strings(ids, end, tree)
            before = _context(found[-1], ids, end)
            # The string without its first word must be frequent too.
            ok = (before >= 0) & (found[-1] >= 0)
            held.append(np.unique((before[ok] << SHIFT) | ids[ok], return_counts=True))
            size += len(held[-1][0])
            if size > HELD:
                held = [_merged(held)]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield _rows(*held[0])
                    held, size = [], 0
        if held:
            yield _rows(*_merged(held))

    def _merged(held: list) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
        return keys[first], np.add.reduceat(counts, first) if len(first) else counts

    def _rows(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts.astype(np.int64))], names=["key", "c"])

    return coded.mapInArrow(count, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))


def _suffixes(tree: Tree) -> list[np.ndarray]:
    """For strings of k + 2 words the number of the string without its first word."""
    found = []
    for k, keys in enumerate(tree.keys):
        context, last = keys >> SHIFT, keys & ((1 << SHIFT) - 1)
        found.append(last if k == 0 else _find(tree.keys[k - 1], (found[k - 1][context] << SHIFT) | last))
    return found


def weigh(tree: Tree, total: int, different: int) -> Scores:
    """Divergence tests, closure under suffixes, and smoothed distributions."""
    root = (tree.counts + 0.1) / (total + 0.1 * (different + 1))
    suffix = _suffixes(tree)
    sizes = [len(tree.words), *map(len, tree.keys)]
    counts = [tree.counts, *tree.string_counts]

    def distributions(kept: list[np.ndarray] | None):
        # of[k]: probability of the last word of each string of k + 1 words after the others, where its context isn't
        # kept that of the shorter context.
        of, rests, keeps = [root], [], []
        for k, keys in enumerate(tree.keys):
            context = keys >> SHIFT
            n = np.bincount(context, minlength=sizes[k])
            own = (tree.string_counts[k] - DISCOUNT) / counts[k][context]
            parent = of[k][suffix[k]]
            left = np.maximum(1 - np.bincount(context, own, sizes[k]), 1e-12)
            parent_left = np.maximum(1 - np.bincount(context, parent, sizes[k]), 1e-12)
            if kept is None:
                gain = np.bincount(context, own * np.log(own / parent), sizes[k]) + left * np.log(left / parent_left)
                keep = (n > 0) & (counts[k] * gain >= PENALTY * (n + 1))
            else:
                keep = kept[k]
            keeps.append(keep)
            rests.append(np.where(keep, left / parent_left, 1.0))
            of.append(np.where(keep[context], own, parent))
        return of, rests, keeps

    _, _, kept = distributions(None)
    for k in range(len(kept) - 1, 0, -1):
        kept[k - 1][suffix[k - 1][kept[k]]] = True
    of, rests, kept = distributions(kept)
    return Scores(np.log10(root), [np.log10(x) for x in of[1:]], [np.log10(x) for x in rests], kept)


class Words(NamedTuple):
    """What a corpus's words say: the tree's frequent ones, the counts of the others, all and different tokens."""

    tree: Tree
    rare: DataFrame
    total: int
    different: int
    fewest: int


def learn_words(texts: DataFrame, fewest: int = FEWEST) -> Words:
    """Count the words of a one-column table of texts."""
    words = cut_lineage(count_words(texts))
    total, different = (int(x or 0) for x in words.agg(F.sum("c"), F.count("*")).first())
    some = words.where(F.col("c") >= fewest).toArrow().sort_by("word")
    tree = Tree(some["word"].to_pylist(), some["c"].to_numpy(), [], [])
    return Words(tree, words.where(F.col("c") < fewest), total, different, fewest)


def grow(words: Words, coded: DataFrame, depth: int = DEPTH) -> tuple[Tree, Scores]:
    """The tree of a table of coded texts, length by length, and its distributions, in memory."""
    tree = words.tree
    for _ in range(depth):
        found = count_strings(coded.select("ids"), tree).where(F.col("c") >= words.fewest).toArrow().sort_by("key")
        keys, counts = found["key"].to_numpy(), found["c"].to_numpy()
        tree = tree._replace(keys=[*tree.keys, keys], string_counts=[*tree.string_counts, counts])
        if not len(keys):
            break
    return tree, weigh(tree, words.total, words.different)


def _word_scores(ids: np.ndarray, end: int, tree: Tree, scores: Scores) -> np.ndarray:
    """Log10 probability of each token; of words that aren't frequent without their share at the root."""
    found = _strings(ids, end, tree)
    out, open_ = np.zeros(len(ids)), np.ones(len(ids), bool)
    for k in range(len(tree.keys) - 1, -1, -1):
        before = _context(found[k], ids, end)
        here = open_ & (before >= 0)
        here[here] = scores.kept[k][before[here]]
        hit = here & (found[k + 1] >= 0)
        out[hit] += scores.entry[k][found[k + 1][hit]]
        miss = here & ~hit
        out[miss] += scores.rest[k][before[miss]]
        open_ &= ~hit
    root = open_ & (ids >= 0)
    out[root] += scores.root[ids[root]]
    return out


# Functions that run in tasks travel inside the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
