"""Similarity join on word shingles by a MinHash LSH forest, with exact verification.

A document is its set of five-word shingles. Documents with equal sets are
collapsed first. Each tree of the forest reads its own run of minimum hashes; a
prefix of the run is a bucket of the sorted trie. Prefixes start at full depth and
are shortened until a pair at the threshold shares a bucket in at least one tree
with the target recall; that depth depends on trees, threshold and recall alone.

Candidates are never written out as pairs. Buckets with the same members are
merged into one; each member's whole set travels to its buckets, and the exact
similarities of a bucket are computed there, a block against a block, as matrix
products. A pair that shares several buckets counts in the first only. What
leaves a bucket is a row per member: its number of links and the root of its tree
in a spanning forest, from which the classes follow as connected components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import worker_memo
from corpusloom.llm.components import connected_components
from corpusloom.session import broadcast_if_small, cut_lineage, setting

SHINGLE, THRESHOLD = 5, 0.8
TREES, DEEPEST, RECALL = 24, 16, 0.9999
#: Members, and shingles of all members, of a block of a bucket.
BLOCK_ROWS, BLOCK_SHINGLES = 256, 500_000
MEMO_WORDS = 50_000
#: Rows of a batch that travels to or from a Python worker in the passes that end in a written table.
BATCH = 1_000
#: Columns of a matrix product.
CHUNK = 4096
_MIX = np.uint64(0x9E3779B97F4A7C15)


def depth_for(trees: int = TREES, threshold: float = THRESHOLD, recall: float = RECALL, deepest: int = DEEPEST) -> int:
    """Shorten prefixes from the deepest on until a pair at the threshold meets in some tree with the target recall."""
    depth = deepest
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: list[str | None], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the different shingles of all texts, and where each text's begin (one entry more than texts).

    A text of fewer words than a shingle has one shingle, its words; one without words has none.
    """
    from xxhash import xxh64_intdigest

    memo = worker_memo("word_hashes")
    if len(memo) > MEMO_WORDS:
        memo.clear()
    words = [t.encode().split() if t else [] for t in texts]
    for w in set().union(*words):
        if w not in memo:
            memo[w] = xxh64_intdigest(w)
    counts = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(counts)
    flat = np.fromiter((memo[w] for ws in words for w in ws), np.uint64, int(ends[-1]) if len(ends) else 0)
    owner = np.repeat(np.arange(len(words)), counts)
    # Rolling combination of up to `size` words; words past a text's end are left out.
    left = np.repeat(ends, counts) - np.arange(len(flat))
    h = np.zeros(len(flat), np.uint64)
    for i in range(size):
        word = np.zeros(len(flat), np.uint64)
        word[: len(flat) - i] = flat[i:]
        h = _mixed(h * _MIX + np.where(left > i, word, np.uint64(0)) + np.uint64(i))
    starts = ends - counts
    whole = (left >= size) | (np.arange(len(flat)) == np.repeat(starts, counts)) & (np.repeat(counts, counts) < size)
    h, owner = h[whole], owner[whole]
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[new], owner[new]
    return h, np.searchsorted(owner, np.arange(len(words) + 1))


def _set_keys(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One hash per set, from sum and mixed sum of its elements; equal sets have equal keys."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_mixed(h * _MIX + np.uint64(7)))])
    mixed = np.concatenate([[np.uint64(0)], np.cumsum(_mixed(h ^ _MIX))])
    a, b = sums[bounds[1:]] - sums[bounds[:-1]], mixed[bounds[1:]] - mixed[bounds[:-1]]
    return _mixed(a + _mixed(b) * _MIX).view(np.int64)


def _buckets(h: np.ndarray, bounds: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """Bucket of each text in each tree: a hash of the tree and its ``depth`` minimum hashes. For non-empty sets."""
    rng = np.random.default_rng(9)
    out = np.empty((len(bounds) - 1, trees), np.uint64)
    for t in range(trees):
        prefix = np.full(len(bounds) - 1, t, np.uint64)
        for _ in range(depth):
            a, b = rng.integers(0, 1 << 63, 2, dtype=np.uint64)
            least = np.minimum.reduceat(_mixed_light(h ^ b, a), bounds[:-1])
            prefix = _mixed(prefix * _MIX + least)
        out[:, t] = prefix
    return out.view(np.int64)


def _mixed_light(h: np.ndarray, a: np.uint64) -> np.ndarray:
    return h * (a | np.uint64(1))


def _prints(trees: int, depth: int):
    schema = pa.schema([("id", pa.int64()), ("text_key", pa.int64()), ("set_key", pa.int64()), ("n", pa.int32()), ("buckets", pa.list_(pa.int64()))])

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                h, bounds = shingle_sets(batch.column(2).to_pylist())
                n = np.diff(bounds)
                full = np.flatnonzero(n)
                lists: list = [[]] * len(n)
                if len(full):
                    compact = np.append(bounds[full], len(h))
                    for i, row in zip(full, _buckets(h, compact, trees, depth).tolist()):
                        lists[i] = row
                keys, counts = pa.array(_set_keys(h, bounds)), pa.array(n.astype(np.int32))
                columns = [batch.column(0), batch.column(1), keys, counts, pa.array(lists, schema.field(4).type)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return prints


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each wanted set once a task, as sorted 8-byte numbers in one string of bytes, in place of its text."""
    seen: set[int] = set()
    for whole in batches:
        for start in range(0, whole.num_rows, 256):
            batch = whole.slice(start, 256)
            h, bounds = shingle_sets(batch.column(0).to_pylist())
            wanted, keep = batch.column(1).to_pylist(), []
            for i, found in enumerate(_set_keys(h, bounds).tolist()):
                if found == wanted[i] and found not in seen:
                    seen.add(found)
                    keep.append(i)
            packed = pa.array([h[bounds[i] : bounds[i + 1]].tobytes() for i in keep], pa.binary())
            kept = batch.take(pa.array(keep, pa.int64()))
            columns = [kept.column(i) for i in range(1, kept.num_columns)]
            yield pa.RecordBatch.from_arrays([*columns, packed], names=[*kept.schema.names[1:], "shingles"])


def _common(lists: list[np.ndarray]) -> np.ndarray:
    """Number of common elements of each two of some lists without repeats."""
    m = len(lists)
    owner = np.repeat(np.arange(m), [len(x) for x in lists])
    values = np.concatenate(lists) if m else np.zeros(0, np.uint64)
    _, place, count = np.unique(values, return_inverse=True, return_counts=True)
    shared = count > 1
    column = np.cumsum(shared) - 1
    keep = shared[place]
    owner, place = owner[keep], column[place[keep]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    total = np.zeros((m, m))
    width = int(shared.sum())
    for start in range(0, width, CHUNK):
        a, b = np.searchsorted(place, [start, start + CHUNK])
        x = np.zeros((m, min(CHUNK, width - start)), np.float32)
        x[owner[a:b], place[a:b] - start] = 1
        total += x @ x.T
    return total


def _roots(linked: np.ndarray) -> np.ndarray:
    """Smallest index that each row is connected with."""
    labels = np.arange(len(linked))
    while True:
        least = np.minimum(labels, np.where(linked, labels[None, :], len(labels)).min(1))
        least = least[least]
        if (least == labels).all():
            return labels
        labels = least


def _solve_bucket(bucket: int, low: int, high: int, rows: list[dict], threshold: float) -> list[tuple[int, int, int]]:
    """Set key, links and root of the members that have links in this block pair."""
    sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
    n = np.array([len(s) for s in sets], float)
    both = _common(sets)
    linked = (1 + threshold) * both >= threshold * (n[:, None] + n[None, :]) - 1e-9
    np.fill_diagonal(linked, False)
    if low != high:
        block = np.array([r["block"] for r in rows])
        linked &= block[:, None] != block[None, :]
    if linked.any():
        earlier = [np.array([b for b in r["shared"] if b < bucket], np.int64) for r in rows]
        linked &= _common(earlier) == 0
    if not linked.any():
        return []
    copies = np.array([r["copies"] for r in rows])
    links, roots = linked @ copies, _roots(linked)
    return [
        (rows[i]["set_key"], int(links[i]), rows[roots[i]]["set_key"]) for i in np.flatnonzero(linked.any(1)).tolist()
    ]


def _verified(threshold: float):
    schema = pa.schema([("set_key", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for start in range(0, b.num_rows, 512) for r in b.slice(start, 512).to_pylist())
        out: list = []
        for key, members in groupby(rows, key=lambda r: (r["bucket"], r["low"], r["high"])):
            # The same set may come from several tasks.
            out += _solve_bucket(*key, list({r["set_key"]: r for r in members}.values()), threshold)
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema)

    return verify


def similarity_classes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
    trees: int = TREES, recall: float = RECALL,
) -> DataFrame:
    """Class and number of links of every document: ``key, class_id, n_links``.

    A link joins two documents whose sets of five-word shingles have a Jaccard
    similarity of at least ``threshold``; a class is a connected component, named by
    its smallest key. Texts of fewer than five words are one shingle; texts without
    words (empty, null, blank) have empty sets, which equal each other and nothing
    else. Repeated rows are copies like any others. Null keys name no class unless
    it has none but null keys; other columns take no part.

    Copies of a set, however many, are one row from the first aggregation on. No
    pair of documents is ever a row. A bucket of any size is dealt into blocks of
    bounded size, and block pairs are separate pieces of work. Intermediate tables
    go to the checkpoint folder, so a lost executor costs the step at hand.
    """
    depth = depth_for(trees, threshold, recall)
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("id", F.xxhash64("text").alias("text_key"), "text")
    kind = "id long, text_key long, set_key long, n int, buckets array<long>"
    small_batches = "spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH)
    with setting(docs.sparkSession, *small_batches):
        prints = cut_lineage(rows.mapInArrow(_prints(trees, depth), kind))
    sizes = prints.groupBy("set_key").agg(
        F.min("id").alias("first"), F.count("*").alias("copies"), F.min("text_key").alias("text_key")
    )

    # Buckets of different sets; those with the same members are kept once.
    entries = prints.select("set_key", "n", F.explode("buckets").alias("bucket")).distinct()
    members = entries.groupBy("bucket").agg(
        F.count("*").alias("rows"),
        F.sum("n").alias("shingles"),
        F.bit_xor(F.xxhash64("set_key")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit("second"), F.col("set_key"))).alias("y"),
    )
    merged = members.where("rows > 1").groupBy("rows", "shingles", "x", "y").agg(F.min("bucket").alias("bucket"))
    blocks = F.greatest(F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
    merged = cut_lineage(merged.select("bucket", blocks.cast("int").alias("blocks")))
    inside = entries.select("set_key", "bucket").join(merged, "bucket")
    shared = inside.groupBy("set_key").agg(F.sort_array(F.collect_list(F.struct("bucket", "blocks"))).alias("shared"))
    chosen = cut_lineage(shared.join(sizes, "set_key"))  # at most one entry a tree in `shared`

    # The whole sets of candidates only, computed again from one text of each set.
    # Up to 100,000 rows of at most TREES entries, some 50 MB, are broadcast; more are joined by a shuffle.
    wanted = broadcast_if_small(chosen.select("text_key", "set_key", "copies", "shared"), 100_000)
    texts = rows.join(wanted, "text_key").select("text", "set_key", "copies", "shared")
    kind = "set_key long, copies long, shared array<struct<bucket: long, blocks: int>>, shingles binary"
    sets = texts.mapInArrow(_sets, kind)
    at = F.explode("shared").alias("at")
    dealt = sets.select("set_key", "copies", F.col("shared.bucket").alias("shared"), "shingles", at)
    dealt = dealt.select("set_key", "copies", "shared", "shingles", F.col("at.bucket").alias("bucket"), F.col("at.blocks").alias("blocks"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("set_key", "bucket"), F.col("blocks")).cast("int"))
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select(
        "bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", "set_key", "copies", "shared", "shingles",
    )
    order = ["bucket", "low", "high"]
    solved = dealt.repartition(*order).sortWithinPartitions(*order, "set_key")
    with setting(docs.sparkSession, *small_batches):
        solved = cut_lineage(solved.mapInArrow(_verified(threshold), "set_key long, links long, root long"))

    links = solved.groupBy("set_key").agg(F.sum("links").alias("links"))
    classes = connected_components(solved.where("set_key <> root"), "set_key", "root")
    named = sizes.join(classes, sizes["set_key"] == classes["node"], "left").join(links, "set_key", "left")
    named = named.select(
        "set_key", "first", F.coalesce("component", "set_key").alias("component"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    names = named.groupBy("component").agg(F.min("first").alias("class_id"))
    table = cut_lineage(named.join(names, "component").select("set_key", "class_id", "n_links"))
    return prints.select("id", "set_key").join(table, "set_key").select(F.col("id").alias(key), "class_id", "n_links")
