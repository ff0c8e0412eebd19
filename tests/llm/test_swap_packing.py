"""Packing: token ids against the library, whole placements, and exchanges against lower bounds."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from corpusloom.llm import queries as q
from corpusloom.llm import swap_packing as sp

MODEL = q.tokenizer_model("word_bpe_49k.json").decode()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_str(MODEL)


def plain_ids(library, text):
    return np.asarray(library.encode(text or "", add_special_tokens=False).ids, dtype="<u4").tobytes()


def check_places(rows, capacity):
    """Every sequence is filled from 0 without gaps and holds no more than it may; gives the number of sequences."""
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for at, size in sorted(places):
            assert at == end
            end += size
        assert end <= capacity
    return len(sequences)


def test_chunks_have_the_ids_of_the_library(spark, sf, library):
    own = sp.TextEncoder(MODEL)
    texts = ["", " ", "<|endoftext|>", "a<|startoftext|>b <|endo", "a\x1cb\x1f c", "x\x85y z　\xa0w", "I'M you're 12 _a-b!?",
             "é ́a", "Å", "İSTANBUL ΣΑΣ ẞ", "a" * 5000, "漢字 😀🏽‍", "don't " * 3000, "᠎ x​y", "\x00\x01"]
    rng = random.Random(1)
    texts += ["".join(rng.choice("aB'sé́ \n\t\x1d\x85 1-_<|>Σ😀") for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["".join(rng.choice("aB'sREe dLl÷ß É\t\n 1-_<|>") for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += [chr(c) + "x" + chr(c) for c in range(0x250)]
    texts += [r["text"] for r in q.table(spark, sf, "documents").collect()]
    for t, ids in zip(texts, own.encode(texts)):
        assert ids == plain_ids(library, t), t


def test_query_packs_every_token(spark, sf, library):
    rows = q.op11_swap_packing(spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in q.table(spark, sf, "documents").collect()}
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
    assert by_doc.keys() == texts.keys()
    total = 0
    for doc_id, parts in by_doc.items():
        ids = plain_ids(library, texts[doc_id]) + bytes(4)
        parts.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in parts] == list(range(len(parts)))
        assert [r["start"] for r in parts] == list(range(0, len(ids) // 4, 2048))
        for r in parts:
            part = ids[4 * r["start"] : 4 * (r["start"] + r["length"])]
            assert (len(part) // 4, zlib.crc32(part)) == (r["length"], r["ids_crc32"])
            assert r["length"] == min(2048, len(ids) // 4 - r["start"])
        total += len(ids) // 4
    assert check_places(rows, 2048) == -(-total // 2048)


def test_odd_rows(spark):
    rows = [(1, None, "x", 1), (None, "", "y", 2), (2, "hello world " * 2000, None, 3), (2, "hello world " * 2000, None, 3), (3, "a", "z", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece string, sequence_id int")
    out = sp.pack_documents(df, MODEL).collect()
    assert sorted((r["doc_id"] or 0, r["piece"], r["length"]) for r in out) == [
        (0, 0, 1), (1, 0, 1), (2, 0, 2048), (2, 0, 2048), (2, 1, 1953), (2, 1, 1953), (3, 0, 2),
    ]
    check_places(out, 2048)
    assert sp.pack_documents(df.where("false"), MODEL).count() == 0


def test_many_small_groups_and_copies(spark):
    """A third of all pieces have one length, groups are small: everything is placed once and near the bound."""
    rng = random.Random(5)
    lengths = [700] * 1000 + [rng.randint(1, 900) for _ in range(2000)]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "name long, length long").repartition(7)
    out = sp.pack(df, 2048, group=300).collect()
    assert sorted((r["name"], r["length"]) for r in out) == list(enumerate(lengths))
    assert check_places(out, 2048) <= -(-sum(lengths) // 2048) + 2


def test_exchanges_empty_bins_that_best_fit_leaves():
    """Best fit alone needs three bins here, a swap of one for one or of two for one saves the third."""
    rng = random.Random(2)
    saved = 0
    for _ in range(200):
        lengths = [rng.randint(5, 60) for _ in range(rng.randint(3, 40))]
        first = sp.best_fit(lengths, 100)
        after = sp.exchange(first, lengths, 100)
        assert sorted(p for b in after for p in b) == list(range(len(lengths)))
        fills = [sum(lengths[p] for p in b) for b in after]
        assert max(fills) <= 100 and sum(f * f for f in fills) >= sum(sum(lengths[p] for p in b) ** 2 for b in first)
        assert sp.fewest(np.bincount(lengths, minlength=101), 100) <= len(after) <= len(first)
        bad = [[i] for i in range(len(lengths))]
        assert len(sp.exchange(bad, lengths, 100)) <= len(first) + 2
        saved += len(first) - len(after)
    assert saved > 0


def test_lower_bound_is_met_by_exhaustive_search():
    rng = random.Random(3)
    for _ in range(60):
        lengths = [rng.randint(1, 20) for _ in range(7)]

        def least(left, bins):
            if not left:
                return len(bins)
            out = least(left[1:], [*bins, left[0]])
            for i, b in enumerate(bins):
                if b + left[0] <= 20:
                    out = min(out, least(left[1:], [*bins[:i], b + left[0], *bins[i + 1 :]]))
            return out

        assert sp.fewest(np.bincount(lengths, minlength=21), 20) <= least(lengths, []) <= len(sp.pack_group(lengths, [[i] for i in range(7)], 20))
