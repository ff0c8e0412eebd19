"""Spelling variants against a brute-force version over whole texts."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from corpusloom.llm import queries as q
from corpusloom.llm import spelling_blocks as sb


def plain_words(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(words):
    near = {w: [v for v in words if v != w and one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    rows = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return rows


def test_query_equals_brute_force(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in q.table(spark, sf, "documents").collect()]
    got = [tuple(r) for r in q.op12_spelling_blocks(spark, sf).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_groups(plain_words(docs))


@pytest.fixture
def variants():
    """Words with chains of ever rarer variants, ties, accents, one very long word, and a word that holds a third of all rows."""
    rng = random.Random(7)
    words = {}
    for _ in range(60):
        w = "".join(rng.choice("abcdeéÿ") for _ in range(rng.randint(6, 9)))
        n = rng.choice([5, 6, 25, 30, 125, 700])
        words[w] = n
        for _ in range(8):
            i, c = rng.randrange(len(w)), rng.choice("abcdeéÿ")
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]])
            words.setdefault(w, rng.choice([5, 5, 6, 26, 130]))
    long = "xy" * 40_000
    words |= {long: 5, long[:-1]: 30, "z" + long[1:]: 5, "commonword": 20_000}
    return {w: n for w, n in words.items() if len(w) >= 6}


@pytest.mark.parametrize("size", [3, 1024])
def test_near_words_in_blocks_of_any_size(spark, variants, monkeypatch, size):
    monkeypatch.setattr(sb, "BLOCK_WORDS", size)
    df = spark.createDataFrame(list(variants.items()), "word string, n long")
    near = {w: [v for v in variants if v != w and abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in variants}
    want = {
        (w, len(vs), *min((-variants[v], v) for v in vs)) for w, vs in near.items() if vs
    }
    got = [(r["word"], r["n_near"], -r["form_n"], r["form"]) for r in sb.near_words(df).collect()]
    assert len(got) == len(want) and set(got) == want


def test_odd_rows(spark):
    rows = [(1, None, "a"), (None, "Straße straße STRASSE " * 5, "b"), (3, "", "c")]
    rows += [(i, "Grüßen grüßet Übungen ÜBUNGEN letters lettres", "x") for i in range(40)] * 2
    rows += [(99, "letter " * 3000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, word string")
    got = {tuple(r) for r in sb.spelling_groups(df).collect()}
    assert got == plain_groups(plain_words([r[:2] for r in rows]))
    assert sb.spelling_groups(df.where("false")).count() == 0


def test_forms_are_followed_to_the_end(spark):
    chain = [(f"w{i}", f"w{i + 1}" if i < 12 else None) for i in range(13)] + [("alone", None)]
    got = dict(map(tuple, sb.follow_forms(spark.createDataFrame(chain, "word string, form string")).collect()))
    assert got == {**{f"w{i}": "w12" for i in range(13)}, "alone": "alone"}
