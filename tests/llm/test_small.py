"""Brute-force and round-trip tests of the per-document operators, with nulls, ties, odd and very long texts."""

from __future__ import annotations

import hashlib
import html
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from oracle import compare, connect

import plain_tree
from corpusloom.llm import (
    chat_layouts, chunk_prints, lsh_forest, piece_table, pu_quality, suffix_tree, text_density, voronoi_knn,
)
from corpusloom.llm import queries as q
from corpusloom.llm.common import worker_memo
from corpusloom.llm.piece_table import PieceTable, encode_texts


@pytest.mark.parametrize("name", list(q.ORACLES))
def test_queries_match_sql(spark, sf, name):
    assert compare(spark, connect(sf), sf, q.QUERIES[name], q.ORACLES[name]) is None


# ---- SentencePiece


def test_pieces_equal_the_library(spark):
    model = q.tokenizer_model()
    own, sp = PieceTable(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    rng = random.Random(3)
    pieces = [sp.id_to_piece(i).replace("▁", " ") for i in range(259, sp.get_piece_size())]
    texts = ["", " ", "   ", "▁", "a" * 3000, "é́😀\x00\n\t", "the " * 5000, "<s> </s> <0x41>", "ab" * 40 + "\n" * 50]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    texts += ["".join(rng.choice("aeinst =-*_/\n\té😀ǘ漢") for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    for t in texts:
        assert own.encode(t) == sp.encode(t), t
    rows = [(1, "a b", "x"), (None, None, "y"), (1, "a b", "x"), (2, texts[6], None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    for r, (key, text, _) in zip(encode_texts(df.coalesce(1), model).collect(), rows):
        assert (r["doc_id"], r["ids"], r["decoded"]) == (key, sp.encode(text or ""), sp.decode(sp.encode(text or "")))
    assert encode_texts(df.where("false"), model).count() == 0


# ---- chat formatting


def test_a_worker_remembers_a_bounded_part_of_one_operator():
    table = PieceTable(q.tokenizer_model(), memo_words=40)
    sp = sentencepiece.SentencePieceProcessor(model_proto=q.tokenizer_model())
    rng = random.Random(4)
    for _ in range(200):
        text = "common " + " ".join("".join(rng.choices("abcdeé", k=5)) for _ in range(rng.randrange(4)))
        assert table.encode(text) == sp.encode(text)
        held = table._words | table._older
        assert len(held) <= 40 and piece_table.SPACE + "common" in held

    lsh_forest.shingle_sets(["some words of a text"])
    worker_memo("piece_table")["table"] = table
    assert not worker_memo("word_hashes") and not worker_memo("piece_table")


def test_quality_features_of_a_batch_by_slices(monkeypatch):
    monkeypatch.setattr(pu_quality, "TEXTS", 3)
    texts, seen = [f"Text {i}! " * i for i in range(8)], []
    whole, plain = pu_quality.features(texts, pu_quality._classes()), pu_quality.features
    monkeypatch.setattr(pu_quality, "features", lambda part, classes: seen.append(len(part)) or plain(part, classes))
    assert (pu_quality._by_slices(pa.array(texts), pu_quality._classes()) == whole).all() and max(seen) == 3
    assert pu_quality._by_slices(pa.array([], pa.string()), pu_quality._classes()).shape == (0, pu_quality.FEATURES)


def test_layouts_and_round_trip(spark):
    wild = ["</s>[INST] ok [/INST]", "\\[\\INST]", "[[INST]", "<<<SYS>>>", "\\", "\\\\", "", "a\n[AS] x [TEXT] y [/TEXT]", " <s> "]
    schema = (
        "conv_id long, turn long, role string, text string, messages array<struct<role: string, content: string>>,"
        "conversations array<struct<from: string, value: string>>, prompt string, response string,"
        "instruction string, input string, output string, extra string"
    )
    rows, want = [], {}

    def add(key, turns, **fields):
        rows.append({"conv_id": key, **fields})
        want.setdefault(key, []).extend(turns)

    for i, w in enumerate(wild):
        for role in ("user", "assistant", "system", "to[INST]ol", None):
            add(1, [(role or "", w)], turn=len(rows), role=role, text=w)
        add(100 + i, [("user", w), ("assistant", w)], messages=[("user", w), ("assistant", w)], extra="x")
    add(2, [("user", "q"), ("assistant", "a")], conversations=[("human", "q"), ("gpt", "a")])
    add(3, [("user", "q"), ("assistant", "a")], prompt="q", response="a")
    add(4, [("user", "q\n\nmore"), ("assistant", "a")], instruction="q", input="more", output="a")
    add(5, [("user", "")], turn=0, role="user", text=None)
    add(None, [("user", "x"), ("user", "x")], messages=[("user", "x"), ("user", "x")])
    add(6, [], prompt="q", output="no layout has these two")
    df = spark.createDataFrame([tuple(r.get(f) for f in re.findall(r"(\w+) (?:long|string|array)", schema)) for r in rows], schema)
    out = chat_layouts.format_chats(df)
    turns = chat_layouts.parse_chat(out["formatted"]).alias("turns")
    loss = chat_layouts.loss_texts(out["formatted"], out["loss_spans"]).alias("loss")
    found = {r["conv_id"]: r for r in out.select("conv_id", "formatted", turns, loss).collect()}
    assert set(found) == set(want)
    for key, expected in want.items():
        assert [tuple(t) for t in found[key]["turns"]] == expected
        assert found[key]["loss"] == [t for role, t in expected if role == "assistant"]
    assert chat_layouts.format_chats(df.where("false")).count() == 0


# ---- page text


def test_main_text():
    page = """<!DOCTYPE html><html><head><title>t</title><script>var a="</p>";</script></head><body class="has-sidebar">
    <header><h1>Site</h1><ul><li><a href=x>Home</a></ul></header><div id="cookie-notice">We use cookies</div>
    <div class="sidebar"><p>Side text that is quite long, really, with many words in it</div>
    <div class="post"><h1>Title &amp; more</h1><p>First <b>para</b>   with <a href=q>link</a>.<p>Second<br>line &lt;x&gt; &#233;.
    <ul><li>one<li>two</ul><section class="comments"><p>A reader's comment, which is very long as well</section></div>
    <form><input><p>Sub</form><div class="ad">Buy</div><footer>&copy; x</footer></body></html>"""
    assert text_density.main_text(page) == "Title & more\n\nFirst para with link.\n\nSecond line <x> é.\n\none\n\ntwo"
    for odd, text in (("", ""), (None, ""), ("<p>", ""), ("plain &amp text", "plain & text"), ("<article>a<p>b", "a\n\nb"), ("<div" * 3000, "")):
        assert text_density.main_text(odd) == text
    assert len(text_density.main_text("<p>word</p>" * 20_000)) == 20_000 * 6 - 2
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    assert text_density.main_text(deep) == "deep"


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p><img alt=it's>first</p><p>second</p>", "first\n\nsecond"),
        ('<div class="a"">text</div>', "text"),
        ('<p x="unclosed>tail</p>', "tail"),
        ("<p title='a>b' x=\"c>d\">in</p>", "in"),
        ("<div class='has-sidebar'>{article}</div>", "{text}"),
        ("<section class='post-related'>{article}</section>", "{text}"),
        ("<div id='page-header-menu-open'><div class=sidebar>Links</div>{article}<div id=comments><p>So true!</p></div></div>", "{text}"),
        # Comments go although they stand in articles, one without a listed word, and hold more text than the article.
        ("{article}<div class=comments><article class=comment>{article}{article}</article><article>Me too</article></div>", "{text}"),
        ("<div class='post-related'><div class=ad>Buy!</div>{paragraphs}</div>", "{paragraphs_text}"),
    ],
)
def test_pages_keep_their_article(page, text):
    line = "Some words of an article, long enough to count."
    paragraphs, lines = f"<p>{line}</p>" * 5, "\n\n".join([line] * 5)
    article = f"<article><h1>Head</h1>{paragraphs}</article>"
    page = page.replace("{article}", article).replace("{paragraphs}", paragraphs)
    want = text.replace("{text}", f"Head\n\n{lines}").replace("{paragraphs_text}", lines)
    assert text_density.main_text(page) == want


def test_given_pages_equal_their_markup(sf):
    """The given pages keep their article in an article element, and blocks end with a paragraph, heading or item."""
    pages = duckdb.sql(f"SELECT html FROM '{sf}/pages.parquet' WHERE html LIKE '%<article>%</article>%'").fetchall()
    assert len(pages) > 20
    for (page,) in pages:
        inner = page.split("<article>", 1)[1].split("</article>", 1)[0]
        inner = re.sub(r"<!--.*?-->", "", inner, flags=re.S)
        inner = re.sub(r"<(script|style|aside|form|nav|figure)\b.*?</\1>", "", inner, flags=re.S)
        inner = re.sub(r"</?(?:b|i|em|strong|a|span|br)\b[^>]*>", lambda m: "\n" if m[0].startswith("<br") else "", inner)
        own = [" ".join(html.unescape(x).split()) for x in re.split(r"<[^>]+>", inner)]
        assert text_density.main_text(page) == "\n\n".join(x for x in own if x)


def test_pages_query(spark):
    pages = [(1, "u", "<p>a b</p>"), (None, None, None), (1, "u", "<p>a b</p>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 AS text")
    found = sorted((tuple(r) for r in text_density.extract_main_text(df).collect()), key=repr)
    assert found == [(1, "u", "a b"), (1, "u", "a b"), (None, None, "")]


# ---- fingerprints


def test_successors_and_prints(spark, monkeypatch):
    monkeypatch.setattr(chunk_prints, "RANGE_ROWS", 3)
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(1, 9))) for _ in range(5000)]
    docs = [(i * 7, " ".join(rng.choice(words) for _ in range(rng.randint(0, 300)))) for i in range(40)]
    docs += [(1001, None), (1002, "é" * 1000), (1003, docs[0][1]), (1004, "z" * 200_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS next_text").repartition(4)
    found = {r["doc_id"]: r for r in chunk_prints.with_successor(df).collect()}
    assert len(found) == len(docs)
    for i, (key, text) in enumerate(docs):
        assert found[key]["text"] == (text or "") and found[key]["next_text"] == (docs[(i + 1) % len(docs)][1] or "")
    nulls = spark.createDataFrame([(None, "a"), (None, "b"), (None, "a"), (3, "c")], "doc_id long, text string")
    got = [(r["doc_id"], r["text"], r["next_text"]) for r in chunk_prints.with_successor(nulls).collect()]
    assert len(got) == 4 and Counter(x[2] for x in got) == Counter(x[1] for x in got)
    assert chunk_prints.with_successor(nulls.where("false")).count() == 0


def test_chunks_resist_shifts():
    gears, rng = chunk_prints._gears(), random.Random(4)
    text = " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(2000))
    a, shifted, other, again = chunk_prints.chunk_sets([text, "new start " + text, text[::-1], text], gears)
    assert a == again and chunk_prints.containment(a, shifted) > 0.98 and chunk_prints.containment(a, other) < 0.02
    # Cut one text alone: the same chunks as within a batch, of the allowed sizes, that make up the text.
    data = text.encode()
    ends = chunk_prints._cuts(data, [0, len(data)], gears)[0]
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(data) and sizes[:-1].min() >= chunk_prints.SMALLEST and sizes.max() <= chunk_prints.LARGEST
    assert chunk_prints.containment({}, {}) == 1 and chunk_prints.containment({}, a) == 0 == chunk_prints.containment(a, {})


def _plain_chunks(text: str) -> dict[str, int]:
    """Chunks of a text cut byte by byte: the hash is the sum of the last bytes' gears, each shifted by its distance."""
    gears = [int(g) for g in chunk_prints._gears()]
    data, chunks, start = text.encode(), {}, 0
    for i in range(len(data)):
        size = i + 1 - start
        window = data[max(0, i + 1 - chunk_prints.WINDOW) : i + 1][::-1]
        rolled = sum(gears[b] << k for k, b in enumerate(window)) & 0xFFFFFFFF
        bits = chunk_prints.HARD if size < chunk_prints.NORMAL else chunk_prints.EASY
        cut = size >= chunk_prints.SMALLEST and not rolled & bits
        if cut or size == chunk_prints.LARGEST or i + 1 == len(data):
            chunks[xxhash.xxh64_hexdigest(data[start : i + 1])] = size
            start = i + 1
    return chunks


def test_fingerprint_query_by_brute_force(spark, sf, tmp_path):
    """All columns of the query, over given texts, odd ones and equal ones."""
    some = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet' ORDER BY length(text), doc_id LIMIT 60").fetchall()
    docs = [(i, t) for i, t in some] + [(10**9, None), (10**9 + 1, ""), (10**9 + 2, "é😀x"), (10**9 + 3, "ab"), (10**9 + 4, some[9][1] * 3)]
    docs += [(10**9 + 5, some[9][1]), (10**9 + 6, some[8][1] + some[9][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    df.selectExpr("*", "'x' AS edited", "1 AS near_next").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in q.op8_chunk_prints(spark, str(tmp_path)).collect()}
    docs.sort()
    assert set(found) == {i for i, _ in docs}
    prints = {t: _plain_chunks(t) for t in {t or "" for _, t in docs}}

    def near(a: dict, b: dict) -> float:
        return sum(n for c, n in a.items() if c in b) / sum(a.values()) if a else float(not b)

    def printed(chunks: dict) -> str:
        return " ".join(f"{c}:{n}" for c, n in sorted(chunks.items()))

    for at, (key, text) in enumerate(docs):
        text, following = text or "", docs[(at + 1) % len(docs)][1] or ""
        moved = len(text) // 4
        edited = text[: len(text) - moved] + following[:moved]
        own, other = prints[text], _plain_chunks(edited)
        row = found[key].asDict()
        assert row.pop("near_edited") == pytest.approx(near(own, other)) and row.pop("near_next") == pytest.approx(near(own, prints[following]))
        assert row == {
            "doc_id": key, "n_chars": len(text), "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(),
            "fingerprint": printed(own), "edited_fingerprint": printed(other),
        }


# ---- quality


def test_quality_on_held_out_rows(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    found = {r["doc_id"]: r for r in pu_quality.score_documents(docs, labels).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for i, r in found.items())
    truth = [(r["quality"], found[r["doc_id"]]) for r in labels.collect() if found[r["doc_id"]]["held_out"]]
    assert np.mean([r["predicted"] == 1 for y, r in truth if y == 1]) >= 0.98
    assert np.mean([r["predicted"] == 0 for y, r in truth if y == 0]) >= 0.8
    # Labels of held-out rows make no difference.
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(string(doc_id)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    again = {r["doc_id"]: r["score"] for r in pu_quality.score_documents(docs, flipped).collect()}
    assert all(abs(again[i] - r["score"]) < 1e-9 for i, r in found.items())


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1.0), (None, "", 2.0), (2, "w " * 100_000, None)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (None, 1), (2, None)], "doc_id long, quality int")
    assert [0 <= r["score"] <= 1 for r in pu_quality.score_documents(docs, labels).collect()] == [True] * 3
    none = pu_quality.score_documents(docs, labels.where("false")).collect()
    assert {r["score"] for r in none} == {0.5}
    assert pu_quality.score_documents(docs.where("false"), labels).count() == 0


# ---- suffix tree


def test_suffix_tree_is_a_distribution(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["the cat sat", "a dog ran", "The", "x y", "rare%d" % rng.randint(0, 50)]) for _ in range(30)) for _ in range(60)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, None), (3, texts[3]), (500, ""), (501, "new " * 50_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS score", "'w' AS word").repartition(3)
    found = suffix_tree.score_documents(df).collect()
    assert len(found) == len(docs)
    learned: Counter = Counter()
    tokens = lambda t: [w.lower() for w in (t or "").split()] + ["\n"]
    for key, t in docs:
        if zlib.crc32(("" if key is None else str(key)).encode()) % 10:
            learned.update(tokens(t))
    n, v = sum(learned.values()), len(learned)
    base = {(k, t): sum(math.log10((learned[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t)) for k, t in docs}
    text_of = {}
    for k, t in docs:
        text_of.setdefault(k, t)
    for r in found:
        t = text_of[r["doc_id"]]
        assert r["train_tokens"] == n and r["n_tokens"] == len(tokens(t))
        assert r["n_known"] == sum(w in learned for w in tokens(t))
        assert abs(r["base_score"] - base[r["doc_id"], t]) < 1e-6 * max(1, abs(r["base_score"]))
    assert sum(r["score"] for r in found if not r["held_out"]) > sum(r["base_score"] for r in found if not r["held_out"])

    # After any two words the probabilities of all words and of the unknown one add up to 1.
    train = df.where(~suffix_tree.held_out(df["doc_id"])).selectExpr("doc_id AS key", "false AS held_out", "text")
    learned_words = plain_tree.learn_words(train.select("text"))
    tree, scores = plain_tree.grow(learned_words, plain_tree.code_texts(train, learned_words.tree))
    assert any(k.any() for k in scores.kept)
    number, norm = {w: i for i, w in enumerate(tree.words)}, n + 0.1 * (v + 1)
    for first in ("the cat", "a dog", "y the", "unseen x"):
        history = [number.get(w, -1) for w in first.encode().split()]
        total_p = 0.0
        for w in [*(w.encode() for w in learned), b"never seen"]:
            ids = np.array([*history, number.get(w, -1)])
            own = plain_tree._word_scores(ids, number[b"\n"], tree, scores)[-1]
            total_p += 10 ** (own if w in number else own + math.log10((learned[w.decode()] + 0.1) / norm))
        assert abs(total_p - 1) < 1e-6
    assert suffix_tree.score_documents(df.where("false")).count() == 0
    lone = suffix_tree.score_documents(df.where("doc_id = 500")).collect()
    assert len(lone) == 1 and lone[0]["n_tokens"] == 1


def test_suffix_tree_keeps_contexts_at_any_size(spark, monkeypatch):
    from pyspark.sql import functions as F

    pairs = [(i, i + 7) for i in range(5)]
    assert spark.createDataFrame(pairs, "a long, b long").select(F.xxhash64("a", "b")).toPandas().iloc[:, 0].tolist() == (
        suffix_tree.pair_keys(*np.array(pairs).T).tolist()
    )
    # Tables and the tree in memory agree, whatever share of the tokens counts as common.
    rng = random.Random(8)
    said = ["alpha beta gamma delta", "beta gamma epsilon", "gamma delta zeta eta", "x", "y z"]
    texts = [" ".join(rng.choice(said) if rng.random() < 0.8 else "w%d" % rng.randint(0, 60) for _ in range(20)) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = df.select(F.col("doc_id").alias("key"), suffix_tree.held_out(df["doc_id"]).alias("held_out"), "text")
    words = plain_tree.learn_words(rows.where("NOT held_out").select("text"))
    coded = plain_tree.code_texts(rows, words.tree)
    tree, scores = plain_tree.grow(words, coded.where("NOT held_out"))
    assert all(k.any() for k in scores.kept)
    want = {r["key"]: float(plain_tree._word_scores(np.array(r["ids"]), tree.end, tree, scores).sum()) for r in coded.collect()}
    base = {r["key"]: sum(scores.root[i] for i in r["ids"] if i >= 0) for r in coded.collect()}
    ways = [(10**6, 10**6, 10**6, 0, 10**6), (9, 10**6, 100, 0, 0), (0, 200, 500, 0, 10**6), (10**6, 100, 300, 4, 0), (20, 20, 50, 9, 10**6), (20, 20, 50, 9, 0)]
    for common, bucket, chunk, split, held in ways:
        monkeypatch.setattr(suffix_tree, "COMMON", common)
        monkeypatch.setattr(suffix_tree, "HELD_COUNTS", held)
        monkeypatch.setattr(suffix_tree, "BUCKET", bucket)
        monkeypatch.setattr(suffix_tree, "CHUNK", chunk)
        assert sum(c > bucket // 2 for c in tree.counts) >= split
        found = suffix_tree.score_documents(df).collect()
        assert len(found) == len(texts)
        for r in found:
            assert abs((r["score"] - r["base_score"]) - (want[r["doc_id"]] - base[r["doc_id"]])) < 1e-6


def test_suffix_tree_with_a_split_word_that_only_longer_contexts_keep(spark, monkeypatch):
    from pyspark.sql import functions as F

    # "of" is followed by all words alike, but after "king of" always by one.
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randint(0, 30)} of w{rng.randint(0, 30)}" for _ in range(40)) + " king of spain" for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = df.select(F.col("doc_id").alias("key"), suffix_tree.held_out(df["doc_id"]).alias("held_out"), "text")
    words = plain_tree.learn_words(rows.where("NOT held_out").select("text"))
    coded = plain_tree.code_texts(rows, words.tree)
    tree, scores = plain_tree.grow(words, coded.where("NOT held_out"))
    want = {r["key"]: float(plain_tree._word_scores(np.array(r["ids"]), tree.end, tree, scores).sum()) for r in coded.collect()}
    base = {r["key"]: sum(scores.root[i] for i in r["ids"] if i >= 0) for r in coded.collect()}
    for bucket in (10**6, 1000):
        monkeypatch.setattr(suffix_tree, "BUCKET", bucket)
        for r in suffix_tree.score_documents(df).collect():
            assert abs((r["score"] - r["base_score"]) - (want[r["doc_id"]] - base[r["doc_id"]])) < 1e-6


def test_suffix_tree_drops_no_context_of_a_large_corpus(spark):
    # Four million tokens more made a share of 1e-6 of what three repetitions don't reach; one word is two thirds of all.
    texts = [(i, "red fox jumps") for i in (1, 2, 3)] + [(100 + i, "pad pad of%d " % (i % 3) * 110_000) for i in range(12)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: r for r in suffix_tree.score_documents(df).collect()}
    assert len(found) == 15 and found[1]["train_tokens"] > 3e6
    assert found[1]["score"] > found[1]["base_score"] + 8


# ---- nearest neighbours


@pytest.mark.parametrize("settings", [{}, {"pivots": 3, "group_queries": 4, "slice_rows": 20}])
def test_top_products(spark, settings):
    rng = np.random.default_rng(1)
    vectors = [(i, (rng.normal(size=6) + (i % 4) * 2).tolist()) for i in range(150)]
    vectors += [(i, vectors[7][1]) for i in range(150, 230)]  # a common vector
    vectors += [(300, None), (301, [1.0, None]), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (None, [1.0] * 6)]
    vectors += [(304, [0.5, 0.25]), (305, []), (10, vectors[10][1]), (11, [9.0] * 6)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").selectExpr("*", "1 AS score", "2 AS cell")
    fine = [(i, v) for i, v in vectors if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ints = [(i, [math.floor(256 * x) for x in v] + [0] * (6 - len(v))) for i, v in fine]
    want = set()
    for i in {i for i, _ in ints if i % 5 == 0}:
        best: dict = {}
        for qv in (v for j, v in ints if j == i):
            for j, v in ints:
                if j != i:
                    best[j] = max(best.get(j, -(10**18)), sum(a * b for a, b in zip(qv, v)))
        for rank, (j, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:5]):
            want.add((i, rank + 1, j, s))
    found = voronoi_knn.top_products(df, df["vec_id"] % 5 == 0, **settings).collect()
    assert {tuple(r) for r in found} == want and len(found) == len(want)
    assert voronoi_knn.top_products(df.where("false"), df["vec_id"] % 5 == 0).count() == 0
    few = voronoi_knn.top_products(df.where("vec_id IN (0, 1, 2)"), df["vec_id"] % 5 == 0).collect()
    assert sorted((r["query_id"], r["rank"]) for r in few) == [(0, 1), (0, 2)]


def test_top_products_of_an_id_with_many_copies(spark):
    # All rows are pivots, so bounds are exact; copies of one id must not stand in for other ids.
    vectors = [(0, [1.0, 0.0])] + [(1, [9.0, 0.0])] * 8 + [(i, [9.0 - i, float(i)]) for i in range(2, 8)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    found = voronoi_knn.top_products(df, df["vec_id"] == 0).collect()
    want = [(0, n + 1, i, 65536 * (9 if i == 1 else 9 - i)) for n, i in enumerate(range(1, 6))]
    assert sorted(tuple(r) for r in found) == want
    # Copies of the query's own id take no places either.
    own = spark.createDataFrame([(0, [9.0, 0.0])] * 8 + vectors, "vec_id long, embedding array<double>")
    assert {(r["rank"], r["vec_id"]) for r in voronoi_knn.top_products(own, own["vec_id"] == 0).collect()} == {(n, n) for n in range(1, 6)}


# ---- URLs


def test_blocks_spread_over_aliases(spark):
    from corpusloom.llm.url_verdicts import judge_urls

    link = lambda u: f'<link rel="canonical" href="{u}">'
    pages = [
        (1, "http://bad.net/x", None),
        (2, "http://a.org/x", link("http://bad.net/x")),
        (3, "http://b.org/y#f", "<meta http-equiv=refresh content='0; url=http://a.org/x'>"),
        (4, "http://c.org/fr/z", link("http://b.org/y")),
        (5, "http://d.org/", link("/other")),
        (6, None, link("http://bad.net/x")),
        (7, "no scheme", ""),
        (8, "HTTP://Www.EXAMPLE.net/en/a?q#t", None),
        (None, "http://bad.net", None),
        (2, "http://a.org/x", link("http://bad.net/x")),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 AS rule", "2 AS host")
    found = Counter((r["page_id"], r["rule"], r["verdict"]) for r in judge_urls(df, q.URL_RULES).collect())
    assert found == Counter(
        [(1, "net/", "block"), (2, None, "block"), (3, None, "block"), (4, "org/fr/", "allow"), (5, None, "allow"),
         (6, None, "allow"), (7, None, "allow"), (8, "example.net/en/", "allow"), (None, None, "allow"), (2, None, "block")]
    )
    more = spark.createDataFrame([("http://d.org/other", "http://bad.net/x")], "a string, b string")
    assert {r["page_id"]: r["verdict"] for r in judge_urls(df, q.URL_RULES, more).collect()}[5] == "block"
    assert judge_urls(df.where("false"), q.URL_RULES).count() == 0

def test_top_products_with_a_common_id(spark):
    """One id holds a third of all rows, as data and as queries; it counts once."""
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(1, 401)]
    rows += [(50, rng.normal(size=6).tolist()) for _ in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = voronoi_knn.top_products(df, df["vec_id"] % 50 == 0, group_queries=16, slice_rows=64).collect()
    whole = [(i, np.floor(np.array(v) * 256)) for i, v in rows]
    want = []
    for query in range(50, 401, 50):
        best: dict[int, int] = {}
        for own in (v for i, v in whole if i == query):
            for i, v in whole:
                if i != query:
                    best[i] = max(best.get(i, -(1 << 60)), int(own @ v))
        top = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:5]
        want += [(query, n, i, score) for n, (i, score) in enumerate(top, 1)]
    assert sorted(tuple(r) for r in found) == want
