"""The word tree's windows: how texts are split, sorted and packed."""

from collections import Counter

import numpy as np
import pyarrow as pa

from corpusloom.llm import suffix_tree
from corpusloom.llm.suffix_tree import NOTHING, UNSEEN
from corpusloom.session import setting, shuffles_removed


def test_texts_are_split_as_their_tokens():
    texts = ["", None, " a  B\x0bc\x1c\x85d \n", "x", "É É ẞ A\x00b", "\t\t", "Z z"]
    sizes, tokens, different = suffix_tree.split_texts(pa.array(texts))
    want = [suffix_tree.tokens_of(t) for t in texts]
    assert sizes.tolist() == [len(w) for w in want]
    assert [different[i].as_py() for i in tokens] == [w for words in want for w in words]


def test_any_longs_come_back():
    rows = np.array([[1, 2, NOTHING, UNSEEN, -1, -5, 2**40], [0] * 7, [3, 1, 2, 2, 2, 1, 9]], np.int64)
    assert (suffix_tree.unpack(suffix_tree.pack(rows), 7, 3) == rows).all()
    assert (suffix_tree.unpack(suffix_tree.pack(rows[0]), 7) == rows[0]).all()
    assert len(suffix_tree.unpack(suffix_tree.pack(rows[0][:0]), 0)) == 0


def test_words_that_are_missing_or_too_rare_take_few_bytes():
    rng = np.random.default_rng(7)
    words = rng.integers(0, 1 << 12, (4, 2000))
    words[rng.random(words.shape) < 0.1] = UNSEEN
    words[rng.random(words.shape) < 0.1] = NOTHING
    # 12 bits a word and where the gaps are; no gap takes eight bytes.
    assert len(suffix_tree.pack(words)) < 4 * 2000 * 1.7


def test_windows_are_sorted_by_all_their_words():
    rng = np.random.default_rng(3)
    some = [NOTHING, UNSEEN, -3, -(2**60), 0, 1, 5, 2**20, 2**40]
    for n in range(2, len(some) + 1):
        rows = rng.choice(some[-n:], (4, 200))
        order, new = suffix_tree._sorted(rows)
        assert (rows[:, order] == rows[:, np.lexsort(rows[::-1])]).all()
        assert new.sum() == np.unique(rows, axis=1).shape[1]


def test_the_setting_for_shuffles_is_put_back(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with shuffles_removed(spark):
        assert spark.conf.get(name) == "true"
        assert spark.range(1000).groupBy("id").count().count() == 1000
    assert spark.conf.get(name) == before


def test_a_setting_that_was_not_set_is_unset_again(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch.of.this.test"
    with setting(spark, name, "7"):
        assert spark.conf.get(name) == "7"
    assert spark.conf.get(name, None) is None


def test_windows_are_sorted_where_keys_are_too_long_for_one_number():
    rng = np.random.default_rng(5)
    rows = rng.integers(-(2**62), 2**62, (3, 300))
    rows[:2] = rows[:2, rng.integers(0, 7, 300)]
    order, new = suffix_tree._sorted(rows)
    assert (rows[:, order] == rows[:, np.lexsort(rows[::-1])]).all()
    assert new.sum() == np.unique(rows, axis=1).shape[1]
    order, new = suffix_tree._sorted(rows[:, :0])
    assert len(order) == len(new) == 0


def test_pairs_of_split_words_travel_in_blocks(spark):
    # Rows from a chunk are as many as there are buckets at most, however many words are split.
    words = ["a", "b", "c", "d"]
    rows = spark.createDataFrame([(i, f"{words[i % 4]} w{i % 97} {words[i % 3]} v{i % 50}") for i in range(2000)], "doc_id long, text string")
    counts = np.array([1000] * 4 + [20] * 147, np.int64)
    number = {w: i for i, w in enumerate([*words, *(f"w{i}" for i in range(97)), *(f"v{i}" for i in range(50))])}
    texts = [[*(number[w] for w in r["text"].split()), 99_999] for r in rows.collect()]
    chunk = (0, [False] * len(texts), [len(t) for t in texts], sum(map(len, texts)), suffix_tree.pack(np.concatenate(texts)))
    coded = spark.createDataFrame([chunk], "chunk long, held array<boolean>, sizes array<int>, n long, ids binary")
    known = spark.createDataFrame([(i, 1000 if i < 4 else 20) for i in range(151)], "key long, c long")
    plan = suffix_tree.Plan(counts, np.arange(4), 8000.0, 3, 3, 2)
    sent = suffix_tree.count_pairs(coded, plan)
    assert sent.count() <= 3
    pairs, _ = suffix_tree._split_words(coded, known, plan)
    want = Counter(pair for t in texts for pair in zip(t, t[1:]) if pair[0] < 4)
    assert {(r["first"], r["second"]): r["c"] for r in pairs.collect()} == {k: c for k, c in want.items() if c >= 2}
    assert pairs.where("key != xxhash64(first, second)").count() == 0


def test_scoring_leaves_windows_behind_before_texts_move(spark):
    # What buckets send back is written: the plan that is returned has the texts and the answers, not the windows.
    df = spark.createDataFrame([(i, f"a b c{i % 5} d") for i in range(60)], "doc_id long, text string")
    plan = suffix_tree.score_documents(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroupsInArrow" not in plan.replace("FlatMapCoGroupsInArrow", "") and "collect_list" not in plan
