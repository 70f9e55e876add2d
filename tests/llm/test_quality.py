"""Document statistics against plain readings; trees, monotonic constraints, odd rows."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cartpath.llm import queries
from cartpath.llm.boosting import constant, fit_trees
from cartpath.llm.quality import FEATURES, learn_quality, score_quality, statistics
from llm.conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text or "")
    windows, marked = {}, set()
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    for places in windows.values():
        if len(places) > 1:
            marked.update(i + k for i in places for k in range(8))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(marked))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "cé ", " ", "\n", "#", "a b a b", "\x0b", " "]), max_size=60), min_size=1, max_size=4))
def test_base_counts(parts):
    texts = ["".join(" ".join(p)) for p in parts]
    base, features = statistics(texts)
    assert [tuple(r) for r in base.tolist()] == [plain(t) for t in texts]
    assert features.shape == (len(texts), len(FEATURES)) and np.isfinite(features).all()


def test_windows_do_not_cross_texts():
    text = "one two three four five six seven eight"
    base, _ = statistics([text, text, text + " " + text])
    assert base[:, 4].tolist() == [0, 0, 16]


def data(seed=0, n=3000):
    rng = np.random.default_rng(seed)
    x = rng.random((n, 4))
    y = (x[:, 0] + 0.3 * np.sin(9 * x[:, 1]) - x[:, 2] + 0.2 * rng.standard_normal(n) > 0).astype(float)
    return x, y


def test_trees_learn_and_keep_their_constraints():
    x, y = data()
    trees = fit_trees(x, y, {0: 1, 2: -1})
    test_x, test_y = data(1)
    assert ((trees.probability(test_x) >= 0.5) == test_y).mean() > 0.85
    grid = np.linspace(0, 1, 60)
    for f, sign in ((0, 1), (2, -1)):
        for row in test_x[:40]:
            line = np.repeat(row[None, :], 60, axis=0)
            line[:, f] = grid
            assert (np.diff(trees.raw(line)) * sign >= -1e-12).all()
    free = fit_trees(x, -x[:, 0] + 0.5 > 0, {0: 1})  # the data says the opposite: the feature is not used
    assert np.ptp(free.raw(np.column_stack([grid, *[np.full(60, 0.5)] * 3]))) < 1e-9


def test_flat_arrays_equal_a_walk_down_each_tree():
    x, y = data(2, 500)
    trees = fit_trees(x, y, n_trees=7)
    for row, raw in zip(x[:50], trees.raw(x[:50])):
        total = trees.bias
        for node in trees.roots:
            while trees.left[node] != node:
                node = trees.left[node] if row[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
            total += trees.value[node]
        assert raw == pytest.approx(total)
    assert len(trees.raw(x[:0])) == 0 and fit_trees(x, y * 0).roots.size == 0


def test_documents(spark, docs, labels):
    rows = {r.doc_id: r for r in queries.op4_quality_rules(spark, SF).collect()}
    for r in docs.collect():
        got = rows[r.doc_id]
        want = plain(r.text)
        assert (got.n_words, got.word_chars, got.n_symbols, got.n_dup_lines, got.n_repeat_words) == want
        assert got.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and not (got.kept and got.base_failed)
    mark = {r.doc_id: r.quality for r in labels.collect()}
    judged = [r for r in rows.values() if r.doc_id in mark and not r.base_failed]
    assert sum(r.kept == mark[r.doc_id] for r in judged) >= 0.95 * len(judged)


def test_odd_rows(spark, odd, odd_rows, none, labels):
    marks = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (6, None), (None, 1), (7, 1), (10, 0)], "doc_id long, quality int")
    for lab in (marks, labels.limit(0), marks.where("quality = 1")):
        rows = score_quality(odd, learn_quality(odd, lab)).collect()
        assert len(rows) == len(odd_rows)
        assert sorted((r.doc_id, r.n_words) for r in rows if r.doc_id) == sorted((d, plain(t)[0]) for d, t, *_ in odd_rows if d)
        assert all(r.base_failed and not r.kept for r in rows if r.n_words < 20)
    assert all(r.kept for r in score_quality(odd, constant(0.999)).collect() if not r.base_failed)
    assert score_quality(none, learn_quality(none, labels)).count() == 0


def test_vectorised_over_many_texts():
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice("ab") for _ in range(rnd.randint(0, 80))) for _ in range(60)]
    assert [tuple(r) for r in statistics(texts)[0].tolist()] == [plain(t) for t in texts]
