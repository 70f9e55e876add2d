"""Substring dedup against a search of all runs, and its steps on their own."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartpath.llm import substrings
from cartpath.llm.queries import op11_substring_dedup
from cartpath.llm.substrings import anchors, maximal_repeats, remove_repeats
from llm.conftest import DOCS, SF


def plain(rows, words):
    """(doc_id, n_words, n_removed, kept words) of (doc_id, text), every run looked up by its words."""
    split = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in split:
        for p in range(len(w) - words + 1):
            if i is not None:
                run = tuple(w[p:p + words])
                first[run] = min(first.get(run, i), i)
    out = []
    for i, w in split:
        gone = set()
        for p in range(len(w) - words + 1):
            if i is not None and first[tuple(w[p:p + words])] < i:
                gone.update(range(p, p + words))
        out.append((i, len(w), len(gone), b" ".join(x for p, x in enumerate(w) if p not in gone).decode()))
    return sorted(out, key=str)


def stored(spark, path, rows, parts=3):
    spark.createDataFrame(rows, "doc_id long, text string").repartition(parts).write.parquet(str(path))
    return spark.read.parquet(str(path))


def found(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in df.collect()), key=str)


def shared_texts(seed, n=60, vocabulary=40):
    """Texts of few words with passages, also overlapping ones and pieces of them, put in several."""
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(vocabulary)}"
    passages = [[word() for _ in range(rnd.randint(3, 40))] for _ in range(8)]
    rows = []
    for i in range(n):
        w = []
        for _ in range(rnd.randint(0, 5)):
            w += [word() for _ in range(rnd.randint(0, 12))]
            p = rnd.choice(passages)
            a = rnd.randrange(len(p))
            w += p[a:a + rnd.randint(1, len(p))]
        rows.append((rnd.choice([i, i, i, rnd.randrange(n), None]), rnd.choice([" ", "  ", "\n", " \t"]).join(w)))
    return rows


@pytest.mark.parametrize("words, seed_words, seed", [(13, 4, 0), (13, 4, 1), (5, 2, 2), (6, 6, 3), (3, 1, 4), (1, 1, 5)])
def test_equals_plain_search(spark, tmp_path, words, seed_words, seed):
    rows = shared_texts(seed, vocabulary=8 if words > 3 else 400)
    docs = stored(spark, tmp_path / "d", rows)
    assert found(remove_repeats(docs, words, seed_words)) == plain(rows, words)


def test_blocks_do_not_matter(spark, tmp_path, monkeypatch):
    """Many small blocks and one partition, many partitions: the same."""
    rows = shared_texts(9, n=120)
    want = plain(rows, 13)
    monkeypatch.setattr(substrings, "BLOCK_BYTES", 700)
    assert found(remove_repeats(stored(spark, tmp_path / "a", rows, 1))) == want
    monkeypatch.setattr(substrings, "BUCKETS", 50)
    assert found(remove_repeats(stored(spark, tmp_path / "b", rows, 40))) == want


def test_hot_passages_and_copies(spark, tmp_path):
    """A third of the rows are copies, a third share one passage, one text is long."""
    rnd = random.Random(4)
    prose = lambda n: " ".join(f"v{rnd.randrange(5000)}" for _ in range(n))
    copy, passage = prose(60), prose(30)
    rows = [(i, copy) for i in range(300)] + [(i, f"{prose(20)} {passage} {prose(20)}") for i in range(300, 600)]
    rows += [(i, prose(60)) for i in range(600, 900)] + [(900, prose(40_000) + " " + passage)]
    rnd.shuffle(rows)
    got = found(remove_repeats(stored(spark, tmp_path / "d", rows, 16)))
    assert got == plain(rows, 13)
    gone = {i: n for i, _, n, _ in got}
    assert all(gone[i] == 60 for i in range(1, 300)) and all(gone[i] >= 30 for i in range(301, 600)) and gone[0] == gone[300] == 0 and gone[900] >= 30


def test_spans_are_the_removed_words(spark, tmp_path):
    rows = shared_texts(11)
    for r in remove_repeats(stored(spark, tmp_path / "d", rows), 13).collect():
        assert sum(s.length for s in r.repeats) == r.n_removed
        ends = [(s.start, s.start + s.length) for s in r.repeats]
        assert all(b <= c for (_, b), (c, _) in zip(ends, ends[1:])) and all(0 <= a and b <= r.n_words for a, b in ends)
        assert len(r.kept.split()) == r.n_words - r.n_removed


def test_odd_rows_and_empty_table(spark, odd, odd_rows, none, tmp_path):
    assert found(remove_repeats(odd)) == plain([(r[0], r[1]) for r in odd_rows], 13)
    none.write.parquet(str(tmp_path / "none"))
    assert remove_repeats(spark.read.parquet(str(tmp_path / "none"))).count() == 0


def test_query_carries_digests(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = sorted((i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in plain(rows, 13))
    assert sorted(map(tuple, op11_substring_dedup(spark, SF).collect())) == want
    assert any(gone for _, _, gone, _ in want)


def test_anchors_are_least_grams():
    rnd = np.random.default_rng(0)
    h = rnd.integers(0, 1 << 62, 300).astype(np.uint64)
    for words, seed_words in ((13, 4), (13, 13), (7, 1), (5, 3)):
        got = anchors(h, words, seed_words)
        grams = anchors(h, seed_words, seed_words)
        assert got.tolist() == [int(min(grams[p:p + words - seed_words + 1])) for p in range(len(h) - words + 1)]


def test_maximal_repeats_merge_touching_runs():
    first, length = maximal_repeats(np.array([2, 3, 4, 9, 30, 44, 58, 60]), 13, np.array([0, 60, 80]))
    assert list(zip(first.tolist(), length.tolist())) == [(2, 20), (30, 13), (44, 13), (58, 13), (60, 13)]


def test_word_hashes_follow_the_words_alone(monkeypatch):
    """Equal words have equal hashes wherever they stand, all others different ones; also in short stretches."""
    rnd = random.Random(3)
    words = [bytes(rnd.choice(b"ab\xc3\xa4\x00") for _ in range(rnd.randint(1, 9))) for _ in range(3000)]
    for stretch in (1, 40, 2 << 20):
        monkeypatch.setattr(substrings, "HASH_BYTES", stretch)
        substrings._cached.clear()
        raw = np.frombuffer(b" ".join(words), np.uint8)
        starts = np.cumsum([0, *(len(w) + 1 for w in words)])[:-1]
        h = substrings.word_hashes(raw, starts, starts + [len(w) for w in words]).tolist()
        assert len(set(zip(words, h))) == len(set(words)) == len(set(h))
    substrings._cached.clear()


def test_parameters(spark, docs):
    with pytest.raises(ValueError):
        remove_repeats(docs, 4, 5)
