"""Ball k-means against plain k-means in Python's whole numbers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartpath.llm import codes
from cartpath.llm.codes import Balls, codebooks_sha256, compress_vectors, full_search

SCHEMA = "vec_id long, embedding array<float>, label int"


def nearest(x, book):
    return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))


def plain(rows, rounds=6, scale=4096):
    """{(vec_id, vector): (code, error)}, codebooks and errors by label."""
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v], lab) for i, v, lab in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], []
    size = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == size]
    width = -(-size // 8)
    vs = [(i, v + [0] * (8 * width - size), lab) for i, v, lab in kept]
    part = lambda v, p: v[p * width:(p + 1) * width]
    books = [[part(v, p) for _, v, _ in vs[:16]] for p in range(8)]
    for _ in range(rounds):
        for p in range(8):
            own = [nearest(part(v, p), books[p])[1] for _, v, _ in vs]
            for e in set(own):
                mine = [part(v, p) for (_, v, _), o in zip(vs, own) if o == e]
                books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    coded = [(i, lab, [nearest(part(v, p), books[p]) for p in range(8)]) for i, v, lab in vs]
    total = {}
    for _, lab, found in coded:
        total[lab] = total.get(lab, 0) + sum(d for d, _ in found)
    return sorted(((i, lab, bytes(k for _, k in f).hex(), sum(d for d, _ in f), total[lab]) for i, lab, f in coded), key=str), books


def found(df):
    return sorted(((r.vec_id, r.label, bytes(r.code).hex(), r.error, r.label_error) for r in df.collect()), key=str)


def vectors(seed, n, size, centres):
    rnd = random.Random(seed)
    heart = [[rnd.uniform(-1, 1) for _ in range(size)] for _ in range(centres)]
    return [(i, [x + rnd.gauss(0, 0.05) for x in rnd.choice(heart)], rnd.choice([None, 0, 1, 2])) for i in range(n)]


@pytest.mark.parametrize("seed, n, size, centres", [(0, 300, 16, 12), (1, 200, 64, 40), (2, 9, 8, 3), (3, 120, 20, 2)])
def test_equals_plain_k_means(spark, seed, n, size, centres):
    rows = vectors(seed, n, size, centres)
    coded, entries = compress_vectors(spark.createDataFrame(rows, SCHEMA).repartition(5))
    want, books = plain(rows)
    assert found(coded) == want and entries.tolist() == books


def test_equal_distances_go_to_the_lower_entry(spark):
    """Small whole steps: most distances are equal to others, entries repeat and go unused."""
    rnd = random.Random(5)
    rows = [(i // 2, [rnd.randrange(3) / 4096 for _ in range(16)], 0) for i in range(200)]
    coded, entries = compress_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3))
    want, books = plain(rows)
    assert found(coded) == want and entries.tolist() == books


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(7, 40, 8, 5) + [(100, None, 1), (101, [], 1), (102, [0.1] * 7 + [None], 1), (103, [nan] * 8, 1), (104, [0.1] * 7 + [-inf], None),
                                   (105, [0.1] * 9, 1), (None, [0.2] * 8, 2), (None, [0.2] * 8, 2), (3, [0.3] * 8, None), (3, [0.3] * 8, None), (106, [-0.0] * 8, 1)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'clash' AS vector", "'clash' AS code", "'clash' AS part", "'clash' AS kind", "'clash' AS error")
    coded, entries = compress_vectors(df)
    want, books = plain(rows)
    assert found(coded) == want and entries.tolist() == books and len(want) == 45


def test_no_vectors(spark):
    for rows in ([], [(1, None, 1), (2, [float("nan")], 1)]):
        coded, entries = compress_vectors(spark.createDataFrame(rows, SCHEMA))
        assert coded.count() == 0 and codebooks_sha256(entries) == codebooks_sha256(np.zeros((8, 0, 0), np.int64))


def test_too_large_components_raise(spark):
    with pytest.raises(Exception, match="do not fit a long"):
        compress_vectors(spark.createDataFrame([(1, [1e30] * 8, 1)], SCHEMA))


def test_hot_label(spark, monkeypatch):
    """Label sums are the same by broadcast and by the salted join."""
    rows = [(i, [(i % 7) / 10, (i % 5) / 10] * 4, 1 if i % 3 else i) for i in range(400)] + [(900 + i, [0.5] * 8, None) for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = found(compress_vectors(df)[0])
    monkeypatch.setattr(codes, "FEW_LABELS", 3)
    assert found(compress_vectors(df)[0]) == want and want == plain(rows)[0]


@pytest.mark.parametrize("seed", range(5))
def test_balls_equal_a_full_search(seed):
    """After the entries move, cores and rings give what comparing with all entries gives; cores skip work."""
    rnd = np.random.default_rng(seed)
    hearts = rnd.integers(-4000, 4000, (16, 8))
    x = hearts[rnd.integers(0, 16, 4000)] + rnd.integers(-40, 40, (4000, 8))
    entries = hearts + rnd.integers(-300, 300, (16, 8))
    entries[3] = entries[7]
    for _ in range(4):
        code, d = full_search(x, entries)
        moved, radius = entries.copy(), np.zeros(16, np.int64)
        for e in np.unique(code):
            moved[e] = x[code == e].sum(axis=0) // (code == e).sum()
            shift = int(((moved[e] - entries[e]) ** 2).sum())
            radius[e] = math.isqrt(int(d[code == e].max())) + 1 + math.isqrt(shift) + 1
            assert ((x[code == e] - moved[e]) ** 2).sum(axis=1).max() <= int(radius[e]) ** 2
        balls = Balls(moved, radius)
        got = balls.assign(x, code)
        want = full_search(x, moved)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
        entries = moved
    assert sum(len(ids) for _, ids in balls.near) < 16 * 15  # not every entry is every ball's neighbour


def test_spent_rounds_are_deleted(spark):
    from cartpath.functions.materialize import _paths
    before = set(_paths(spark))
    compress_vectors(spark.createDataFrame(vectors(1, 50, 8, 3), SCHEMA))
    assert sum("/codes-" in p for p in set(_paths(spark)) - before) == 1
