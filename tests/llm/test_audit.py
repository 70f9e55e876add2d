"""The filter audit against walking every document through every order."""

import random
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from cartpath.llm import audit
from cartpath.llm.audit import audit_filters, potentials, steps, worths
from llm.conftest import DOCS

LABELS = "doc_id long, quality int, toxic int"


def failures(rows):
    """For (doc_id, text): the letters of the filters that fail it."""
    import re
    out = []
    for i, text in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
        fails += "C" * (100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text)) + "D" * any(c in "#$%&*|" for c in text)
        out.append(fails + "E" * any(j is not None and i is not None and j < i and (t or "") == text for j, t in rows))
    return out


def walked(docs, labels):
    good, toxic = ({i for i, *v in labels if v[k] == 1 and i is not None} for k in (0, 1))
    fails = failures([(d[0], d[1]) for d in docs])
    out, shapley = {}, Counter()
    for part in {d[3] or "" for d in docs}:
        mine = [(d[0], f) for d, f in zip(docs, fails) if (d[3] or "") == part]
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for k, letter in enumerate(order, 1):
                gone = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                failing = [f for _, f in mine if letter in f]
                out[part, order, k] = [len(left), len(gone), len(failing) - len(gone), sum(f == letter for f in failing),
                                       sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
                shapley[part, letter] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found(df):
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in df.collect()}


def test_equals_walking(spark):
    rnd = random.Random(1)
    texts = [" ".join(rnd.choice(["Ein", "zwei", f"w{rnd.randrange(400)}", f"x{rnd.randrange(400)}", rnd.choice(["a", "$5", "BIG"])])
                      for _ in range(rnd.choice([5, 199, 200, 260]))) for _ in range(25)]
    texts += [" ".join(f"u{k}" for k in range(n)) for n in (199, 200, 201)] + [None, ""]
    docs = [(rnd.choice([i, i, i, rnd.randrange(90), None]), rnd.choice(texts), "en", rnd.choice(["a", "b", None, ""]), 1) for i in range(90)]
    labels = [(rnd.choice([None, *range(90)]), rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for _ in range(80)]
    got = found(audit_filters(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)))
    assert got == walked(docs, labels)


def test_odd_rows_and_empty_tables(spark, odd, odd_rows, none):
    empty = spark.createDataFrame([], LABELS)
    assert found(audit_filters(odd, empty)) == walked(odd_rows, [])
    assert audit_filters(none, empty).count() == 0
    assert found(audit_filters(odd, spark.createDataFrame([(1, 1, 1), (1, 0, 0), (None, 1, 1)], LABELS).selectExpr(
        "*", "'clash' AS text", "'clash' AS part", "'clash' AS n"))) == walked(odd_rows, [(1, 1, 1)])


def test_hot_text(spark):
    """A third of the rows hold one text; the rows of the least id stay, also when it repeats."""
    docs = [(i, "same text", "en", "a", 9) for i in (5, 5, *range(6, 300))] + [(i, f"text {i}", "en", "a", 9) for i in range(300, 900)]
    got = found(audit_filters(spark.createDataFrame(docs, DOCS).repartition(16), spark.createDataFrame([], LABELS)))
    assert got["a", "EABCD", 1][:2] == (len(docs) - 294, 294)
    assert got["a", "AEBCD", 2][:3] == (0, 0, 294)


def test_potential_is_the_mean_worth_of_random_coalitions():
    """Shapley values add up to the grand coalition's worth, and potentials match the sum over dividends."""
    rnd = np.random.default_rng(3)
    counts = rnd.integers(0, 50, (7, 32))
    v, p = worths(counts), potentials(worths(counts), 120)
    for part in range(7):
        for s in range(32):
            assert v[part, s] == sum(counts[part, f] for f in range(32) if f & s)
    shapley = np.stack([p[:, 31] - p[:, 31 ^ 1 << i] for i in range(5)])
    assert (shapley.sum(axis=0) == 120 * v[:, 31]).all()
    # Harsanyi dividends: P(S) is the sum over T within S of d(T) / |T|.
    d = np.zeros_like(v)
    for s in range(1, 32):
        d[:, s] = v[:, s] - sum(d[:, t] for t in range(1, s) if t & s == t)
    for s in range(32):
        want = sum(120 * d[:, t] // t.bit_count() for t in range(1, 32) if t & s == t)
        assert (p[:, s] == want).all()


def test_steps_do_not_depend_on_slices(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i % 5} $" * (i % 3), "en", f"s{i % 9}", 1) for i in range(60)], DOCS)
    labels = spark.createDataFrame([(i, i % 2, i % 3) for i in range(60)], LABELS)
    want = found(audit_filters(docs, labels))
    monkeypatch.setattr(audit, "SLICE", 2)
    assert found(audit_filters(docs, labels)) == want and len(want) == 9 * 600


def test_a_part_without_failures_has_zeros():
    zero = np.zeros((1, 32), np.int64)
    n = zero.copy()
    n[0, 0] = 8
    table = steps(n, zero, zero)
    assert (table["kept"] == 8).all() and all((table[c] == 0).all() for c in table if c != "kept")
