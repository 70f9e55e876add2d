"""Mixing against DuckDB, a loop over the sources, and numeric integration."""

import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from cartpath.llm import queries
from cartpath.llm.mixing import demand_position, mix_sources, source_targets, training_order
from conftest import SF_MID
from llm.conftest import SF


def share_by_rounds(sizes, weights, budget, cap):
    """The excess over the caps is shared again by weight until none is above."""
    todo, target, rest = set(range(len(sizes))), {}, budget * sum(sizes)
    while todo:
        total = sum(weights[i] for i in todo)
        above = [i for i in todo if rest * weights[i] / total > cap * sizes[i] + 1e-9]
        if not above:
            return target | {i: rest * weights[i] / total for i in todo}
        for i in above:
            target[i] = cap * sizes[i]
            todo.remove(i)
        rest = budget * sum(sizes) - sum(target.values())
    return target


@pytest.mark.parametrize("seed", range(6))
def test_targets_match_rounds(spark, seed):
    rnd = random.Random(seed)
    sizes = [rnd.choice([0, 1, 10, 500, 2000, rnd.randrange(100_000)]) for _ in range(rnd.randint(1, 9))]
    df = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, source_size long")
    got = {int(r.source[1:]): r.target for r in source_targets(df).collect()}
    want = share_by_rounds(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))], 1.5, 2.0)
    assert got == pytest.approx(want)


@pytest.mark.parametrize("sf", [SF, SF_MID])
def test_query_matches_sql(spark, sf):
    got = queries.op1_mix_sources(spark, sf).toPandas().sort_values("doc_id").reset_index(drop=True)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = con.execute(queries.OP1_SQL).df().sort_values("doc_id").reset_index(drop=True)
    assert got[sorted(got)].round(8).equals(want[sorted(got)].astype(got[sorted(got)].dtypes).round(8))
    taken, size = got.groupby("source_size")["taken"].sum(), got.groupby("source_size")["target"].first()
    assert ((taken - size).abs() < len(got)).all() and (got["taken"] <= 2 * got["size"]).all()


@pytest.mark.parametrize("knots", [(1.5, 1.0, 0.5), (1, 1), (0, 2, 2, 1), (3, 0, 0, 5)])
def test_position_inverts_the_integral(spark, knots):
    df = spark.range(101).select((F.col("id") / 100).alias("x")).withColumn("p", demand_position(F.col("x"), knots))
    n, steps = 20_000, len(knots) - 1
    dens = []
    for i in range(n):
        t = (i + 0.5) / n * steps
        k = min(int(t), steps - 1)
        dens.append(knots[k] + (knots[k + 1] - knots[k]) * (t - k))
    total, run, sums = sum(dens), 0.0, [0.0]
    for d in dens:
        run += d
        sums.append(run / total)
    for r in df.collect():
        assert 0 <= r.p <= 1 and abs(sums[min(n, round(r.p * n))] - r.x) < 1e-3


def test_order_follows_the_schedules(spark):
    rows = [(i, "w " * 20, "en", s, 40) for i in range(300) for s in ("a", "c")]
    rows = [(2 * i + (s == "c"), t, lang, s, n) for i, t, lang, s, n in rows] + [(9999, "w", "en", "b", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    seen = [r.source for r in training_order(df, weights=(1, 1, 1), budget=1.0).collect() if r.source != "b"]
    early = Counter(seen[:len(seen) // 3])
    assert early["a"] > 1.5 * early["c"]  # early sources fade, late ones grow
    assert 580 <= len(seen) <= 600


def test_odd_rows(spark, odd, odd_rows, none):
    rows = mix_sources(odd).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in odd_rows)
    assert all(r.taken == 0 and r.position1 is None for r in rows if not r["size"])
    assert all(0 <= r.taken <= 2 * r["size"] for r in rows) and {r.source for r in rows} == {"a", "b", "c", "", None}
    by = {}
    for r in rows:
        by.setdefault(r.source, [r.target, 0])[1] += r.taken
    assert all(taken == int(target) for target, taken in by.values())
    assert mix_sources(none).count() == 0 and training_order(none).count() == 0
    passes = training_order(odd)
    assert passes.columns == odd.columns and passes.count() == sum((r.position1 is not None) + (r.position2 is not None) for r in rows)


def test_parameters(spark, docs):
    for bad in ({"cap": 3}, {"weights": (1, 0)}):
        with pytest.raises(ValueError):
            mix_sources(docs, **bad)
    with pytest.raises(ValueError):
        demand_position(F.lit(0.5), (0, 0))


def test_repeated_rows_spread_and_count_once_each(spark):
    """Half of the rows are one row (null id): the stream is cut inside them, and they take what single rows would."""
    from cartpath.functions.sequence import ordered
    rows = [(None, "two words", "a")] * 600 + [(i, f"word{i} " * (i % 7), "ab"[i % 2]) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        got = mix_sources(docs).collect()
        stream = ordered(docs.withColumn("key", F.lit(1)), ["source"], ["key", "doc_id"])
        assert max(r["count"] for r in stream.groupBy("_part").count().collect()) <= 2 * len(rows) / 12
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(got) == len(rows)
    for source in "ab":
        mine = [r for r in got if r.source == source]
        assert sum(r.taken for r in mine) == int(mine[0].target) and sum(r.size for r in mine) == mine[0].source_size


def test_many_sources_are_joined_with_salts(spark, monkeypatch):
    from cartpath.llm import common
    docs = spark.createDataFrame([(i, f"word{i} " * (i % 5 + 1), None if i % 9 == 0 else f"s{i % 40}" if i % 3 else "hot") for i in range(300)],
                                 "doc_id long, text string, source string")
    want = sorted(map(str, mix_sources(docs).collect()))
    few = common.join_few
    monkeypatch.setattr("cartpath.llm.mixing.join_few", lambda *a: few(*a, bound=3))
    assert sorted(map(str, mix_sources(docs).collect())) == want
