"""Stage tables between jobs, quantiles over ranges of values, item profile, distinct-count sketches."""

import random

import pytest
from pyspark.sql import functions as F

from cartpath.functions.quantiles import exact_quantiles, value_ranks
from cartpath.functions.sequence import is_ordered, ordered, read_ordered, with_group_values, with_position
from cartpath.operators import profile as P
from cartpath.operators.labels import cut_rows, cut_test_set, points_of, session_positions, split_points
from cartpath.plans import jobs
from cartpath.sources import files, stages

ROWS = "timestamp long, event string, itemid long, session long"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def sessions(spark, seed, n=600, hot=3):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(0, 40 * 86400), rnd.choice(["view", "view", "addtocart", "transaction"]), rnd.randrange(20), hot if i % 3 == 0 else rnd.randrange(60))
            for i in range(n)]
    return spark.createDataFrame(rows, ROWS), rows


def test_stage_tables_keep_their_order(spark, tmp_path):
    df, rows = sessions(spark, 1)
    path = str(tmp_path / "sessions.parquet")
    stages.write_sessions(df, path)
    back = stages.read_sessions(spark, path)
    assert is_ordered(back, ["session", "timestamp"]) and not is_ordered(back, ["timestamp"])
    assert sorted(map(tuple, back.select("timestamp", "event", "itemid", "session").collect())) == sorted(rows)
    # Read by any other means it is a plain table.
    assert spark.read.parquet(path).count() == len(rows)
    key = ["session", "pos", "timestamp", "event", "itemid"]
    assert sorted(map(tuple, session_positions(back).select(*key).collect())) == sorted(map(tuple, session_positions(df).select(*key).collect()))
    gaps = [sorted(r[0] for r in P.inter_event_gaps(x).collect()) for x in (back, df)]
    steps = [sorted(map(tuple, P.clicks_between_carts(x).collect())) for x in (back, df)]
    assert gaps[0] == gaps[1] and steps[0] == steps[1] and gaps[0] and steps[0]


def test_stage_tables_are_read_without_an_exchange_of_rows(spark, tmp_path):
    df, _ = sessions(spark, 2)
    path = str(tmp_path / "sessions.parquet")
    stages.write_sessions(df, path)
    back = stages.read_sessions(spark, path)
    for made in (session_positions(back), P.inter_event_gaps(back), cut_rows(back)):
        lines = plan_of(made).splitlines()
        # What is exchanged has been aggregated to the ends of ranges.
        for i, line in enumerate(lines):
            if "Exchange" in line and "BroadcastExchange" not in line and "ReusedExchange" not in line:
                assert "Aggregate" in " ".join(lines[i + 1:i + 4]) or "Generate" in " ".join(lines[i + 1:i + 4]), line
        plan = "\n".join(lines)
        assert "rangepartitioning" not in plan and "SortMergeJoin" not in plan and "Bucketed: true" in plan


def test_text_items_order_like_numbers(spark, tmp_path):
    df = spark.createDataFrame([(5, "view", str(i), 1) for i in (10, 9, 100, 7)], "timestamp long, event string, itemid string, session long")
    path = str(tmp_path / "t.parquet")
    stages.write_sessions(df, path)
    got = session_positions(stages.read_sessions(spark, path)).orderBy("pos").collect()
    assert [r.itemid for r in got] == [7, 9, 10, 100]
    words = spark.createDataFrame([(5, "view", "sku-2", 1), (5, "view", "sku-10", 1), (5, "view", None, 1)], df.schema)
    stages.write_sessions(words, str(tmp_path / "w.parquet"))
    assert stages.read_sessions(spark, str(tmp_path / "w.parquet"), text_items=True).schema["itemid"].dataType.simpleString() == "string"
    with pytest.raises(Exception, match="without itemid"):
        stages.read_sessions(spark, str(tmp_path / "w.parquet"), text_items=True).collect()


def test_jobs_agree_on_stage_tables_and_exports(spark, tmp_path):
    """Cutting the stage table gives what cutting the CSV export gives; lists and lines hold the same rows."""
    rnd = random.Random(6)
    lines = ["timestamp,visitorid,event,itemid,transactionid"]
    for _ in range(900):
        lines.append(f"{rnd.randrange(0, 40 * 86400) * 1000},{rnd.randrange(12)},{rnd.choice(['view', 'addtocart', 'transaction'])},{rnd.randrange(30)},")
    (tmp_path / "events.csv").write_text("\n".join(lines) + "\n")
    out = str(tmp_path / "out")
    jobs.prepare_split(spark, str(tmp_path / "events.csv"), out, 3, 2, gap_sec=86400)
    results = []
    for source, lists in ((f"{out}/test_set.parquet", False), (f"{out}/test_set", False), (f"{out}/test_set.parquet", True)):
        trimmed, labels = jobs.cut_test_sessions(spark, source, str(tmp_path / f"cut{len(results)}"), lists=lists)
        results.append((sorted(map(tuple, trimmed.select("session", "pos", "itemid", "timestamp", "event").collect())),
                        sorted((r.session, r.addtocart or [], r.transaction or []) for r in labels.collect())))
    assert results[0] == results[1] == results[2] and results[0][0] and results[0][1]
    assert files.read_sessions(spark, f"{out}/train_set").columns == ["timestamp", "event", "itemid", "session"]


def test_cut_rows_equal_the_joined_points(spark):
    df, _ = sessions(spark, 7)
    points = sorted(map(tuple, split_points(session_positions(df)).collect()))
    cut = cut_rows(df)
    assert sorted(map(tuple, points_of(cut).collect())) == points
    assert {tuple(r) for r in cut.select("session", "n_events", "last_label_pos", "last_possible_idx", "split_idx").collect()} == set(points)
    assert sorted(map(tuple, cut_test_set(df)[2].collect())) == points


def test_group_values(spark):
    df, rows = sessions(spark, 8)
    o = ordered(df, ["session"], ["timestamp"], num_partitions=13)
    got = with_group_values(o, ["session"], {"n": (F.sum, F.lit(1)), "first": (F.min, F.col("timestamp")),
                                             "cart": (F.max, F.when(F.col("event") == "addtocart", F.col("itemid")))}).collect()
    for r in got:
        mine = [x for x in rows if x[3] == r.session]
        assert (r.n, r.first) == (len(mine), min(x[0] for x in mine))
        assert r.cart == max((x[2] for x in mine if x[1] == "addtocart"), default=None)


def test_order_is_noted_for_its_beginning_only(spark, tmp_path):
    df, _ = sessions(spark, 9, n=50)
    path = str(tmp_path / "o")
    ordered(df, ["session"], ["timestamp", "itemid"], path=path)
    back = read_ordered(spark, path)
    assert is_ordered(back, ["session", "timestamp", "itemid"]) and is_ordered(back, ["session"])
    assert not is_ordered(back, ["session", "itemid"]) and not is_ordered(back.drop("_row"), ["session"])
    assert ordered(back, ["session"], ["timestamp"]) is back
    assert with_position(back, ["session"]).count() == 50


@pytest.mark.parametrize("seed", range(4))
def test_quantiles_equal_percentile(spark, seed):
    rnd = random.Random(seed)
    values = [rnd.choice([None, rnd.randrange(30), rnd.randrange(10**9), rnd.random()]) for _ in range(rnd.choice([1, 2, 3, 500]))]
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    ours = spark.range(1).select(exact_quantiles(df, "x", qs, num_partitions=7).alias("q")).first().q
    want = df.agg(F.percentile("x", qs)).first()[0] or [None] * 6
    assert list(ours) == list(want)


def test_describe_of_many_values_equals_describe(spark):
    rnd = random.Random(3)
    df = spark.createDataFrame([(rnd.choice([None, rnd.randrange(10_000)]),) for _ in range(700)], "x long")
    assert P.describe(df, "x", many=True).collect() == P.describe(df, "x").collect()
    empty = df.where("x < 0")
    assert P.describe(empty, "x", many=True).collect() == P.describe(empty, "x").collect()


def test_ranks_spread_over_ranges(spark):
    """No task holds all values: they lie in ranges of about equal numbers of distinct values."""
    df = spark.range(0, 200_000, numPartitions=8).withColumn("x", F.pmod(F.xxhash64("id"), F.lit(10**12)))
    ranks = value_ranks(df, "x", num_partitions=16)
    plan = plan_of(ranks)
    assert "Bucketed: true" in plan and "percentile" not in plan.lower()
    q = spark.range(1).select(exact_quantiles(df, "x", [0.5], 16).alias("q")).first().q
    assert q == df.agg(F.percentile("x", [0.5])).first()[0]


def test_item_profile_gives_the_item_tables(spark):
    df, _ = sessions(spark, 11)
    df = df.union(spark.createDataFrame([(1, "view", None, 5), (2, "addtocart", None, 5)], ROWS))
    profile = P.item_profile(df)
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert same(P.profile_events_per_item(profile), P.events_per_item(df))
    for e in ("view", "addtocart", "transaction"):
        assert same(P.profile_per_item_counts(profile, e, "n"), P.per_item_counts(df, e, "n"))
    assert same(P.profile_item_coverage(profile), P.item_coverage(df))


def test_sketches_unite_over_days(spark):
    n = 200_000
    df = spark.range(n).select((F.col("id") % 5 * 86400).alias("timestamp"), F.lit("view").alias("event"),
                               (F.col("id") % 50_000).alias("itemid"), (F.col("id") % 120_000).alias("session"))
    daily = P.daily_sketches(df)
    assert daily.count() == 5
    united, once = P.distinct_of_sketches(daily).first(), P.distinct_of_sketches(P.daily_sketches(df.withColumn("timestamp", F.lit(0)))).first()
    assert united == once
    assert abs(united.n_sessions - 120_000) <= 1200 and abs(united.n_items - 50_000) <= 500
    some = P.distinct_of_sketches(daily.where("day < 2")).first()
    exact = df.where("timestamp < 2 * 86400").agg(F.count_distinct("session"), F.count_distinct("itemid")).first()
    assert abs(some.n_sessions - exact[0]) <= exact[0] * 0.01 and abs(some.n_items - exact[1]) <= exact[1] * 0.01
    assert P.distinct_of_sketches(daily.where("day > 9")).first() == (0, 0)
