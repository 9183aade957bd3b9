"""Ordered prefix, shares, quantiles, time axis: pins and properties."""
import datetime as dt
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from revlens.operators import ordered, scale, segment, timeaxis

D = dt.date


def test_ordered_prefix_matches_plain_window_with_hot_value(spark):
    rnd = random.Random(7)
    # a third of all rows share one value: range bounds must still split it
    rows = [(i, 5 if i % 3 == 0 else rnd.randint(0, 50)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, v long")
    got = ordered.ordered_prefix(df, [F.col("v").desc(), F.col("k").asc()], "v", num_partitions=7)
    w = Window.orderBy(F.col("v").desc(), F.col("k").asc())
    ref = df.select("k", F.row_number().over(w).alias("rn"),
                    F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cs"))
    a = {r.k: (r._rownum, r._prefix, r._n) for r in got.collect()}
    b = {r.k: (r.rn, r.cs, 3000) for r in ref.collect()}
    assert a == b


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=60))
def test_exact_quantiles_equal_numpy(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = {r.prob: r.value for r in ordered.exact_quantiles(df, "x", [0.15, 0.5, 0.85]).collect()}
    for p in (0.15, 0.5, 0.85):
        assert abs(got[p] - float(np.percentile(xs, p * 100))) <= 1e-9 * max(1.0, abs(got[p]))


def test_shares_properties_and_top_fraction(spark):
    rows = [("c1", 10.0), ("c2", 30.0), ("c2", 5.0), ("c3", 30.0), ("c4", -3.0), ("c5", 1.0),
            ("c6", 2.0), ("c7", 0.5), (None, 4.0)]
    df = spark.createDataFrame(rows, "CustomerID string, NetRevenue double")
    sh = segment.revenue_shares(df, ["CustomerID"], keep_count=True).orderBy("rank").collect()
    assert [r.CustomerID for r in sh][:2] == ["c2", "c3"]  # 35 then 30
    total = sum(v for _, v in rows)
    assert abs(sum(r.shareOfRevenue for r in sh) - (total - 4.0) / total * 100) < 1e-9
    assert all(a.rank + 1 == b.rank for a, b in zip(sh, sh[1:]))
    top = segment.top_fraction_keys(segment.revenue_shares(df, ["CustomerID"], keep_count=True),
                                    ["CustomerID"], 0.25)
    assert [r.CustomerID for r in top.collect()] == ["c2"]   # floor(7 * 0.25) = 1


def test_rfm_frequency_variants(spark):
    df = spark.createDataFrame([("o1", "c", D(2023, 1, 1), 1.0), ("o1", "c", D(2023, 1, 5), 2.0),
                                ("o2", "c", D(2023, 2, 1), 3.0), (None, "c", D(2023, 2, 2), 4.0)],
                               "OrderNumber string, CustomerID string, OrderDate date, NetRevenue double")
    for freq, expect in (("distinct", 2), ("rows", 4), ("lines", 3)):
        r = segment.rfm_features(df, "2023-12-31", frequency=freq).first()
        assert r.orderCount == expect and r.daysSinceLastOrder == 332 and r.sumRevenue == 10.0


def test_weekly_spine_fills_gaps(spark):
    df = spark.createDataFrame([("k", D(2023, 1, 3), 1.0), ("k", D(2023, 1, 24), 2.0),
                                ("k", D(2023, 1, 4), 4.0)], "key string, OrderDate date, NetRevenue double")
    wk = timeaxis.weekly_sum(df, ["key"], ["NetRevenue"]).orderBy("week").collect()
    assert [(r.week, r.NetRevenue) for r in wk] == [(D(2023, 1, 2), 5.0), (D(2023, 1, 9), 0.0),
                                                     (D(2023, 1, 16), 0.0), (D(2023, 1, 23), 2.0)]
    daily = timeaxis.daily_sum(df, ["key"], ["NetRevenue"]).agg(F.sum("NetRevenue")).first()[0]
    assert daily == sum(r.NetRevenue for r in wk)


def test_lag_frame_sample_counts(spark):
    start = D(2020, 1, 6)
    rows = [("k", start + dt.timedelta(weeks=i), float(i)) for i in range(30)]
    s = spark.createDataFrame(rows, "key string, week date, y double")
    assert timeaxis.lag_frame(s, ["key"], "y", 10).count() == 19
    assert timeaxis.lag_frame(s, ["key"], "y", 10, reference_compat=False).count() == 20
    first = timeaxis.lag_frame(s, ["key"], "y", 10).orderBy("week").first()
    assert first.lags == [float(i) for i in range(10)] and first.target == 10.0
    split = timeaxis.train_test_by_position(s, ["key"], 0.8)
    assert split.where("split = 'train'").count() == 24
    assert timeaxis.first_n(s, ["key"], 13).count() == 13


def test_date_range_periods(spark):
    rows = timeaxis.date_range_periods(spark, "2024-01-01", "2024-12-31", 24).orderBy("i").collect()
    assert len(rows) == 24
    assert rows[1].date == dt.datetime(2024, 1, 16, 20, 52, 10, 434782)
    assert rows[-1].date == dt.datetime(2024, 12, 31)


def test_scalers(spark):
    xs = [1.0, 2.0, 3.0, 4.0, 100.0, 6.0, 7.0]
    df = spark.createDataFrame([(i, x, 5.0) for i, x in enumerate(xs)], "id int, x double, c double")
    rs = {r.id: (r.x, r.c) for r in scale.robust_scale(df, ["x", "c"]).collect()}
    q15, q50, q85 = np.percentile(xs, [15, 50, 85])
    for i, x in enumerate(xs):
        assert abs(rs[i][0] - (x - q50) / (q85 - q15)) < 1e-12
        assert rs[i][1] == 0.0                      # constant column: range 0 -> divide by 1
    ss = [r.x for r in scale.standard_scale(df, ["x"]).orderBy("id").collect()]
    assert np.allclose(ss, (np.array(xs) - np.mean(xs)) / np.std(xs))
    mm = scale.minmax_scale(df.withColumn("key", F.lit(1)), ["key"], "x")
    back = mm.select(scale.minmax_inverse("scaled").alias("b"), "x").collect()
    assert all(abs(r.b - r.x) < 1e-9 for r in back)


def test_grouped_prefix_across_partitions_and_batches(spark):
    rnd = random.Random(3)
    # group 'hot' holds most rows (spans partitions); small groups share partitions
    rows = [("hot", i, rnd.randint(0, 9)) for i in range(2500)] + \
           [(f"g{j}", i, rnd.randint(0, 9)) for j in range(40) for i in range(rnd.randint(1, 30))]
    df = spark.createDataFrame(rows, "g string, k long, v long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = ordered.ordered_prefix(df, [F.col("v").asc(), F.col("k").asc()], "v",
                                     num_partitions=9, group_col="g").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    w = Window.partitionBy("g").orderBy(F.col("v").asc(), F.col("k").asc())
    ref = df.select("g", "k", F.row_number().over(w).alias("rn"),
                    F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cs"),
                    F.count(F.lit(1)).over(Window.partitionBy("g")).alias("n")).collect()
    assert {(r.g, r.k): (r._rownum, r._prefix, r._n) for r in got} == \
           {(r.g, r.k): (r.rn, r.cs, r.n) for r in ref}


def test_multi_column_quantiles(spark):
    rnd = np.random.default_rng(5)
    a, b = rnd.normal(size=200), rnd.integers(0, 5, size=200).astype(float)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double")
    got = {(r.column, r.prob): r.value for r in ordered.exact_quantiles_multi(df, ["a", "b"], [0.15, 0.5, 0.85]).collect()}
    for col, arr in (("a", a), ("b", b)):
        for p in (0.15, 0.5, 0.85):
            assert abs(got[(col, p)] - np.percentile(arr, p * 100)) < 1e-12


def test_weekly_sum_reads_its_lines_once(spark):
    lines = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderpriority", F.col("o_orderdate").alias("OrderDate"),
                                                                    F.col("o_totalprice").alias("NetRevenue"))
    out = timeaxis.weekly_sum(lines, ["o_orderpriority"], ["NetRevenue"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    rows = out.collect()
    weeks = {}
    for r in rows:
        weeks.setdefault(r.o_orderpriority, []).append(r.week)
    for w in weeks.values():
        assert len(w) == len(set(w)) == (max(w) - min(w)).days // 7 + 1


def test_weekly_sum_fills_gaps_and_null_sums(spark):
    import datetime as dt
    d = dt.date(2020, 1, 7)
    rows = [("a", d, 1.0), ("a", d + dt.timedelta(weeks=3), None), ("b", d, 2.0), (None, d, 3.0), ("a", None, 9.0)]
    out = timeaxis.weekly_sum(spark.createDataFrame(rows, "k string, OrderDate date, v double"), ["k"], ["v"], money=())
    got = sorted(((r.k or "", r.week.isoformat(), r.v) for r in out.collect()))
    assert got == [("", "2020-01-06", 3.0), ("a", "2020-01-06", 1.0), ("a", "2020-01-13", 0.0), ("a", "2020-01-20", 0.0),
                   ("a", "2020-01-27", 0.0), ("b", "2020-01-06", 2.0)]


def test_running_sums_beyond_64_bits_with_and_without_exchange_reuse(spark):
    rows = [(f"c{i:03d}", 9.0e13 - i) for i in range(200)]
    df = spark.createDataFrame(rows, "CustomerID string, NetRevenue double").repartition(6)
    out = []
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        try:
            out.append([tuple(r) for r in segment.revenue_shares(df, ["CustomerID"], keep_total=True).orderBy("rank").collect()])
        finally:
            spark.conf.unset("spark.sql.exchange.reuse")
    assert out[0] == out[1]
    total = sum(int(v) for _, v in rows)
    assert int(out[0][0][-1]) == total
    upto = 0
    for row, (key, v) in zip(out[0], rows):
        upto += int(v)
        assert row[0] == key and abs(row[3] - upto / total * 100) < 1e-9


def test_prefix_with_null_groups_and_empty_frames(spark):
    df = spark.createDataFrame([("a", 1, 5), (None, 2, 7), (None, 1, None), ("a", 0, 2)], "g string, k long, v long")
    got = {(r.g, r.k): (r._rownum, r._prefix, r._n) for r in ordered.ordered_prefix(df, [F.col("k").asc()], "v", 3, "g").collect()}
    assert got == {("a", 0): (1, 2, 2), ("a", 1): (2, 7, 2), (None, 1): (1, 0, 2), (None, 2): (2, 7, 2)}
    none = df.where("k > 99")
    assert ordered.ordered_prefix(none, [F.col("k").asc()], "v").count() == 0
    assert ordered.exact_quantiles_multi(none, ["k", "v"], [0.5]).count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.floats(allow_nan=False, width=64), st.sampled_from([0.0, -0.0, 1.0, 5e-324, 1.7e308, -1.7e308])), min_size=1, max_size=40))
def test_ranks_of_any_doubles(spark, xs):
    counts = ordered.value_counts(spark.createDataFrame([(x,) for x in xs] + [(None,), (float("nan"),)], "x double"), ["x"])
    got = ordered.ranks_of(counts, {"x": list(range(len(xs)))})
    assert [got["x", i] for i in range(len(xs))] == sorted(x + 0.0 for x in xs)


def test_describe_reads_its_rows_once(spark, tmp_path):
    from revlens.operators import explore
    rnd = np.random.default_rng(2)
    x = rnd.lognormal(0, 3, 4000)
    df = spark.createDataFrame([(float(a), int(a) % 7, None) for a in x], "x double, y int, z double")
    df.write.parquet(str(tmp_path / "t"))
    got = {r.column: r for r in explore.describe(spark.read.parquet(str(tmp_path / "t")), ["x", "y", "z"]).collect()}
    y = np.array([int(a) % 7 for a in x])
    for c, v in (("x", x), ("y", y)):
        r = got[c]
        want = [len(v), v.mean(), v.std(ddof=1), v.min(), *np.percentile(v, [25, 50, 75]), v.max()]
        assert np.allclose([r["count"], r["mean"], r["std"], r["min"], r["q25"], r["q50"], r["q75"], r["max"]], want, rtol=1e-12)
    assert got["z"]["count"] == 0 and got["z"]["mean"] is None and got["z"]["q50"] is None
