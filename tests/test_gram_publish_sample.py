"""Models from products, staged publishing, exact samples, one-hot forms."""
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.operators import cluster, explore, gram, timeaxis
from revlens.sinks import publish_table


def _xy(n=240, seed=0):
    rnd = np.random.default_rng(seed)
    X = np.column_stack([rnd.normal(5, 2, n), rnd.normal(1e6, 1e3, n), rnd.normal(size=n), np.full(n, 3.0)])
    return X, 4 + 2 * X[:, 0] + 0.01 * X[:, 1] + rnd.normal(0, 0.5, n)


def _rows(spark, X, y, folds=3):
    fold = np.arange(len(y)) * folds // len(y)
    return spark.createDataFrame([(int(f), *map(float, x), float(t)) for f, x, t in zip(fold, X, y)],
                                 "fold int, " + ", ".join(f"f{i} double" for i in range(X.shape[1])) + ", y double").repartition(5)


def _plain(X, y, reg, intercept):
    """Ridge on columns of unit deviation, solved from the rows."""
    mx, my = (X.mean(0), y.mean()) if intercept else (np.zeros(X.shape[1]), 0.0)
    d = np.sqrt(((X - mx) ** 2).mean(0))
    ok = d > 1e-9
    Z = (X[:, ok] - mx[ok]) / d[ok]
    u = np.linalg.lstsq(Z.T @ Z / len(y) + reg * np.eye(ok.sum()), Z.T @ (y - my) / len(y), rcond=1e-12)[0]
    w = np.zeros(X.shape[1])
    w[ok] = u / d[ok]
    return w, my - mx @ w


def test_walk_forward_ridge_matches_a_fit_on_the_rows(spark):
    X, y = _xy()
    X = X[:, [0, 2, 3]]
    df = _rows(spark, X, y)
    got = {(r.regParam, r.fitIntercept): r.rmse for r in
           cluster.grid_search_cv(df, ["f0", "f1", "f2"], "y", "fold", [0.0, 0.3], [0.0]).collect()}
    cut = len(y) // 3
    for (reg, intercept), rmse in got.items():
        want = []
        for i in (1, 2):
            w, b = _plain(X[:i * cut], y[:i * cut], reg, intercept)
            e = y[i * cut:(i + 1) * cut] - X[i * cut:(i + 1) * cut] @ w - b
            want.append(np.sqrt((e ** 2).mean()))
        assert abs(rmse - np.mean(want)) < 1e-6 * max(1, np.mean(want))


def test_lasso_meets_its_conditions():
    X, y = _xy(400, 3)
    X = X[:, [0, 2]]
    Z = np.column_stack([np.ones(len(y)), X, y])
    reg = 0.2
    coef = gram.solve(Z.T @ Z, reg, 1.0, True)
    d, dy = X.std(0), y.std()
    r = (y - coef[0] - X @ coef[1:]) / dy
    slope = ((X - X.mean(0)) / d * r[:, None]).mean(0)
    u = coef[1:] * d / dy
    assert all(abs(slope[j] - reg * np.sign(u[j])) < 1e-9 if u[j] else abs(slope[j]) <= reg + 1e-9 for j in range(2)) and u[0] != 0 and u[1] == 0


def test_grid_reads_its_rows_once_and_ranks(spark):
    X, y = _xy()
    out = cluster.grid_search_cv(_rows(spark, X, y), [f"f{i}" for i in range(4)], "y", "fold", [0.0, 0.01, 0.1], [0.0, 0.5])
    rows = out.orderBy("rank").collect()
    assert len(rows) == 12 and rows[0].rank == 1 and rows[0].rmse == min(r.rmse for r in rows)
    one = cluster.grid_search_cv(_rows(spark, X, y, 1), ["f0"], "y", "fold", [0.0], [0.0])
    assert {r.rmse for r in one.collect()} == {None}


def test_failed_publish_leaves_the_old_table(spark):
    publish_table(spark.range(3), "pub_probe")
    broken = spark.range(5).select(F.when(F.col("id") >= 0, F.raise_error(F.lit("no"))).alias("id").cast("long"))
    with pytest.raises(Exception):
        publish_table(broken, "pub_probe")
    assert sorted(r.id for r in spark.table("pub_probe").collect()) == [0, 1, 2]
    # the new rows may come from the table itself
    publish_table(spark.table("pub_probe").where("id > 0").withColumn("more", F.lit(1)), "pub_probe")
    assert sorted(tuple(r) for r in spark.table("pub_probe").collect()) == [(1, 1), (2, 1)]
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("pub_probe")] == ["pub_probe"]
    spark.sql("DROP TABLE pub_probe")


def test_exact_sample_in_md5_order(spark, monkeypatch):
    monkeypatch.setattr(explore, "SAMPLE_BUCKET", 3)
    rows = [(i % 97, f"t{i % 700}" if i % 11 else None) for i in range(1500)]
    df = spark.createDataFrame(rows, "a int, b string").repartition(7)
    key = lambda r: hashlib.md5(f"42|{r[0]}|{r[1] or ''}".encode()).hexdigest()
    want = sorted(rows, key=lambda r: (key(r), r[0], r[1] or ""))
    for n in (0, 1, 5, 333, 1499, 1500, 9000):
        got = [tuple(r) for r in explore.sample_exact_n(df, n).collect()]
        assert sorted(got, key=str) == sorted(want[:n], key=str)
    assert explore.sample_exact_n(df.where("a > 1000"), 5).count() == 0


def test_one_hot_of_many_levels(spark):
    n = 20_000
    df = spark.range(n).select((F.col("id") % 5).alias("id"), F.format_string("v%05d", "id").alias("c"),
                               F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("d"))
    long = cluster.one_hot_long(df, ["c", "d"])
    assert long.where("feature = 'c'").agg(F.max("level"), F.countDistinct("level")).first() == (n - 1, n)
    assert long.where("feature = 'd'").count() == n - len(range(0, n, 3))
    some = {r.c: r.indicators for r in cluster.one_hot_sparse(df, ["c", "d"]).where("c IN ('v00000', 'v00007', 'v19999')").collect()}
    assert all(v.size == n + 2 for v in some.values())
    assert some["v00000"].indices.tolist() == [0] and some["v00007"].indices.tolist() == [7, n] and some["v19999"].indices.tolist() == [n - 1, n]


def test_moving_average_of_small_values(spark):
    import datetime as dt
    rows = [("k", dt.date(2020, 1, 6) + dt.timedelta(weeks=i), v) for i, v in enumerate((1e-5, 2e-5, 9e-5))]
    out = timeaxis.centered_moving_average(spark.createDataFrame(rows, "k string, week date, v double"), ["k"], "v", 3)
    assert [r.trend for r in out.orderBy("week").collect()] == [None, 4e-5, None]
