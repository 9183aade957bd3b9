"""Clustering, forecasting, diagnostics, file sets and sinks."""
import datetime as dt
import io
import math
import os
import tempfile
import zipfile

import numpy as np
from pyspark.sql import functions as F

from revlens.operators import cluster, diagnostics, evaluate, explore, forecast
from revlens.sinks import publish_table, write_csv_export, write_parquet
from revlens.sources import files

D = dt.date


def _weeks(n, start=D(2020, 1, 6)):
    return [start + dt.timedelta(weeks=i) for i in range(n)]


def test_select_k_finds_three_groups_and_stable_labels(spark):
    rnd = np.random.default_rng(3)
    pts = []
    for cx, n in ((0.0, 30), (10.0, 25), (20.0, 20)):
        for i in range(n):
            pts.append((f"id{len(pts)}", cx + rnd.normal(0, 0.3), cx + rnd.normal(0, 0.3)))
    df = spark.createDataFrame(pts, "id string, a double, b double")
    assigned, scores = cluster.segment(df, ["id"], ["a", "b"], [2, 3, 4, 5], 45, "a")
    assert cluster.best_k(scores) == 3
    sizes = {r.cluster: r.size for r in explore.cluster_size(assigned).collect()}
    assert sizes == {1: 20, 2: 25, 3: 30}   # ids ordered by descending mean of ``a``
    centres = {r.cluster: r.a for r in cluster.cluster_centers(assigned, ["a"]).collect()}
    assert centres[1] > centres[2] > centres[3]


def test_one_hot_hash_corr(spark):
    df = spark.createDataFrame([("x", "p", 1.0, 2.0), ("y", "q", 2.0, 4.0), ("x", "q", 3.0, 6.5)],
                               "c string, d string, u double, v double")
    oh = cluster.one_hot(df, ["c"])
    assert sorted(c for c in oh.columns if c.startswith("c_")) == ["c_x", "c_y"]
    assert [r.c_x for r in oh.collect()] == [1, 0, 1]
    fh = cluster.feature_hash(df, ["c", "d"], 10)
    assert len([c for c in fh.columns if c.startswith("hashed_")]) == 10
    corr = {(r.col_a, r.col_b): r.corr for r in cluster.correlation_matrix(df, ["u", "v"]).collect()}
    assert abs(corr[("u", "v")] - np.corrcoef([1, 2, 3], [2, 4, 6.5])[0, 1]) < 1e-12


def test_lag_model_exact_on_noiseless_ar2(spark):
    y = [1.0, 2.0]
    for _ in range(58):
        y.append(0.6 * y[-1] + 0.3 * y[-2] + 1.0)
    s = spark.createDataFrame([("k", w, v) for w, v in zip(_weeks(60), y)], "key string, week date, y double")
    fdf = forecast.lag_model_forecast(s, ["key"], "y", look_back=2, horizon=5)
    out = fdf.orderBy("Date").collect()
    hist = [r for r in out if r.Predict is None]
    fut = [r for r in out if r.Predict is not None]
    assert len(hist) == 60 and len(fut) == 5
    for r in hist:
        p = r.Train if r.Train is not None else r.Test
        if p is not None:
            assert abs(p - r.y) < 1e-6
    nxt = list(y)
    for r in fut:
        nxt.append(0.6 * nxt[-1] + 0.3 * nxt[-2] + 1.0)
        assert abs(r.Predict - nxt[-1]) < 1e-6 and r.y == r.Predict
    assert fut[0].Date == D(2020, 1, 6) + dt.timedelta(weeks=60)
    err = evaluate.rmse(fdf.where(F.col("Predict").isNull()), ["key"], "y", "Train")
    assert err.first().rmse < 1e-6


def test_differenced_ar_integrates_quadratic(spark):
    y = [0.5 * t * t + 2 * t + 1 for t in range(40)]
    s = spark.createDataFrame([("k", w, v) for w, v in zip(_weeks(40), y)], "key string, week date, y double")
    fut = (forecast.differenced_ar_forecast(s, ["key"], "y", p=2, d=2, horizon=3)
           .where("predicted_mean IS NOT NULL").orderBy("Date").collect())
    for i, r in enumerate(fut):
        t = 40 + i
        assert abs(r.predicted_mean - (0.5 * t * t + 2 * t + 1)) < 1e-5


def test_smoothing_and_acf(spark):
    ys = [3.0, 5.0, 4.0, 6.0, 8.0, 7.0, 9.0, 12.0]
    s = spark.createDataFrame([("k", w, v) for w, v in zip(_weeks(8), ys)], "key string, week date, y double")
    fitted = [r.fitted for r in diagnostics.simple_exp_smoothing(s, ["key"], "y", 0.5).orderBy("week").collect()]
    lvl, exp = ys[0], []
    for v in ys:
        exp.append(lvl)
        lvl = 0.5 * v + 0.5 * lvl
    exp[0] = ys[0]
    assert np.allclose(fitted, exp)
    a = {r.lag: r.acf for r in diagnostics.acf(s, ["key"], "y", 3).collect()}
    d = np.array(ys) - np.mean(ys)
    for k in range(1, 4):
        assert abs(a[k] - np.sum(d[k:] * d[:-k]) / np.sum(d * d)) < 1e-12
    p = {r.lag: r.pacf for r in diagnostics.pacf(diagnostics.acf(s, ["key"], "y", 3), ["key"]).collect()}
    assert abs(p[1] - a[1]) < 1e-12
    adf = diagnostics.adf_statistic(s, ["key"], "y").first()
    assert adf.crit_5pct == -2.86 and adf.nobs > 0
    h = diagnostics.holt(s, ["key"], "y", 0.5, 0.5).count()
    assert h == 8


def _xlsx(rows):
    """Minimal workbook with inline strings and numbers."""
    def cell(ref, v):
        if isinstance(v, str):
            return f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>'
        return f'<c r="{ref}"><v>{v}</v></c>'
    body = "".join(f'<row r="{i + 1}">' + "".join(cell(f"{chr(65 + j)}{i + 1}", v) for j, v in enumerate(r)
                                                  if v is not None) + "</row>" for i, r in enumerate(rows))
    sheet = ('<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
             f"<sheetData>{body}</sheetData></worksheet>")
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", sheet)
    return buf.getvalue()


def test_forecast_file_sets(spark):
    d = tempfile.mkdtemp(prefix="revlens-files-")
    os.makedirs(f"{d}/csv")
    header = "Date,Revenue,Train,Test,Predict\n"
    open(f"{d}/csv/predCluster1.csv", "w").write(header + "2024-01-01,5.0,,,5.0\n2024-01-08,3.0,2.0,,\n")
    open(f"{d}/csv/predCluster2.csv", "w").write(header + "2024-01-01,,,,7.0\n")
    open(f"{d}/csv/other.csv", "w").write(header + "2024-01-01,1.0,,,2.0\n")
    cs = files.read_forecast_csv_dir(spark, f"{d}/csv/*.csv")
    got = {(r.Cluster, r.Revenue, r.Predict) for r in cs.collect()}
    assert got == {("1", None, 5.0), ("1", 3.0, None), ("2", None, 7.0), ("Unknown", 1.0, 2.0)}
    tot = {r.Cluster: r.totalPredict for r in files.forecast_total_by_cluster(cs).collect()}
    assert tot == {"1": "5.0", "2": "7.0", "3": "No Data"}

    os.makedirs(f"{d}/xl")
    hdr = ["Date", "Quantity", "Train", "Test", "Predict"]
    open(f"{d}/xl/2024predictionsBayern.xlsx", "wb").write(
        _xlsx([hdr, [45292, "0.125", None, None, None], [45299, 4, None, None, 4], [45306, "abc", 0, None, None]]))
    open(f"{d}/xl/2024predictionsScrewsBrandenburg.xlsx", "wb").write(_xlsx([hdr, [45292, 2, 1, None, None]]))
    open(f"{d}/xl/summary.xlsx", "wb").write(_xlsx([hdr, [45292, 9, 9, 9, 9]]))
    open(f"{d}/xl/brokenpredictions.xlsx", "wb").write(b"not a zip")
    gen = files.read_forecast_workbooks(spark, f"{d}/xl/*.xlsx", files.GENERAL_COLUMNS)
    rows = {(r.Location, r.Date, r.Quantity, r.Predict) for r in gen.collect()}
    assert ("Bayern", D(2024, 1, 1), 0.12, None) in rows          # half-even rounding
    assert ("Bayern", D(2024, 1, 8), None, 4.0) in rows           # Quantity == Predict -> null
    assert ("Bayern", D(2024, 1, 15), None, None) in rows         # text -> null, 0 -> null
    assert not any(r[0] == "summary" for r in rows)               # no 'predictions' in the name
    prod = files.read_forecast_workbooks(spark, f"{d}/xl/*.xlsx", files.PRODUCT_COLUMNS, extract_item_type=True)
    tags = {(r.ItemType, r.Location) for r in prod.collect()}
    assert ("Screws", "Brandenburg") in tags and ("", "Bayern") in tags
    bad = [r.path for r in files.unreadable_workbooks(spark, f"{d}/xl/*.xlsx").collect()]
    assert len(bad) == 1 and bad[0].endswith("brokenpredictions.xlsx")


def test_sources_and_sinks(spark):
    d = tempfile.mkdtemp(prefix="revlens-io-")
    with open(f"{d}/kunden.csv", "w", encoding="utf-8-sig") as f:
        f.write("Kunde_SK;Ort;PLZ-Code;Branchengruppe;Vertriebskanalkategorie;Vertriebskanal\n")
        f.write("001;Köln;01234;I;B2B_x;\n")
    cu = files.read_customers_csv(spark, f"{d}/kunden.csv").first()
    assert cu["Kunde_SK"] == "001" and cu["PLZ-Code"] == "01234" and cu["Ort"] == "Köln"
    with open(f"{d}/plz.csv", "w", encoding="utf-8-sig") as f:
        f.write("osm_id,ort,plz,bundesland\n1,Köln,50667,Nordrhein-Westfalen\n")
    ref = files.read_postal_reference(spark, f"{d}/plz.csv").first()
    assert ref.plz == 50667 and ref.ort == "Köln"
    with open(f"{d}/clusters.csv", "w") as f:
        f.write("CustomerID,cluster\na,0\nb,2\nc,7\n")
    cl = {r.ID: r.cluster for r in files.read_cluster_assignments(spark, f"{d}/clusters.csv").collect()}
    assert cl == {"a": 1, "b": 3, "c": 7}
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    write_parquet(df, f"{d}/out.parquet")
    assert spark.read.parquet(f"{d}/out.parquet").count() == 1
    write_csv_export(df, f"{d}/out.csv")
    assert spark.read.csv(f"{d}/out.csv", sep=";", header=True).first()["b"] == "x"
    prev = publish_table(df, "revlens_test_table")
    assert prev.count() == 1
    assert files.read_sql_table(spark, "revlens_test_table", 5).count() == 1
    assert not math.isnan(1.0)


def test_publish_forecasts_job(spark):
    from revlens.plans import jobs
    d = tempfile.mkdtemp(prefix="revlens-pub-")
    for sub in ("lstm", "items", "products"):
        os.makedirs(f"{d}/{sub}")
    header = "Date,Revenue,Train,Test,Predict\n"
    open(f"{d}/lstm/aCluster1.csv", "w").write(header + "2024-01-01,5.0,,,6.0\n")
    open(f"{d}/lstm/aCluster3.csv", "w").write(header + "2024-01-01,2.0,,,2.0\n")
    hdr = ["Date", "Quantity", "Train", "Test", "Predict"]
    open(f"{d}/items/2024predictionsBayern.xlsx", "wb").write(_xlsx([hdr, [45292, 3, None, None, None]]))
    open(f"{d}/products/2024predictionsNailsNordrhein-Westfalen.xlsx", "wb").write(
        _xlsx([hdr, [45292, 1, None, None, 2]]))
    open(f"{d}/items/2023predictionsBroken.xlsx", "wb").write(b"no workbook")
    out = jobs.publish_forecasts(spark, f"{d}/lstm/*.csv", f"{d}/items/*.xlsx", f"{d}/products/*.xlsx")
    assert set(out) == {"predictions_LSTM", "predictions_LSTM_Items", "predictions_LSTM_Items_SpecificProducts", "predictions_unreadable"}
    bad = spark.table("predictions_unreadable").collect()
    assert len(bad) == 1 and bad[0].path.endswith("2023predictionsBroken.xlsx")
    lstm = {(r.Cluster, r.Revenue) for r in spark.table("predictions_LSTM").collect()}
    assert lstm == {("1", 5.0), ("3", None)}
    prod = spark.table("predictions_LSTM_Items_SpecificProducts").first()
    assert (prod.ItemType, prod.Location, prod.Quantity) == ("Nails", "Nordrhein-Westfalen", 1.0)
    assert spark.table("predictions_LSTM_Items").first().Location == "Bayern"


def test_run_all_on_table_derived_raw_data(spark):
    from revlens.plans import catalog, jobs
    from conftest import SF_SMALL
    inv, cust, ref = catalog._tpch_raw(spark, SF_SMALL)
    stage = tempfile.mkdtemp(prefix="revlens-stage-")
    for sub in ("lstm", "items", "products"):
        os.makedirs(f"{stage}/{sub}")
    open(f"{stage}/lstm/aCluster1.csv", "w").write("Date,Revenue,Train,Test,Predict\n2024-01-01,5.0,,,6.0\n")
    book = _xlsx([["Date", "Quantity", "Train", "Test", "Predict"], [45292, 3, None, None, None]])
    open(f"{stage}/items/predictionsBayern.xlsx", "wb").write(book)
    open(f"{stage}/products/predictionsNailsBayern.xlsx", "wb").write(book)
    res = jobs.run_all(spark, inv, cust, ref, catalog.ANALYSIS_YEAR, catalog.REFERENCE_DATE, stage, horizon=4,
                       publish={"lstm_csv_glob": f"{stage}/lstm/*.csv", "items_glob": f"{stage}/items/*.xlsx",
                                "products_glob": f"{stage}/products/*.xlsx"})
    cust_fc = spark.read.parquet(f"{stage}/forecast_customers")
    items_fc = spark.read.parquet(f"{stage}/forecast_items")
    assert set(res) == {"customers", "items", "published"}
    assert spark.table("predictions_LSTM_Items").first().Location == "Bayern" and spark.table("predictions_unreadable").count() == 0
    assert {"cluster", "Date", "Revenue", "Train", "Test", "Predict"} <= set(cust_fc.columns)
    # every cluster gets exactly 4 future weeks
    fut = cust_fc.where("Predict IS NOT NULL").groupBy("cluster").count().collect()
    assert fut and all(r["count"] == 4 for r in fut)
    assert items_fc.where("Predict IS NOT NULL").count() > 0
    assert spark.read.parquet(f"{stage}/cleaned").count() > 0
