"""Dirty-input fixtures (F1-F3) for cleaning and location repair."""
import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens import functions as RF
from revlens.operators import clean, geo
from revlens.plans import jobs

D = dt.date

INVOICE_SCHEMA = T.StructType([
    T.StructField("Belegnummer", T.StringType()), T.StructField("Unternehmen", T.StringType()),
    T.StructField("Artikel_SK", T.LongType()), T.StructField("Auftragsdatum_SK", T.IntegerType()),
    T.StructField("Kunde_Verkauf_SK", T.LongType()), T.StructField("Umsatztyp", T.StringType()),
    T.StructField("Preis Verpackungseinheit", T.DoubleType()), T.StructField("Menge", T.DoubleType()),
    T.StructField("Nettoumsatz", T.DoubleType()), T.StructField("Productgroup", T.StringType()),
    T.StructField("Productsubgroup", T.StringType()), T.StructField("Business Area", T.StringType()),
    T.StructField("Type", T.StringType())])
CUSTOMER_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in
                                ["Kunde_SK", "Ort", "PLZ-Code", "Branchengruppe",
                                 "Vertriebskanalkategorie", "Vertriebskanal"]])


def invoices(spark):
    rows = [
        ("A1", "C1", 10, 20230102, 1, "R", 5.0, 2.0, 10.0, "G", "S1", "BA", "T"),
        ("A1", "C1", 10, 20230102, 1, "R", 5.0, 1.0, 5.0, "G", "S1", "BA", "T"),   # same article twice
        ("A1", "C1", 11, 20230102, 1, "R", 5.0, None, 7.5, "G", None, "BA", "T"),
        ("A2", "C2", 12, 20231231, 2, "R", 1.0, 0.5, 0.005, "G", "S2", "BA", "T"),
        ("A3", "C2", 12, 20231301, 2, "R", 1.0, 1.0, 3.0, "G", "S2", "BA", "T"),   # invalid date
        ("A4", "C2", 13, 20230103, 3, "R", 1.0, -2.0, -4.0, "G", "S2", "BA", "T"),  # return
        ("A5", "C2", 13, 20230103, 4, "R", 1.0, 1.0, None, "G", "S2", "BA", "T"),   # no revenue
        ("A6", "C2", 13, 20230103, 5, "R", 1.0, 1.0, 1.0, "G", "S2", "BA", "T"),    # customer with bad code
        ("A7", "C2", 13, 20230103, 6, "R", 1.0, 1.0, 1.0, "G", "S2", "BA", "T"),    # Internal channel
        ("A8", "C2", 13, 20230103, 7, "R", 1.0, 1.0, 2.0, "G", "S2", "BA", "T"),    # code 08312, unresolved
        ("A9", "C2", 13, 20230103, 99, "R", 1.0, 1.0, 2.0, "G", "S2", "BA", "T"),   # unknown customer
    ]
    return spark.createDataFrame(rows, INVOICE_SCHEMA)


def customers(spark):
    rows = [
        ("1", "Muenchen", "80331", "I1", "B2B_x", "old"),
        ("2", "Berlin, Mitte", "10115", "I2", "B2C_y", None),
        ("3", "Hamburg", "20095", None, "B2B2C_z", None),
        ("4", "Nowhere", "00000", None, "B2B_x", None),
        ("5", "Bad", "A1234", None, "B2B_x", None),
        ("6", "Köln", "50667", None, "Internal_q", None),
        ("7", "Zwickau", "08312", None, "B2B", None),
    ]
    return spark.createDataFrame(rows, CUSTOMER_SCHEMA)


def postal(spark):
    rows = [("München", 80331, "Bayern"), ("Munchen Ost", 80331, "Bayern"),
            ("Berlin", 10115, "Berlin"), ("Hamburg", 20095, None),
            ("Hamburg-Nord", 20096, "Hamburg")]
    return spark.createDataFrame(rows, "ort string, plz int, bundesland string")


def test_seasons_pin(spark):
    df = spark.createDataFrame([(D(2023, m, 15),) for m in range(1, 13)], "d date")
    out = {r["m"]: (r["f"], r["w"]) for r in df.select(
        F.month("d").alias("m"), RF.season_fiscal("d").alias("f"),
        RF.season_meteorological("d").alias("w")).collect()}
    assert [out[m][0] for m in range(1, 13)] == (["Spring"] * 3 + ["Summer"] * 3 + ["Autumn"] * 3
                                                  + ["Winter"] * 3)
    assert [out[m][1] for m in (12, 1, 2, 3, 6, 9)] == ["Winter", "Winter", "Winter", "Spring",
                                                         "Summer", "Autumn"]


def test_scalar_rules(spark):
    df = spark.createDataFrame([("B2B_x", "Bayern", "20231301", 0.125, 5.0, 5.0),
                                ("B2B", None, "20230102", None, 1.0, 2.0),
                                (None, "Saarland", None, 0.0, None, 1.0)],
                               "c string, s string, d string, r double, a double, p double")
    rows = df.select(RF.sales_channel("c").alias("ch"), RF.distribution_center("s").alias("dc"),
                     RF.parse_yyyymmdd("d").alias("d"), RF.zero_to_null_rounded("r").alias("r"),
                     RF.null_where_equal("a", "p").alias("a")).collect()
    assert [r.ch for r in rows] == ["B2B", "B2B", None]
    assert [r.dc for r in rows] == ["Bayern", "Brandenburg", "Baden-Württemberg"]
    assert [r.d for r in rows] == [None, D(2023, 1, 2), None]
    assert [r.r for r in rows] == [0.12, None, None]
    assert [r.a for r in rows] == [None, 1.0, None]


def test_week_start_rule(spark):
    df = spark.createDataFrame([(D(2023, 1, 2),), (D(2023, 1, 3),), (D(2023, 1, 8),)], "d date")
    assert [r[0] for r in df.select(RF.week_start("d")).collect()] == [D(2022, 12, 26), D(2023, 1, 2),
                                                                       D(2023, 1, 2)]


def test_initial_cleaning(spark):
    merged = invoices(spark).withColumn("Kunde_Verkauf_SK", F.col("Kunde_Verkauf_SK").cast("string")).join(
        customers(spark).withColumnRenamed("Kunde_SK", "Kunde_Verkauf_SK"), "Kunde_Verkauf_SK")
    out = clean.initial_cleaning(merged)
    orders = sorted(r.OrderNumber for r in out.select("OrderNumber").collect())
    # A3 bad date, A5 null revenue, A6 bad code, A7 Internal, A9 unknown customer, '00000' dropped
    assert orders == ["A1", "A1", "A1", "A2", "A4", "A8"]
    assert {r.SalesChannel for r in out.collect()} == {"B2B", "B2C", "B2B2C"}


def test_filters(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), None), (D(2023, 12, 31), 0.5), (D(2024, 1, 2), 2.0)],
                               "OrderDate date, Quantity double")
    tr, te = clean.date_split(df, "2024-01-01")
    assert tr.count() == 1 and te.count() == 1
    assert clean.min_quantity(df).count() == 2
    assert clean.not_in_future(df, "2024-01-01").count() == 2
    assert clean.year_equals(df, 2024).count() == 2


def test_dedupe_first_deterministic_and_idempotent(spark):
    df = spark.createDataFrame([("o", 1, "b", 2.0), ("o", 1, "a", 3.0), ("o", 2, "z", 1.0)],
                               "OrderNumber string, ArticleID int, x string, v double")
    once = clean.dedupe_first(df, ["OrderNumber", "ArticleID"])
    assert sorted(map(tuple, once.collect())) == [("o", 1, "a", 3.0), ("o", 2, "z", 1.0)]
    twice = clean.dedupe_first(once, ["OrderNumber", "ArticleID"])
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))
    dup = clean.duplicates_keep_all(df, ["OrderNumber", "ArticleID"])
    assert dup.count() == 2


def test_nearest_state_ties_and_radius(spark):
    ref = spark.createDataFrame([(100, "Low"), (102, "High"), (500, "Far"), (-5, "Neg"), (900, None)],
                                "PostalCode int, State string")
    codes = spark.createDataFrame([(101,), (300,), (301,), (0,), (700,)], "PostalCodeInt int")
    got = {r.PostalCodeInt: r.State for r in geo.nearest_state(codes, ref).collect()}
    assert got[101] == "Low"           # equal distance: lower code wins
    assert got[300] == "High"          # 198 away beats two codes 200 away
    assert got[301] == "High"          # 199 away both sides: lower code wins
    assert got[0] == "Low"             # negative codes are never candidates
    assert got[700] == "Far"           # 200 away exactly; 900 has no state


def test_nearest_state_lower_code_on_equal_distance(spark):
    ref = spark.createDataFrame([(100, "A"), (500, "B")], "PostalCode int, State string")
    codes = spark.createDataFrame([(300,), (301,), (701,)], "PostalCodeInt int")
    got = {r.PostalCodeInt: r.State for r in geo.nearest_state(codes, ref).collect()}
    assert got == {300: "A", 301: "B", 701: None}


def test_fuzzy_best_match(spark):
    inputs = spark.createDataFrame([(1, "Muenchen"), (2, "Anything"), (3, "abc")], "k int, t string")
    cands = spark.createDataFrame([(1, "München"), (1, "Berlin"), (3, "abd"), (3, "abe")], "k int, c string")
    got = {r.k: r.best for r in geo.fuzzy_best_match(inputs, cands, "k", "t", "c", "best").collect()}
    assert got == {1: "München", 2: "Anything", 3: "abd"}


def test_prepare_sales_end_to_end(spark):
    out = jobs.prepare_sales(invoices(spark), customers(spark), postal(spark))
    rows = {(r.OrderNumber, r.ArticleID): r for r in out.collect()}
    assert out.columns == jobs.CANONICAL_ORDER
    # A1 article 10 was twice in the order and fanned out to two towns: one row
    assert sum(1 for k in rows if k == ("A1", 10)) == 1
    a1 = rows[("A1", 10)]
    assert a1.City in ("München", "Munchen Ost") and a1.State == "Bayern"
    assert rows[("A2", 12)].City == "Berlin"            # 'Berlin, Mitte' -> Berlin
    assert rows[("A4", 13)].State == "Hamburg"          # null state -> nearest code 20096
    assert rows[("A8", 13)].State == "Sachsen"          # manual rule on '08312'
    assert rows[("A8", 13)].PostalCode == "08312"
    assert rows[("A1", 11)].Quantity is None


def test_csv_columns_are_found_by_name(spark, tmp_path):
    import pytest
    from revlens.sources import files
    p = tmp_path / "c.csv"
    p.write_text("extra;b;a\n9;2;x\n", encoding="utf-8")
    assert [tuple(r) for r in files.read_plain_csv(spark, str(p), "a string, b int", sep=";").collect()] == [("x", 2)]
    with pytest.raises(ValueError):
        files.read_plain_csv(spark, str(p), "a string, missing int", sep=";")


def test_long_postal_codes_stay_whole(spark):
    from revlens import functions as RF
    df = spark.createDataFrame([("77",), ("123456",)], "c string").select(RF.pad_postal("c").alias("p"))
    assert [r.p for r in df.collect()] == ["00077", "123456"]


def test_lines_of_customers_from_100000_on_stay(spark, tmp_path):
    from conftest import SF_SMALL
    from revlens.plans import catalog
    shift = {"customer": "c_custkey", "orders": "o_custkey"}
    for t in ("lineitem", "orders", "part", "customer", "nation", "region", "supplier"):
        df = spark.read.parquet(f"{SF_SMALL}/{t}.parquet")
        if t in shift:
            df = df.withColumn(shift[t], F.col(shift[t]) + 2 * 99_999)
        df.write.parquet(f"{tmp_path}/{t}.parquet")
    run = catalog.queries()["prepare_sales_tpch"]
    plain, far = (dict(map(tuple, run(spark, d).groupBy("PostalCode").count().collect())) for d in (SF_SMALL, str(tmp_path)))
    assert far.pop("99999") > 0  # customer 0, whose own code 00000 is no valid one
    assert plain and far == plain


def test_prepare_sales_in_slices(spark, tmp_path, monkeypatch):
    from revlens.operators import slices
    more = [(None, "C3", 14, 20230104, 1, "R", 1.0, 3.0, 4.0, "G", "S2", "BA", "T"),   # two lines without a number are one key
            (None, "C2", 14, 20230104, 1, "R", 1.0, 3.0, 9.0, "G", "S2", "BA", "T"),
            ("A4", "C9", 13, 20230103, None, "R", 1.0, 3.0, 9.0, "G", "S2", "BA", "T")]
    more += [(f"B{i}", "C1", i % 7, 20230105, 1 + i % 7, "R", 1.0, 1.0, float(i), "G", "S2", "BA", "T") for i in range(60)]
    twice = spark.createDataFrame([("1", "Aachen", "52062", "I0", "B2C_a", None), ("3", "Hamburg", "20095", None, "B2B2C_z", None)], CUSTOMER_SCHEMA)
    tables = {"inv": invoices(spark).unionByName(spark.createDataFrame(more, INVOICE_SCHEMA)),
              "cust": customers(spark).unionByName(twice), "ref": postal(spark)}
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}")
    inv, cust, ref = (spark.read.parquet(f"{tmp_path}/{name}") for name in tables)
    assert slices.slice_count(inv) == 1 and slices.slice_count(invoices(spark)) == slices.MAX_SLICES
    whole = jobs.prepare_sales(inv, cust, ref)
    monkeypatch.setattr(slices, "SLICE_BYTES", 1)
    sliced = jobs.prepare_sales(inv, cust, ref)
    staged = jobs.prepare_sales(inv, cust, ref, str(tmp_path))
    # what is read at last is written: no line is shuffled once more
    assert "Exchange" not in sliced._jdf.queryExecution().executedPlan().toString()
    rows = sorted(map(tuple, whole.collect()), key=str)
    assert rows == sorted(map(tuple, sliced.collect()), key=str) == sorted(map(tuple, staged.collect()), key=str)
    assert whole.schema == sliced.schema
    # 1, 2, 3 and 7 are customers with a known place; A1 has two articles
    assert len(rows) == 6 + sum(1 + i % 7 in (1, 2, 3, 7) for i in range(60))
    places = {r.CustomerID: (r.City, r.IndustryGroup, r.SalesChannel, r.State) for r in whole.where("OrderNumber like 'B%'").collect()}
    assert places["1"] == ("Aachen", "I0", "B2C", None)  # all of a customer's places compete, the whole row is taken
    assert {r.Company: r.NetRevenue for r in whole.where("OrderNumber is null").collect()} == {"C2": 9.0}


def test_prepare_sales_shuffles_no_line_for_its_place(spark, tmp_path):
    inv, cust, ref = invoices(spark), customers(spark), postal(spark)
    for name, df in (("inv", inv), ("cust", cust), ("ref", ref)):
        df.write.parquet(f"{tmp_path}/{name}")
    inv, cust, ref = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("inv", "cust", "ref"))
    plan = jobs.prepare_sales(inv, cust, ref)._jdf.queryExecution().optimizedPlan().toString()
    # the lines are read once and meet their customers once
    assert plan.count("Nettoumsatz") and sum("Relation" in x and "Nettoumsatz" in x for x in plan.splitlines()) == 1
