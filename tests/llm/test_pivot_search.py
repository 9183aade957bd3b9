"""Pivot-distance search against all inner products."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.llm import pivot_search as P
from revlens.llm import queries

SCHEMA = "vec_id long, embedding array<float>, label int, v string, block string"


@pytest.fixture(scope="module", autouse=True)
def prepared(spark):
    queries.prepare(spark)


def brute(rows, k=10):
    ok = [(i, [math.floor(1024 * float(np.float32(x))) for x in e]) for i, e in rows
          if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for a, (qi, q) in enumerate(ok):
        if qi is None or qi % 100:
            continue
        found = sorted((-sum(x * y for x, y in zip(q, e)), i is None, i or 0) for b, (i, e) in enumerate(ok) if b != a)
        out += [(qi, n + 1, None if null else i, -s) for n, (s, null, i) in enumerate(found[:k])]
    return sorted(out, key=str)


def found(spark, rows, parts=4, **kw):
    df = spark.createDataFrame([(i, e, 0, "x", "y") for i, e in rows], SCHEMA).repartition(parts)
    out = P.top_k(P.integer_vectors(df, F.col("vec_id") % 100 == 0), **kw)
    assert out.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    return sorted(map(tuple, out.collect()), key=str)


def vectors(n, dim=16, seed=1, spread=0.2):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(8, dim))
    x = centre[rng.integers(0, 8, n)] + spread * rng.normal(size=(n, dim))
    return [(int(i), [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]


def test_clusters_ties_nulls_and_twins(spark):
    rows = vectors(900)
    rows += [(1000 + i, rows[100][1]) for i in range(40)]  # many equal to a query
    rows += [(200, rows[200][1]), (300, rows[5][1]), (None, rows[100][1]), (None, None), (400, None), (500, [1.0, None]),
             (600, [float("nan")] * 16), (700, [float("inf")] * 16), (800, [0.5, -0.25]), (1100, [])]
    want = brute(rows)
    assert found(spark, rows, block=64, pack=4, n_pivots=8) == want
    assert found(spark, rows, parts=1) == want


def test_norms_of_all_sizes(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(c * f) for c in e]) for (i, e), f in zip(vectors(500, seed=5), rng.lognormal(0, 1.5, 500))]
    assert found(spark, rows, block=50, pack=3, n_pivots=5) == brute(rows)


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=6) * 60_000]) for i in range(210)]
    assert found(spark, rows, block=40) == brute(rows)


def test_fewer_than_k_and_empty(spark):
    assert found(spark, vectors(4)) == brute(vectors(4))
    assert found(spark, [(100, [1.0])]) == []
    assert found(spark, []) == [] and found(spark, [(0, None)]) == []
    with pytest.raises(Exception, match="scaled component"):
        found(spark, [(0, [3e30]), (1, [1.0])])


def test_far_annuli_are_not_visited(spark):
    rows = vectors(4000, spread=0.02, seed=9)
    df = spark.createDataFrame([(i, e, 0, "x", "y") for i, e in rows], SCHEMA)
    v = P.integer_vectors(df, F.col("vec_id") % 100 == 0)
    space = P.build_space(v, 10, n_pivots=8)
    index = P.build_index(v, space, 64)
    packs = P._packs(P.query_rows(index, space), space, 1.0, 1)
    reached = P._visit(index, packs, space).select("block", "at", "vec_id").distinct().count()
    assert reached < 0.25 * 40 * len(rows) and index.agg(F.sum("n")).first()[0] == len(rows)
