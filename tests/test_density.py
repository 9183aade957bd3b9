"""kNN distance and DBSCAN against brute force on small fixtures."""
import numpy as np

import pytest
from pyspark.sql import functions as F

from revlens.operators import cluster, density


def _brute_dbscan(X, eps, ms):
    n = len(X)
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    nb = D <= eps
    core = nb.sum(1) >= ms
    label = -np.ones(n, dtype=int)
    for i in range(n):                       # components of core points, id = smallest member
        if core[i] and label[i] < 0:
            stack, comp = [i], []
            label[i] = i
            while stack:
                j = stack.pop()
                comp.append(j)
                for t in np.where(nb[j] & core)[0]:
                    if label[t] < 0:
                        label[t] = i
                        stack.append(t)
            m = min(comp)
            label[comp] = m
    for i in range(n):
        if not core[i]:
            cands = [label[j] for j in np.where(nb[i] & core)[0]]
            label[i] = min(cands) if cands else -1
    return label


def test_knn_and_dbscan_match_brute_force(spark):
    rnd = np.random.default_rng(11)
    X = np.vstack([rnd.normal(0, 0.2, (25, 2)), rnd.normal(3, 0.3, (20, 2)), rnd.uniform(-2, 5, (8, 2)),
                   np.repeat([[1.5, 1.5]], 6, axis=0)])            # six identical points
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(X)]
    df = spark.createDataFrame(rows, "id long, a double, b double")

    got = {r.id: r.dist for r in density.knn(df, "id", ["a", "b"], k=3, leaf=8).where("rank = 3").collect()}
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    exp = np.sort(D, axis=1)[:, 2]                                   # self counts as the first
    assert all(abs(got[i] - exp[i]) < 1e-12 for i in range(len(X)))

    for eps, ms in ((0.3, 4), (0.6, 5), (0.15, 3)):
        lab = {r.id: r.cluster for r in density.dbscan(df, "id", ["a", "b"], eps, ms).collect()}
        ref = _brute_dbscan(X, eps, ms)
        order = sorted(set(int(x) for x in ref if x >= 0))        # clusters numbered by smallest member
        ref = [order.index(int(x)) if x >= 0 else -1 for x in ref]
        assert [lab[i] for i in range(len(X))] == ref, (eps, ms)

    trials = [(e, m) for e in (0.1, 0.3, 0.6, 1.5, 9.0) for m in (1, 2, 4, 8)]
    scores, labels = density.dbscan_search(df, "id", ["a", "b"], sorted({e for e, _ in trials}), [1, 2, 4, 8])
    got = {}
    for r in labels.collect():
        got.setdefault((r.eps, r.min_samples), {})[r.id] = r.cluster
    for eps, ms in trials:
        ref = _brute_dbscan(X, eps, ms)
        order = sorted(set(int(x) for x in ref if x >= 0))
        assert [got[eps, ms][i] for i in range(len(X))] == [order.index(int(x)) if x >= 0 else -1 for x in ref], (eps, ms)
    for r in scores.collect():
        lab = np.array([got[r.eps, r.min_samples][i] for i in range(len(X))])
        assert (r.clusters, r.noise) == (len(set(lab) - {-1}), (lab < 0).sum())
        want = _silhouette(X, lab) if 2 <= r.clusters <= 50 else -10.0
        assert abs(r.score - want) < 1e-8
    ranked = scores.orderBy("rank").collect()
    assert [r.rank for r in ranked] == list(range(1, 21)) and ranked[0].score == max(r.score for r in ranked)
    assert density.best_trials(scores, 10).count() == 10
    best = {r.id: r.cluster for r in density.best_labels(scores, labels).collect()}
    assert best == got[ranked[0].eps, ranked[0].min_samples]


def _silhouette(X, lab):
    D2 = ((X[:, None, :] - X[None, :, :]) ** 2).sum(-1)
    out = []
    for i, own in enumerate(lab):
        n = (lab == own).sum()
        if n == 1:
            out.append(0.0)
            continue
        a = D2[i][lab == own].sum() / (n - 1)
        b = min(D2[i][lab == c].mean() for c in set(lab) if c != own)
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(out))


def test_silhouettes_are_those_of_the_library(spark):
    rnd = np.random.default_rng(3)
    X = np.vstack([rnd.normal(0, 0.2, (40, 2)), rnd.normal(3, 0.3, (30, 2))])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(X)], "id long, a double, b double")
    scores, labels = density.dbscan_search(df, "id", ["a", "b"], [0.5], [4])
    pred = cluster.assemble(df, ["a", "b"]).join(labels.select("id", "cluster"), "id")
    assert abs(scores.first().score - cluster.silhouette(pred)) < 1e-8


@pytest.mark.parametrize("d, parts", [(1, 4096), (2, 7), (3, 4096)])
def test_dbscan_on_crowded_cells(spark, monkeypatch, d, parts):
    """Dense cells side by side, dealt in parts: no pair of crowded cells is compared point by point."""
    monkeypatch.setattr(density, "PART", parts)
    rnd = np.random.default_rng(d)
    X = np.vstack([rnd.normal(0, 0.25, (400, d)), rnd.normal(2, 0.2, (200, d)), rnd.uniform(-1, 3, (60, d)), np.zeros((50, d))])
    df = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(X)], "id long, " + ", ".join(f"x{j} double" for j in range(d)))
    for eps, ms in ((0.2, 6), (0.05, 3)):
        got = {r.id: r.cluster for r in density.dbscan(df, "id", [f"x{j}" for j in range(d)], eps, ms).collect()}
        ref = _brute_dbscan(X, eps, ms)
        order = sorted(set(int(x) for x in ref if x >= 0))
        assert [got[i] for i in range(len(X))] == [order.index(int(x)) if x >= 0 else -1 for x in ref]


def test_rows_without_coordinates_stay(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.1, 0.0), (3, None, 0.0), (4, float("nan"), 1.0), (None, 0.0, 0.1), (1, 0.0, 0.0)],
                               "id long, a double, b double")
    rows = sorted(((r.id or 0, r.cluster) for r in density.dbscan(df, "id", ["a", "b"], 0.5, 2).collect()), key=str)
    assert rows == sorted([(0, 0), (1, 0), (1, 0), (2, 0), (3, None), (4, None)], key=str)
    none = spark.createDataFrame([], "id long, a double, b double")
    assert density.dbscan(none, "id", ["a", "b"], 0.5, 2).count() == 0 and density.knn(none, "id", ["a", "b"]).count() == 0


def test_knn_ranks_and_curve(spark):
    rnd = np.random.default_rng(7)
    X = np.vstack([rnd.normal(0, 1, (300, 3)), np.repeat([[2.0, 2.0, 2.0]], 9, axis=0), np.array([[1e6, 0, 0], [0, -1e7, 0], [5, 5, 5]]),
                   np.column_stack([np.full(80, 3.0), rnd.normal(0, 1, 80), np.full(80, -1.0)])])
    df = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(X)], "id long, x double, y double, z double")
    out = density.knn(df, "id", ["x", "y", "z"], k=5, leaf=12)
    got = {}
    for r in out.collect():
        got.setdefault(r.id, {})[r.rank] = r.dist
    D = np.sort(np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1)), axis=1)[:, :5]
    assert len(got) == len(X) and all(np.allclose([got[i][j + 1] for j in range(5)], D[i], rtol=1e-12, atol=1e-12) for i in range(len(X)))
    curve = density.knn_curve(out, "id", 5).orderBy("position").collect()
    assert [r.position for r in curve] == list(range(1, len(X) + 1)) and [r.kdist for r in curve] == sorted(r.kdist for r in curve)


def test_an_outlier_does_not_make_all_pairs(spark):
    """Points in one far corner: the leaves are cut by rank, so each stays small."""
    rnd = np.random.default_rng(1)
    X = np.vstack([rnd.normal(0, 1e-3, (3000, 2)), [[1e9, 1e9]]])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(X)], "id long, a double, b double")
    pts, _ = density.collapse(df, "id", ["a", "b"])
    sizes = density._leaves(pts, 2, 64).groupBy("node").count()
    assert sizes.agg(F.max("count")).first()[0] <= 64 and sizes.count() < 200


def test_dbscan_follows_a_long_chain(spark):
    pts = spark.createDataFrame([(i, 0.4 * i) for i in range(140)], "id long, x double")
    out = density.dbscan(pts, "id", ["x"], 0.5, 2)
    assert {r.cluster for r in out.collect()} == {0}


def test_knn_keeps_every_id(spark):
    two = spark.createDataFrame([(1, 0.0), (2, 5.0)], "id long, x double")
    assert {(r.id, r.dist) for r in density.knn(two, "id", ["x"], k=3).where("rank = 3").collect()} == {(1, None), (2, None)}
    odd = spark.createDataFrame([(1, 0.0), (2, 1.0), (3, 3.0), (4, None), (5, float("nan")), (6, float("inf"))], "id long, x double")
    got = {r.id: r.dist for r in density.knn(odd, "id", ["x"], k=3).where("rank = 3").collect()}
    assert got == {1: 3.0, 2: 2.0, 3: 3.0, 4: None, 5: None, 6: None}


def test_knn_goes_on_until_far_points_are_settled(spark):
    far = spark.createDataFrame([(1, 0.0), (2, 1.0), (3, 1e12)], "id long, x double")
    got = {r.id: r.dist for r in density.knn(far, "id", ["x"], k=3).where("rank = 3").collect()}
    assert got == {1: 1e12, 2: 1e12 - 1, 3: 1e12}


def test_starting_centres_come_from_all_points(spark):
    rnd = np.random.default_rng(4)
    X = np.vstack([rnd.normal(0, 0.1, (4000, 2)), rnd.normal(500, 0.1, (3, 2)), rnd.normal(-500, 0.1, (3, 2))])
    pts = cluster.assemble(spark.createDataFrame([(float(a), float(b)) for a, b in X], "a double, b double"), ["a", "b"])
    model = cluster.select_k(pts, [3])[1][3]
    assert np.allclose(sorted(c[0].round() for c in model.clusterCenters()), [-500, 0, 500], atol=1)


def test_skipped_k_are_rows(spark):
    pts = cluster.assemble(spark.createDataFrame([(0.0,), (1.0,), (9.0,)], "a double"), ["a"])
    rows = {r.k: (r.silhouette, r.inertia, r.converged) for r in cluster.select_k(pts, [2, 3, 5])[0].collect()}
    assert rows[2][0] is not None and rows[2][2] and rows[3] == rows[5] == (None, None, None)


def test_one_value_has_no_silhouette(spark):
    pts = cluster.assemble(spark.createDataFrame([(4.0,)] * 9, "a double"), ["a"])
    row = cluster.select_k(pts, [2])[0].first()
    assert row.silhouette is None and row.inertia == 0.0


def test_segments_are_nearest_centres_and_keep_every_row(spark):
    rnd = np.random.default_rng(8)
    X = np.vstack([rnd.normal(c, 0.3, (30, 2)) for c in (0, 4, 9)])
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(X)] + [(500, None, 1.0), (501, float("nan"), 1.0)]
    out, scores = cluster.segment(spark.createDataFrame(rows, "id long, a double, b double"), ["id"], ["a", "b"], [2, 3, 4, 5, 200], 1, "a")
    got = {r.id: r for r in out.collect()}
    assert len(got) == 92 and got[500].cluster is None and got[501].cluster is None
    s = {r.k: r for r in scores.collect()}
    assert cluster.best_k(scores) == 3 and s[200].silhouette is None
    lab = np.array([got[i].cluster for i in range(90)])
    centres = {c: X[lab == c].mean(0) for c in set(lab)}
    assert sorted(centres, key=lambda c: -centres[c][0]) == [1, 2, 3]  # by descending value
    for i, x in enumerate(X):
        assert lab[i] == min(centres, key=lambda c: ((x - centres[c]) ** 2).sum())
    assert abs(sum(((x - centres[c]) ** 2).sum() for x, c in zip(X, lab)) - s[3].inertia) < 1e-6
    sizes = {r.cluster: r["size"] for r in __import__("revlens.operators.explore", fromlist=["x"]).cluster_size(out.where("cluster IS NOT NULL")).collect()}
    assert sizes == {1: 30, 2: 30, 3: 30}


def test_rows_without_numbers_stay_in_pca_and_forest(spark):
    rnd = np.random.default_rng(2)
    rows = [(i, *map(float, rnd.normal(size=3))) for i in range(40)] + [(90, None, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double")
    out, variance = cluster.pca(df, ["a", "b"], 2)
    got = {r.id: (r.pc_1, r.pc_2) for r in out.collect()}
    assert len(got) == 41 and got[90] == (None, None) and abs(sum(variance) - 1) < 1e-9
    pred, errors = cluster.random_forest_regression(df.where("id < 30"), df.where("id >= 30"), ["a", "b"], "y", trees=3)
    assert {r.split: (r.n, r.incomplete) for r in errors.collect()} == {"train": (30, 0), "test": (10, 1)}
    assert {r.id: r.prediction for r in pred.collect()}[90] is None and pred.count() == 11


def test_forest_on_many_rows_fits_cells_of_bins(spark, monkeypatch):
    from pyspark.ml.regression import RandomForestRegressor
    rnd = np.random.default_rng(5)
    x = rnd.integers(1, 51, 6000)
    rows = [(i, float(v), float(v * 10 + rnd.normal() * v)) for i, v in enumerate(x)] + [(9000, None, 1.0), (9001, 3.0, None)]
    df = spark.createDataFrame(rows, "id long, a double, y double")
    train, test = df.where("id < 5000"), df.where("id >= 5000")
    plain, plain_errors = cluster.random_forest_regression(train, test, ["a"], "y", trees=30)

    fitted, fit = [], RandomForestRegressor.fit
    monkeypatch.setattr(RandomForestRegressor, "fit", lambda self, data, *a: fitted.append(data.count()) or fit(self, data, *a))
    monkeypatch.setattr(cluster, "FOREST_COUNTS", 100_000, raising=False)
    monkeypatch.setattr(cluster, "DRAW_ROWS", 1000, raising=False)
    pred, errors = cluster.random_forest_regression(train, test, ["a"], "y", trees=30)
    again, _ = cluster.random_forest_regression(train, test, ["a"], "y", trees=30)
    assert len(fitted) == 60 and max(fitted) <= 32  # a tree sees its cells, not 5,000 rows
    got, want = ({r.id: r.prediction for r in d.collect()} for d in (pred, plain))
    assert all(abs(r.prediction - got[r.id]) < 1e-9 for r in again.where("prediction IS NOT NULL").collect())
    assert set(got) == set(want) and got[9000] is None and pred.columns == plain.columns
    near = [abs(got[i] - want[i]) for i in want if want[i] is not None]
    assert max(near) < 16  # labels run from 10 to 500, their bins are some 16 wide and may begin at other values
    a, b = ({r.split: r for r in e.collect()} for e in (errors, plain_errors))
    assert all(a[s].n == b[s].n and a[s].incomplete == b[s].incomplete and abs(a[s].rmse / b[s].rmse - 1) < 0.03 for s in b)


def test_forest_by_cells_learns_two_features_and_one_value(spark, monkeypatch):
    monkeypatch.setattr(cluster, "FOREST_COUNTS", 0)
    rnd = np.random.default_rng(6)
    rows = [(i, float(rnd.integers(0, 4)), 7.0, float(rnd.normal())) for i in range(400)]
    df = spark.createDataFrame([(i, a, b, 100 * a + e) for i, a, b, e in rows], "id long, a double, b double, y double")
    pred, errors = cluster.random_forest_regression(df, df, ["a", "b"], "y", trees=20)
    got = {r.id: (r.a, r.prediction) for r in pred.collect()}
    order = [np.mean([p for a, p in got.values() if a == v]) for v in range(4)]
    # a node sees one of the features; some see only the one without splits and end there, as in MLlib
    assert len(got) == 400 and order == sorted(order) and order[3] - order[0] > 80
    assert {r.split: r.n for r in errors.collect()} == {"train": 400, "test": 400}
