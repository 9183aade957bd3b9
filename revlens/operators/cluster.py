"""Clustering and feature encodings on Spark ML (ML-5..13).

k-means, silhouette and PCA run as distributed MLlib jobs over written
feature vectors; only the list of candidate k values (a handful of
numbers) lives on the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, FeatureHasher, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def complete(cols: list[str]) -> Column:
    """Whether a row has a number in every column."""
    ok = F.lit(True)
    for c in cols:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return ok


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """The complete rows with their feature vector; what becomes of the others is the caller's to say."""
    return VectorAssembler(inputCols=cols, outputCol=out).transform(df.where(complete(cols)))


def kmeans_fit(vectors: DataFrame, k: int, seed: int = 45, init: str = "k-means||",
               max_iter: int = 100, tol: float = 1e-4, features: str = "features"):
    """ML-7: fitted model (``init``: 'k-means||' or 'random')."""
    km = KMeans(k=k, seed=seed, initMode=init, maxIter=max_iter, tol=tol,
                featuresCol=features, predictionCol="cluster")
    return km.fit(vectors)


def silhouette(predictions: DataFrame, features: str = "features",
               distance: str = "squaredEuclidean") -> float:
    """ML-8: mean silhouette (MLlib's linear-cost squared-Euclidean form)."""
    ev = ClusteringEvaluator(featuresCol=features, predictionCol="cluster",
                             metricName="silhouette", distanceMeasure=distance)
    return float(ev.evaluate(predictions))


def select_k(vectors: DataFrame, ks: list[int], seed: int = 45, init: str = "k-means||",
             features: str = "features", max_iter: int = 100, parallelism: int = 4) -> tuple[DataFrame, dict]:
    """ML-9 + ML-10: ``k, silhouette, inertia, converged`` for every candidate k, and the fitted models.

    ``vectors`` should be materialised (see :func:`materialise`).  Every fit is a
    distributed MLlib job, started from all points; up to ``parallelism`` candidates run as
    concurrent jobs (as ``CrossValidator(parallelism=...)`` does).  A k that is not smaller than the number
    of points is a row of nulls, a model that leaves one cluster has no silhouette;
    ``converged`` is false where ``max_iter`` ended the fit.
    """
    from concurrent.futures import ThreadPoolExecutor
    data = vectors.select(features).persist()
    n = data.count()

    def score(k):
        if k >= n:
            return (k, None, None, None), None
        model = kmeans_fit(data, k, seed, init, features=features, max_iter=max_iter)
        summary = model.summary
        filled = sum(1 for size in summary.clusterSizes if size)
        quality = silhouette(model.transform(data), features) if filled > 1 else None
        return (k, quality, float(summary.trainingCost), summary.numIter < max_iter), model

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(ks) or 1))) as pool:
        found = list(pool.map(score, ks))
    data.unpersist()
    scores = vectors.sparkSession.createDataFrame([row for row, _ in found], "k int, silhouette double, inertia double, converged boolean")
    return scores, {row[0]: model for row, model in found if model is not None}


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the checkpoint folder and cut its lineage.

    Iterative jobs (k-means over several k) then read the saved rows instead
    of recomputing the whole upstream plan, and a lost executor does not
    force a recomputation from the raw tables.
    """
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def best_k(scores: DataFrame) -> int:
    """SRT-6 on the score table: highest silhouette, smallest k on ties."""
    row = scores.where("silhouette IS NOT NULL").agg(F.max_by("k", F.struct(F.col("silhouette"), -F.col("k"))).alias("k")).first()
    if row is None or row["k"] is None:
        raise ValueError("no k could be evaluated (too few rows)")
    return int(row["k"])


def relabel_by(pred: DataFrame, value: str, label: str = "cluster", one_based: bool = True) -> DataFrame:
    """Stable cluster ids: ordered by descending mean ``value`` (then old id)."""
    means = pred.groupBy(label).agg(F.avg(value).alias("_m"))
    ranked = means.withColumn("_new", F.row_number().over(  # k rows
        Window.orderBy(F.col("_m").desc(), F.col(label))) - (0 if one_based else 1))
    return (pred.join(F.broadcast(ranked.select(label, "_new")), label)
                .drop(label).withColumnRenamed("_new", label))


def cluster_centers(pred: DataFrame, cols: list[str], label: str = "cluster") -> DataFrame:
    """ML-11: mean of every feature per cluster."""
    return pred.groupBy(label).agg(*[F.avg(c).alias(c) for c in cols])


def one_hot(df: DataFrame, cols: list[str]) -> DataFrame:
    """ML-5: indicator columns ``<col>_<value>`` for columns whose values make sensible column names.

    The levels become the frame's columns, so they are read first; for a column of
    many values use :func:`one_hot_sparse` or :func:`one_hot_long`, which have no such list.
    """
    out = df
    for c in cols:
        levels = [r[0] for r in df.select(c).where(F.col(c).isNotNull()).distinct().orderBy(c).collect()]
        out = out.withColumns({f"{c}_{v}": (F.col(c) == F.lit(v)).cast("int") for v in levels})
    return out


def one_hot_levels(df: DataFrame, col: str) -> DataFrame:
    """``<col>, level`` numbers of the values, from 0 in the order of the values; null is no level."""
    from .ordered import ordered_prefix
    ranked = ordered_prefix(df.select(col).where(F.col(col).isNotNull()).distinct(), [F.col(col).asc()])
    return ranked.select(col, (F.col("_rownum") - 1).alias("level"))


def one_hot_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """ML-5 in long form: every row with ``feature`` (column) and ``level`` of each of its values; any number of levels."""
    parts = []
    for c in cols:
        levels = one_hot_levels(df, c)
        parts.append(df.join(levels, c).withColumn("feature", F.lit(c)).select(*df.columns, "feature", "level"))
    return reduce(DataFrame.unionByName, parts)


def one_hot_sparse(df: DataFrame, cols: list[str], out: str = "indicators") -> DataFrame:
    """ML-5 as one sparse vector per row: the columns' levels side by side, nothing for a null.

    Levels are numbered and joined, never collected; only their counts (one number per column) are.
    """
    at, found = 0, df.withColumn("_row", F.monotonically_increasing_id())
    found = materialise(found)  # the row numbers are fixed
    places = []
    for c in cols:
        levels = materialise(one_hot_levels(found, c))
        places.append(found.select("_row", c).join(levels, c).select("_row", (F.col("level") + at).cast("int").alias("at")))
        at += levels.count()
    ones = reduce(DataFrame.unionByName, places).groupBy("_row").agg(F.sort_array(F.collect_list("at")).alias("_at"))
    width = max(at, 1)

    @F.udf(VectorUDT())
    def vector(places):
        return Vectors.sparse(width, places or [], [1.0] * len(places or []))

    return found.join(ones, "_row", "left").withColumn(out, vector("_at")).drop("_row", "_at")


def feature_hash(df: DataFrame, cols: list[str], buckets: int = 10, out: str = "hashed") -> DataFrame:
    """ML-6: signed hashing of categorical columns into ``buckets`` features,
    expanded to ``<out>_<i>`` columns."""
    h = FeatureHasher(inputCols=cols, outputCol="_hv", numFeatures=buckets,
                      categoricalCols=cols).transform(df)
    arr = vector_to_array("_hv")
    return h.withColumns({f"{out}_{i}": arr[i] for i in range(buckets)}).drop("_hv")


def pca(df: DataFrame, cols: list[str], k: int) -> tuple[DataFrame, list[float]]:
    """ML-12: centred PCA -> (frame with ``pc_1..pc_k``, explained variance ratios).

    Rows without all numbers stay, with null components, and are not learnt from.
    """
    v = assemble(df, cols, "_raw")
    centred = StandardScaler(inputCol="_raw", outputCol="_c", withMean=True, withStd=False).fit(v).transform(v)
    model = PCA(k=k, inputCol="_c", outputCol="_pc").fit(centred)
    arr = vector_to_array("_pc")
    out = model.transform(centred).withColumns({f"pc_{i + 1}": arr[i] for i in range(k)}).drop("_raw", "_c", "_pc")
    rest = df.where(~complete(cols)).withColumns({f"pc_{i + 1}": F.lit(None).cast("double") for i in range(k)})
    return out.unionByName(rest), [float(x) for x in model.explainedVariance]


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """ML-13: Pearson correlation of every column pair, one aggregation."""
    pairs = [(a, b) for a in cols for b in cols]
    wide = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"c{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)])))


def segment(features: DataFrame, key: list[str], cols: list[str], ks: list[int], seed: int,
            value: str) -> tuple[DataFrame, DataFrame]:
    """Cluster rows of ``features`` on the (already scaled) ``cols``:
    k by silhouette, the best k's model, stable 1-based labels.

    Rows without all numbers are not clustered and have a null label.  Returns (assignments
    with key + cols + cluster, score table)."""
    rows = materialise(features.select(*key, *[F.col(c).cast("double").alias(c) for c in cols]))
    vectors = assemble(rows, cols)
    scores, models = select_k(vectors, ks, seed)
    pred = models[best_k(scores)].transform(vectors).drop("features")
    labelled = relabel_by(pred, value)
    rest = rows.where(~complete(cols)).withColumn("cluster", F.lit(None).cast("int"))
    return labelled.unionByName(rest), scores


# ---------------------------------------------------------------------------
# Parameter grids, neighbours and density clustering (ML-14..18, JOIN-9)
# ---------------------------------------------------------------------------

def param_grid(spark, **axes) -> DataFrame:
    """JOIN-9: every combination of the given parameter lists, as a small frame
    built on the driver from the (short) lists -- not a join."""
    import itertools
    names = list(axes)
    rows = [tuple(float(v) if isinstance(v, (int, float)) else v for v in combo)
            for combo in itertools.product(*[axes[n] for n in names])]
    return spark.createDataFrame(rows, names)


BINS = 32  # MLlib's default number of bins a feature
CELLS = 1 << 10
FOREST_COUNTS = 1 << 26
DRAW_ROWS = 1 << 18


def random_forest_regression(train: DataFrame, test: DataFrame, features: list[str], label: str,
                             trees: int = 100, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """ML-17: random forest fitted on the complete rows of ``train``; returns (test predictions, null for
    rows without all features; ``split, rmse, n, incomplete`` of both splits from one pass).

    MLlib keeps ``trees`` bootstrap counts with every row.  Beyond ``FOREST_COUNTS`` of them a forest on one or two
    features (``CELLS`` cells of bins at most) is learnt from sums by tree and cell, see :func:`forest_by_cells`.
    """
    from pyspark.ml.regression import RandomForestRegressor
    rows = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    usable = [*features, label]
    known = train.where(complete(usable))
    if BINS ** len(features) <= CELLS and (n := known.count()) * trees > FOREST_COUNTS:
        predict = forest_by_cells(known, n, features, label, trees, seed)
    else:
        rf = RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=trees, seed=seed)
        model = rf.fit(assemble(train.where(complete([label])), features))
        predict = lambda df: model.transform(assemble(df, features)).drop("features")
    e = F.col("prediction") - F.col(label)
    errors = predict(rows.where(complete([label]))).groupBy("split").agg(
        F.sqrt(F.avg(e * e)).alias("rmse"), F.count(F.lit(1)).alias("n"))
    left = rows.groupBy("split").agg(F.sum((~complete(usable)).cast("long")).alias("incomplete"))
    scores = left.join(errors, "split", "left").select("split", "rmse", F.coalesce("n", F.lit(0)).cast("long").alias("n"), "incomplete")
    rest = test.where(~complete(features)).withColumn("prediction", F.lit(None).cast("double"))
    return predict(test).unionByName(rest), scores


def bin_edges(known: DataFrame, col: str) -> list[float]:
    """Edges of ``BINS`` bins at most: midpoints of the values if they are so few, else quantiles of all rows."""
    x = known.select(F.col(col).cast("double").alias("x"))
    few = sorted(r.x for r in x.distinct().limit(BINS + 1).collect())
    if len(few) <= BINS:
        inner = [(a + b) / 2 for a, b in zip(few, few[1:])]
    else:
        inner = sorted(set(x.approxQuantile("x", [i / BINS for i in range(1, BINS)], 0.001)) - {float("-inf"), float("inf")})
    return [float("-inf"), *inner, float("inf")]


def forest_by_cells(known: DataFrame, n: int, features: list[str], label: str, trees: int, seed: int):
    """A forest learnt from what its splits can tell apart; returns a function that adds ``prediction`` to the rows with all features.

    Every row is drawn a Poisson(1) number of times for every tree, as in MLlib's bootstrap (other draws); the draws are
    summed by tree and cell of bins at once and kept nowhere.  Rows of a cell are never split, so their number and
    mean label give every split the gain that the rows give it, up to rounding.  MLlib learns each tree from its cells.
    """
    from concurrent.futures import ThreadPoolExecutor
    from itertools import product
    from statistics import fmean

    import numpy as np
    import pandas as pd
    from pyspark import TaskContext
    from pyspark.ml.feature import Bucketizer
    from pyspark.ml.regression import RandomForestRegressor

    spark = known.sparkSession
    edges = [bin_edges(known, c) for c in features]
    bins = [f"_bin{i}" for i in range(len(features))]

    def binned(df):
        """Two edges make one bin, which Bucketizer does not take."""
        df = df.where(complete(features))
        for c, at, b in zip(features, edges, bins):
            df = Bucketizer(splits=at, inputCol=c, outputCol=b).transform(df) if len(at) > 2 else df.withColumn(b, F.lit(0.0))
        return df

    width = BINS ** len(features)
    cell = sum((F.col(b) * BINS ** i for i, b in enumerate(bins)), F.lit(0.0)).cast("int")

    def draw(batches):
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        w, s = np.zeros((trees, width)), np.zeros((trees, width))
        for batch in batches:
            at, y = batch["cell"].to_numpy(), batch["y"].to_numpy()
            times = rng.poisson(1.0, (trees, len(at)))
            first = np.flatnonzero(np.diff(at, prepend=-1))
            w[:, at[first]] += np.add.reduceat(times, first, axis=1)
            s[:, at[first]] += np.add.reduceat(times * y, first, axis=1)
        tree, at = np.nonzero(w)
        yield pd.DataFrame({"tree": tree.astype(np.int32), "cell": at.astype(np.int32), "w": w[tree, at], "s": s[tree, at]})

    # sorted: a rerun draws the same rows, and the rows of a cell follow one another
    dealt = (binned(known).select(cell.alias("cell"), F.col(label).cast("double").alias("y")).repartition(-(-n // DRAW_ROWS))
             .sortWithinPartitions("cell", "y"))
    drawn = (dealt.mapInPandas(draw, "tree int, cell int, w double, s double").groupBy("tree", "cell")
             .agg(F.sum("w").alias("w"), (F.sum("s") / F.sum("w")).alias("y")))
    sums = assemble(drawn.select("tree", "w", "y", *((F.floor(F.col("cell") / BINS ** i) % BINS).cast("double").alias(b)
                                                     for i, b in enumerate(bins))).coalesce(1), bins).persist()
    grid = list(product(*[map(float, range(len(at) - 1)) for at in edges]))
    cells = assemble(spark.createDataFrame(grid, ", ".join(f"{b} double" for b in bins)).coalesce(1), bins).persist()

    def tree(t):
        one = RandomForestRegressor(featuresCol="features", labelCol="y", weightCol="w", numTrees=1, bootstrap=False,
                                    featureSubsetStrategy="onethird", seed=seed + t).fit(sums.where(F.col("tree") == t))
        return {tuple(r)[:-1]: r.prediction for r in one.transform(cells).select(*bins, "prediction").collect()}

    sums.count()
    with ThreadPoolExecutor(max_workers=8) as pool:
        found = list(pool.map(tree, range(trees)))
    sums.unpersist()
    cells.unpersist()
    mean = spark.createDataFrame([(*c, fmean(f[c] for f in found)) for c in grid],
                                 ", ".join([*(f"{b} double" for b in bins), "prediction double"]))
    return lambda df: binned(df).join(F.broadcast(mean), bins).select(*df.columns, "prediction")


def grid_search_cv(samples: DataFrame, features: list[str], label: str, fold_col: str,
                   reg_params: list[float], elastic_net: list[float],
                   intercepts: list[bool] = (True, False)) -> DataFrame:
    """ML-18: walk-forward grid search (RMSE) of a penalised linear regressor; see :mod:`gram`."""
    from . import gram
    return gram.walk_forward_grid(samples, features, label, fold_col, reg_params, elastic_net, intercepts)
