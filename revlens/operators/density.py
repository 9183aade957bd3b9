"""Density clustering and nearest-neighbour distances without all pairs (ML-14..16).

Rows with identical coordinates are one weighted point; a row with a null or
non-finite coordinate takes no part and keeps a null result.

``knn``: points are split at sketched medians of their widest dimension until a
leaf has at most ``LEAF`` points.  The k-th distance inside its leaf bounds a point's
ball; only points whose ball reaches the box of another leaf are searched again, in
those leaves, found by going down the tree of boxes with equi-joins.

``dbscan_trials``: all (eps, min_samples) are keys of one job.

* Cells have side eps/sqrt(d), so points of one cell are neighbours and a cell of
  ``min_samples`` points is all core.  Neighbours are counted only for points
  of sparser cells; a cell has fewer than ``min_samples`` of those, so the rows
  stay in proportion to the points however crowded the other cells are, and crowded
  cells are dealt in parts.
* Clusters are components of the graph of cells with core points.  Two cells are
  linked if a core point of one is within eps of one of the other; boxes of their core
  points decide it by their least and greatest distance, and only undecided
  pairs are halved, until every pair is decided.
* Components come from star contraction (large-star, small-star) on the cells.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cluster import materialise
from .ordered import ordered_prefix

LEAF = 64
PART = 4096
# a cell is a trifle smaller than eps/sqrt(d): rounding never puts far points together
SHRINK = 1 - 1e-9
MAX_HALVINGS = 40


def _finite(cols: list[str]) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & F.coalesce(F.abs(F.col(c).cast("double")) < float("inf"), F.lit(False))
    return out


def _xs(d: int, prefix: str = "x") -> list[str]:
    return [f"{prefix}{i}" for i in range(d)]


def _distance(a: str, b: str, d: int) -> Column:
    total = F.lit(0.0)
    for i in range(d):
        total = total + (F.col(f"{a}{i}") - F.col(f"{b}{i}")) * (F.col(f"{a}{i}") - F.col(f"{b}{i}"))
    return F.sqrt(total)


def collapse(df: DataFrame, id_col: str, cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """Weighted distinct points ``(pid, w, x0 ..)`` and the map ``(id, pid)``; pid is null for rows that take no part."""
    base = materialise(df.select(F.col(id_col).alias("_id"), _finite(cols).alias("_ok"),
                                 *[(F.col(c).cast("double") + 0.0).alias(x) for c, x in zip(cols, _xs(len(cols)))]))
    xs = _xs(len(cols))
    # a null id is a row like any other
    pts = base.where("_ok").groupBy(*xs).agg(F.count(F.lit(1)).alias("w"), F.min("_id").alias("_first"))
    pts = materialise(pts.withColumn("pid", F.monotonically_increasing_id()))
    ids = base.join(pts.withColumn("_ok", F.lit(True)).select("_ok", *xs, "pid"), ["_ok", *xs], "left")
    return pts, materialise(ids.select(F.col("_id").alias(id_col), "pid"))


# ---------------------------------------------------------------------------
# nearest neighbours
# ---------------------------------------------------------------------------

def _leaves(pts: DataFrame, d: int, leaf: int) -> DataFrame:
    """Points with the number of their tree node (children of ``n`` are ``2n`` and ``2n + 1``)."""
    out = materialise(pts.withColumn("node", F.lit(1).cast("long")))
    for _ in range(60):
        s = out.groupBy("node").agg(F.count(F.lit(1)).alias("n"), *[f(x).alias(f"{k}{i}") for i, x in enumerate(_xs(d)) for k, f in (
            ("lo", F.min), ("hi", F.max), ("mid", lambda x: F.percentile_approx(x, 0.5, 1000)))]).where(F.col("n") > leaf)
        s = materialise(s)
        if s.limit(1).count() == 0:
            break
        widest = F.greatest(*[F.col(f"hi{i}") - F.col(f"lo{i}") for i in range(d)]) if d > 1 else F.col("hi0") - F.col("lo0")
        pick = lambda k: F.coalesce(*[F.when(F.col(f"hi{i}") - F.col(f"lo{i}") == widest, F.col(f"{k}{i}")) for i in range(d)])
        axis = F.coalesce(*[F.when(F.col(f"hi{i}") - F.col(f"lo{i}") == widest, F.lit(i)) for i in range(d)])
        rule = s.select("node", axis.alias("axis"), pick("mid").alias("at"), (pick("mid") < pick("hi")).alias("above"))
        x = F.coalesce(*[F.when(F.col("axis") == i, F.col(f"x{i}")) for i in range(d)])
        right = F.when(F.col("above"), x > F.col("at")).otherwise(x >= F.col("at"))
        node = F.when(F.col("axis").isNull(), F.col("node")).otherwise(2 * F.col("node") + right.cast("long"))
        out = materialise(out.join(rule, "node", "left").select(*pts.columns, node.alias("node")))
    return out


def _within(probes: DataFrame, pts: DataFrame, d: int, k: int) -> DataFrame:
    """For ``probes(a, a0 .., node)`` the nearest points of their nodes up to weight k: ``a, dist, w, upto``."""
    b = pts.select("node", F.col("pid").alias("b"), "w", *[F.col(f"x{i}").alias(f"b{i}") for i in range(d)])
    pairs = probes.join(b, "node").select("a", "b", "w", _distance("a", "b", d).alias("dist"))
    upto = F.sum("w").over(Window.partitionBy("a").orderBy("dist", "b").rowsBetween(Window.unboundedPreceding, 0))
    return pairs.withColumn("upto", upto).where(F.col("upto") - F.col("w") < k).drop("b")


def _box_gap(d: int) -> Column:
    total = F.lit(0.0)
    for i in range(d):
        g = F.greatest(F.col(f"lo{i}") - F.col(f"a{i}"), F.col(f"a{i}") - F.col(f"hi{i}"), F.lit(0.0))
        total = total + g * g
    return F.sqrt(total)


def knn(df: DataFrame, id_col: str, cols: list[str], k: int = 3, leaf: int = LEAF) -> DataFrame:
    """ML-14: ``id, rank, dist`` for ranks 1 to k (rank 1 is the row itself or its twin), exact.

    Rows of equal coordinates take as many ranks as there are of them.  ``dist`` is null
    for ranks that do not exist and for rows that take no part.
    """
    d = len(cols)
    pts, ids = collapse(df, id_col, cols)
    pts = _leaves(pts.drop("_first"), d, max(leaf, 2 * k))
    probe = pts.select(F.col("pid").alias("a"), "node", *[F.col(f"x{i}").alias(f"a{i}") for i in range(d)])
    own = materialise(_within(probe, pts, d, k))
    bound = own.groupBy("a").agg(F.max("dist").alias("far"), F.max("upto").alias("_n"))
    bound = bound.select("a", F.when(F.col("_n") >= k, F.col("far")).otherwise(float("inf")).alias("r"))
    # boxes of all nodes, from the leaves up
    box = pts.groupBy("node").agg(*[f(f"x{i}").alias(f"{n}{i}") for i in range(d) for n, f in (("lo", F.min), ("hi", F.max))])
    depth = int(box.agg(F.max(F.length(F.bin("node")) - 1)).first()[0] or 0)
    up = box.select("*", F.explode(F.sequence(F.lit(0), F.length(F.bin("node")) - 1)).alias("_up"))
    tree = materialise(up.groupBy(F.expr("shiftright(node, _up)").alias("node")).agg(
        F.min("_up").alias("_height"), *[f(f"{n}{i}").alias(f"{n}{i}") for i in range(d) for n, f in (("lo", F.min), ("hi", F.max))]))
    todo = probe.withColumnRenamed("node", "own").join(bound, "a").withColumn("node", F.lit(1).cast("long"))
    todo = todo.withColumn("_height", F.lit(min(1, depth)))
    arrived = todo.where("_height = 0").drop("_height")
    children = tree.where("node > 1").withColumn("parent", F.expr("shiftright(node, 1)"))
    for _ in range(depth):
        step = (todo.where("_height > 0").withColumnRenamed("node", "parent").drop("_height").join(children, "parent")
                .where(_box_gap(d) <= F.col("r")).select("a", *[f"a{i}" for i in range(d)], "own", "r", "node", "_height"))
        todo = materialise(step)
        arrived = arrived.unionByName(todo.where("_height = 0").drop("_height"))
    again = materialise(arrived)
    reached = materialise(again.where("node != own").select("a").distinct())
    rest = _within(again.join(reached, "a", "left_semi").select("a", "node", *[f"a{i}" for i in range(d)]), pts, d, k)
    near = own.join(reached, "a", "left_anti").unionByName(rest)
    ranks = near.select(F.col("a").alias("pid"), "dist", F.explode(F.sequence(
        F.col("upto") - F.col("w") + 1, F.least("upto", F.lit(k).cast("long")))).alias("rank"))
    asked = ids.select(id_col, "pid", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(k).cast("long"))).alias("rank"))
    return asked.join(ranks, ["pid", "rank"], "left").select(id_col, F.col("rank").cast("int").alias("rank"), "dist")


def knn_curve(distances: DataFrame, id_col: str, k: int) -> DataFrame:
    """The k-distance plot's table: ``position`` (1-based) of every id by its k-th distance, nulls left out."""
    kth = distances.where((F.col("rank") == k) & F.col("dist").isNotNull()).select(id_col, F.col("dist").alias("kdist"))
    ranked = ordered_prefix(kth, [F.col("kdist").asc(), F.col(id_col).asc_nulls_first()])
    return ranked.select(F.col("_rownum").alias("position"), id_col, "kdist")


# ---------------------------------------------------------------------------
# density clustering
# ---------------------------------------------------------------------------

def components(links: DataFrame, key: str) -> DataFrame:
    """``(key, node, label)`` of every node in ``links(key, u, v)``: the smallest node it is linked with.

    Large-star and small-star steps in turn, each written, until one changes nothing.
    """
    e = materialise(links.where("u != v").select(key, F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())

    def mark(x):
        return tuple(x.agg(F.count(F.lit(1)), F.sum(F.xxhash64(key, "u", "v").cast("decimal(38,0)"))).first())

    before = mark(e)
    while before[0]:
        both = e.unionByName(e.select(key, F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(key, "u").agg(F.min("v").alias("m")).select(key, "u", F.least("u", "m").alias("m"))
        large = both.join(least, [key, "u"]).where("v > u").select(key, F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = large.groupBy(key, "u").agg(F.min("v").alias("m"))
        small = large.join(least, [key, "u"]).select(
            key, F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        e = materialise(small)
        now = mark(e)
        if now == before:
            break
        before = now
    roots = e.select(key, F.col("v").alias("node"), F.col("v").alias("label"))
    return e.select(key, F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots).distinct()


def _box_distances(d: int) -> tuple[Column, Column]:
    """Least and greatest distance between the boxes ``alo, ahi`` and ``blo, bhi``."""
    low, high = F.lit(0.0), F.lit(0.0)
    for i in range(d):
        g = F.greatest(F.col(f"alo{i}") - F.col(f"bhi{i}"), F.col(f"blo{i}") - F.col(f"ahi{i}"), F.lit(0.0))
        s = F.greatest(F.col(f"ahi{i}") - F.col(f"blo{i}"), F.col(f"bhi{i}") - F.col(f"alo{i}"))
        low, high = low + g * g, high + s * s
    return F.sqrt(low), F.sqrt(high)


def _boxes(points: DataFrame, by: list[str], d: int) -> DataFrame:
    return points.groupBy(*by).agg(*[f(f"x{i}").alias(f"{n}{i}") for i in range(d) for n, f in (("lo", F.min), ("hi", F.max))])


def _side(frame: DataFrame, side: str, d: int, names: dict[str, str]) -> DataFrame:
    return frame.select("t", *[F.col(a).alias(b) for a, b in names.items()],
                        *[F.col(f"{n}{i}").alias(f"{side}{n}{i}") for i in range(d) for n in ("lo", "hi")])


def _cell_links(core: DataFrame, near: DataFrame, trials: DataFrame, d: int) -> DataFrame:
    """``(t, u, v)``: cells (by their smallest core point) with core points within eps of each other."""
    cells = materialise(_boxes(core, ["t", "e", "cell"], d).join(core.groupBy("t", "cell").agg(F.min("pid").alias("node")), ["t", "cell"]))
    eps = trials.select("t", "eps")
    left = _side(cells, "a", d, {"e": "e", "cell": "cell", "node": "u"})
    right = _side(cells, "b", d, {"cell": "cell_b", "node": "v"})
    pairs = near.join(left, ["e", "cell"]).join(right, ["t", "cell_b"]).where("u < v").join(eps, "t")
    low, high = _box_distances(d)
    state = F.when(high <= F.col("eps"), "linked").when(low <= F.col("eps"), "open").otherwise("apart")
    pairs = materialise(pairs.withColumn("state", state).where("state != 'apart'").select("t", "eps", "cell", "cell_b", "u", "v", "state"))
    links = pairs.where("state = 'linked'").select("t", "u", "v")
    start = F.array(*[F.lit(None).cast("long")] * 0).cast("array<long>")
    todo = pairs.where("state = 'open'").drop("state").withColumn("pa", start).withColumn("pb", start)
    for level in range(1, MAX_HALVINGS + 1):
        if todo.limit(1).count() == 0:
            return links.distinct()
        wanted = todo.select("t", "cell").unionByName(todo.select("t", F.col("cell_b").alias("cell"))).distinct()
        part = F.array(*[F.floor(F.col(f"u{i}") * float(2**level)).cast("long") for i in range(d)])
        parent = F.array(*[F.shiftright(F.floor(F.col(f"u{i}") * float(2**level)).cast("long"), 1) for i in range(d)]) if level > 1 else start
        pieces = _boxes(core.join(wanted, ["t", "cell"], "left_semi").withColumn("part", part).withColumn("parent", parent),
                        ["t", "cell", "part", "parent"], d)
        a = _side(pieces, "a", d, {"cell": "cell", "part": "na", "parent": "pa"})
        b = _side(pieces, "b", d, {"cell": "cell_b", "part": "nb", "parent": "pb"})
        next_ = todo.join(a, ["t", "cell", "pa"]).join(b, ["t", "cell_b", "pb"]).withColumn("state", state).where("state != 'apart'")
        # one linked piece decides its pair of cells
        done = F.max((F.col("state") == "linked").cast("int")).over(Window.partitionBy("t", "u", "v"))
        next_ = materialise(next_.select("t", "eps", "cell", "cell_b", "u", "v", F.col("na").alias("pa"), F.col("nb").alias("pb"), done.alias("done")))
        links = links.unionByName(next_.where("done = 1").select("t", "u", "v").distinct())
        todo = next_.where("done = 0").drop("done")
    # what is still open are points closer together than halving can tell: compare them one by one
    part = F.array(*[F.floor(F.col(f"u{i}") * float(2**MAX_HALVINGS)).cast("long") for i in range(d)])
    at = core.withColumn("part", part)
    a = at.select("t", "cell", F.col("part").alias("pa"), *[F.col(f"x{i}").alias(f"a{i}") for i in range(d)])
    b = at.select("t", F.col("cell").alias("cell_b"), F.col("part").alias("pb"), *[F.col(f"x{i}").alias(f"b{i}") for i in range(d)])
    exact = todo.join(a, ["t", "cell", "pa"]).join(b, ["t", "cell_b", "pb"]).where(_distance("a", "b", d) <= F.col("eps"))
    return links.unionByName(exact.select("t", "u", "v")).distinct()


def dbscan_trials(df: DataFrame, id_col: str, cols: list[str], trials: list[tuple[float, int]]) -> tuple[DataFrame, DataFrame]:
    """ML-15 for every (eps, min_samples): ``(points, labels)``, both written.

    ``points`` is ``(id, pid)``; ``labels`` is ``(t, pid, w, x0 .., cluster)`` with
    ``t`` the trial's place in the list.  A core point has at least ``min_samples`` rows
    within eps (itself included).  Clusters are numbered 0, 1, ... by
    their core point with the smallest id; a border point joins the lowest number
    among its core neighbours; noise is -1.
    """
    d = len(cols)
    spark = df.sparkSession
    pts, ids = collapse(df, id_col, cols)
    # points are numbered in the order of their smallest id
    pts = ordered_prefix(pts, [F.col("_first").asc_nulls_first(), F.col("pid").asc()]).withColumnRenamed("_rownum", "no")
    pts = materialise(pts.drop("_n", "_first"))
    ids = materialise(ids.join(pts.select("pid", "no"), "pid", "left").select(id_col, F.col("no").alias("pid")))
    pts = pts.drop("pid").withColumnRenamed("no", "pid")
    radii = sorted({float(e) for e, _ in trials})
    most = max(int(m) for _, m in trials)
    asked = spark.createDataFrame([(i, radii.index(float(e)), float(e), int(m)) for i, (e, m) in enumerate(trials)],
                                  "t int, e int, eps double, ms int")
    side = [e / math.sqrt(d) * SHRINK for e in radii]
    at = pts.select("*", F.explode(F.array(*[F.struct(F.lit(i).alias("e"), F.lit(e).alias("eps"), F.lit(s).alias("side"))
                                             for i, (e, s) in enumerate(zip(radii, side))])).alias("_e")).select("*", "_e.*").drop("_e")
    # coordinates in cells, so that halving a cell is exact
    at = at.select("*", *[(F.col(f"x{i}") / F.col("side")).alias(f"u{i}") for i in range(d)])
    at = at.withColumn("cell", F.array(*[F.floor(f"u{i}").cast("long") for i in range(d)]))
    cells = materialise(at.groupBy("e", "cell").agg(F.sum("w").alias("n"), F.count(F.lit(1)).alias("m"))
                        .withColumn("parts", F.ceil(F.col("m") / PART).cast("int")))
    at = materialise(at.join(cells.select("e", "cell", "n", "parts"), ["e", "cell"])
                     .withColumn("part", F.expr("CAST(pmod(xxhash64(pid), parts) AS INT)")))
    reach = math.ceil(math.sqrt(d))
    offsets = [o for o in itertools.product(range(-reach, reach + 1), repeat=d)
               if any(o) and sum(max(abs(v) - 1, 0) ** 2 for v in o) <= d]
    steps = ", ".join(f"array({', '.join(f'{v}L' for v in o)})" for o in offsets)
    shifted = F.expr(f"explode(transform(array({steps}), o -> zip_with(cell, o, (a, b) -> a + b)))")
    near = materialise(cells.select("e", "cell", shifted.alias("cell_b"))
                       .join(cells.select("e", F.col("cell").alias("cell_b"), F.col("n").alias("n_b"), F.col("parts").alias("parts_b")), ["e", "cell_b"]))
    # rows within eps of the points of sparse cells: by cell where the cell is all core, by point elsewhere
    probes = (at.where(F.col("n") < most).select("e", "cell", "eps", F.col("pid").alias("a"), *[F.col(f"x{i}").alias(f"a{i}") for i in range(d)])
              .join(near, ["e", "cell"]).select("*", F.explode(F.sequence(F.lit(0), F.col("parts_b") - 1)).alias("part")).drop("cell"))
    b = at.select("e", F.col("cell").alias("cell_b"), "part", F.col("pid").alias("b"), "w", *[F.col(f"x{i}").alias(f"b{i}") for i in range(d)])
    met = probes.join(b, ["e", "cell_b", "part"]).where(_distance("a", "b", d) <= F.col("eps"))
    met = materialise(met.groupBy("e", "a", "cell_b", F.when(F.col("n_b") < most, F.col("b")).alias("b")).agg(F.sum("w").alias("w")))
    counts = met.groupBy("e", F.col("a").alias("pid")).agg(F.sum("w").alias("_near"))
    total = F.col("n") + F.coalesce("_near", F.lit(0))
    at = materialise(at.join(counts, ["e", "pid"], "left").withColumn("total", total).drop("_near", "part", "parts", "n", "side", "eps"))
    by_trial = at.join(F.broadcast(asked), "e")  # bounded by the list of trials
    core = materialise(by_trial.where("total >= ms").select("t", "e", "cell", "pid", *_xs(d), *_xs(d, "u")))
    links = _cell_links(core, near.select("e", "cell", "cell_b"), asked, d)
    nodes = core.groupBy("t", "cell").agg(F.min("pid").alias("node"))
    labels = nodes.join(components(links, "t"), ["t", "node"], "left").select("t", "cell", F.coalesce("label", "node").alias("label"))
    labels = materialise(labels)
    of_core = core.join(labels, ["t", "cell"]).select("t", "pid", "label")
    loose = by_trial.where("total < ms").select("t", "e", "cell", "pid", "ms")
    own = loose.join(labels, ["t", "cell"]).select("t", "pid", "label")
    totals = at.select("e", F.col("pid").alias("b"), F.col("total").alias("total_b"))
    # a point without a number of its own stands for a cell that is all core
    met = met.join(totals, ["e", "b"], "left").withColumn("total_b", F.coalesce("total_b", F.lit(most)))
    other = (loose.select("t", "e", "ms", F.col("pid").alias("a")).join(met.select("e", "a", "cell_b", "total_b"), ["e", "a"])
             .where("total_b >= ms").join(labels.withColumnRenamed("cell", "cell_b"), ["t", "cell_b"]).select("t", F.col("a").alias("pid"), "label"))
    border = own.unionByName(other).groupBy("t", "pid").agg(F.min("label").alias("label"))
    found = of_core.unionByName(border)
    numbers = ordered_prefix(labels.select("t", "label").distinct(), [F.col("label").asc()], group_col="t")
    numbers = numbers.select("t", "label", (F.col("_rownum") - 1).alias("cluster"))
    everyone = by_trial.select("t", "pid", "w", *_xs(d))
    out = everyone.join(found.join(numbers, ["t", "label"]).select("t", "pid", "cluster"), ["t", "pid"], "left")
    return ids, materialise(out.withColumn("cluster", F.coalesce("cluster", F.lit(-1).cast("long"))))


def dbscan(df: DataFrame, id_col: str, cols: list[str], eps: float, min_samples: int) -> DataFrame:
    """ML-15: ``id, cluster``; null for rows that take no part."""
    ids, labels = dbscan_trials(df, id_col, cols, [(eps, min_samples)])
    return ids.join(labels.select("pid", "cluster"), "pid", "left").select(id_col, "cluster")


def silhouettes(labels: DataFrame, d: int, max_clusters: int) -> DataFrame:
    """``t, clusters, noise, score`` of every trial: mean silhouette by squared distance, noise a cluster of its own.

    The mean squared distance to a cluster follows from its count, sum and squared
    norms, so a row meets the at most ``max_clusters + 1`` sums of its trial, not other
    rows.  Trials with more clusters, or with one label only, have no score.
    """
    norm = sum((F.col(f"x{i}") * F.col(f"x{i}") for i in range(1, d)), F.col("x0") * F.col("x0"))
    sums = labels.groupBy("t", "cluster").agg(F.sum("w").alias("n"), F.sum(F.col("w") * norm).alias("q"),
                                              *[F.sum(F.col("w") * F.col(f"x{i}")).alias(f"s{i}") for i in range(d)])
    sums = materialise(sums)
    sizes = sums.groupBy("t").agg(F.sum((F.col("cluster") >= 0).cast("long")).alias("clusters"), F.count(F.lit(1)).alias("_labels"),
                                  F.sum(F.when(F.col("cluster") < 0, F.col("n")).otherwise(0)).alias("noise"))
    fit = sizes.where((F.col("_labels") > 1) & (F.col("clusters") <= max_clusters)).select("t")
    # bounded by trials times clusters
    table = sums.join(fit, "t").groupBy("t").agg(F.collect_list(F.struct("cluster", "n", "q", *[f"s{i}" for i in range(d)])).alias("_all"))
    rows = labels.join(F.broadcast(table), "t").withColumn("_norm", norm)
    dots = " + ".join(f"x{i} * c.s{i}" for i in range(d))
    rows = rows.withColumn("_far", F.expr(f"transform(_all, c -> struct(c.cluster AS cluster, c.n AS n, _norm + c.q / c.n - 2 * ({dots}) / c.n AS m))"))
    rows = rows.withColumn("_own", F.expr("filter(_far, c -> c.cluster = cluster)[0]"))
    rows = rows.withColumn("_b", F.expr("array_min(transform(filter(_far, c -> c.cluster != _own.cluster), c -> c.m))"))
    rows = rows.withColumn("_a", F.expr("IF(_own.n > 1, _own.m * _own.n / (_own.n - 1), NULL)"))
    s = F.when(F.col("_a").isNull() | (F.greatest("_a", "_b") == 0), 0.0).otherwise((F.col("_b") - F.col("_a")) / F.greatest("_a", "_b"))
    score = rows.groupBy("t").agg((F.sum(F.col("w") * s) / F.sum("w")).alias("score"))
    return sizes.join(score, "t", "left").select("t", "clusters", "noise", "score")


def dbscan_search(df: DataFrame, id_col: str, cols: list[str], eps_values: list[float], min_samples_values: list[int],
                  min_clusters: int = 2, max_clusters: int = 50) -> tuple[DataFrame, DataFrame]:
    """ML-16: ``(scores, labels)`` of the grid.

    ``scores``: ``eps, min_samples, clusters, noise, score, rank``, one row per trial; a trial with fewer than
    ``min_clusters`` or more than ``max_clusters`` clusters, or a single label, scores -10; scores are rounded to nine decimals, so equal labels score alike; rank 1 is the best
    (ties: smaller eps, then fewer samples).  ``labels``: ``eps, min_samples, id, cluster`` of every trial.
    """
    trials = [(float(e), int(m)) for e in eps_values for m in min_samples_values]
    ids, labels = dbscan_trials(df, id_col, cols, trials)
    asked = df.sparkSession.createDataFrame([(i, e, m) for i, (e, m) in enumerate(trials)], "t int, eps double, min_samples int")
    s = asked.join(silhouettes(labels, len(cols), max_clusters), "t", "left")
    ok = (F.col("clusters") >= min_clusters) & F.col("score").isNotNull()
    s = s.select("t", "eps", "min_samples", F.coalesce("clusters", F.lit(0)).cast("int").alias("clusters"),
                 F.coalesce("noise", F.lit(0)).cast("int").alias("noise"), F.when(ok, F.round("score", 9)).otherwise(-10.0).alias("score"))
    rank = F.row_number().over(Window.orderBy(F.desc("score"), "eps", "min_samples"))  # one row per trial of the grid
    scores = materialise(s.withColumn("rank", rank))
    every = asked.join(labels.select("t", "pid", "cluster"), "t")
    return scores.drop("t"), ids.join(every, "pid").select("eps", "min_samples", id_col, "cluster")


def best_trials(scores: DataFrame, n: int = 10) -> DataFrame:
    """The n best trials of a search."""
    return scores.where(F.col("rank") <= n)


def best_labels(scores: DataFrame, labels: DataFrame) -> DataFrame:
    """The labels of the best trial."""
    return labels.join(F.broadcast(scores.where("rank = 1").select("eps", "min_samples")), ["eps", "min_samples"])
