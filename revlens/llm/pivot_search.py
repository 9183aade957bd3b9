"""Exact top-k by integer inner product with a pivot-distance index.

Vectors are lengthened by one component so that all have the norm of the longest
one; a query gets a zero there.  Then ``distance**2 = |q|**2 + M**2 - 2 * score``:
the highest scores are the nearest vectors.  Every vector is keyed by its nearest
pivot and its distance to it, ranges of that key are sorted, and each range is
cut into blocks of at most ``BLOCK`` vectors of one pivot: sorted annuli.

A query starts with the k-th best score inside the block it lies in, which
bounds its radius.  The annuli are then visited in rings: a block is reached
when the triangle inequality allows a vector of it within the radius, first
within half of the starting radius, then, with the k-th best score found by
then, as far as the radius says.  What is not reached cannot hold a better vector
nor an equal one.  Queries travel in packs of at most ``PACK`` neighbours; packs
meet blocks by pivot and band of distance, so nothing that grows with the
table is broadcast, and a hot pivot is as many blocks as its vectors need.

The pivots (``PIVOTS`` k-means centres) are learnt on at most ``SAMPLE`` vectors by
hash order; they decide the cost alone.  The bounds allow for rounding of the
distances; scores are exact integers.

Defined results: vectors that are null or hold a null or non-finite component
take no part; shorter vectors count as filled up with zeros; a component
of 2**28 or more in size after scaling is an error (scores would leave 64 bits).
Every query row is a query of its own, and a repeated id is a candidate
for its twin; a null id is no query, and as a candidate it comes after equal
scores with ids.  Ties go to the smaller id; other columns are not read; an empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ._stage import stage

PIVOTS = 32
SAMPLE = 4096
BLOCK = 2048
PACK = 256
BANDS = 64
LARGEST = 1 << 28


def integer_vectors(df: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """``vec_id, is_query, v``: ``floor(scale * x)`` of every component, only of vectors that take part."""
    d = df.select(F.col(id_col).cast("long").alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("is_query"),
                  F.col(vec_col).cast("array<double>").alias("x"))
    d = d.where("x IS NOT NULL AND forall(x, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('Infinity'))")
    big = F.expr(f"exists(x, c -> abs({scale} * c) >= {LARGEST})")
    v = F.when(big, F.raise_error(F.lit(f"a scaled component of {LARGEST} or more"))).otherwise(
        F.expr(f"transform(x, c -> CAST(floor({scale} * c) AS INT))"))
    return d.select("vec_id", "is_query", v.alias("v"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column, filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    off = column.offsets.to_numpy()
    out = np.zeros((len(column), dim), np.float64)
    n = np.diff(off)
    row = np.repeat(np.arange(len(column)), n)
    out[row, np.arange(len(row)) - np.repeat(off[:-1] - off[0], n)] = column.values.to_numpy()[off[0]:off[-1]]
    return out


def _packed(a: np.ndarray) -> np.ndarray:
    return a.astype("<i4").tobytes()


def _unpacked(data, dim: int) -> np.ndarray:
    a = np.frombuffer(data, "<i4")
    return a.reshape(-1, dim).astype(np.float64) if dim else np.zeros((0, 0))


def scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products; in floating point only where it has room for every sum."""
    most = np.abs(q).max(initial=0) * np.abs(v).max(initial=0) * max(1, q.shape[1])
    if most < 2.0**53:
        return (q @ v.T).astype(np.int64)
    return q.astype(np.int64) @ v.astype(np.int64).T


def _distances(norm2: np.ndarray, last: np.ndarray, x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distance of each lengthened row ``(x, last)`` with squared norm ``norm2`` to each pivot."""
    dim = x.shape[1]
    dots = x @ pivots[:, :dim].T + last[:, None] * pivots[None, :, dim]
    return np.sqrt(np.maximum(0.0, norm2[:, None] + (pivots**2).sum(1)[None] - 2 * dots))


def learn_pivots(x: np.ndarray, n_pivots: int) -> np.ndarray:
    """k-means centres of lengthened vectors, started with farthest points."""
    x = np.unique(x, axis=0)
    at = [0]
    near = ((x - x[0]) ** 2).sum(1)
    while len(at) < min(n_pivots, len(x)):
        at.append(int(near.argmax()))
        near = np.minimum(near, ((x - x[at[-1]]) ** 2).sum(1))
    centres = x[at].astype(np.float64)
    for _ in range(10):
        d = (x**2).sum(1)[:, None] + (centres**2).sum(1)[None] - 2 * x @ centres.T
        own = d.argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


class Space:
    """Pivots and sizes that every task needs (a few kilobytes)."""

    def __init__(self, dim: int, norm2: float, pivots: np.ndarray, k: int):
        self.dim, self.norm2, self.pivots, self.k = dim, norm2, pivots, k
        # far above the rounding of a distance, far below any gap that matters
        self.slack = 1e-6 * (1.0 + np.sqrt(norm2))
        self.width = max(1.0, 2 * np.sqrt(norm2)) / BANDS

    def of_vectors(self, x: np.ndarray) -> np.ndarray:
        own = (x**2).sum(1)
        return _distances(np.full(len(x), self.norm2), np.sqrt(np.maximum(0.0, self.norm2 - own)), x, self.pivots)

    def of_queries(self, q: np.ndarray) -> np.ndarray:
        return _distances((q**2).sum(1), np.zeros(len(q)), q, self.pivots)

    def radius(self, q: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Distance that a score of at least ``least`` cannot exceed; infinite where fewer than k are known."""
        r = np.sqrt(np.maximum(0.0, (q**2).sum(1) + self.norm2 - 2 * least.astype(np.float64))) + self.slack
        return np.where(least == np.iinfo(np.int64).min, np.inf, r)


def build_space(vectors: DataFrame, k: int, n_pivots: int = PIVOTS, sample: int = SAMPLE) -> Space | None:
    """Sizes over all vectors, pivots from a sample bounded by ``sample`` rows; None for an empty table."""
    n, dim, norm2 = vectors.agg(F.count("*"), F.max(F.size("v")),
                                F.max(F.expr("aggregate(v, 0L, (s, c) -> s + CAST(c AS BIGINT) * c)"))).first()
    if not n:
        return None
    rows = vectors.select(F.xxhash64("v").alias("h"), "v").orderBy("h", "v").limit(sample).collect()
    x = np.zeros((len(rows), dim))
    for i, r in enumerate(rows):
        x[i, :len(r.v)] = r.v
    full = np.concatenate([x, np.sqrt(np.maximum(0.0, norm2 - (x**2).sum(1)))[:, None]], axis=1)
    return Space(dim, float(norm2), learn_pivots(full, n_pivots), k)


def build_index(vectors: DataFrame, space: Space, block: int = BLOCK) -> DataFrame:
    """The written blocks ``block, pivot, near, far, n, ids, no_id, asks, least, vecs``.

    ``least`` has, for each row that is a query, the k-th best score of its block.
    """
    def key(batches):
        for b in batches:
            x = _matrix(b.column("v"), space.dim)
            d = space.of_vectors(x)
            pivot = d.argmin(1) if len(x) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("is_query"), pa.array(pivot, pa.int32()), pa.array(d[np.arange(len(x)), pivot]),
                 pa.array([_packed(r) for r in x], pa.binary())], ["vec_id", "is_query", "pivot", "dist", "v"])

    keyed = vectors.mapInArrow(key, "vec_id long, is_query boolean, pivot int, dist double, v binary")
    order = ["pivot", "dist", "vec_id"]
    ranges = keyed.repartitionByRange(*order).sortWithinPartitions(*order)

    def cut(batches):
        task, made, held = TaskContext.get().partitionId(), 0, []

        def finished():
            nonlocal made, held
            ids, asks, pivot, dist, vecs = (np.concatenate([h[i] for h in held]) for i in range(5))
            no_id = np.array([i is None for i in ids], bool)
            x = _unpacked(b"".join(vecs), space.dim) if space.dim else np.zeros((len(ids), 0))
            least = np.full(len(ids), np.iinfo(np.int64).min)
            at = np.flatnonzero(asks.astype(bool))
            if len(at) and len(ids) > space.k:
                own = scores(x[at], x)
                own[np.arange(len(at)), at] = np.iinfo(np.int64).min
                least[at] = np.partition(own, len(ids) - space.k, axis=1)[:, len(ids) - space.k]
            row = [(task << 32) + made, int(pivot[0]), float(dist.min()), float(dist.max()), len(ids),
                   np.where(no_id, 0, ids).astype("<i8").tobytes(), no_id.tobytes(), asks.astype(bool).tobytes(),
                   least.astype("<i8").tobytes(), _packed(x)]
            made, held = made + 1, []
            return pa.RecordBatch.from_pylist([dict(zip(_BLOCK_SCHEMA.names, row))], _BLOCK_SCHEMA)

        n, last = 0, None
        for b in batches:
            cols = [np.array(b.column(c).to_pylist(), object) if c in ("vec_id", "v") else b.column(c).to_numpy(zero_copy_only=False)
                    for c in ("vec_id", "is_query", "pivot", "dist", "v")]
            lo = 0
            while lo < b.num_rows:
                if held and (cols[2][lo] != last or n >= block):
                    yield finished()
                    n = 0
                last = cols[2][lo]
                other = np.flatnonzero(cols[2][lo:] != last)
                hi = min(lo + block - n, lo + int(other[0]) if len(other) else b.num_rows)
                held.append([c[lo:hi] for c in cols])
                n += hi - lo
                lo = hi
        if held:
            yield finished()

    return stage(ranges.mapInArrow(cut, _BLOCK_SQL), "pivot-blocks")


_BLOCK_SCHEMA = pa.schema([("block", pa.int64()), ("pivot", pa.int32()), ("near", pa.float64()), ("far", pa.float64()), ("n", pa.int64()),
                           ("ids", pa.binary()), ("no_id", pa.binary()), ("asks", pa.binary()), ("least", pa.binary()), ("vecs", pa.binary())])
_BLOCK_SQL = ("block long, pivot int, near double, far double, n long, ids binary, no_id binary, asks binary, least binary, vecs binary")
_QUERY_SQL = "block long, at int, query_id long, pivot int, near double, least long, reached double, v binary"


def query_rows(index: DataFrame, space: Space) -> DataFrame:
    """One row per query: its place, its vector and the k-th best score of its block."""
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                asks = np.frombuffer(r["asks"], bool)
                at = np.flatnonzero(asks)
                if not len(at):
                    continue
                ids, least = (np.frombuffer(r[c], "<i8")[at] for c in ("ids", "least"))
                x = _unpacked(r["vecs"], space.dim)[at] if space.dim else np.zeros((len(at), 0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), r["block"])), pa.array(at, pa.int32()), pa.array(ids), pa.array(np.full(len(at), r["pivot"]), pa.int32()),
                     pa.array(np.full(len(at), r["near"])), pa.array(least), pa.array(np.full(len(at), -1.0)),
                     pa.array([_packed(v) for v in x], pa.binary())],
                    ["block", "at", "query_id", "pivot", "near", "least", "reached", "v"])

    return index.where("n > 0").select("block", "pivot", "near", "ids", "asks", "least", "vecs").mapInArrow(run, _QUERY_SQL)


_PACK_SCHEMA = pa.schema([("pack", pa.int64()), ("home", pa.binary()), ("at", pa.binary()), ("query_ids", pa.binary()), ("least", pa.binary()),
                          ("reached", pa.binary()), ("limit", pa.binary()), ("vecs", pa.binary()),
                          ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64()))])
_PACK_SQL = ("pack long, home binary, at binary, query_ids binary, least binary, reached binary, limit binary, vecs binary, "
             "low array<double>, high array<double>")


def _packs(queries: DataFrame, space: Space, share: float, pack: int) -> DataFrame:
    """Packs of neighbouring queries with the interval of distances to each pivot that they reach this time."""
    order = ["pivot", "near", "block", "at"]

    def run(batches):
        task, made = TaskContext.get().partitionId(), 0
        for b in batches:
            for lo in range(0, b.num_rows, pack):
                p = b.slice(lo, pack)
                home, at, ids, least, reached = (p.column(c).to_numpy() for c in ("block", "at", "query_id", "least", "reached"))
                q = _unpacked(b"".join(p.column("v").to_pylist()), space.dim) if space.dim else np.zeros((p.num_rows, 0))
                r = space.radius(q, least)
                limit = np.where(np.isinf(r), r, r * share)
                go = limit > reached
                d, near, far = space.of_queries(q), limit[:, None], limit[:, None]
                low = np.where(go[:, None], np.maximum(0.0, d - near), np.inf).min(0)
                high = np.where(go[:, None], np.minimum(d + far, 1e300), -np.inf).max(0)
                if not go.any():
                    continue
                row = [(task << 32) + made, home.astype("<i8").tobytes(), at.astype("<i8").tobytes(), ids.astype("<i8").tobytes(),
                       least.astype("<i8").tobytes(), reached.astype("<f8").tobytes(), limit.astype("<f8").tobytes(), _packed(q),
                       low.tolist(), high.tolist()]
                made += 1
                yield pa.RecordBatch.from_pylist([dict(zip(_PACK_SCHEMA.names, row))], _PACK_SCHEMA)

    return stage(queries.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, _PACK_SQL), "query-packs")


def _visit(index: DataFrame, packs: DataFrame, space: Space) -> DataFrame:
    """The at most k best rows of every (query, block) reached: ``block, at, query_id, vec_id, score``."""
    band = lambda c: F.least(F.lit(BANDS), F.floor(F.col(c) / space.width)).cast("int")
    routes = (packs.select("pack", F.posexplode(F.arrays_zip("low", "high")).alias("pivot", "reach"))
              .select("pack", "pivot", "reach.low", "reach.high").where("low <= high")
              .select("pack", "pivot", "low", "high", band("low").alias("q_first"), F.explode(F.sequence(band("low"), band("high"))).alias("band")))
    meta = (index.select("block", "pivot", "near", "far", band("near").alias("b_first"), F.explode(F.sequence(band("near"), band("far"))).alias("band")))
    pairs = (routes.join(meta.hint("merge"), ["pivot", "band"])
             # each pair once: in the first band that both have
             .where("band = greatest(q_first, b_first) AND near <= high AND far >= low").select("pack", "block"))
    rows = (pairs.join(packs.drop("low", "high").withColumnRenamed("vecs", "vecs_q").hint("merge"), "pack")
            .join(index.select("block", "pivot", "near", "far", "ids", "no_id", "vecs").hint("merge"), "block"))

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                home, at, qids, least = (np.frombuffer(r[c], "<i8") for c in ("home", "at", "query_ids", "least"))
                reached, limit = (np.frombuffer(r[c], "<f8") for c in ("reached", "limit"))
                ids, no_id = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["no_id"], bool)
                q = _unpacked(r["vecs_q"], space.dim) if space.dim else np.zeros((len(at), 0))
                v = _unpacked(r["vecs"], space.dim) if space.dim else np.zeros((len(ids), 0))
                d = space.of_queries(q)[:, r["pivot"]]
                gap = np.maximum(0.0, np.maximum(r["near"] - d, d - r["far"]) - space.slack)
                go = np.flatnonzero((gap > reached) & (gap <= limit))
                if not len(go):
                    continue
                s = scores(q[go], v)
                ok = np.ones(s.shape, bool)
                mine = np.flatnonzero(home[go] == r["block"])
                ok[mine, at[go][mine]] = False
                floor = np.iinfo(np.int64).min
                s = np.where(ok, s, floor)
                bound = least[go]
                if len(ids) > space.k:
                    bound = np.maximum(bound, np.partition(s, len(ids) - space.k, axis=1)[:, len(ids) - space.k])
                i, j = np.nonzero(ok & (s >= bound[:, None]))
                order = np.lexsort((ids[j], no_id[j], -s[i, j], i))
                i, j = i[order], j[order]
                first = np.searchsorted(i, np.arange(len(go)))
                keep = np.arange(len(i)) - first[i] < space.k
                i, j = i[keep], j[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(home[go][i]), pa.array(at[go][i], pa.int32()), pa.array(qids[go][i]),
                     pa.array(ids[j], mask=no_id[j]), pa.array(s[i, j])], ["block", "at", "query_id", "vec_id", "score"])

    cols = ["home", "at", "query_ids", "least", "reached", "limit", "pivot", "near", "far", "ids", "no_id", "block"]
    return rows.select(*cols, "vecs_q", "vecs").mapInArrow(
        run, "block long, at int, query_id long, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query; Spark limits every map task to k rows a query before the shuffle."""
    w = W.partitionBy("block", "at").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, k: int = 10, n_pivots: int = PIVOTS, block: int = BLOCK, pack: int = PACK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest scores of each query row of ``integer_vectors``."""
    space = build_space(vectors, k, n_pivots)
    if space is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    index = build_index(vectors, space, block)
    asked = query_rows(index, space)
    first = _packs(asked, space, 0.5, pack)
    near = stage(_best(_visit(index, first, space), k).drop("rank"), "pivot-ring")
    # the k-th best score so far bounds the second ring
    kth = near.groupBy("block", "at").agg(F.min("score").alias("kth"), F.count("*").alias("n"))
    again = asked.join(kth, ["block", "at"], "left")
    bound = F.when(F.col("n") >= k, F.greatest("least", "kth")).otherwise(F.col("least"))
    radius = _first_limit(space)
    again = again.select("block", "at", "query_id", "pivot", "near", bound.alias("now"), "least", "v").mapInArrow(radius, _QUERY_SQL)
    rest = _visit(index, _packs(again, space, 1.0, pack), space)
    return _best(near.unionByName(rest), k).select("query_id", "rank", "vec_id", "score")


def _first_limit(space: Space):
    """Sets ``reached`` to what the first ring has visited and ``least`` to the present bound."""
    def run(batches):
        for b in batches:
            q = _unpacked(b"".join(b.column("v").to_pylist()), space.dim) if space.dim else np.zeros((b.num_rows, 0))
            r = space.radius(q, b.column("least").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("block", "at", "query_id", "pivot", "near", "now")), pa.array(np.where(np.isinf(r), r, r * 0.5)), b.column("v")],
                ["block", "at", "query_id", "pivot", "near", "least", "reached", "v"])
    return run
