"""Mixing sources to target weights: a multivariate-hypergeometric splitting tree over output shards.

Sources, by code point with null last, weigh 5, 2, 1, 5, 2, 1, ... and share
all words; a source's target stops at ``max_repeat`` times its words, and the
excess is shared again by weight until no target is above its stop.

Every source is cut into blocks (documents by id hash).  A source's quota in
blocks is its whole passes over all blocks plus the blocks of the last, partial
pass.  The vector of quotas is split between the two halves of the output
shards by a multivariate hypergeometric draw, again and again down to single
shards; each shard walks its own path of the tree, so the tree is never held
in one place.  The counts on the way give every shard a range of positions in
the source's permuted blocks, disjoint from all others.  Documents of the one
block that only partly fits are taken in hash order while they bring the sum
nearer to the target.  Inside a shard the order is a hash of document and copy.

Blocks per source are bounded (``MAX_BLOCKS``), their contents grow with the
data; the table of draws has at most ``max_repeat * MAX_BLOCKS`` rows a source.

Defined results: a null or empty text has size 0 and is taken with its block
like any other; repeated rows are rows of their own size but one id lies in
one block; a null source is a source; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._stage import stage

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
MAX_BLOCKS = 1024
BLOCK_ROWS = 16
SHARDS = 64


def word_count(text="text"):
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``source, source_size, n_docs, weight, target`` from rows ``source, size`` (one row per source).

    With sources in order of stop / weight, the sources that reach their stop
    come first; the others share what is left by weight.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    everything = W.partitionBy()
    order = W.orderBy(F.col("source").asc_nulls_last())
    per = (per.withColumn("i", F.row_number().over(order) - 1)
           .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("i") % len(WEIGHTS) + 1).cast("int")))
           .withColumn("stop", (max_repeat * F.col("source_size")).cast("double"))
           .withColumn("total", F.sum("source_size").over(everything).cast("double"))
           .withColumn("all_weight", F.sum("weight").over(everything)))
    by_level = W.orderBy(F.col("stop") / F.col("weight"), "i")
    before = by_level.rowsBetween(W.unboundedPreceding, -1)
    # the level if this source and all after it stay below their stops
    level = ((F.col("total") - F.coalesce(F.sum("stop").over(before), F.lit(0.0)))
             / (F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    per = per.withColumn("level", level).withColumn("open", F.col("level") * F.col("weight") <= F.col("stop"))
    final = F.min(F.when(F.col("open"), F.struct(F.col("stop") / F.col("weight"), F.col("i"), F.col("level").alias("level")))).over(everything)
    return per.withColumn("final", final).select(
        "source", "source_size", "n_docs", "weight",
        F.when(F.col("final").isNull(), F.col("stop")).otherwise(F.least("stop", F.col("final.level") * F.col("weight"))).alias("target"))


def split_tree_path(shard: int, shards: int, quotas: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and counts of each source's blocks for one shard.

    A node of the tree is a range of shards; its draw is seeded by the range,
    so every shard that passes it sees the same split.
    """
    lo, hi = 0, shards
    have = quotas.astype(np.int64).copy()
    offset = np.zeros(len(have), np.int64)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        take = int(have.sum()) * (mid - lo) // (hi - lo)
        rng = np.random.Generator(np.random.Philox(np.random.SeedSequence([seed, lo, hi])))
        left = rng.multivariate_hypergeometric(have, take, method="marginals") if take else np.zeros_like(have)
        if shard < mid:
            have, hi = left, mid
        else:
            offset, have, lo = offset + left, have - left, mid
    return offset, have


def mix(docs: DataFrame, shards: int = SHARDS, seed: int = 1, max_repeat: int = MAX_REPEAT) -> tuple[DataFrame, DataFrame]:
    """``(plan, sizes)``: the copies ``doc_id, source, shard, copy`` and ``sizes`` per row with its target."""
    base = stage(docs.select(F.col("doc_id"), "source", word_count().alias("size")), "mix-sizes")
    targets = stage(source_targets(base, max_repeat), "mix-targets")
    key = F.xxhash64(F.lit(seed), "doc_id")
    blocks_of = F.greatest(F.lit(1), F.least(F.lit(MAX_BLOCKS), F.ceil(F.col("n_docs") / BLOCK_ROWS))).cast("int")
    sized = (base.join(targets.withColumnRenamed("source", "ts"), F.col("source").eqNullSafe(F.col("ts"))).drop("ts")
             .withColumn("n_blocks", blocks_of).withColumn("block", F.pmod(key, F.col("n_blocks")).cast("int")))

    # Words per block, and where the last partial pass of each source ends.
    per_block = sized.groupBy("source", "block").agg(F.sum("size").alias("words"), F.first("n_blocks").alias("n_blocks"),
                                                     F.first("target").alias("target"), F.first("source_size").alias("source_size"))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-9)).otherwise(0).cast("int")
    rank = W.partitionBy("source").orderBy(F.xxhash64(F.lit(seed + 1), "block"), "block")
    per_block = stage(
        per_block.withColumn("passes", passes)
        .withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("passes") * F.col("source_size")))
        .withColumn("position", F.row_number().over(rank) - 1)
        .withColumn("n_used", F.count("*").over(W.partitionBy("source")))
        .withColumn("before", F.sum("words").over(rank.rowsBetween(W.unboundedPreceding, 0)) - F.col("words"))
        .withColumn("part", F.when(F.col("before") + F.col("words") <= F.col("rest"), "whole")
                    .when(F.col("before") < F.col("rest"), "partial").otherwise("none")), "mix-blocks")

    quotas = (per_block.groupBy("source").agg(
        (F.max("passes") * F.max("n_used") + F.count_if(F.col("part") != "none")).cast("long").alias("quota"),
        F.max("n_used").alias("n_used")))
    # One row holds the quota of every source; each shard row carries it down its own path.
    root = quotas.agg(F.sort_array(F.collect_list(F.struct(F.col("source").isNull().alias("last"), "source", "quota"))).alias("q"))

    def walk(frames):
        for pdf in frames:
            rows = []
            for shard, q in zip(pdf["shard"], pdf["q"]):
                counts = np.array([x["quota"] for x in q], np.int64)
                offset, have = split_tree_path(int(shard), shards, counts, seed)
                rows += [(int(shard), q[s]["source"], int(offset[s]), int(have[s])) for s in np.flatnonzero(have)]
            yield pd.DataFrame(rows, columns=["shard", "source", "offset", "n"]).astype({"shard": "int32", "offset": "int64", "n": "int64"})

    spark = docs.sparkSession
    ids = spark.range(shards).select(F.col("id").cast("int").alias("shard"), F.lit(1).alias("one"))
    draws = (ids.join(root.withColumn("one", F.lit(1)), "one").select("shard", "q")
             .mapInPandas(walk, "shard int, source string, offset long, n long")
             .select("shard", "source", F.explode(F.sequence("offset", F.col("offset") + F.col("n") - 1)).alias("at")))
    pb = per_block.select("source", "block", "position", "n_used", "passes", "part", "before", "rest")
    counts = quotas.select(F.col("source").alias("qs"), F.col("n_used").cast("long").alias("nu"))
    draws = (draws.join(counts, F.col("source").eqNullSafe(F.col("qs"))).drop("qs")
             .withColumn("copy", F.floor(F.col("at") / F.col("nu")).cast("int"))
             .withColumn("position", F.pmod("at", "nu").cast("int")))
    d = draws.select(F.col("source").alias("ds"), F.col("position").alias("dp"), "shard", "copy")
    drawn = stage(d.join(pb, F.col("ds").eqNullSafe(F.col("source")) & (F.col("dp") == F.col("position")))
                  .select("source", "block", "shard", "copy", F.when(F.col("copy") < F.col("passes"), "whole")
                          .otherwise(F.col("part")).alias("part"), (F.col("rest") - F.col("before")).alias("room")), "mix-draws")

    # Documents of the block that fits only in part: largest first while they fit, then the nearest one.
    edge = drawn.where("part = 'partial'").select("source", "block", "room")
    s = sized.select("doc_id", "source", "size", "block")
    near = s.join(edge.toDF("es", "eb", "room"), F.col("source").eqNullSafe(F.col("es")) & (F.col("block") == F.col("eb")))
    near = _fill(near.select("doc_id", "source", "size", "block", "room"), seed).select("doc_id", "source", "size", "block")
    x = drawn.toDF("xs", "xb", "shard", "copy", "part", "room")
    same = F.col("source").eqNullSafe(F.col("xs")) & (F.col("block") == F.col("xb"))
    plan = (s.join(x.where("part = 'whole'"), same).select("doc_id", "source", "size", "shard", "copy")
            .unionByName(near.join(x.where("part = 'partial'"), same).select("doc_id", "source", "size", "shard", "copy")))
    return plan, sized.select("doc_id", "source", "size", "source_size", "target")


def _fill(near: DataFrame, seed: int, passes: int = 5) -> DataFrame:
    """Rows whose sizes fill ``room`` (one block per source), each pass with rows that still fit."""
    own = W.partitionBy("source")
    tie = [F.xxhash64(F.lit(seed + 2), "doc_id"), F.col("doc_id")]
    near = near.withColumn("taken", F.lit(False))
    for _ in range(passes):
        near = near.withColumn("fits", ~F.col("taken") & (F.col("size") > 0) & (F.col("size") <= F.col("room")))
        order = own.orderBy(F.col("fits").desc(), F.col("size").desc(), *tie).rowsBetween(W.unboundedPreceding, 0)
        near = (near.withColumn("upto", F.sum(F.when(F.col("fits"), F.col("size")).otherwise(0)).over(order))
                .withColumn("now", F.col("fits") & (F.col("upto") <= F.col("room")))
                .withColumn("room", F.col("room") - F.sum(F.when(F.col("now"), F.col("size")).otherwise(0)).over(own))
                .withColumn("taken", F.col("taken") | F.col("now")))
    left = own.orderBy(F.col("taken") | (F.col("size") == 0), "size", *tie)
    near = near.withColumn("nth", F.row_number().over(left))
    return near.where(F.col("taken") | ((F.col("nth") == 1) & (F.col("size") > 0) & (F.col("size") < 2 * F.col("room"))))


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """Per row: ``doc_id, size, source_size, target, taken, copies``; repeated rows of one id share its copies."""
    plan, sized = mix(docs, **options)
    n = plan.groupBy("doc_id", "source", "size").agg(F.count("*").alias("all_copies"))
    rows = sized.groupBy("doc_id", "source", "size", "source_size", "target").agg(F.count("*").alias("rows"))
    j = rows.join(n.toDF("d", "s", "z", "all_copies"), F.col("doc_id").eqNullSafe(F.col("d"))
                  & F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")), "left")
    n_all, n_rows = F.coalesce("all_copies", F.lit(0)), F.col("rows")
    copies = F.floor(n_all / n_rows) + F.when(F.col("row") <= n_all % n_rows, 1).otherwise(0)
    return (j.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))).withColumn("copies", copies)
            .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs`` repeated by their copies, with ``mix_shard``, ``mix_copy``, ``mix_order``."""
    plan, _ = mix(docs, **options)
    p = plan.select("doc_id", "source", "size", "shard", "copy").distinct().toDF("__d", "__s", "__z", "mix_shard", "mix_copy")
    docs = docs.select(*[c for c in docs.columns if c not in ("mix_shard", "mix_copy", "mix_order")])
    out = (docs.withColumn("__n", word_count())
           .join(p, F.col("doc_id").eqNullSafe(F.col("__d")) & F.col("source").eqNullSafe(F.col("__s")) & (F.col("__n") == F.col("__z")))
           .drop("__d", "__s", "__z", "__n").withColumn("mix_order", F.xxhash64(F.lit(options.get("seed", 1) + 3), "doc_id", "mix_copy")))
    return out.repartition("mix_shard").sortWithinPartitions("mix_shard", "mix_order")
