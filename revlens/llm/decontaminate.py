"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Test items are partitioned by their number of five-word shingles.  A long
document would drown a short item, so for each size partition the document is
read in overlapping windows of shingles whose length fits that partition;
windows are built from MinHash signatures of 16-shingle blocks, so all
partitions share one pass.  A window and an item with an equal MinHash value
are candidates.  An item of fewer than ``DIRECT`` shingles, which MinHash would
miss, is a candidate of every document that holds one of them.  An item of
fewer than five words has one shingle, its whole word sequence, and is looked
up among the word sequences of that length.  Candidates are verified by exact containment: the share of
the item's distinct shingles that the whole document holds.

Values that no item has are dropped early through bit tables of fixed size
(``2**BITMAP_BITS`` bits, whatever the number of items); the joins behind them
are exact.

Words are runs of letters, digits and non-ASCII characters, ASCII lower-cased.
Bound: an item of ``DIRECT`` shingles or more that a document holds to the
threshold is missed with a chance of up to about two in 10,000 (40 MinHash
values against a window of up to four times its size).

Defined results: null and empty texts match nothing; repeated items and rows are
matched one by one; rows with one ``doc_id`` count as one document; null ids
are ignored; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as T
from ._stage import stage

K = 5
BLOCK = 16
PERMUTATIONS = 40
DIRECT = 8
_DIRECT_CLASS = 1 << 20
BITMAP_BITS = 23
_rng = np.random.default_rng(911)
_XOR = _rng.integers(0, 2**64, PERMUTATIONS, dtype=np.uint64, endpoint=False)
_ODD = _rng.integers(0, 2**64, PERMUTATIONS, dtype=np.uint64, endpoint=False) | np.uint64(1)


def size_class(n: np.ndarray) -> np.ndarray:
    """Class c holds items of ``16 * 2**(c-1) < n <= 16 * 2**c`` shingles (c = 0: up to 16)."""
    return np.ceil(np.log2(np.maximum(n, 1) / BLOCK)).clip(0).astype(np.int64)


def _shingles(buf, off, lengths=(K,)):
    """Shingles and their rows for each number of words in ``lengths``."""
    starts, ends, rows = T.find_words(buf, off, T.IS_ALNUM)
    w = T.hash_words(buf, starts, ends)
    return [(s, rows[at]) for s, at in (T.hash_shingles(w, rows, k) for k in lengths)]


def _slot(values: np.ndarray, cls, perm) -> np.ndarray:
    """Key of one MinHash value in one size class and permutation."""
    with np.errstate(over="ignore"):
        return T.mix64(values + np.uint64(perm) * np.uint64(0xA24BAED4963EE407) + np.uint64(cls) * np.uint64(0x9FB21C651E98DF25))


def item_tables(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Signature keys ``(key, item, cls)`` and distinct shingles ``(shingle, item, item_id, size)``.

    ``item`` stands for one id with one set of shingles: texts that share an id stay apart.

    ``cls`` is the size class, or for a direct item the negative number of words in its shingles.
    """
    def run(batches):
        for batch in batches:
            ids = batch.column("item_id")
            for lo, buf, off in T.text_blocks(batch.column("text")):
                sets = [(k, s, np.searchsorted(rows, np.arange(len(off)))) for k, (s, rows) in
                        zip(range(K, 0, -1), _shingles(buf, off, range(K, 0, -1)))]
                for i in range(len(off) - 1):
                    # of a short item the longest sequence, which is the whole of it
                    k, u = next(((k, np.unique(s[at[i]:at[i + 1]])) for k, s, at in sets if at[i] < at[i + 1]), (0, None))
                    if not k:
                        continue
                    if len(u) < DIRECT:
                        c, keys = -k, _slot(u, _DIRECT_CLASS, 0)
                    else:
                        c = int(size_class(np.array([len(u)]))[0])
                        with np.errstate(over="ignore"):
                            keys = np.array([_slot(((u ^ x) * o).min(keepdims=True), c, p)[0]
                                             for p, (x, o) in enumerate(zip(_XOR, _ODD))], np.uint64)
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(lo + i, 1), pa.array([c], pa.int32()),
                         pa.array([keys.view(np.int64)], pa.list_(pa.int64())),
                         pa.array([u.view(np.int64)], pa.list_(pa.int64()))], ["item_id", "cls", "keys", "shingles"])

    items = stage(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id IS NOT NULL")
                  .mapInArrow(run, "item_id long, cls int, keys array<long>, shingles array<long>"), "benchmark-items")
    items = items.withColumn("item", F.xxhash64("item_id", "shingles"))
    # equal items (same id, same shingles) count once
    return (items.select("item", "cls", F.explode("keys").alias("key")).distinct(),
            items.groupBy("item").agg(F.first("item_id").alias("item_id"), F.first("shingles").alias("s"))
            .select("item", "item_id", F.size("s").alias("size"), F.explode("s").alias("shingle")))


def _bitmap(df: DataFrame, col: str, bits: int) -> np.ndarray:
    """Bit table of a column of 64-bit hashes; built per task, merged as words of fixed number."""
    slot = F.shiftrightunsigned(F.col(col), 64 - bits)
    rows = (df.select(F.shiftright(slot, 5).alias("w"), F.expr("1L").alias("one"), slot.alias("slot"))
            .groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 31 as int))")).alias("m")).collect())
    out = np.zeros(1 << (bits - 5), np.uint32)
    for w, m in rows:
        out[w] = m
    return out


def _in_bitmap(table: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    slot = (h >> np.uint64(64 - bits)).astype(np.int64)
    return (table[slot >> 5] >> (slot & 31).astype(np.uint32)) & np.uint32(1) == 1


def _probe(sent):
    """Per document with a signature hit: its hit keys and those shingles that some item may have."""
    def run(batches):
        classes, sig_map, all_map = sent.value
        if not len(classes):
            return
        lengths = [K, *(n for n in range(1, K) if -n in classes)]
        for batch in batches:
            ids = batch.column("doc_id")
            for lo, buf, off in T.text_blocks(batch.column("text")):
                sets = _shingles(buf, off, lengths)
                s, rows = sets[0]
                hits = [_windows(s, rows, classes, sig_map)] if len(s) and (classes >= 0).any() else []
                for n, (x, r) in zip(lengths, sets):
                    if -n in classes:
                        key = _slot(x, _DIRECT_CLASS, 0)
                        good = _in_bitmap(sig_map, key, BITMAP_BITS)
                        hits.append((r[good], key[good]))
                if not hits:
                    continue
                rows_hit = np.concatenate([h[0] for h in hits])
                keys_hit = np.concatenate([h[1] for h in hits])
                order = np.argsort(rows_hit, kind="stable")
                rows_hit, keys_hit = rows_hit[order], keys_hit[order]
                known = [_in_bitmap(all_map, x, BITMAP_BITS) for x, _ in sets]
                for d in np.unique(rows_hit):
                    own = []
                    for (x, r), m in zip(sets, known):
                        a, b = np.searchsorted(r, [d, d + 1])
                        own.append(x[a:b][m[a:b]])
                    own = np.unique(np.concatenate(own))
                    a, b = np.searchsorted(rows_hit, [d, d + 1])
                    keys = np.unique(keys_hit[a:b])
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(lo + int(d), 1), pa.array([keys.view(np.int64)], pa.list_(pa.int64())),
                         pa.array([own.view(np.int64)], pa.list_(pa.int64()))], ["doc_id", "keys", "shingles"])
    return run


def _windows(s, rows, classes, sig_map):
    """Rows and signature keys of the windows that may match an item of a size class."""
    first = np.flatnonzero(np.insert(rows[1:] != rows[:-1], 0, True))
    length = np.diff(np.append(first, len(s)))
    n_blocks = -(-length // BLOCK)
    b0 = np.cumsum(n_blocks) - n_blocks  # first block of each document
    owner = np.repeat(np.arange(len(first)), n_blocks)
    in_doc = np.arange(len(owner)) - b0[owner]
    starts = first[owner] + in_doc * BLOCK
    doc_rows, keys = [np.zeros(0, rows.dtype)], [np.zeros(0, np.uint64)]
    for p in range(PERMUTATIONS):
        with np.errstate(over="ignore"):
            m = np.minimum.reduceat((s ^ _XOR[p]) * _ODD[p], starts)
        # m over 2**c blocks from every block on, clipped at the document's end
        reach, span = m, 1
        for c in range(int(classes[-1]) + 1):
            # a window of two spans, from every span-th block on, holds any item of class c
            window = _min_ahead(reach, owner, span)
            if c in classes:
                at = np.flatnonzero(in_doc % span == 0)
                key = _slot(window[at], c, p)
                good = _in_bitmap(sig_map, key, BITMAP_BITS)
                doc_rows.append(rows[first[owner[at[good]]]])
                keys.append(key[good])
            reach, span = window, span * 2
    return np.concatenate(doc_rows), np.concatenate(keys)


def _min_ahead(v: np.ndarray, owner: np.ndarray, step: int) -> np.ndarray:
    """Minimum of each block and the one ``step`` blocks ahead in the same document."""
    out = v.copy()
    if len(v) > step:
        same = owner[:-step] == owner[step:]
        out[:-step] = np.where(same, np.minimum(v[:-step], v[step:]), v[:-step])
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: int = 80) -> DataFrame:
    """Rows ``doc_id, item_id, n_item, n_found, containment`` for containment of ``threshold`` per cent or more."""
    spark = docs.sparkSession
    sigs, shingles = item_tables(benchmark)
    sigs, shingles = stage(sigs, "benchmark-keys"), stage(shingles, "benchmark-shingles")
    classes = np.array(sorted(r[0] for r in sigs.select("cls").distinct().collect()), np.int64)
    sent = spark.sparkContext.broadcast((classes, _bitmap(sigs, "key", BITMAP_BITS), _bitmap(shingles, "shingle", BITMAP_BITS)))
    probe = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
                  .mapInArrow(_probe(sent), "doc_id long, keys array<long>, shingles array<long>"), "benchmark-probe")
    pairs = (probe.select("doc_id", F.explode("keys").alias("key")).join(sigs.select("key", "item"), "key")
             .select("doc_id", "item").distinct())
    held = (probe.select("doc_id", F.explode("shingles").alias("shingle")).distinct()
            .join(shingles, "shingle").groupBy("doc_id", "item", "item_id", "size").agg(F.count("*").alias("n_found"))
            .where(100 * F.col("n_found") >= threshold * F.col("size")))
    return held.join(pairs, ["doc_id", "item"], "left_semi").select(
        "doc_id", "item_id", F.col("size").cast("long").alias("n_item"), "n_found",
        (F.col("n_found") / F.col("size")).alias("containment"))


def drop_leaks(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a test item."""
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
