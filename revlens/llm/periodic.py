"""Periodic runs of words by seed-and-extend on the diagonals of each document.

A run is a stretch of words with smallest period ``q`` and at least
``max(min_length, 2 * q)`` words that no neighbouring word extends.  On the
diagonal of lag ``q`` (word ``i`` against word ``i + q``) it is a stretch of
equal words, at least ``max(min_length - q, q)`` long, so half of ``min_length``
words is the least overlap: the index holds the k-grams of that length that
occur twice in their document.  For lags from ``k * 2**j`` to twice that the
overlap is at least ``k * 2**j``, so these lags are seeded by grams of that
length, ranked by pairs of the grams half as long (exact ranks, no hashes of
grams).

Pairs of occurrences of one gram in one document are enumerated lag class by lag
class.  A pair whose stretch goes on beyond it is covered by the pair one
further on the same diagonal: such pairs are stepped over, a whole piece of
occurrences with the same neighbour at a time, so no group emits all its pairs.
What is left of each stretch are its first and its last seed.  The table of
each lag, both sorted by place, then gives how far every stretch covers:
its n-th first seed belongs to its n-th last one.  A stretch on a
multiple of a run's period covers the same words as the run and goes.

The work is done inside one Arrow block of about a megabyte of text (one text
at least): no shuffle, memory follows the longest text.

Defined results: a null or empty text, or one without a word, has no runs and
an empty collapsed text; repeated rows and null ids are rows like any other;
ties cannot arise among runs (start, length and period tell them apart); other
columns are not read; an empty table gives no rows.  Words are compared by a
64-bit hash of their bytes (case counts).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import find_words, hash_words, mix64, text_blocks

MIN_LENGTH = 12
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _ranks(keys: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Dense ranks of ``keys`` at the places ``at`` of ``n``; -1 elsewhere and where a key occurs once."""
    out = np.full(n, -1, np.int64)
    if len(at):
        _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
        twice = counts[inverse] > 1
        out[at[twice]] = inverse[twice]
    return out


def _longer(rank: np.ndarray, shift: int, rows: np.ndarray) -> np.ndarray:
    """Ranks of the grams made of the gram at a place and the one ``shift`` further in the same row."""
    n = len(rank)
    if n <= shift:
        return np.full(n, -1, np.int64)
    at = np.flatnonzero((rank[:-shift] >= 0) & (rank[shift:] >= 0) & (rows[:-shift] == rows[shift:]))
    return _ranks(rank[at] * (n + 1) + rank[at + shift], at, n)


def _outer_pairs(rank: np.ndarray, at: np.ndarray, beside: np.ndarray, low: int, high: int):
    """Lags and first places of the pairs of equal grams, ``low <= lag <= high``, whose neighbours differ.

    ``at`` are places sorted by rank and place, ``beside`` their neighbours.
    """
    n, span = len(at), int(at.max(initial=0)) + high + 2
    change = np.flatnonzero((rank[1:] != rank[:-1]) | (beside[1:] != beside[:-1])) + 1
    # first occurrence after each one that has another neighbour
    after = np.append(change, n)[np.searchsorted(change, np.arange(n), "right")]
    key = rank * span + at
    x = np.arange(n)
    y = np.searchsorted(key, key + low)
    lags, places = [], []
    while True:
        inside = y < n
        x, y = x[inside], y[inside]
        near = (rank[y] == rank[x]) & (at[y] - at[x] <= high)
        x, y = x[near], y[near]
        if not len(x):
            break
        differ = beside[x] != beside[y]
        lags.append((at[y] - at[x])[differ])
        places.append(at[x][differ])
        y = np.where(differ, y + 1, after[y])
    if not lags:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lag, place = np.concatenate(lags), np.concatenate(places)
    order = np.lexsort((place, lag))
    return lag[order], place[order]


def word_runs(words: np.ndarray, rows: np.ndarray, min_length: int = MIN_LENGTH):
    """``(first word, length, period)`` of all runs; ``rows`` (ascending) tells the texts apart."""
    n = len(words)
    empty = np.zeros(0, np.int64)
    if n < min_length:
        return empty, empty, empty
    # equal words of one text, and only those, share an id
    with np.errstate(over="ignore"):
        _, ids = np.unique(mix64(words ^ mix64(rows.astype(np.uint64) + np.uint64(1))), return_inverse=True)
    ids = ids.astype(np.int64)
    first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    size = np.diff(np.append(first, n))
    begin, end = np.repeat(first, size), np.repeat(first + size, size)
    k = (min_length + 1) // 2
    rank, m = _ranks(ids, np.arange(n), n), 1
    while 2 * m <= k:
        rank, m = _longer(rank, m, rows), 2 * m
    if m < k:
        rank = _longer(rank, k - m, rows)
    found, low, longest = [], 1, int(size.max()) // 2
    while low <= longest:
        at = np.flatnonzero(rank >= 0)
        if not len(at):
            break
        at = at[np.argsort(rank[at], kind="stable")]
        r, high = rank[at], min(2 * k - 1, longest)
        # at a text's edge every place has a neighbour of its own
        left = np.where(at > begin[at], ids[at - 1], -1 - at)
        right = np.where(at + k < end[at], ids[np.minimum(at + k, n - 1)], -1 - at)
        lag, start = _outer_pairs(r, at, left, low, high)
        _, last = _outer_pairs(r, at, right, low, high)
        overlap = last + k - start
        whole = overlap >= np.maximum(min_length - lag, lag)
        found.append(np.stack([start[whole], (overlap + lag)[whole], lag[whole]]))
        rank, low, k = _longer(rank, k, rows), 2 * k, 2 * k
    if not found:
        return empty, empty, empty
    start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    least = np.ones(len(start), bool)
    least[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[least], length[least], period[least]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _joined(buf, starts, ends, rows, n_rows):
    """Bytes and offsets of the texts made of the given words, one blank between two."""
    lens = ends - starts + 1
    base = np.cumsum(lens) - lens
    total = int(lens.sum())
    out = np.full(total, 0x20, np.uint8)
    at = np.arange(total) - np.repeat(base, lens)
    inside = at < np.repeat(lens - 1, lens)
    out[inside] = buf[(at + np.repeat(starts, lens))[inside]]
    last = np.append(rows[1:] != rows[:-1], True) if len(rows) else np.zeros(0, bool)
    keep = np.ones(total, bool)
    keep[(base + lens - 1)[last]] = False
    sizes = np.bincount(rows, weights=lens, minlength=n_rows).astype(np.int64)
    sizes[rows[last]] -= 1
    return out[keep], np.append(0, np.cumsum(sizes))


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """Per row ``doc_id, n_words, runs, collapsed``.

    ``runs`` are ``(start, length, period)`` by start, then period; ``collapsed``
    are the words, joined by one blank, without those that stand in a run
    after its first ``period`` words.
    """
    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for lo, buf, off in text_blocks(batch.column("text")):
                n_rows = len(off) - 1
                starts, ends, rows = find_words(buf, off)
                start, length, period = word_runs(hash_words(buf, starts, ends, lower=False), rows, min_length)
                delta = np.zeros(len(starts) + 1, np.int64)
                np.add.at(delta, start + period, 1)
                np.add.at(delta, start + length, -1)
                keep = np.cumsum(delta[:-1]) == 0
                data, offsets = _joined(buf, starts[keep], ends[keep], rows[keep], n_rows)
                n_words = np.bincount(rows, minlength=n_rows)
                first_word = np.cumsum(n_words) - n_words
                of = rows[start]
                entries = pa.StructArray.from_arrays([start - first_word[of], length, period], fields=list(_RUN_TYPE))
                places = np.append(0, np.cumsum(np.bincount(of, minlength=n_rows)))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, n_rows), pa.array(n_words, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(places, pa.int32()), entries),
                     pa.LargeStringArray.from_buffers(n_rows, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def run_report(found: DataFrame) -> DataFrame:
    """``doc_id``, number of runs, the longest run and digests of all runs and of the collapsed text."""
    # greatest length, then smallest start, then period
    best = F.expr("array_min(transform(runs, r -> struct(-r.length AS shorter, r.start AS start, r.period AS period, r.length AS length)))")
    lines = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')))")
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
                    F.col("best.length").alias("length"), F.col("best.period").alias("period"),
                    F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
                    F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: every tenth document (by crc32 of its id) repeats its words from some place on; null ids never."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    d = docs.select("doc_id", "text", F.when(h % 10 == 0, h).alias("h"))
    words = F.when(F.col("h").isNotNull(), F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)"))
    d = d.withColumn("words", words).withColumn("n", F.size("words")).withColumn("g", F.expr("h div 10"))
    d = d.withColumn("a", F.expr("IF(n > 0, g % n, 0)")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    changed = F.expr("array_join(transform(words, (w, i) -> IF(i < a, w, words[CAST(a + (i - a) % p AS INT)])), ' ')")
    return d.select("doc_id", F.when(F.col("n") > 0, changed).otherwise(F.col("text")).alias("text"))
