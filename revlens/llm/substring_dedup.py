"""Substring dedup: content-defined chunking with a gear rolling hash, deduplicated by digest.

A 16-byte gear hash runs over the text (ASCII letters lower-cased, every run
of white space one blank).  A word start is a cut where the hash over the
bytes before it is the smallest among its neighbours within ``radius`` words,
so cuts depend on nearby text of the same row alone: an insertion moves a cut
or two and the following chunks keep their digests.

A single short chunk may repeat by chance.  A chunk is a repeat when its
digest together with a neighbour's (the pair digest) occurs in a document with
a smaller id; a passage is a run of repeated chunks with ``min_words`` words or
more.  Only whole chunks count, so the ends of a common passage are lost: of
passages in fresh surroundings 0.20 are found at 25 words, 0.80 at 30, 0.98 at
35 and all from 40 on (300 of each length).  A text of fewer than ``min_words`` words is compared as a whole as well:
where it is repeated, all of it is one passage whatever its length.  The copy in the smallest ``doc_id`` stays, repeats inside that same
document stay too.

Defined results: null, empty and blank texts have no chunk; a text without a
cut is one chunk, paired with nothing, and compared as a whole; rows with one ``doc_id`` are one document and keep their
texts; a null ``doc_id`` is never changed and never a first copy; extra
columns pass through.
"""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _text as T
from ._stage import stage

_GEAR = np.random.default_rng(77).integers(0, 2**16, 256, dtype=np.uint16)
RADIUS = 2
MIN_WORDS = 20
# Runs of one repeated word have no smallest hash: cut them at this many words.
MAX_WORDS = 16
FILTER_BITS = 1 << 25
_WHOLE = np.uint64(0xA0761D6478BD642F)  # tells whole texts from pairs


def gear_hashes(b: np.ndarray, void: np.ndarray) -> np.ndarray:
    """Rolling hash of the 16 bytes that end at each byte: ``h = 2 h + gear[byte]`` modulo 2**16; ``void`` bytes add nothing."""
    h = _GEAR[b]
    h[void] = 0
    for step in (1, 2, 4, 8):
        more = h.copy()
        more[step:] += h[:-step] << np.uint16(step)
        h = more
    return h


def chunk_cuts(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, radius: int) -> np.ndarray:
    """Mask over the words of a block: True where a chunk begins."""
    n = len(starts)
    lens = ends - starts
    new_row = np.ones(n, bool)
    new_row[1:] = rows[1:] != rows[:-1]
    size = lens + 1 + 16 * new_row  # a word and one blank; void bytes keep the row before out of the hash
    first = np.cumsum(size) - lens - 1
    flat = np.full(int(size.sum()), 32, np.uint8)
    pos = np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens)
    flat[pos + np.repeat(first, lens)] = T.LOWER[buf[pos + np.repeat(starts, lens)]]
    h = gear_hashes(flat, (first[new_row][:, None] - np.arange(1, 17)).ravel())
    at = np.zeros(n, np.uint64)  # hash of the bytes before each word
    at[1:] = h[first[1:] - 1]
    at[new_row] = np.iinfo(np.uint64).max
    low = np.ones(n, bool)
    for d in range(1, radius + 1):
        other = rows[d:] != rows[:-d]
        low[d:] &= (at[d:] < at[:-d]) | other
        low[:-d] &= (at[:-d] <= at[d:]) | other
    # the head of a run of one word has equal hashes ahead and another one behind
    low[1:-1] |= (at[1:-1] == at[2:]) & (at[1:-1] != at[:-2]) & ~new_row[2:]
    cut = np.flatnonzero(low | new_row)
    since = np.arange(n) - np.repeat(cut, np.diff(np.append(cut, n)))
    return since % MAX_WORDS == 0


def chunks(docs: DataFrame, min_words: int = MIN_WORDS, radius: int = RADIUS) -> DataFrame:
    """One row per pair of adjacent chunks: ``doc_id, seq, pair`` (digest) and the place of both.

    ``start`` is the first character of the first chunk, ``end`` the end of
    the second one, ``words`` and ``words2`` their sizes.  A text of one chunk or
    of fewer than ``min_words`` words gives a row for the whole of it too, with
    ``words2 = 0`` and ``seq`` the negative number of its chunks.
    """
    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for lo, buf, off in T.text_blocks(batch.column("text")):
                starts, ends, rows = T.find_words(buf, off)
                if not len(starts):
                    continue
                cut = np.flatnonzero(chunk_cuts(buf, starts, ends, rows, radius))
                w = T.hash_words(buf, starts, ends)
                # order matters inside a chunk: position-weighted sum of word hashes
                lens = np.diff(np.append(cut, len(w)))
                pos = np.arange(len(w)) - np.repeat(cut, lens)
                with np.errstate(over="ignore"):
                    digest = T.mix64(np.add.reduceat(w * T._power_table(int(lens.max()) + 1)[pos + 1], cut) + lens.astype(np.uint64))
                    r = rows[cut]
                    nxt = np.append(r[1:] == r[:-1], False)
                    after = np.append(digest[1:], np.uint64(0))
                    pair = T.mix64(digest * np.uint64(0x9E3779B97F4A7C15) + after)
                keep = np.flatnonzero(nxt)
                chars = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])  # characters before each byte
                b1 = ends[np.append(cut[1:], len(w)) - 1]
                head = np.flatnonzero(np.insert(r[1:] != r[:-1], 0, True))
                n_chunks = np.diff(np.append(head, len(r)))
                seq = np.arange(len(cut)) - np.repeat(head, n_chunks)
                n_words = np.add.reduceat(lens, head)
                whole = np.flatnonzero((n_words < min_words) | (n_chunks == 1))
                begin = cut[head[whole]]
                size = n_words[whole]
                at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
                text = np.zeros(0, np.uint64)
                if len(whole):
                    with np.errstate(over="ignore"):
                        text = T.mix64(np.add.reduceat(w[at + np.repeat(begin, size)] * T._power_table(int(size.max()) + 1)[at + 1],
                                                       np.cumsum(size) - size) + size.astype(np.uint64) + _WHOLE)
                base, base2 = chars[off[r[keep]]], chars[off[r[head[whole]]]]
                both = lambda a, b, kind: pa.array(np.concatenate([a, b]).astype(kind))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(both(r[keep] + lo, r[head[whole]] + lo, np.int64)), both(seq[keep], -n_chunks[whole], np.int32),
                     both(chars[starts[cut[keep]]] - base, chars[starts[begin]] - base2, np.int32),
                     both(chars[b1[keep + 1]] - base, chars[ends[begin + size - 1]] - base2, np.int32),
                     both(lens[keep], size, np.int32), both(lens[keep + 1], np.zeros(len(whole)), np.int32),
                     both(pair[keep].view(np.int64), text.view(np.int64), np.int64)],
                    ["doc_id", "seq", "start", "end", "words", "words2", "pair"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, seq int, start int, end int, words int, words2 int, pair long")


@contextmanager
def _runtime_filter(spark: SparkSession):
    """Let Spark filter the chunks by a Bloom filter of the repeated pairs before it shuffles them.

    The filter has ``FILTER_BITS`` bits whatever the input; where the repeats outgrow it, it lets
    more rows pass and the join behind it stays exact.
    """
    name = "spark.sql.optimizer.runtime.bloomFilter."
    wanted = {"enabled": "true", "applicationSideScanSizeThreshold": "0", "creationSideThreshold": str(1 << 60),
              "numBits": str(FILTER_BITS), "expectedNumItems": str(FILTER_BITS // 8)}
    before = {k: spark.conf.get(name + k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(name + k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(name + k, v)


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, radius: int = RADIUS) -> DataFrame:
    """Rows ``doc_id, first_doc_id, start, end, n_words, n_chunks`` for every repeated passage.

    ``start`` and ``end`` count characters (end exclusive).  ``first_doc_id``
    is the smallest document that holds the passage's first chunk pair.
    """
    c = stage(chunks(docs.where("doc_id IS NOT NULL"), min_words, radius), "substring-chunks")
    firsts = stage(c.groupBy("pair").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
                   .where("first_doc < last_doc"), "substring-firsts").where("first_doc < last_doc")
    with _runtime_filter(docs.sparkSession):
        hit = stage(c.join(firsts.drop("last_doc"), "pair").where("first_doc < doc_id").drop("pair"), "substring-hits")
    per_doc = hit.groupBy("doc_id").agg(F.sort_array(F.collect_list(
        F.struct("seq", "first_doc", "start", "end", "words", "words2"))).alias("hits"))
    return per_doc.mapInArrow(_runs(min_words), "doc_id long, first_doc_id long, start int, end int, n_words int, n_chunks int")


def _runs(min_words):
    """Join pairs that follow one another into passages."""
    def run(batches):
        for batch in batches:
            out = []
            for d, hits in zip(batch.column("doc_id").to_pylist(), batch.column("hits").to_pylist()):
                i = 0
                while i < len(hits) and hits[i]["seq"] < 0:  # whole texts; an equal text is a repeated row
                    if i == 0 or hits[i] != hits[i - 1]:
                        out.append((d, hits[i]["first_doc"], hits[i]["start"], hits[i]["end"], hits[i]["words"], -hits[i]["seq"]))
                    i += 1
                while i < len(hits):
                    j, words = i, hits[i]["words"]
                    while j + 1 < len(hits) and hits[j + 1]["seq"] <= hits[j]["seq"] + 1:
                        j += 1  # an equal seq is a repeated row
                        words += hits[j]["words"] if hits[j]["seq"] > hits[j - 1]["seq"] else 0
                    words += hits[j]["words2"]
                    if words >= min_words:
                        out.append((d, hits[i]["first_doc"], hits[i]["start"], hits[j]["end"], words,
                                    hits[j]["seq"] - hits[i]["seq"] + 2))
                    i = j + 1
            cols = list(zip(*out)) if out else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, kinds)],
                                             ["doc_id", "first_doc_id", "start", "end", "n_words", "n_chunks"])
    return run


def cut_passages(docs: DataFrame, passages: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every listed passage taken out of its text; columns and rows unchanged.

    A column ``n_chars`` is brought up to date.  Ids that occur in several rows
    keep their texts, since a span would not say which row it belongs to.
    """
    cuts = passages.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__cuts"))
    single = docs.groupBy("doc_id").agg(F.count("*").alias("__rows")).where("__rows = 1").select("doc_id")
    cuts = cuts.join(single, "doc_id")
    out = docs.join(cuts.withColumnRenamed("doc_id", "__id"), F.col("doc_id") == F.col("__id"), "left")
    t = F.col(text_col)
    kept = F.aggregate(
        "__cuts", F.struct(F.lit("").alias("s"), F.lit(0).alias("at")),
        lambda a, c: F.struct(F.concat(a["s"], F.substring(t, a["at"] + 1, c["start"] - a["at"])).alias("s"), c["end"].alias("at")),
        lambda a: F.concat(a["s"], F.substring(t, a["at"] + 1, F.length(t))))
    new = F.when(F.col("__cuts").isNull(), t).otherwise(kept)
    cols = [new.alias(c) if c == text_col else F.col(c) for c in docs.columns]
    out = out.select(*cols)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(text_col).isNotNull(), F.length(text_col)).otherwise(F.col("n_chars"))
                             .cast(docs.schema["n_chars"].dataType))
    return out
