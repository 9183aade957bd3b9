"""Ranked lexical search with K2-treaps over the term-document grid.

The index is a written table of shards.  Terms are runs of letters and
digits of ASCII (lower-cased) and of all characters beyond it.  A shard is a run of documents of one
input partition (about ``SHARD_POINTS`` term-document pairs, ``SHARD_DOCS``
documents at most) and holds their grid: rows are terms (64-bit hashes) from the
most to the least frequent, columns are the documents, like ones side by side
(by most frequent term, then length).  The grid is cut into squares as wide as the
shard has columns; each is a quadtree in level order: four bits a cell for its
non-empty quarters, whose ranks lead to the children, and the greatest impact in
the cell, rounded up to 16 bits.  The leaves are the pairs and hold the term's
occurrences.  Cells without a pair cost nothing.  The impact of a pair is the
part of its score that does not depend on the query.

A query's row paths descend jointly.  A state is a range of columns together with
the cells that hold it in the rows of all the query's terms; the sum of weight
times greatest impact bounds the score of each of its documents.  Best states
first (``BEAM`` at a time for each query, a group of queries in one sweep of
arrays), a state is halved and each path goes down to the quarter of its row; a
single column gives the exact score.  States below the k-th best score known to the
task are dropped; equal ones stay for the tie by id.  A task keeps k rows
per query over all its shards, then the tasks' rows are ranked by query.

Counts (documents with a term, all terms, documents of each term) cover all
documents.  Queries are taken in blocks of about ``BLOCK_TERMS`` terms; one block is
sent to each task, so its size is bounded whatever the number of queries.
Memory follows one shard and, when building, one block of a megabyte of text (one
text at least); shards are written and read one by one, and queries search a shard in
groups of about ``GROUP_PATHS`` paths.

Defined results: a null or empty text has no terms and is never found; a query
without terms gives no rows; every query row is ranked on its own, also where ids
repeat or are null; repeated document rows are ranked row by row; a
null doc_id comes after equal scores with ids; other columns are not read;
empty tables give no rows.  Two terms are one where their 64-bit hashes agree.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ._stage import stage
from ._text import IS_ALNUM, find_words, hash_words, text_blocks

SHARD_POINTS = 1 << 19
SHARD_DOCS = 1 << 12
BLOCK_TERMS = 1 << 18
GROUP_PATHS = 1 << 11
BEAM = 64
STEP = 16  # an impact is below 10**6, so its sixteenth fits 16 bits
_POP = np.array([bin(i).count("1") for i in range(16)], np.uint8)
# children before quarter q of a cell with mask m
_BEFORE = np.array([[_POP[m & ((1 << q) - 1)] for q in range(4)] for m in range(16)], np.uint8)


def corpus_counts(docs: DataFrame) -> tuple[int, int]:
    """Documents with a term, and terms with repeats."""
    def run(batches):
        docs_with, terms = 0, 0
        for batch in batches:
            for _, buf, off in text_blocks(batch.column("text")):
                rows = find_words(buf, off, IS_ALNUM)[2]
                docs_with, terms = docs_with + len(np.unique(rows)), terms + len(rows)
        yield pa.RecordBatch.from_arrays([pa.array([docs_with], pa.int64()), pa.array([terms], pa.int64())], ["d", "l"])

    r = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "d long, l long").agg(F.sum("d").alias("d"), F.sum("l").alias("l")).first()
    return int(r.d or 0), int(r.l or 0)


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of ``x`` (below 2**24) at even places."""
    x = x.astype(np.uint64)
    for s, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(s))) & np.uint64(mask)
    return x


def _least_type(a: np.ndarray) -> np.ndarray:
    top = int(a.max(initial=0))
    return a.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4")


def make_shard(doc: np.ndarray, term: np.ndarray, tf: np.ndarray, ids: np.ndarray, no_id: np.ndarray, n_terms: np.ndarray,
               n_docs_all: int, n_terms_all: int) -> dict:
    """One shard of the points ``(document place, term hash, occurrences)``."""
    terms, row, df = np.unique(term, return_inverse=True, return_counts=True)
    row_of = np.empty(len(terms), np.int64)
    row_of[np.argsort(-df, kind="stable")] = np.arange(len(terms))
    row = row_of[row]
    # like documents side by side
    main = np.zeros(len(ids), np.int64)
    np.maximum.at(main, doc, (tf << 32) - row)
    main = -main & 0xFFFFFFFF
    order = np.lexsort((n_terms, main))
    col_of = np.empty(len(ids), np.int64)
    col_of[order] = np.arange(len(ids))
    ids, no_id, n_terms, col = ids[order], no_id[order], n_terms[order], col_of[doc]
    m = 100 - 50 + (50 * n_terms * n_docs_all) // n_terms_all
    bits = max(1, int(len(ids) - 1).bit_length())
    side = 1 << bits
    code = ((row >> bits).astype(np.uint64) << np.uint64(2 * bits)) | (_spread(row & (side - 1)) << np.uint64(1)) | _spread(col)
    order = np.argsort(code)
    code, tf = code[order], tf[order]
    top = -(-impacts(tf, m[col[order]]) // STEP)
    masks, tops, sizes = [], [top.astype("<u2")], [len(code)]
    for _ in range(bits):
        parent = code >> np.uint64(2)
        first = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
        masks.append(np.bitwise_or.reduceat(np.uint8(1) << (code & np.uint64(3)).astype(np.uint8), first))
        top = np.maximum.reduceat(top, first)
        tops.append(top.astype("<u2"))
        sizes.append(len(first))
        code = parent[first]
    occurrences = _least_type(tf)
    return {"n_docs": len(ids), "n_points": len(tf), "ids": ids.astype("<i8").tobytes(), "no_id": no_id.tobytes(),
            "m": m.astype("<i8").tobytes(), "terms": terms.astype("<u8").tobytes(), "df": df.astype("<i4").tobytes(),
            "rows": row_of.astype("<i4").tobytes(), "sizes": sizes[::-1], "masks": np.concatenate(masks[::-1]).tobytes(),
            # the leaves have their occurrences instead
            "tops": np.concatenate(tops[:0:-1]).tobytes(), "occurrences": occurrences.tobytes(), "width": occurrences.itemsize}


_SCHEMA = pa.schema([("n_docs", pa.int64()), ("n_points", pa.int64()), ("ids", pa.binary()), ("no_id", pa.binary()), ("m", pa.binary()),
                     ("terms", pa.binary()), ("df", pa.binary()), ("rows", pa.binary()), ("sizes", pa.list_(pa.int64())),
                     ("masks", pa.binary()), ("tops", pa.binary()), ("occurrences", pa.binary()), ("width", pa.int32())])
_SQL = ("n_docs long, n_points long, ids binary, no_id binary, m binary, terms binary, df binary, rows binary, sizes array<long>, "
        "masks binary, tops binary, occurrences binary, width int")


def build_index(docs: DataFrame, counts: tuple[int, int], shard_points: int = SHARD_POINTS, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """The written table of shards of ``docs(doc_id, text)``."""
    n_docs_all, n_terms_all = counts

    def run(batches):
        held, n_points, n_docs = [], 0, 0

        def finished():
            nonlocal held, n_points, n_docs
            shard = make_shard(*(np.concatenate([h[i] for h in held]) for i in range(6)), n_docs_all, n_terms_all)
            held, n_points, n_docs = [], 0, 0
            return pa.RecordBatch.from_pylist([shard], _SCHEMA)

        for batch in batches:
            given = batch.column("doc_id")
            no_id = given.is_null().to_numpy(zero_copy_only=False)
            ids = given.fill_null(0).to_numpy(zero_copy_only=False)
            for lo, buf, off in text_blocks(batch.column("text")):
                starts, ends, rows = find_words(buf, off, IS_ALNUM)
                if not len(starts):
                    continue
                words, term = np.unique(hash_words(buf, starts, ends), return_inverse=True)
                pairs, tf = np.unique(rows * len(words) + term, return_counts=True)
                doc, term = pairs // len(words), words[pairs % len(words)]
                n_terms = np.bincount(rows, minlength=len(off) - 1)
                place = np.cumsum(n_terms > 0) - 1
                own = np.flatnonzero(n_terms)
                # blocks go to shards in pieces of whole documents
                cuts = np.append(np.flatnonzero(np.append(True, doc[1:] != doc[:-1])), len(doc))
                at = 0
                while at < len(own):
                    room = max(1, shard_docs - n_docs)
                    to = min(len(own), at + room, max(at + 1, int(np.searchsorted(cuts, cuts[at] + shard_points - n_points, "right")) - 1))
                    a, b = cuts[at], cuts[to]
                    here = own[at:to]
                    held.append((place[doc[a:b]] - at + n_docs, term[a:b], tf[a:b], ids[lo + here], no_id[lo + here], n_terms[here]))
                    n_points, n_docs, at = n_points + b - a, n_docs + to - at, to
                    if n_points >= shard_points or n_docs >= shard_docs or at < len(own):
                        yield finished()
        if held:
            yield finished()

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stage(d.mapInArrow(run, _SQL), "k2-treap", large_rows=True)


def _rows(batch: pa.RecordBatch):
    """The rows of a batch of shards, one at a time; their bytes are not copied."""
    for i in range(batch.num_rows):
        row = ((name, batch.column(name)[i]) for name in batch.schema.names)
        yield {name: v.as_buffer() if isinstance(v, (pa.BinaryScalar, pa.LargeBinaryScalar)) else v.as_py() for name, v in row}


class Shard:
    """A shard's arrays with the ranks worked out; cells of all levels are numbered through."""

    def __init__(self, r: dict):
        sizes = np.array(r["sizes"])
        self.bits = len(sizes) - 1
        self.base = np.append(0, np.cumsum(sizes))
        self.ids, self.m = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["m"], "<i8")
        self.no_id = np.frombuffer(r["no_id"], bool)
        self.terms, self.rows = np.frombuffer(r["terms"], "<u8"), np.frombuffer(r["rows"], "<i4")
        self.masks, self.tops = np.frombuffer(r["masks"], np.uint8), np.frombuffer(r["tops"], "<u2")
        self.occurrences = np.frombuffer(r["occurrences"], f"<u{r['width']}")
        n = _POP[self.masks]
        self.first = np.cumsum(n, dtype=np.int64)
        self.first -= n
        self.first += self.base[1]


class Best:
    """The k best ``(score, document)`` of each query so far."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.query, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.no_id = np.zeros(0, bool)
        self.least = np.ones(n, np.int64)  # scores above 0 count

    def add(self, query, score, ids, no_id):
        fit = score >= self.least[query]
        if not fit.any():
            return
        q, s, i, z = (np.concatenate([a, b[fit]]) for a, b in ((self.query, query), (self.score, score), (self.id, ids), (self.no_id, no_id)))
        order = np.lexsort((i, z, -s, q))
        q, s, i, z = q[order], s[order], i[order], z[order]
        nth = np.arange(len(q)) - np.searchsorted(q, q)
        keep = nth < self.k
        self.query, self.score, self.id, self.no_id = q[keep], s[keep], i[keep], z[keep]
        full = nth == self.k - 1
        self.least[q[full]] = s[full]


def _pieces(ptr: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the entries of the chosen pieces, and for each its place in ``chosen``."""
    n = ptr[chosen + 1] - ptr[chosen]
    of = np.repeat(np.arange(len(chosen)), n)
    return np.repeat(ptr[chosen] - (np.cumsum(n) - n), n) + np.arange(len(of)), of


def descend(shard: Shard, queries: np.ndarray, ptr: np.ndarray, row: np.ndarray, weight: np.ndarray, best: Best, beam: int = BEAM) -> int:
    """Add the shard's documents to ``best``; returns the number of states that were halved.

    Query ``queries[i]`` has the rows ``row[ptr[i]:ptr[i + 1]]`` with positive weights.
    """
    bits, halved = shard.bits, 0
    side = (1 << bits) - 1
    query, col, level = queries, np.zeros(len(queries), np.int64), np.zeros(len(queries), np.int64)
    node, row = (row >> bits).astype(np.int64), row & side
    bound = np.add.reduceat(weight * STEP * shard.tops[node].astype(np.int64), ptr[:-1]) if len(queries) else np.zeros(0, np.int64)
    while len(query):
        order = np.lexsort((-bound, query))
        nth = np.empty(len(order), np.int64)
        q = query[order]
        nth[order] = np.arange(len(q)) - np.searchsorted(q, q)
        now, later = np.flatnonzero(nth < beam), np.flatnonzero(nth >= beam)
        halved += len(now)
        at, of = _pieces(ptr, now)
        lev = level[now]
        n, r, w = node[at], row[at], weight[at]
        mask, high = shard.masks[n], (r >> (bits - 1 - lev[of])) & 1
        parts = []
        for half in (0, 1):
            quarter = 2 * high + half
            has = np.flatnonzero((mask >> quarter.astype(np.uint8)) & 1)
            parts.append((2 * of[has] + half, shard.first[n[has]] + _BEFORE[mask[has], quarter[has]], r[has], w[has]))
        state, child, r, w = (np.concatenate(p) for p in zip(*parts))
        order = np.argsort(state, kind="stable")
        state, child, r, w = state[order], child[order], r[order], w[order]
        # every path may have ended: a cell can be there for its other rows
        begin = np.flatnonzero(np.append(True, state[1:] != state[:-1])[:len(state)])
        size = np.diff(np.append(begin, len(state)))
        s = state[begin]
        new_query, new_level, new_col = query[now][s >> 1], lev[s >> 1] + 1, 2 * col[now][s >> 1] + (s & 1)
        leaf = new_level == bits
        value = np.empty(len(child), np.int64)
        at_leaf = np.repeat(leaf, size)
        column = np.repeat(new_col, size)[at_leaf]
        value[at_leaf] = impacts(shard.occurrences[child[at_leaf] - shard.base[bits]].astype(np.int64), shard.m[column])
        value[~at_leaf] = STEP * shard.tops[child[~at_leaf]].astype(np.int64)
        total = np.add.reduceat(value * w, begin)
        best.add(new_query[leaf], total[leaf], shard.ids[new_col[leaf]], shard.no_id[new_col[leaf]])
        # what stays: states not yet halved and inner ones, not below the k-th best score
        later = later[bound[later] >= best.least[query[later]]]
        inner = np.flatnonzero(~leaf & (total >= best.least[new_query]))
        old, _ = _pieces(ptr, later)
        new, _ = _pieces(np.append(begin, len(state)), inner)
        sizes = np.concatenate([ptr[later + 1] - ptr[later], size[inner]])
        query, col, level, bound = (np.concatenate([a[later], b[inner]]) for a, b in (
            (query, new_query), (col, new_col), (level, new_level), (bound, total)))
        node, row, weight = (np.concatenate([a[old], b[new]]) for a, b in ((node, child), (row, r), (weight, w)))
        ptr = np.append(0, np.cumsum(sizes))
    return halved


def query_terms(items: DataFrame) -> DataFrame:
    """The written table ``item_id, n_terms, terms`` (distinct hashes) of the queries that have terms."""
    def run(batches):
        for batch in batches:
            ids = batch.column("item_id")
            for lo, buf, off in text_blocks(batch.column("text")):
                starts, ends, rows = find_words(buf, off, IS_ALNUM)
                h = hash_words(buf, starts, ends)
                cut = np.searchsorted(rows, np.arange(len(off)))
                terms = [np.unique(h[a:b]) for a, b in zip(cut[:-1], cut[1:])]
                yield pa.RecordBatch.from_arrays([ids.slice(lo, len(terms)), pa.array([len(t) for t in terms], pa.int64()),
                                                  pa.array([t.tobytes() for t in terms], pa.binary())], ["item_id", "n_terms", "terms"])

    given = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return stage(given.mapInArrow(run, "item_id long, n_terms long, terms binary").where("n_terms > 0"), "k2-queries")


def _frequencies(index: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """Documents that hold each term of the (sorted) vocabulary of one query block."""
    sent = index.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        known = sent.value
        total = np.zeros(len(known), np.int64)
        for b in batches:
            for r in _rows(b):
                terms, df = np.frombuffer(r["terms"], "<u8"), np.frombuffer(r["df"], "<i4")
                at = np.minimum(np.searchsorted(terms, known), len(terms) - 1)
                total += np.where(terms[at] == known, df[at], 0)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["term", "df"])

    out = np.zeros(len(vocabulary), np.int64)
    for term, df in index.select("terms", "df").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df")).collect():
        out[term] = df
    return out


def _search_block(index: DataFrame, rows: list, counts: tuple[int, int], k: int, first_item: int, group_paths: int) -> DataFrame:
    """At most k rows per query and task: ``item, item_id, doc_id, score``."""
    ids = [r.item_id for r in rows]
    terms = [np.frombuffer(r.terms, "<u8") for r in rows]
    vocabulary, of = np.unique(np.concatenate(terms), return_inverse=True)
    df = _frequencies(index, vocabulary)
    weight = np.array([math.floor(1000 * math.log((2 * counts[0] + 2) / (2 * int(n) + 1))) for n in df], np.int64)
    ptr = np.append(0, np.cumsum([len(t) for t in terms]))
    sent = index.sparkSession.sparkContext.broadcast((vocabulary, weight, ptr, of.astype(np.int64), ids))

    def run(batches):
        vocabulary, weight, ptr, of, ids = sent.value
        best = Best(len(ids), k)
        item = np.repeat(np.arange(len(ids)), np.diff(ptr))
        for b in batches:
            for r in _rows(b):
                shard = Shard(r)
                at = np.minimum(np.searchsorted(shard.terms, vocabulary), len(shard.terms) - 1)
                row = np.where((shard.terms[at] == vocabulary) & (weight > 0), shard.rows[at], -1)
                here = np.flatnonzero(row[of] >= 0)
                a, asked = 0, item[here]
                while a < len(here):
                    # whole queries, about group_paths paths: a sweep of the beam holds BEAM times as many
                    z = int(np.searchsorted(asked, asked[min(a + group_paths, len(here)) - 1], "right"))
                    own, a = here[a:z], z
                    queries, begin = np.unique(item[own], return_index=True)
                    descend(shard, queries, np.append(begin, len(own)), row[of[own]].astype(np.int64), weight[of[own]], best)
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.query + first_item), pa.array([ids[q] for q in best.query], pa.int64()),
             pa.array(best.id, mask=best.no_id), pa.array(best.score)], ["item", "item_id", "doc_id", "score"])

    cols = ["ids", "no_id", "m", "terms", "rows", "sizes", "masks", "tops", "occurrences", "width"]
    return index.select(*cols).mapInArrow(run, "item long, item_id long, doc_id long, score long")


def search(index: DataFrame, items: DataFrame, counts: tuple[int, int], k: int = 50, block_terms: int = BLOCK_TERMS,
           group_paths: int = GROUP_PATHS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of each query."""
    spark = index.sparkSession
    asked = query_terms(items)
    total, n_items = asked.agg(F.sum("n_terms"), F.count("*")).first()
    out, done = spark.createDataFrame([], "item long, item_id long, doc_id long, score long"), 0
    blocks = -(-(total or 0) // block_terms)
    for i in range(blocks):
        # blocks by hash: about block_terms terms each, one at a time on the driver
        rows = asked.where(F.pmod(F.xxhash64("terms"), F.lit(blocks)) == i).collect()
        if rows and counts[0]:
            out = out.unionByName(_search_block(index, rows, counts, k, done, group_paths))
            done += len(rows)
    w = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """Index all documents and rank them for every item."""
    counts = corpus_counts(docs)
    return search(build_index(docs, counts), items, counts, k)
