"""K2-treap search against scores of all documents."""
import math
import re
from collections import Counter

import numpy as np
import pytest

from revlens.llm import k2_treap as K
from revlens.llm import queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, item_id string, rank int, terms string"
ITEMS = "item_id long, text string, doc_id long, score int"


@pytest.fixture(scope="module", autouse=True)
def prepared(spark):
    queries.prepare(spark)


def brute(docs, items, k):
    bags = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    n_docs = sum(1 for _, b in bags if b)
    n_terms = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for i, b in bags:
            s = 0
            for t in set(TERM.findall((text or "").translate(LOWER))):
                if b[t]:
                    m = 100 - 50 + (50 * sum(b.values()) * n_docs) // n_terms
                    s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * b[t]) // (1000 * b[t] + 20 * m))
            if s > 0:
                found.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def corpus(n=600, seed=2):
    rng = np.random.default_rng(seed)
    vocabulary = [f"t{j}" for j in range(300)] + ["Éa", "ß", "x_y", "A-b"]
    p = 1 / np.arange(1, len(vocabulary) + 1)
    docs = [(int(i), " ".join(rng.choice(vocabulary, rng.integers(1, 80), p=p / p.sum()))) for i in rng.permutation(n)]
    docs += [(5000 + i, docs[0][1].upper()) for i in range(90)]  # equal scores
    docs += [(7, "t1 t2"), (7, "t1 t2"), (None, docs[0][1]), (None, None), (9000, None), (9001, ""), (9002, " .,; "), (9003, "t5 " * 30_000)]
    items = [(i, " ".join(rng.choice(vocabulary, rng.integers(1, 30)))) for i in range(40)]
    items += [(1, docs[0][1]), (1, "t1"), (1, "t1"), (None, "t2 T2 t2"), (70, None), (71, ""), (72, "unknown"), (73, "t0")]
    return docs, items


@pytest.mark.parametrize("points, columns, block_terms, parts", [(1 << 19, 1 << 12, 1 << 18, 3), (700, 37, 60, 2), (1, 1, 1 << 18, 1)])
def test_ranking_matches_all_scores(spark, points, columns, block_terms, parts):
    docs, items = corpus(600 if points > 1 else 120)
    d = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in docs], DOCS).repartition(parts)
    q = spark.createDataFrame([(i, t, 3, 4) for i, t in items], ITEMS)
    counts = K.corpus_counts(d)
    index = K.build_index(d, counts, points, columns)
    out = K.search(index, q, counts, 20, block_terms)
    assert out.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, out.collect()), key=str) == brute(docs, items, 20)
    assert index.count() >= len([t for _, t in docs if K and TERM.findall(t or "")]) / columns


def test_empty_tables(spark):
    docs, items = corpus(20)
    none, some = spark.createDataFrame([], DOCS), spark.createDataFrame([(i, t, "x", 1, "y") for i, t in docs], DOCS)
    asked, nothing = spark.createDataFrame([(i, t, 3, 4) for i, t in items], ITEMS), spark.createDataFrame([], ITEMS)
    for d, q in ((none, asked), (some, nothing), (none, nothing)):
        assert K.rank_documents(d, q).collect() == []
    blank = spark.createDataFrame([(1, " ", "x", 1, "y"), (2, None, "x", 1, "y")], DOCS)
    assert K.rank_documents(blank, asked).collect() == []


@pytest.mark.parametrize("beam", [1, 3, 64])
def test_paths_that_end_before_a_document(beam):
    """Single queries on a sparse grid: cells are there for other rows only."""
    rng = np.random.default_rng(8)
    n = 300
    points = np.unique(rng.integers(0, n * 500, 900))
    doc, term = points // 500, (points % 500).astype(np.uint64)
    doc = np.unique(doc, return_inverse=True)[1]
    n = doc.max() + 1
    tf, lengths = rng.integers(1, 4, len(doc)), rng.integers(4, 90, n)
    shard = K.Shard(K.make_shard(doc, term, tf, np.arange(n), np.zeros(n, bool), lengths, n, int(lengths.sum())))
    m = 50 + (50 * lengths * n) // lengths.sum()
    for _ in range(60):
        asked = np.unique(rng.choice(term, 3))
        weight = rng.integers(1, 9000, len(asked))
        best = K.Best(1, 7)
        K.descend(shard, np.array([0]), np.array([0, len(asked)]), shard.rows[np.searchsorted(shard.terms, asked)].astype(np.int64), weight, best, beam)
        total = np.zeros(n, np.int64)
        for t, w in zip(asked, weight):
            at = term == t
            np.add.at(total, doc[at], w * K.impacts(tf[at], m[doc[at]]))
        want = sorted((-s, i) for i, s in enumerate(total.tolist()) if s)[:7]
        assert [(-s, i) for s, i in zip(best.score.tolist(), best.id.tolist())] == want


def test_bounds_stop_the_descent():
    """Documents far below the best ones are not opened one by one."""
    rng = np.random.default_rng(1)
    n = 4096
    doc = np.repeat(np.arange(n), 2)
    term = np.tile(np.array([3, 9], np.uint64), n)
    tf = np.ones(2 * n, np.int64)
    tf[2 * rng.permutation(n)[:60]] = 50
    raw = K.make_shard(doc, term, tf, np.arange(n), np.zeros(n, bool), np.full(n, 60), 10 * n, 600 * n)
    best = K.Best(1, 50)
    halved = K.descend(K.Shard(raw), np.array([0]), np.array([0, 2]), K.Shard(raw).rows.astype(np.int64), np.array([5000, 10]), best, beam=4)
    assert len(best.score) == 50 and best.score.min() == best.score.max() and halved < n // 3


def test_shards_of_a_task_are_written_and_read_one_by_one(spark):
    """A task of many shards keeps none of them: each is a row group of its own."""
    from urllib.parse import unquote, urlparse

    import pyarrow.parquet as pq
    docs, _ = corpus(200)
    d = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in docs], DOCS).coalesce(1)
    index = K.build_index(d, K.corpus_counts(d), 700, 37)
    groups = [m.row_group(i).num_rows for f in index.inputFiles() for m in [pq.ParquetFile(unquote(urlparse(f).path)).metadata] for i in range(m.num_row_groups)]
    assert len(groups) == index.count() > 8 and set(groups) == {1}


@pytest.mark.parametrize("group_paths", [1, 7, 300])
def test_groups_of_queries_do_not_change_the_ranking(spark, group_paths):
    docs, items = corpus(150)
    d = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in docs], DOCS)
    q = spark.createDataFrame([(i, t, 3, 4) for i, t in items], ITEMS)
    counts = K.corpus_counts(d)
    out = K.search(K.build_index(d, counts, 700, 37), q, counts, 20, group_paths=group_paths)
    assert sorted(map(tuple, out.collect()), key=str) == brute(docs, items, 20)
