"""Registered queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package
from ..sources.tables import read_table
from . import decontaminate, k2_treap, language_id, licenses, mixing, ngram_join, periodic, pivot_search, substring_dedup, token_counts, toxicity, weak_supervision, zip_warc
from ._text import crc_remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
# Texts are long: few rows per Arrow batch keep a Python worker's memory small.
ARROW_ROWS = 500
# Rows of an index are megabytes.
ARROW_BYTES = 16 << 20
TOKENIZER_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the splitting pattern that belongs to this vocabulary.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def prepare(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


@register("op1_substring_dedup")
def op1(spark, sf_dir):
    return substring_dedup.repeated_passages(read_table(spark, sf_dir, "documents"))


@register("op2_mix_sources")
def op2(spark, sf_dir):
    return mixing.taken_words(read_table(spark, sf_dir, "documents"))


@register("op3_toxicity")
def op3(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), usable=crc_remainder("doc_id", 5) != 0)
    return toxicity.score(docs, model).select(
        "doc_id", (crc_remainder("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register("op4_license_scan")
def op4(spark, sf_dir):
    return licenses.find_licenses(read_table(spark, sf_dir, "documents"))


@register("op5_quality_rules")
def op5(spark, sf_dir):
    return weak_supervision.judge(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


@register("op6_ngram_jaccard_join")
def op6(spark, sf_dir):
    return ngram_join.near_duplicates(read_table(spark, sf_dir, "documents"), k=4, threshold=85)


@register("op7_language_id")
def op7(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = crc_remainder("doc_id", 3) == 1
    model = language_id.train(docs, ~held)
    return language_id.predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


@register("op8_benchmark_decontamination")
def op8(spark, sf_dir):
    return decontaminate.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@register("op9_warc_zip")
def op9(spark, sf_dir):
    return zip_warc.round_trip(read_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op10_token_counts")
def op10(spark, sf_dir):
    ranks = token_counts.load_ranks(os.environ.get("REVLENS_TOKENIZER", TOKENIZER_PATH))
    return token_counts.count_documents(read_table(spark, sf_dir, "documents"), ranks, SPLIT_PATTERN)


@register("op11_lexical_search", r"""
    WITH d AS (
      SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents
    ), i AS (
      SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
    ), c AS (
      SELECT CAST(count(*) FILTER (len(t) > 0) AS BIGINT) AS n, CAST(sum(len(t)) AS BIGINT) AS l FROM d
    ), p AS (
      SELECT doc_id, len(t) AS n, unnest(t) AS term FROM d
    ), q AS (
      SELECT doc_id, n, term, count(*) AS tf FROM p WHERE term IN (SELECT term FROM i) GROUP BY ALL
    ), w AS (
      SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(c.n) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM q, c GROUP BY term
    ), s AS (
      SELECT i.item_id, q.doc_id,
             CAST(sum(w.w * ((1000000000 * q.tf) // (1000 * q.tf + 20 * (100 - 50 + (50 * q.n * c.n) // c.l)))) AS BIGINT) AS score
      FROM i JOIN q USING (term) JOIN w USING (term), c GROUP BY ALL
    ), r AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0
    )
    SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
""")
def op11(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return k2_treap.rank_documents(docs, read_table(spark, sf_dir, "benchmark"), k=50)


@register("op12_pivot_search", """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e
      FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
      SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id
      WHERE q.vec_id % 100 = 0
    ), r AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
    )
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
""")
def op12(spark, sf_dir):
    vectors = pivot_search.integer_vectors(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
    return pivot_search.top_k(vectors, k=10)


@register("op13_periodic_runs")
def op13(spark, sf_dir):
    """Words of every tenth document are made periodic first; the digests are of the operator's runs and texts."""
    return periodic.run_report(periodic.find_runs(periodic.with_planted_periods(read_table(spark, sf_dir, "documents"))))


def _prepared(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _prepared(v) for k, v in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
