"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read back.

1. toxicity: documents that the classifier rejects go;
2. n-gram Jaccard join: one document of each group of near copies stays;
3. substring dedup: passages that an earlier document holds are cut out;
4. benchmark decontamination: documents that hold a test item go;
5. mixing: the documents of all sources, repeated to their target weights.

All stages but the last return the columns of ``documents``; the last adds
``mix_shard``, ``mix_copy`` and ``mix_order``.

Defined results: every stage takes empty tables, null columns and repeated
rows as its operator's docstring says; documents with a null id are never
near copies of others and pass the filters on their own text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from revlens.llm import decontaminate, mixing, ngram_join, substring_dedup, toxicity
from revlens.llm._stage import stage
from revlens.llm.queries import prepare
from revlens.sources.tables import read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The model learns from the labelled documents of this input."""
    prepare(spark)
    return toxicity.drop_toxic(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component the document with the smallest id stays (five-word shingles, similarity 0.8)."""
    prepare(spark)
    return ngram_join.one_per_component(docs, ngram_join.near_duplicates(docs, k=5, threshold=80))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return substring_dedup.cut_passages(docs, substring_dedup.repeated_passages(docs))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontaminate.drop_leaks(docs, decontaminate.leaks(docs, read_table(spark, sf_dir, "benchmark")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mixed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("benchmark_decontamination", drop_benchmark),
    ("mix_sources", mix_sources),
]

# A learned model and rolling hashes have no SQL.  The operators are tested one by one in
# tests/llm, the whole chain there on planted toxic, copied, repeated and benchmark rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of ``documents`` after all stages."""
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
