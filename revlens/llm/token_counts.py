"""Token counts by separator scan over flat, unindexed token files.

A token file is nothing but little-endian 16-bit identifiers; every document
ends with the end-of-document identifier.  A scan knows neither where
documents begin nor how many there are: each block of a file is searched for
the separator with one vectorised comparison, and a prefix scan over the
blocks of a file (a window in block order) gives every block the place of the
last separator before it and the number of documents before it, so documents
that cross blocks are stitched without reading anything twice.

Files are written and read through pyarrow file systems, so any store with a
URI works.  A file is listed only by the task that finished it; pieces of lost
tasks are never read.

Defined results: a null or empty text is a document of no token; tokens after
the last separator of a file form one more, unterminated document; an empty
file has no document; a file whose size is odd is an error; repeated rows and
extra columns are kept apart by their place in the file.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._stage import shared_path, stage

WIDTH = np.dtype("<u2")
SEPARATOR = 50256
FILE_TOKENS = 1 << 25
BLOCK_TOKENS = 1 << 21


def open_store(uri: str):
    """pyarrow file system and path of a URI or local path."""
    from pyarrow import fs
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def load_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _encoding(data: bytes, pattern: str):
    import base64

    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}
    return tiktoken.Encoding("flat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def write_token_files(docs: DataFrame, folder: str, ranks: bytes, pattern: str, separator: int = SEPARATOR,
                      file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Tokenise whole texts into flat files; returns the places ``file, ordinal, doc_id`` (written).

    ``ranks`` is a vocabulary file's content (fixed size), sent to each task.
    """
    sent = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches):
        enc = _encoding(sent.value, pattern)
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        out, name, tokens, ids = None, None, 0, []

        def finished():
            nonlocal out
            out.close()
            out = None
            return pa.RecordBatch.from_arrays(
                [pa.array([name] * len(ids), pa.string()), pa.array(range(len(ids)), pa.int64()), pa.array(ids, pa.int64())],
                ["file", "ordinal", "doc_id"])

        for batch in batches:
            for d, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if out is None:
                    name, tokens, ids = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.bin", 0, []
                    out = store.open_output_stream(f"{root.rstrip('/')}/{name.rsplit('/', 1)[1]}")
                row = np.array([*enc.encode_ordinary(text or ""), separator], WIDTH)
                out.write(row.tobytes())
                tokens += len(row)
                ids.append(d)
                if tokens >= file_tokens:
                    yield finished()
        if out is not None:
            yield finished()

    places = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "file string, ordinal long, doc_id long")
    return stage(places, "token-places")


def list_blocks(spark: SparkSession, files: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``file, block, first, n`` (in tokens) for every block of every listed file, from its size alone."""
    def run(batches):
        for batch in batches:
            for f in batch.column("file").to_pylist():
                store, path = open_store(f)
                size = store.get_file_info(path).size
                if size is None or size % WIDTH.itemsize:
                    raise ValueError(f"{f}: {size} bytes is no whole number of tokens")
                n = size // WIDTH.itemsize
                first = np.arange(0, n, block_tokens)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f] * len(first), pa.string()), pa.array(range(len(first)), pa.int64()),
                     pa.array(first, pa.int64()), pa.array(np.minimum(block_tokens, n - first), pa.int64())],
                    ["file", "block", "first", "n"])

    return files.select("file").distinct().mapInArrow(run, "file string, block long, first long, n long")


def scan_blocks(blocks: DataFrame, separator: int = SEPARATOR) -> DataFrame:
    """Adds ``ends``: places (in the file) of all separators of the block."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                f, first, n = (batch.column(c)[i].as_py() for c in ("file", "first", "n"))
                store, path = open_store(f)
                with store.open_input_file(path) as src:
                    src.seek(first * WIDTH.itemsize)
                    tokens = np.frombuffer(src.read(n * WIDTH.itemsize), WIDTH)
                ends = np.flatnonzero(tokens == separator) + first
                yield pa.RecordBatch.from_arrays([*batch.slice(i, 1).columns, pa.array([ends], pa.list_(pa.int64()))],
                                                 [*batch.schema.names, "ends"])

    return blocks.mapInArrow(run, "file string, block long, first long, n long, ends array<long>")


def documents(scanned: DataFrame) -> DataFrame:
    """``file, ordinal, start, n_tokens, terminated``: blocks stitched by a prefix scan, then one row per document."""
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy("file")
    s = (scanned.withColumn("prior", F.coalesce(F.max(F.array_max("ends")).over(before), F.lit(-1)))
         .withColumn("nth", F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)))
         .withColumn("is_last", F.col("block") == F.max("block").over(whole))
         .withColumn("stop", F.col("first") + F.col("n")))
    # the file's end closes a document without separator
    open_end = F.col("is_last") & (F.coalesce(F.array_max("ends"), F.col("prior")) < F.col("stop") - 1)
    s = s.withColumn("all_ends", F.when(open_end, F.concat("ends", F.array("stop"))).otherwise(F.col("ends")))
    d = s.select("file", "nth", "prior", "stop", "is_last", "all_ends", F.posexplode("all_ends").alias("i", "end"))
    start = F.when(F.col("i") == 0, F.col("prior")).otherwise(F.get("all_ends", F.col("i") - 1)) + 1
    return d.select("file", (F.col("nth") + F.col("i")).alias("ordinal"), start.alias("start"),
                    (F.col("end") - start).alias("n_tokens"), (F.col("end") < F.col("stop")).alias("terminated"))


def count_documents(docs: DataFrame, ranks: bytes, pattern: str, separator: int = SEPARATOR,
                    block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Round trip of a table: ``doc_id, n_tokens`` from the flat files written of it."""
    spark = docs.sparkSession
    places = write_token_files(docs, shared_path(spark, "tokens"), ranks, pattern, separator)
    blocks = stage(list_blocks(spark, places, block_tokens), "token-blocks")
    spread = blocks.repartition(spark.sparkContext.defaultParallelism, "file", "block")
    counted = documents(scan_blocks(spread, separator))
    # both sides grow with the corpus: never broadcast one on the size of its compressed files
    return places.join(counted.hint("merge"), ["file", "ordinal"], "left").select("doc_id", "n_tokens", "file", "ordinal", "start")
