"""Token counts through a digest cache.

A count is stored under (digest of the tokenizer's file and library version,
digest of the normalised content). Documents are reduced to digests before any
shuffle; only digests that the cache lacks are encoded, each once, and the new
counts are appended to the cache, a Parquet table that Spark writes and reads.
A rerun after a failure finds what was appended; equal counts appended twice are
one on reading.

Normalisation maps null to the empty text and nothing else, as any change of a
text may change its count.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable, Iterator
from importlib.metadata import version

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from runloom.llm.common import arrow_batches, arrow_map, require
from runloom.llm.packing import encoder
from runloom.session import shared_dir, written

LIMIT = 512
#: Characters that the library encodes at once; its encodings take a hundred times that.
PART_CHARS = 1 << 16
CACHE_SCHEMA = "tokenizer string, digest string, n_tokens long"


def counter(path: str) -> Callable[[list[str]], list[int]]:
    """The library's count for each text: tokenizers for .json, sentencepiece for .model; no special tokens are added.

    A plain byte-level BPE file is run by its ranks, as ``packing.encoder``
    does, which gives the library's ids in a fifth of its time.
    """
    if path.endswith(".json"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = encoder(path)
        return lambda texts: [len(encode(t)) for t in texts]
    if path.endswith(".model"):
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in p.encode(texts, num_threads=1)]
    raise ValueError("a tokenizer file ends in .json or .model")


def tokenizer_version(path: str) -> str:
    """Digest of the file's bytes, of the libraries that may run it with their versions, and of the pattern of the ranks."""
    import public_tokenizers

    libraries = ("tokenizers", "tiktoken") if path.endswith(".json") else ("sentencepiece",)
    said = "".join(f"|{x}|{version(x)}" for x in libraries) + (f"|{public_tokenizers.PATTERN}" if path.endswith(".json") else "")
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + said.encode()).hexdigest()


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches:
            counts: list[int] = []
            part, size = [], 0
            for text in batch.column(1).to_pylist():
                if part and size + len(text) > PART_CHARS:
                    counts += count(part)
                    part, size = [], 0
                part.append(text)
                size += len(text)
            counts += count(part)
            yield pa.record_batch([batch.column(0), pa.array(counts, pa.int64())], names=["digest", "n_tokens"])

    return run


def read_cache(spark: SparkSession, cache: str) -> DataFrame:
    """The stored counts; a cache that does not exist yet is empty."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(cache)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(cache)


def count_tokens(docs: DataFrame, path: str, cache: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_bytes, n_tokens)``, one row for each input row, and the cache at ``cache`` extended.

    Null text counts as empty; special strings inside texts are handled as the
    library does by default; null ids and repeated rows stay, and equal texts are
    encoded once, in repeated rows too: copies meet in a partial aggregate before
    the shuffle. Other columns are not read. An empty table gives an empty result
    and leaves the cache as it is.
    """
    require(docs, id_col, text_col)
    spark = docs.sparkSession
    arrow_batches(spark)
    key = tokenizer_version(path)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")).withColumn("digest", F.sha2("text", 256))
    known = read_cache(spark, cache).filter(F.col("tokenizer") == key).select("digest")
    misses = rows.groupBy("digest").agg(F.first("text").alias("text")).join(known, "digest", "left_anti")
    counted = misses.transform(arrow_map, _count(path), "digest string, n_tokens long")
    counted.select(F.lit(key).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache)
    # Written, so that the join is between plain exchanges, whose hot partitions Spark splits.
    stored = written(read_cache(spark, cache).filter(F.col("tokenizer") == key).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))
    return rows.select("id", "digest", F.octet_length("text").cast("long").alias("n_bytes")).join(stored, "digest").select(F.col("id").alias(id_col), "n_bytes", "n_tokens")


def op7_token_counts(spark, sf_dir):
    """Bytes and tokens of every document by the 50k byte-level tokenizer; the cache is new for each call."""
    import public_tokenizers

    cache = f"{shared_dir(spark).rstrip('/')}/token-counts-{uuid.uuid4().hex}"
    counts = count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"), cache)
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)
