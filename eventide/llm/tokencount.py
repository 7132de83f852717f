"""Token counts by a digest cache.

The cache is a Parquet folder of (version, digest, n_tokens).  ``version`` is
the digest of the vocabulary file and the library's version; ``digest`` that
of the content with each run of ASCII white space as one space and none at
the ends, which changes no count of a vocabulary that drops white space
(``squeeze=False`` for others).  Counting joins the documents' digests to the
cache, encodes each distinct content that it lacks once, appends the new
counts, and reads all counts from the cache.

Copies are combined before the shuffle, so a text that holds a third of all
rows crosses it once per task.

Defined cases: a null text counts as an empty one (0 tokens); repeated rows
each get their row; an empty table adds nothing; other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, text_columns
from .tokens import GROUP, encoder, text_groups

LIMIT = 2048
CACHE = "version string, digest binary, n_tokens bigint"


def tokenizer_version(path: str) -> str:
    """Digest of a vocabulary file's bytes and of the library's version."""
    import tokenizers

    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + tokenizers.__version__.encode()).hexdigest()


def normalised(text: Column, squeeze: bool = True) -> Column:
    text = F.coalesce(text, F.lit(""))
    return F.trim(F.regexp_replace(text, r"[ \t\n\x0B\f\r]+", " ")) if squeeze else text


def digest(content: Column) -> Column:
    return F.unhex(F.sha2(content.cast("binary"), 256))


def read_cache(spark: SparkSession, path: str, version: str) -> DataFrame:
    """The cache's counts for one version (one row per digest, also after appends that met); empty if there is none yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    cache = spark.read.schema(CACHE).parquet(path) if there else spark.createDataFrame([], CACHE)
    return cache.where(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _count(path: str):
    def run(batches):
        count = encoder(path, True)
        for batch in batches:
            sizes = [n for run in text_groups(batch.column("content").to_pylist(), GROUP) for n in count.encode(run)]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(sizes, pa.int64())], names=["digest", "n_tokens"])

    return run


def fill_cache(docs: DataFrame, tokenizer_path: str, cache_path: str, squeeze: bool = True) -> None:
    """Append the counts of all contents of ``docs`` that the cache lacks."""
    version = tokenizer_version(tokenizer_path)
    content = text_columns(docs).select(normalised(F.col("text"), squeeze).alias("content"))
    distinct = content.select(digest(F.col("content")).alias("digest"), "content").groupBy("digest").agg(F.first("content").alias("content"))
    misses = distinct.join(read_cache(docs.sparkSession, cache_path, version).select("digest"), "digest", "left_anti")
    counts = misses.mapInArrow(_count(tokenizer_path), "digest binary, n_tokens bigint")
    counts.select(F.lit(version).alias("version"), "digest", "n_tokens").write.mode("append").parquet(cache_path)


def token_counts(docs: DataFrame, tokenizer_path: str, cache_path: str, squeeze: bool = True) -> DataFrame:
    """Per document: doc_id, n_bytes (UTF-8), n_tokens, by way of the cache."""
    fill_cache(docs, tokenizer_path, cache_path, squeeze)
    # written apart, so that the join below it can split the rows of a frequent text
    cache = materialize(read_cache(docs.sparkSession, cache_path, tokenizer_version(tokenizer_path)), "counts")
    rows = text_columns(docs).select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"), digest(normalised(F.col("text"), squeeze)).alias("digest"))
    return rows.join(cache, "digest").select("doc_id", "n_bytes", "n_tokens")
