"""Token ids in Parquet list columns, in ascending doc_id order.

``write_tokens`` deals the documents into ranges of doc_id (shards), encodes
them in order, and writes one file per shard with Spark's Parquet writer:
``doc_id``, ``shard``, ``seq`` (place in the shard), ``n_tokens`` and the list
column ``ids``.  Row groups and pages have set sizes; pages carry column and
offset indexes; ids are delta-packed (``encoding="delta"``) or
dictionary-coded.  ``read_metadata`` reads only the short columns,
``read_tokens`` only the row groups and pages that hold the asked doc_ids.

Defined cases: a null or empty text is the end id alone; a null doc_id comes
first; rows that repeat a doc_id follow one another in an order that the file
fixes; an empty table gives an empty file; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import text_columns
from .tokens import GROUP, encoder, text_groups

END_ID = 2
SHARD_BYTES = 24 << 20
ROW_GROUP_BYTES, PAGE_BYTES, PAGE_ROWS = 16 << 20, 256 << 10, 2000
FILE = "doc_id bigint, shard int, seq bigint, n_tokens bigint, ids array<int>"


def _encode(path: str, end_id: int):
    def run(batches):
        encode, shard, seq = encoder(path, False), TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            done = 0
            for texts in text_groups(batch.column("text").to_pylist(), GROUP):
                coded = [x + end for x in encode.encode(texts)]
                size = np.array([len(x) // 4 for x in coded], dtype=np.int64)
                ids = np.frombuffer(b"".join(coded), dtype="<i4")
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32)), pa.array(ids))
                n = len(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(done, n), pa.array(np.full(n, shard, np.int32)), pa.array(np.arange(seq, seq + n)), pa.array(size), lists],
                    names=["doc_id", "shard", "seq", "n_tokens", "ids"],
                )
                done += n
                seq += n

    return run


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = END_ID, encoding: str = "delta", shard_bytes: int = SHARD_BYTES) -> None:
    """Encode every text and write the token file at ``path``."""
    rows = text_columns(docs)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ordered = rows.repartitionByRange(max(1, -(-size // shard_bytes)), "doc_id").sortWithinPartitions("doc_id")
    options = {
        "parquet.block.size": ROW_GROUP_BYTES, "parquet.page.size": PAGE_BYTES, "parquet.page.row.count.limit": PAGE_ROWS,
        "parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary": str(encoding == "dictionary").lower(), "compression": "zstd",
    }
    ordered.mapInArrow(_encode(tokenizer_path, end_id), FILE).write.options(**options).parquet(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, shard, seq and n_tokens; the ids are not read."""
    return spark.read.schema(FILE).parquet(path).drop("ids")


def read_tokens(spark: SparkSession, path: str, wanted: Column | None = None) -> DataFrame:
    """Whole rows, of the documents that ``wanted`` (on doc_id) asks for."""
    df = spark.read.schema(FILE).parquet(path)
    return df if wanted is None else df.where(wanted)


def with_start(rows: DataFrame, metadata: DataFrame) -> DataFrame:
    """Adds ``start``: the ids of all documents before this one.

    A running sum within each shard, plus the totals of the shards before it
    (one row per shard), which come from the file's short columns alone.
    """
    before = Window.partitionBy("shard").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    shards = metadata.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    shards = shards.select("shard", F.coalesce(F.sum("total").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    return rows.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).join(shards, "shard").withColumn("start", F.col("start") + F.col("offset")).drop("offset")


def _crc(batches):
    for batch in batches:
        lists = batch.column("ids")
        values, off = lists.values.to_numpy(zero_copy_only=False).astype("<u4"), lists.offsets.to_numpy()
        crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
        columns = {c: batch.column(c) for c in ("doc_id", "shard", "seq", "n_tokens")} | {"ids_crc32": pa.array(crc, pa.int64())}
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def token_report(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a token file: doc_id, start, n_tokens, ids_crc32."""
    rows = read_tokens(spark, path).mapInArrow(_crc, "doc_id bigint, shard int, seq bigint, n_tokens bigint, ids_crc32 bigint")
    return with_start(rows, read_metadata(spark, path)).select("doc_id", "start", "n_tokens", "ids_crc32")
