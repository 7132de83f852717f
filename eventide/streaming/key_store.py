"""Consumer-side idempotency against an unbounded store of keys.

Keys are kept in buckets, in layers as in ``layers``; each layer of a bucket
has Bloom filter pages of its own (PAGE_BITS bits, all bits of a key in one
page).  A micro-batch's keys are tested against the pages first, and only the
files that may hold one of them are read to confirm it.  No horizon: a replay
of any age is found, and none passes as new.

``consume`` writes the first row of every new key to ``accepted`` and then
commits its keys, so a crash in between gives the same rows again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import dedup_first_seen
from .layers import LAYER, PART, LayeredTable

#: bits of a page (positions fit 16 bits with a sign); bits per key, and of them set for each
PAGE_BITS, KEY_BITS, HASHES = 32_768, 32, 8


def _page(key: list[str], pages: Column) -> Column:
    return F.pmod(F.xxhash64(*key, F.lit("page")), pages)


def _bits(key: list[str]) -> Column:
    return F.array(*(F.pmod(F.xxhash64(*key, F.lit(k)), F.lit(PAGE_BITS)) for k in range(HASHES)))


def _build_pages(batches):
    """Pages from rows of keys (part, pages, page, positions); all rows of a page come to one task."""
    row_of: dict[tuple, int] = {}
    held = np.zeros((64, PAGE_BITS // 8), dtype=np.uint8)
    for batch in batches:
        part = batch.column(PART).dictionary_encode()
        page = batch.column("page").to_numpy()
        names, pages = part.dictionary.to_pylist(), batch.column("pages").to_numpy()
        code = part.indices.to_numpy().astype(np.int64) << 40 | page
        found, first, place = np.unique(code, return_index=True, return_inverse=True)
        rows = [row_of.setdefault((names[c >> 40], int(pages[k]), c & ((1 << 40) - 1)), len(row_of)) for c, k in zip(found.tolist(), first.tolist(), strict=True)]
        if len(row_of) > len(held):
            held = np.concatenate((held, np.zeros((max(len(held), len(row_of) - len(held)), held.shape[1]), dtype=np.uint8)))
        at = batch.column("at").flatten().to_numpy().astype(np.int64)
        row = np.repeat(np.array(rows, dtype=np.int64)[place], HASHES)
        np.bitwise_or.at(held, (row, at >> 3), (1 << (at & 7)).astype(np.uint8))
    names = list(row_of)
    for i in range(0, len(names), 256):
        part, pages, page = zip(*names[i : i + 256], strict=True)
        bits = [held[k].tobytes() for k in range(i, i + len(part))]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(pages, pa.int32()), pa.array(page, pa.int64()), pa.array(bits, pa.binary())], names=[PART, "pages", "page", "bits"])


def _is_set(bits: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("mod", F.floor(byte / F.pow(F.lit(2), at % 8)), F.lit(2)) == 1


class KeyStore(LayeredTable):
    def __init__(self, spark: SparkSession, path: str, key: list[str], buckets: int = 64, max_layers: int = 8):
        super().__init__(spark, f"{path}/keys", ", ".join(f"{k} string" for k in key), None, max_layers)
        self.key, self.buckets, self.accepted_path = key, buckets, f"{path}/accepted"

    def _bucket(self) -> Column:
        return F.format_string("b%05d", F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)))

    def _write(self, rows: DataFrame, layer: str) -> list[str]:
        """The keys, and the pages of each of their files."""
        parts = super()._write(rows, layer)
        keys = self._scan({p: [layer] for p in parts})
        sizes = keys.groupBy(PART).agg(F.ceil(F.count("*") * KEY_BITS / PAGE_BITS).cast("int").alias("pages"))
        at = _bits(self.key).cast("array<smallint>").alias("at")
        placed = keys.join(sizes, PART).select(PART, "pages", _page(self.key, F.col("pages")).alias("page"), at)
        # bitmap_construct_agg would sort a row for every bit, by an aggregate that has no hash form
        pages = placed.repartition(PART, "page").mapInArrow(_build_pages, f"{PART} string, pages int, page bigint, bits binary")
        pages.withColumn(LAYER, F.lit(layer)).write.mode("overwrite").parquet(f"{self.folder.path}/bloom/{layer}")
        return parts

    def _commit(self, state: dict) -> None:
        super()._commit(state)
        held = {n.removeprefix(f"{LAYER}=") for n in self.folder.names("data")}
        for n in self.folder.names("bloom"):
            if n not in held:
                self.folder.remove(f"bloom/{n}")

    def may_hold(self, keys: DataFrame) -> DataFrame:
        """The keys (with PART) that a file may hold, once for each such file (LAYER)."""
        live = self.files()
        layers = sorted({x for xs in live.values() for x in xs})
        if not layers:
            return keys.limit(0).withColumn(LAYER, F.lit(""))
        pages = self.spark.read.parquet(*(f"{self.folder.path}/bloom/{x}" for x in layers))
        pages = pages.where(F.array_contains(F.array(*(F.lit(f"{x}/{p}") for p, xs in live.items() for x in xs)), F.concat_ws("/", LAYER, PART)))
        per_file = pages.select(PART, LAYER, "pages").distinct()
        at = keys.join(per_file, PART).withColumn("page", _page(self.key, F.col("pages"))).withColumn("at", _bits(self.key))
        found = at.join(pages.select(PART, LAYER, "page", "bits"), [PART, LAYER, "page"])
        hit = F.lit(True)
        for k in range(HASHES):
            hit = hit & _is_set(F.col("bits"), F.col("at")[k])
        return found.where(hit).select(*self.key, PART, LAYER)

    def seen(self, keys: DataFrame) -> tuple[DataFrame, int, int]:
        """The keys that the store holds, how many files were read for it, and how many there are."""
        maybe = self.may_hold(keys.select(*self.key, self._bucket().alias(PART))).persist()
        try:
            files = maybe.select(PART, LAYER).distinct().collect()  # at most the number of files
            wanted: dict[str, list[str]] = {}
            for f in files:
                wanted.setdefault(f[PART], []).append(f[LAYER])
            held = self._scan(wanted).select(*self.key)
            return held.join(maybe.select(*self.key).distinct(), self.key, "left_semi"), len(files), sum(map(len, self.files().values()))
        finally:
            maybe.unpersist()

    def consume(self, batch: DataFrame, batch_id: int, order: list[str]) -> bool:
        """Accepts the batch's first row of each key that was never seen; False if the batch was consumed before.

        Rows whose key has a null pass (they can't be told apart) and are not kept.
        """
        if self.has(batch_id):
            return False
        first = dedup_first_seen(batch, self.key, order).persist()
        try:
            keyed = first.select(*self.key).dropna()
            seen, n_read, n_files = self.seen(keyed)
            fresh = first.join(seen, self.key, "left_anti")
            fresh.write.mode("overwrite").parquet(f"{self.accepted_path}/batch_id={batch_id}")
        finally:
            first.unpersist()
        new = self.spark.read.parquet(f"{self.accepted_path}/batch_id={batch_id}").select(*self.key).dropna()
        notes = self.state()["notes"]
        return self.append(new.withColumn(PART, self._bucket()), batch_id,
                           {"read": [*notes.get("read", []), n_read][-100:], "files": [*notes.get("files", []), n_files][-100:]})

    def accepted(self) -> DataFrame:
        return self.spark.read.parquet(self.accepted_path)
