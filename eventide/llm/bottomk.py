"""Document fingerprints: bottom-k sketches of shingle hashes.

A shingle is ``SHINGLE`` consecutive code points (a shorter text is one
shingle).  A sketch keeps the ``k`` smallest distinct 32-bit shingle hashes
and, if there are fewer than k, all of them.  Sketches of parts merge into
the sketch of the whole (the k smallest of both).  Of two sketches,
``likeness`` estimates the resemblance (shared part of the k smallest of the
union), ``containment`` the share of one text's shingles that the other has,
and ``distinct`` the number of shingles of one.

A fingerprint is the sketch's hashes, ascending, as base64 text.

``edited_pairs`` also compares each document with its edited text, whose end
comes from the next document by doc_id.  Documents are dealt into ranges of
doc_id; the first document of each range also goes, as a ghost, to the range
before (that of the first range to the last), so every task finds all next
documents in its own rows.  The texts cross one shuffle.

Defined cases: a null text is an empty one, with no shingles; two empty
sketches are alike (1.0), an empty and another one not (0.0); rows that
repeat a doc_id follow one another by text; rows without a doc_id come before
the others; a single document is its own next; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mix, text_columns

SHINGLE, K = 9, 128
RANGE_BYTES = 8 << 20
_P = [pow(0x9E3779B97F4A7C15, i, 1 << 64) for i in range(SHINGLE)]
_LOWEST = -(1 << 63)


def sketch(text: str, k: int = K) -> np.ndarray:
    """The k smallest distinct shingle hashes of a text, ascending."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    n = len(points)
    if not n:
        return np.zeros(0, dtype=np.uint32)
    if n < SHINGLE:
        h = np.array([sum(int(c + 1) * p for c, p in zip(points.tolist(), _P, strict=False)) % (1 << 64)], dtype=np.uint64)
    else:
        h = np.zeros(n - SHINGLE + 1, dtype=np.uint64)
        for i, p in enumerate(_P):
            h += (points[i : n - SHINGLE + 1 + i] + np.uint64(1)) * np.uint64(p)
    return smallest((mix(h) >> np.uint64(32)).astype(np.uint32), k)


def smallest(h: np.ndarray, k: int = K) -> np.ndarray:
    """The k smallest distinct values, ascending."""
    take = 4 * k
    while take < len(h):
        low = np.unique(np.partition(h, take)[:take])
        if len(low) >= k:
            return low[:k]
        take *= 4
    return np.unique(h)[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """Sketch of the union of two sets from their sketches."""
    return np.union1d(a, b)[:k]


def likeness(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated resemblance (Jaccard) of two sets."""
    if not len(a) and not len(b):
        return 1.0
    low = merge(a, b, k)
    return len(np.intersect1d(np.intersect1d(low, a, True), b, True)) / len(low)


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles (exact below k)."""
    return float(len(a)) if len(a) < k else (k - 1) * 2.0**32 / (float(a[-1]) + 1)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has."""
    if not len(a):
        return 1.0
    shared = likeness(a, b, k) * distinct(merge(a, b, k), k)
    return min(1.0, shared / distinct(a, k))


def to_text(a: np.ndarray) -> str:
    return base64.b64encode(a.astype("<u4").tobytes()).decode()


def from_text(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s), dtype="<u4")


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """Per document: doc_id, fingerprint, n_shingles (estimate)."""

    def run(batches):
        for batch in batches:
            own = [sketch(t or "", k) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([to_text(s) for s in own]), pa.array([distinct(s, k) for s in own], pa.float64())], names=["doc_id", "fingerprint", "n_shingles"])

    return text_columns(docs).mapInArrow(run, "doc_id bigint, fingerprint string, n_shingles double")


def merged_fingerprints(parts: DataFrame, key: str, k: int = K) -> DataFrame:
    """Fingerprint of each ``key``'s union from the fingerprints of its parts.

    Hashes meet as rows, so a key with any number of parts stays bounded:
    each distinct hash is ranked within its key and the k first are kept.
    """
    def hashes(batches):
        for batch in batches:
            each = [from_text(s) for s in batch.column("fingerprint").to_pylist()]
            at = np.repeat(np.arange(len(each)), [len(e) for e in each])
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(at)), pa.array(np.concatenate([*each, np.zeros(0, "<u4")]).astype(np.int64))], names=["key", "hash"])

    kind = dict(parts.dtypes)[key]
    rows = parts.select(F.col(key).alias("key"), "fingerprint").mapInArrow(hashes, f"key {kind}, hash bigint").distinct()
    low = rows.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy("hash"))).where(F.col("n") <= k)
    joined = low.groupBy("key").agg(F.sort_array(F.collect_list("hash")).alias("hashes"))

    @F.pandas_udf("string")
    def text(hashes: pd.Series) -> pd.Series:
        return hashes.map(lambda h: to_text(np.asarray(h, dtype=np.uint32)))

    return joined.select(F.col("key").alias(key), text("hashes").alias("fingerprint"))


# ------------------------------------------------------------- the next document


def with_ranges(rows: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``rows`` (place, text) dealt into ranges of ``place``: adds range and ghost; the first rows of a range come again as ghosts of the range before."""
    size, low = rows.agg(F.sum(F.octet_length("text")), F.min("place")).first()
    count = max(1, -(-(size or 0) // range_bytes))
    cuts = []
    if count > 1:
        # values that are there themselves, so each is the first place of its range
        got = rows.agg(F.percentile_approx("place", F.lit([i / count for i in range(1, count)]), F.lit(20 * count))).first()[0]
        cuts = sorted({c for c in got if c > low})
    bounds, last = np.array(cuts, dtype=np.int64), len(cuts)
    firsts = {low: last} | {c: i for i, c in enumerate(cuts)}

    @F.pandas_udf("array<int>")
    def ranges(place: pd.Series) -> pd.Series:
        own = np.searchsorted(bounds, place.to_numpy(), side="right").tolist()
        return pd.Series([[r] if p not in firsts else [r, ~firsts[p]] for p, r in zip(place.tolist(), own, strict=True)])

    dealt = rows.withColumn("range", F.explode(ranges("place")))
    return dealt.withColumn("ghost", F.col("range") < 0).withColumn("range", F.when(F.col("range") < 0, F.bitwise_not("range")).otherwise(F.col("range")))


def _compare(k: int):
    def row(doc, nxt):
        place, text, has_id = doc
        cut = len(text) // 4
        edited = text[: len(text) - cut] + nxt[1][:cut]
        a, b, c = sketch(text, k), sketch(edited, k), sketch(nxt[1], k)
        return (place if has_id else None, len(text), hashlib.sha256(edited.encode()).hexdigest(), to_text(a), to_text(b), likeness(a, b, k), likeness(a, c, k))

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches):
        held, own_range, seen_ghost = None, None, False
        for batch in batches:
            out = []
            for r, ghost, place, text, has_id in zip(*(batch.column(c).to_pylist() for c in ("range", "ghost", "place", "text", "has_id")), strict=True):
                doc = (place, text, has_id)
                if r != own_range:
                    held, own_range, seen_ghost = None, r, False
                if seen_ghost:
                    continue  # more rows with the next range's first place
                if held is not None:
                    out.append(row(held, doc))
                held, seen_ghost = doc, ghost
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * len(types), types, strict=True)], names=names)

    return run


def edited_pairs(docs: DataFrame, k: int = K, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows = text_columns(docs).select(
        F.coalesce("doc_id", F.lit(_LOWEST)).alias("place"), F.coalesce("text", F.lit("")).alias("text"), F.col("doc_id").isNotNull().alias("has_id")
    )
    dealt = with_ranges(rows, range_bytes).repartition("range").sortWithinPartitions("range", "ghost", "place", "text")
    return dealt.mapInArrow(_compare(k), "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
