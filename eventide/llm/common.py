"""Helpers shared by the operators: scratch tables and batch-wise text hashing.

The hashing helpers work on whole slices of an Arrow string column at once
(bytes in one numpy array), so the per-word cost is a few nanoseconds and the
memory is bounded by ``SLICE_BYTES`` (or by one single longer text).
"""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from eventide.session import scratch_path

SLICE_BYTES = 1 << 20
#: bytes of an Arrow batch in the pipeline (Spark counts rows, and 10,000 documents can be 64 MB in the JVM and again in Python)
BATCH_BYTES = 4 << 20
#: what operators keep in a worker from task to task, by operator
_KEPT: dict[str, dict] = {}


# --------------------------------------------------------------- scratch tables


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    return scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it again.

    Cuts the lineage like a reliable checkpoint, in a compact format; a lost
    executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once per Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_eventide_shipped", False):
        return
    top = Path(__file__).resolve().parents[1]
    target = os.path.join(tempfile.mkdtemp(prefix="eventide-src-"), "eventide-src.zip")
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    sc.addPyFile(target)
    sc._eventide_shipped = True


def small_batches(spark: SparkSession) -> None:
    """From now on Spark's Arrow batches end at BATCH_BYTES, however long the rows are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def kept(operator: str) -> dict:
    """The dictionary in which an operator keeps things in a worker from task to task."""
    return _KEPT.setdefault(operator, {})


def release() -> None:
    """Give the memory that Arrow and the C library hold free back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def make_room(operator: str = "") -> None:
    """A task of ``operator`` begins: what other operators kept in this worker goes."""
    others = [x for name, x in _KEPT.items() if name != operator and x]
    for x in others:
        x.clear()
    if others:
        gc.collect()
        release()


def released(run, operator: str = ""):
    """``run`` (batches to batches) that begins with what ``operator`` kept alone and at its end gives free memory back.

    Workers live on from stage to stage, and what theirs keep is missing to the
    JVM while it joins and sorts.
    """

    def tidy(batches):
        make_room(operator)
        yield from run(batches)
        release()

    return tidy


# ------------------------------------------------------------------ text slices


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, bytes, offsets) of ``column`` in slices of about ``limit`` bytes.

    ``offsets`` has one entry more than there are rows and starts at 0; a null
    is an empty text.
    """
    a = batch.column(batch.schema.get_field_index(column))
    if a.null_count:
        a = a.fill_null("")
    wide = pa.types.is_large_string(a.type)
    bufs = a.buffers()
    off = np.frombuffer(bufs[1], dtype=np.int64 if wide else np.int32)[a.offset : a.offset + len(a) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    i, n = 0, len(a)
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, j, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def row_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(first row, end row) of slices of about ``limit`` bytes of a string column (one longer text is a slice)."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    end = np.cumsum(size, dtype=np.int64)
    i = 0
    while i < len(end):
        j = max(i + 1, int(np.searchsorted(end, (end[i - 1] if i else 0) + limit, side="right")))
        yield i, j
        i = j


# ---------------------------------------------------------------------- hashing

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ODD = 0x9E3779B97F4A7C15
_POW: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd constant and of its inverse mod 2^64."""
    if len(_POW.get("p", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        for key, base in (("p", _ODD), ("q", pow(_ODD, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POW[key] = np.cumprod(steps, dtype=np.uint64)
    return _POW["p"][:n], _POW["q"][:n]


def byte_values(seed: int) -> np.ndarray:
    """One 64-bit value for each byte, the same for A-Z as for a-z."""
    low = np.arange(256, dtype=np.uint64)
    low[65:91] += np.uint64(32)
    return mix(low + np.uint64(seed * 2654435761 + 1))


class Words:
    """Words of a slice: ``start``/``end`` byte positions, ``doc`` row, 64-bit ``hash``; ``first`` word of each row (one entry more than rows)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, values: np.ndarray):
        n = len(data)
        inside = np.zeros(n + 2, dtype=np.int8)
        inside[1:-1] = is_word[data]
        step = np.diff(inside)
        start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        # a word that runs over the end of a text is cut there
        cuts = offsets[1:-1]
        cuts = np.unique(cuts[(cuts > 0) & (cuts < n)])
        cuts = cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)]
        if len(cuts):
            start, end = np.sort(np.concatenate((start, cuts))), np.sort(np.concatenate((end, cuts)))
        p, q = _powers(n + 1)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values[data] * p[:n], dtype=np.uint64, out=total[1:])
        self.start, self.end = start, end
        self.hash = mix((total[end] - total[start]) * q[start] + (end - start).astype(np.uint64))
        self.first = np.searchsorted(start, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))


_SPACE = np.ones(256, dtype=np.int8)
_SPACE[[0x20, *range(0x09, 0x0E)]] = 0
#: bytes of words that are parted by white space
NON_SPACE = _SPACE
_ALNUM = np.zeros(256, dtype=np.int8)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
#: bytes of words of ASCII letters, digits and all non-ASCII characters
ALNUM = _ALNUM


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words (by first word; the last k - 1 entries are left out)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        out *= np.uint64(_ODD)
        out += h[j : j + n]
    return mix(out)


def text_columns(docs: DataFrame, *more: str) -> DataFrame:
    """Only the columns an operator reads, whatever else the table holds."""
    return docs.select("doc_id", "text", *more)


def fresh_name(docs: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``docs`` has."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name
