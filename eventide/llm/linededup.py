"""Line dedup by a sharded minimal perfect hash.

1. Every line of at least ``min_chars`` code points becomes a 128-bit hash of
   its key; partial aggregation counts the documents that hold it and keeps
   the largest doc_id among them.
2. All distinct lines are dealt into shards by their hash.  Each shard is one
   minimal perfect hash function (levels of bit arrays; a line's level is the
   first one where nothing else of its shard meets it) that indexes two compact
   arrays: a 16-bit fingerprint and the count, in the narrowest type that holds
   the shard's largest.  Lines of at least ``min_docs`` also have an entry with
   the largest doc_id.
3. The documents probe the arrays of broadcast blocks of shards, line by
   line: the count read there decides, and the largest doc_id says which
   document keeps its lines.  No line is joined.

A line costs some 3.5 bytes of arrays.  A block holds shards of at most
``block_bytes``; if the arrays need more, the documents pass over several
blocks, one after the other.  Every line that the documents probe has been
indexed, so the hash gives each its own place and the result does not rest on
the short fingerprint; that one only tells apart lines from elsewhere (all but
1 in 65,536).

Defined cases: a null or empty text is one empty line; white space at both
ends and the case of A-Z do not tell lines apart; a line that one document
holds several times counts once, and the keeping document keeps all of its
own; rows that repeat a doc_id count as documents of their own, and all of
them keep what the id keeps; a null doc_id is below every other, and keeps a
line only if no other document holds it; an empty table gives no rows.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh_name, materialize, mix, released, row_slices, text_columns

MIN_CHARS, MIN_DOCS = 40, 5
#: lines of one shard, on average
SHARD_LINES = 1 << 18
#: bytes of arrays that are broadcast at a time
BLOCK_BYTES = 128 << 20
_BLANK = b" \t\n\x0b\x0c\r"
_NULL_ID = -(1 << 63)
_NOWHERE = (1 << 63) - 1


def line_hash(line: bytes, min_chars: int) -> bytes | None:
    """The 16-byte hash of a line's key, or None if the key is too short."""
    key = line.strip(_BLANK)
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key.lower())


def _line_hashes(min_chars: int):
    def run(batches):
        for whole in batches:
            for i, j in row_slices(whole.column("text")):
                batch = whole.slice(i, j - i)
                ids = batch.column("doc_id").to_pylist()
                out, owner = bytearray(), []
                for k, t in enumerate(batch.column("text")):
                    t = t.as_py()
                    if not t:
                        continue
                    own = {h for line in t.encode().split(b"\n") if len(line) >= min_chars and (h := line_hash(line, min_chars))}
                    out += b"".join(own)
                    owner += [ids[k] if ids[k] is not None else _NULL_ID] * len(own)
                h = np.frombuffer(bytes(out), dtype=np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), pa.array(owner, pa.int64())], names=["h1", "h2", "doc_id"])

    return run


def line_counts(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Distinct lines: h1, h2 (halves of the hash), n_docs, last (largest doc_id)."""
    lines = text_columns(docs).mapInArrow(released(_line_hashes(min_chars)), "h1 bigint, h2 bigint, doc_id bigint")
    return lines.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last"))


# ------------------------------------------------------------ perfect hash of a shard


def _slot(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    """Place at a level; the halves of the hash take turns, so lines that agree in one half part at the next level."""
    h = h2 if level % 2 else h1
    return mix(h + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & 0xFFFFFFFFFFFFFFFF)) % np.uint64(size)


def _fingerprint(h2: np.ndarray) -> np.ndarray:
    return (h2.view(np.uint64) >> np.uint64(48)).astype(np.uint16)


_COUNT_TYPES = (np.uint8, np.uint16, np.uint32, np.uint64)


def build_shard(h1: np.ndarray, h2: np.ndarray, count: np.ndarray, last: np.ndarray, min_docs: int) -> bytes:
    """Levels of bit arrays and the arrays they index, as one block of bytes."""
    a, b, taken = h1.view(np.uint64), h2.view(np.uint64), []
    while len(a):
        size = max(64, 2 * len(a) + 63 & ~63)
        slot = _slot(a, b, len(taken), size).astype(np.int64)
        alone = np.bincount(slot, minlength=size)[slot] == 1
        bits = np.zeros(size, dtype=np.uint8)
        bits[slot[alone]] = 1
        taken.append(np.packbits(bits, bitorder="little"))
        a, b = a[~alone], b[~alone]
    most = int(count.max(initial=0))
    width = next(k for k, t in enumerate(_COUNT_TYPES) if most <= np.iinfo(t).max)
    often = count >= min_docs
    head = np.array([len(taken), len(h1), int(often.sum()), width, min_docs, *(8 * len(x) for x in taken)], dtype=np.int64).tobytes()
    levels = b"".join(x.tobytes() for x in taken)
    n = len(h1)
    blank = b"\0" * (8 * int(often.sum()) + n * (2 + (1 << width)))
    at = Shard(head + levels + blank).index(h1, h2)
    fingerprints, counts = np.empty(n, dtype=np.uint16), np.empty(n, dtype=_COUNT_TYPES[width])
    fingerprints[at], counts[at] = _fingerprint(h2), count
    by_place = np.argsort(at[often])
    return head + levels + last[often][by_place].tobytes() + counts.tobytes() + fingerprints.tobytes()


class Shard:
    """A built shard: ``index`` of hashes (in range for any hash) and the arrays."""

    def __init__(self, data: bytes):
        levels, self.n, n_often, width, self.min_docs = (int(x) for x in np.frombuffer(data, np.int64, 5))
        self.sizes = [int(x) for x in np.frombuffer(data, np.int64, levels, 40)]
        at, base = 40 + 8 * levels, 0
        self.words, self.ranks = [], []
        for size in self.sizes:
            words = np.frombuffer(data, np.uint64, size // 64, at)
            ones = np.bitwise_count(words).astype(np.int64)
            self.words.append(words)
            self.ranks.append((base + np.cumsum(ones) - ones).astype(np.uint32))
            base += int(ones.sum())
            at += size // 8
        kind = _COUNT_TYPES[width]
        self.lasts = np.frombuffer(data, np.int64, n_often, at)
        # what follows need not begin at a multiple of its width
        self.count = np.frombuffer(data[at + 8 * n_often : at + 8 * n_often + self.n * (1 << width)], kind)
        self.fingerprint = np.frombuffer(data[at + 8 * n_often + self.n * (1 << width) :], np.uint16)
        #: places of the lines of at least min_docs, in order; ``lasts`` has their largest doc_ids
        self.often = np.flatnonzero(self.count >= self.min_docs)

    def index(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The place of each hash; -1 for one that is met at no level (it is not in the shard)."""
        out = np.full(len(h1), -1, dtype=np.int64)
        left, a, b = np.arange(len(h1)), h1.view(np.uint64), h2.view(np.uint64)
        for level, size in enumerate(self.sizes):
            slot = _slot(a, b, level, size)
            word, bit = (slot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (slot & np.uint64(63))
            held = self.words[level][word]
            hit = (held & bit) != 0
            below = np.bitwise_count(held[hit] & (bit[hit] - np.uint64(1))).astype(np.int64)
            out[left[hit]] = self.ranks[level][word[hit]].astype(np.int64) + below
            left, a, b = left[~hit], a[~hit], b[~hit]
            if not len(left):
                break
        return out

    def counts(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents that hold each line (0: not in the shard) and its largest doc_id if they are min_docs or more."""
        at = self.index(h1, h2)
        known = at >= 0
        known[known] = self.fingerprint[at[known]] == _fingerprint(h2[known])
        count, last = np.zeros(len(h1), dtype=np.int64), np.full(len(h1), _NOWHERE, dtype=np.int64)
        count[known] = self.count[at[known]]
        often = count >= self.min_docs
        last[often] = self.lasts[np.searchsorted(self.often, at[often])]
        return count, last


def _build(min_docs: int):
    """Rows come sorted by shard; one row for each shard goes out."""

    def run(batches):
        shard, parts = None, []

        def flush():
            cols = [np.concatenate([p[k] for p in parts]) for k in range(4)]
            data = build_shard(*cols, min_docs)
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([data], pa.binary()), pa.array([len(data)], pa.int64())], names=["shard", "data", "n_bytes"])

        for batch in batches:
            s = batch.column("shard").to_numpy(zero_copy_only=False)
            cols = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("h1", "h2", "n_docs", "last")]
            for own in np.split(np.arange(len(s)), np.flatnonzero(np.diff(s)) + 1) if len(s) else ():
                if parts and s[own[0]] != shard:
                    yield flush()
                    parts = []
                shard = int(s[own[0]])
                parts.append([c[own] for c in cols])
        if parts:
            yield flush()

    return run


def build_shards(lines: DataFrame, shards: int, min_docs: int) -> DataFrame:
    """Rows (shard, data, n_bytes), one for each shard that has lines; a line's shard is its hash modulo ``shards``."""
    dealt = lines.withColumn("shard", F.pmod("h2", F.lit(shards)).cast("bigint"))
    return dealt.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(released(_build(min_docs)), "shard bigint, data binary, n_bytes bigint")


class Probe:
    """Shards of one block, opened when a worker first meets them."""

    def __init__(self, data: dict[int, bytes], shards: int):
        self.data, self.shards, self.open = data, shards, {}

    def last(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Largest doc_id of each line whose count is min_docs or more; for any other, or one of another block, a value above all."""
        out = np.full(len(h1), _NOWHERE, dtype=np.int64)
        shard = np.mod(h2, self.shards)
        for s in np.unique(shard).tolist():
            if s not in self.data:
                continue
            if s not in self.open:
                self.open[s] = Shard(self.data[s])
            own = np.flatnonzero(shard == s)
            out[own] = self.open[s].counts(h1[own], h2[own])[1]
        return out


_PROBES: dict[str, Probe] = {}


def _drop(shared, shards: int, min_chars: int, id_at: int, text_at: int):
    """Adds to the last column (numbers of lines to drop) what this block's arrays name."""

    key = uuid.uuid4().hex

    def run(batches):
        if key not in _PROBES:
            _PROBES.clear()
            _PROBES[key] = Probe(shared.value, shards)
        probe = _PROBES[key]
        for whole in batches:
            for i, j in row_slices(whole.column(text_at)):
                yield mark(probe, whole.slice(i, j - i))

    def mark(probe, batch):
        ids = batch.column(id_at).to_pylist()
        texts = batch.column(text_at)
        found, where, owner = bytearray(), [], []
        for k, t in enumerate(texts):
            t = t.as_py()
            if not t or len(t) < min_chars:
                continue
            me = ids[k] if ids[k] is not None else _NULL_ID
            for n, line in enumerate(t.encode().split(b"\n")):
                if len(line) >= min_chars and (h := line_hash(line, min_chars)):
                    found += h
                    where.append((k, n))
                    owner.append(me)
        h = np.frombuffer(bytes(found), dtype=np.int64).reshape(-1, 2)
        last = probe.last(h[:, 0].copy(), h[:, 1].copy())
        drop = batch.column(batch.num_columns - 1).to_pylist()
        gone = np.flatnonzero((last != _NOWHERE) & (last != np.array(owner, dtype=np.int64)))
        for x in gone.tolist():
            k, n = where[x]
            drop[k] = drop[k] or []
            drop[k].append(n)
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(drop, pa.list_(pa.int32()))], names=batch.schema.names)

    return run


def dropped_lines(
    docs: DataFrame, column: str, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, shard_lines: int = SHARD_LINES, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``docs`` with a last column ``column``: 0-based numbers of the lines to drop (null: none)."""
    spark = docs.sparkSession
    lines = materialize(line_counts(docs, min_chars), "lines")
    shards = max(1, -(-lines.count() // shard_lines))
    built = materialize(build_shards(lines, shards, min_docs), "shards")
    # ranges of shards that fit a block; one row for each shard_lines lines comes by
    blocks, room = [[0, -1]], block_bytes
    for shard, size in built.select("shard", "n_bytes").orderBy("shard").toLocalIterator():
        if size > room and blocks[-1][1] >= blocks[-1][0]:
            blocks.append([shard, shard])
            room = block_bytes
        blocks[-1][1] = shard
        room -= size
    at = docs.columns.index
    out = docs.withColumn(column, F.lit(None).cast("array<int>"))
    for k, (first, last) in enumerate(blocks):
        own = built.where(F.col("shard").between(first, last)).select("shard", "data").collect()  # block_bytes at most
        shared = spark.sparkContext.broadcast({r[0]: bytes(r[1]) for r in own})
        if k:
            out = materialize(out, "probed")  # one block in a worker's memory at a time
        out = out.mapInArrow(released(_drop(shared, shards, min_chars, at("doc_id"), at("text"))), out.schema)
    return out


def kept_text(text: Column, dropped: Column) -> Column:
    """``text`` without the lines that ``dropped`` numbers (null: whole)."""
    lines = F.filter(F.split(text, "\n", -1), lambda _, n: ~F.array_contains(dropped, n))
    return F.when(dropped.isNull(), text).otherwise(F.array_join(lines, "\n"))


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` (all columns) with the repeated lines taken out of ``text``; other columns as they were."""
    mark = fresh_name(docs, "dropped")
    marked = dropped_lines(docs, mark, min_chars, min_docs)
    kept = kept_text(F.col("text"), F.col(mark))
    return marked.select(*[kept.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])


def line_report(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, kept_sha256."""
    marked = dropped_lines(text_columns(docs), "dropped", min_chars, min_docs)
    text, dropped = F.coalesce("text", F.lit("")), F.col("dropped")
    n_lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    return marked.select(
        "doc_id", n_lines.cast("bigint").alias("n_lines"),
        F.when(dropped.isNull(), 0).otherwise(F.size(dropped)).cast("bigint").alias("n_dropped"),
        F.sha2(kept_text(text, dropped).cast("binary"), 256).alias("kept_sha256"),
    )
