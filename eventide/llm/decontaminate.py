"""Benchmark decontamination with suffix arrays over shards of the training text.

A shard is a slice of the documents a task reads.  Its word sequence is
indexed by a suffix array; every suffix of every benchmark item is looked up
by binary search, which gives all places of its windows, and the longest
verbatim match at each place.  Shards are independent, so the job is one
narrow pass over the documents: nothing of them is shuffled.

Words are runs of ASCII letters and digits (A-Z taken as a-z) and non-ASCII
characters.  A window is ``window`` consecutive words of an item; an item of
fewer words, but not none, is one window of all its words.

Defined cases: a null or empty text has no words and is clean; an item
without words never matches; a null ``item_id`` counts as the id ``""``;
items that share an id count once; repeated documents each get their own row;
an empty table of documents or items gives no rows or only clean rows; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, Words, byte_values, fresh_name, materialize, released, text_columns, text_slices

WINDOW = 10
#: items are looked up in blocks of about this many characters, so that what is broadcast stays bounded
BLOCK_CHARS = 16 << 20
#: bytes of text in one shard
SHARD_BYTES = 4 << 20
_VALUES = byte_values(3)

MATCH = "struct<item_id:string,item_word:int,doc_word:bigint,n_words:int>"
_OUT = f"doc_id bigint, digest binary, n_words bigint, hits array<bigint>, items array<string>, longest int, matches array<{MATCH}>"


class Items:
    """Benchmark items of one block: word ids in one sequence, and the test suffixes that begin a window."""

    def __init__(self, ids: list[str], texts: list[str], window: int):
        self.ids = ids
        raw = [t.encode() for t in texts]
        offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
        w = Words(np.frombuffer(b"".join(raw), dtype=np.uint8), offsets, ALNUM, _VALUES)
        self.vocab = np.unique(w.hash)
        self.words = np.append(np.searchsorted(self.vocab, w.hash) + 1, -1).astype(np.int64)
        length = np.diff(w.first)
        left = w.first[w.doc + 1] - np.arange(len(w.doc))  # words from here to the item's end
        size = np.minimum(window, length[w.doc])
        self.start = np.flatnonzero(left >= size)
        self.window = size[self.start]
        self.left = left[self.start]
        self.item = w.doc[self.start]
        self.offset = self.start - w.first[self.item]
        self.least = int(self.window.min()) if len(self.start) else 0
        self.most = int(length.max()) if len(length) else 0


def common_prefix(train: np.ndarray, at: np.ndarray, words: np.ndarray, start: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Words that train[at:] and words[start:] have in common, up to ``limit``."""
    n = np.zeros(len(at), dtype=np.int64)
    live = np.arange(len(at))
    while len(live):
        live = live[n[live] < limit[live]]
        live = live[train[at[live] + n[live]] == words[start[live] + n[live]]]
        n[live] += 1
    return n


def suffix_array(train: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``train`` by the ``depth`` words from there on (prefix doubling)."""
    n = len(train)
    rank, step = np.unique(train, return_inverse=True)[1].astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while step < depth:
        key = rank * (n + 1)
        key[: n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        new = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        rank[order] = new
        if new[-1] == n - 1:
            break
        step *= 2
    return order


def bound(train: np.ndarray, order: np.ndarray, items: Items, upper: bool) -> np.ndarray:
    """Binary search of each window: the first suffix not below it, or (upper) the first above it."""
    lo, hi = np.zeros(len(items.start), dtype=np.int64), np.full(len(items.start), len(order), dtype=np.int64)
    live = np.arange(len(lo))
    while len(live):
        mid = (lo[live] + hi[live]) // 2
        at, start, size = order[mid], items.start[live], items.window[live]
        n = common_prefix(train, at, items.words, start, size)
        below = (n == size) if upper else np.zeros(len(live), dtype=bool)
        part = n < size
        below[part] = train[at[part] + n[part]] < items.words[start[part] + n[part]]
        lo[live] = np.where(below, mid + 1, lo[live])
        hi[live] = np.where(below, hi[live], mid)
        live = live[lo[live] < hi[live]]
    return lo


def shard_matches(w: Words, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(test suffix, word of the shard, longest common words) for each place of each window in a shard."""
    none = (np.zeros(0, np.int64),) * 3
    if not len(items.start) or not len(w.hash):
        return none
    at = np.minimum(np.searchsorted(items.vocab, w.hash), len(items.vocab) - 1)
    ids = np.where(items.vocab[at] == w.hash, at + 1, 0)
    # stretches of words that some item has, within one text; shorter ones than any window cannot hold a match
    breaks = np.flatnonzero((ids == 0) | np.concatenate(([True], np.diff(w.doc) != 0)))
    edge = np.append(breaks, len(ids))
    begin = np.where(ids[breaks] == 0, breaks + 1, breaks)
    keep = edge[1:] - begin >= items.least
    begin, size = begin[keep], (edge[1:] - begin)[keep]
    if not len(begin):
        return none
    # the stretches one after the other, each closed by a 0
    total = int(size.sum() + len(size))
    place = np.ones(total, dtype=np.int64)
    heads = np.concatenate(([0], np.cumsum(size + 1)[:-1]))
    place[heads] = begin - np.concatenate(([0], begin[:-1] + size[:-1]))
    place = np.cumsum(place)
    ends = heads + size
    train = np.zeros(total, dtype=np.int64)
    body = np.ones(total, dtype=bool)
    body[ends] = False
    train[body] = ids[place[body]]
    order = suffix_array(train, items.most)
    lo, hi = bound(train, order, items, False), bound(train, order, items, True)
    n = hi - lo
    query = np.repeat(np.arange(len(lo)), n)
    if not len(query):
        return none
    spot = order[np.arange(len(query)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
    return query, place[spot], common_prefix(train, spot, items.words, items.start[query], items.left[query])


def _scan(items: Items, window: int, with_digest: bool, with_matches: bool):
    def run(batches):
        schema = None
        for batch in batches:
            doc_id = batch.column("doc_id")
            for i, j, data, off in text_slices(batch, "text", SHARD_BYTES):
                w = Words(data, off, ALNUM, _VALUES)
                query, word, longest = shard_matches(w, items)
                rows = j - i
                mark = np.zeros(len(w.hash) + 1, dtype=np.int64)
                np.add.at(mark, word, 1)
                np.add.at(mark, word + items.window[query], -1)
                hit = np.cumsum(mark)[:-1] > 0
                doc = w.doc[word]
                names: list = [[] for _ in range(rows)]
                for pair in np.unique(doc * len(items.ids) + items.item[query]).tolist() if len(query) else ():
                    names[pair // len(items.ids)].append(items.ids[pair % len(items.ids)])
                best = np.zeros(rows, dtype=np.int64)
                np.maximum.at(best, doc, longest)
                # positions of hit words, as begin and end of each stretch
                edge = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8)))
                spans: list = [[] for _ in range(rows)]
                for b, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                    # a stretch may run over texts that follow one another
                    for d in range(int(w.doc[b]), int(w.doc[e - 1]) + 1):
                        f, l = max(b, int(w.first[d])), min(e, int(w.first[d + 1]))
                        if f < l:
                            spans[d] += [f - int(w.first[d]), l - int(w.first[d])]
                found: list = [[] for _ in range(rows)]
                if with_matches and len(query):
                    # only matches that cannot be extended to the left
                    known = {}
                    for q, p, n in sorted(zip(query.tolist(), word.tolist(), longest.tolist(), strict=True), key=lambda x: x[1]):
                        d, s, t = int(w.doc[p]), int(items.offset[q]), p - int(w.first[w.doc[p]])
                        key = (int(items.item[q]), d, t - s)
                        if known.get(key, -1) < p:
                            found[d].append({"item_id": items.ids[items.item[q]], "item_word": s, "doc_word": t, "n_words": n})
                            known[key] = p + n - 1
                texts = batch.column("text").slice(i, rows)
                columns = {
                    "doc_id": doc_id.slice(i, rows),
                    "digest": pa.array([hashlib.md5(b"" if t is None else t.encode()).digest() for t in texts.to_pylist()] if with_digest else [None] * rows, pa.binary()),
                    "n_words": pa.array(np.diff(w.first), pa.int64()),
                    "hits": pa.array(spans, pa.list_(pa.int64())),
                    "items": pa.array(names, pa.list_(pa.string())),
                    "longest": pa.array(best.astype(np.int32)),
                    "matches": pa.array(found, pa.list_(pa.struct([("item_id", pa.string()), ("item_word", pa.int32()), ("doc_word", pa.int64()), ("n_words", pa.int32())]))),
                }
                schema = schema or pa.schema([(k, v.type) for k, v in columns.items()])
                yield pa.RecordBatch.from_arrays(list(columns.values()), schema=schema)

    return run


def item_blocks(benchmark: DataFrame, window: int, block_chars: int):
    """Yields (items of a block, number of blocks); a block holds about ``block_chars`` characters.

    Repeated items are taken once: all copies would land in one block.
    """
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["item_id", "text"])
    chars = items.agg(F.sum(F.length("text") + F.length("item_id"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    if blocks > 1:
        items = materialize(items, "items")
    for k in range(blocks):
        own = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        got = own.collect()  # at most one block
        yield Items([r[0] for r in got], [r[1] for r in got], window), blocks


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS, with_matches: bool = True) -> DataFrame:
    """One row per document: doc_id, n_words, hits, items, longest, matches.

    ``hits``: begin and end (exclusive) of each stretch of hit words, as flat
    pairs; ``items``: ids of the items with a window in the document, sorted
    as strings; ``longest``: words of the longest verbatim match; ``matches``:
    the matches that cannot be extended, with their places, sorted (one entry
    for each, so they are made only ``with_matches``; else the list is empty).

    The items are taken in as many blocks as their measured size needs; only
    one block is in memory at a time.
    """
    rows, blocks, parts = text_columns(docs), 0, []
    for items, blocks in item_blocks(benchmark, window, block_chars):
        part = rows.mapInArrow(_scan(items, window, blocks > 1, with_matches), _OUT)
        parts.append(part if blocks == 1 else materialize(part, "matches").withColumn("block", F.lit(len(parts))))
    if blocks == 1:
        out = parts[0]
    else:
        out = parts[0].select("doc_id", "digest", "n_words")
        key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        # equal rows give equal results, so each (doc_id, text) is merged once and joined to its rows
        merged = every.dropDuplicates(["block", "doc_id", "digest"]).groupBy(key.alias("_id"), F.col("digest").alias("_digest")).agg(
            F.flatten(F.collect_list("hits")).alias("hits"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
            F.max("longest").alias("longest"), F.flatten(F.collect_list("matches")).alias("matches"),
        )
        out = out.join(merged, (key == F.col("_id")) & (F.col("digest") == F.col("_digest")))
    return out.select("doc_id", "n_words", "hits", F.array_sort(F.array_distinct("items")).alias("items"), "longest", F.array_sort("matches").alias("matches"))


def hit_count(hits: Column) -> Column:
    """Words in the union of the stretches that ``hits`` holds as flat pairs."""
    pairs = F.array_sort(F.transform(F.sequence(F.lit(0), (F.size(hits) / 2).cast("int") - 1), lambda k: F.struct(F.get(hits, k * 2).alias("b"), F.get(hits, k * 2 + 1).alias("e"))))
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("to"))
    total = F.aggregate(
        pairs, start,
        lambda s, p: F.struct((s["n"] + F.greatest(F.lit(0).cast("bigint"), p["e"] - F.greatest(p["b"], s["to"]))).alias("n"), F.greatest(s["to"], p["e"]).alias("to")),
    )["n"]
    return F.when(F.size(hits) > 0, total).otherwise(F.lit(0).cast("bigint"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest."""
    m = find_matches(docs, benchmark, window, block_chars, with_matches=False)
    n = hit_count(F.col("hits"))
    return m.select(
        "doc_id", "n_words", n.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.size("items") > 0).alias("contaminated"), "longest",
    )


def _flag(items: Items):
    """Sets the last column where a row's text holds a window of the block's items."""

    def run(batches):
        for batch in batches:
            flags = np.array(batch.column(batch.num_columns - 1).to_pylist(), dtype=bool)
            for i, j, data, off in text_slices(batch, "text", SHARD_BYTES):
                w = Words(data, off, ALNUM, _VALUES)
                flags[i + w.doc[shard_matches(w, items)[1]]] = True
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(flags)], names=batch.schema.names)

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` (all columns) without the rows whose text holds a window of an item.

    One narrow pass for each block of items; with several blocks the rows are
    written between the passes, so that one block is in memory at a time.
    """
    mark = fresh_name(docs, "contaminated")
    out = docs.withColumn(mark, F.lit(False))
    for k, (items, _) in enumerate(item_blocks(benchmark, window, block_chars)):
        if k:
            out = materialize(out, "flagged")
        out = out.mapInArrow(released(_flag(items)), out.schema)
    return out.where(~F.col(mark)).select(*[F.col(f"`{c}`") for c in docs.columns])
