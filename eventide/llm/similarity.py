"""Near-duplicate groups by fast similarity sketching, banding and exact checks.

A text's set holds its distinct shingles of five words (words: runs without
white space, A-Z as a-z; a text of fewer words is one shingle of them all).

1. *Sketch.*  ``BINS`` coordinates.  In round r every shingle is hashed to one
   bin and a value; a bin keeps the smallest value of the first round that
   reaches it.  Rounds go on until all bins are full; after ``BINS`` rounds
   each round fills the one bin it is for, so every coordinate fills.  Two
   sets agree in a coordinate with their resemblance as probability.
2. *Banding.*  Documents with equal word sequences form a class, sketched
   once.  ``BANDS`` bands of ``BINS / BANDS`` coordinates give bucket keys; a
   pair at the threshold of 0.75 shares no bucket with probability 5e-6.
3. *Exact checks.*  In each bucket all classes are compared to one leader on
   their full sets, and the links found are contracted to components.  Buckets
   that still hold several components get another leader, ``ROUNDS`` times in
   all.  What is then left is decided between components: those that meet in
   a bucket are compared, all members of the smaller one to all of the larger,
   in blocks (an index of a block's shingles, probed by the other side), so
   pairs are never rows.  Components meet directly in buckets of at most
   ``MEET_LIMIT`` of them; in larger ones if members share one of their rarest
   shingles (rarest within the bucket; as many as any pair at the threshold
   must share one of), which loses no pair.  Within one component nothing is
   compared, so copies are not expanded into pairs.
4. *Components* by alternating large-star and small-star steps.

Defined cases: a text without words (or null) has an empty set and links with
nothing; a row without a doc_id links with nothing and is kept; repeated rows
each get their row; where one doc_id has several texts, the classes of which
it is the smallest id count as one; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import NON_SPACE, Words, _powers, byte_values, fresh_name, grams, materialize, mix, released, text_columns, text_slices

SHINGLE = 5
#: a link needs 100 * intersection >= 75 * union
PERCENT = 75
BINS, BANDS = 128, 32
MEET_LIMIT = 64
ROUNDS = 2
#: classes that one task compares to a copy of their leader, or to a block of others
STAR_ROWS = 256
BLOCK_ROWS = 1024
#: ids to each map of 2^15 bits
IDS_PER_MAP = 2048
_VALUES = byte_values(2)
_MASK = np.uint64((1 << 57) - 1)
_FULL = np.uint64((1 << 64) - 1)
_ROUND = mix(np.arange(1, 2 * BINS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


# -------------------------------------------------------------------- one slice


def word_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, Words]:
    """Shingle hashes (in order, with repeats), the row of each, two hashes of each row's word sequence, the words."""
    w = Words(data, offsets, NON_SPACE, _VALUES)
    rows, size = len(offsets) - 1, np.diff(w.first)
    g = grams(w.hash, SHINGLE)
    whole = w.doc[: len(g)] == w.doc[SHINGLE - 1 :]
    h, doc = g[whole], w.doc[: len(g)][whole]
    short = np.flatnonzero((size > 0) & (size < SHINGLE))
    if len(short):
        own = np.array([int(grams(w.hash[w.first[r] : w.first[r + 1]], int(size[r]))[0]) for r in short.tolist()], dtype=np.uint64)
        h = np.concatenate((h, mix(own + size[short].astype(np.uint64))))
        doc = np.concatenate((doc, short))
        order = np.argsort(doc, kind="stable")
        h, doc = h[order], doc[order]
    place = np.arange(len(w.hash)) - w.first[w.doc]
    p = _powers(int(size.max()) + 1 if rows else 1)[0]
    key = np.zeros((rows, 2), dtype=np.uint64)
    some = np.flatnonzero(size > 0)
    for k in range(2):
        total = mix(w.hash + np.uint64(k + 1)) * p[place]
        key[some, k] = mix(np.add.reduceat(total, w.first[some]) + size[some].astype(np.uint64)) if len(some) else 0
    return h, doc, key.view(np.int64), w


def fill(h: np.ndarray, doc: np.ndarray, rows: int) -> np.ndarray:
    """Sketches: one row of BINS coordinates for each text (all ones where a text has no shingles)."""
    s = np.full(rows * BINS, _FULL, dtype=np.uint64)
    if not len(h):
        return s.reshape(rows, BINS)
    e, d = h, doc
    for r in range(4):
        m = mix(e + _ROUND[r])
        np.minimum.at(s, d * BINS + (m >> np.uint64(57)).astype(np.int64), (np.uint64(r) << np.uint64(57)) | (m & _MASK))
        open_ = (s.reshape(rows, BINS) == _FULL).any(axis=1)
        keep = open_[d]
        if not keep.any():
            return s.reshape(rows, BINS)
        e, d = e[keep], d[keep]
    s = s.reshape(rows, BINS)
    edge = np.flatnonzero(np.concatenate(([True], np.diff(d) != 0, [True])))
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        own, line = e[a:b], s[d[a]]
        for first, last in ((4, 12), (12, 40), (40, BINS)):
            m = mix(own[None, :] + _ROUND[first:last, None])
            key = (np.arange(first, last, dtype=np.uint64)[:, None] << np.uint64(57)) | (m & _MASK)
            got = np.full(BINS, _FULL, dtype=np.uint64)
            np.minimum.at(got, (m >> np.uint64(57)).astype(np.int64).ravel(), key.ravel())
            np.copyto(line, got, where=line == _FULL)
            if not (line == _FULL).any():
                break
        else:
            left = np.flatnonzero(line == _FULL)
            line[left] = mix(own[None, :] + _ROUND[BINS + left, None]).min(axis=1) >> np.uint64(1)
    return s


def band_keys(s: np.ndarray) -> np.ndarray:
    """A bucket key for each band of each sketch."""
    s = s.reshape(len(s), BANDS, BINS // BANDS)
    key = np.tile(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(s), 1))
    for k in range(s.shape[2]):
        key = mix(key + s[:, :, k])
    return key.view(np.int64)


def _sign(batches):
    for batch in batches:
        for i, j, data, off in text_slices(batch, "text"):
            h, doc, key, _ = word_sets(data, off)
            rows = j - i
            edge = np.searchsorted(doc, np.arange(rows + 1))
            n = [len(np.unique(h[a:b])) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
            bands = band_keys(fill(h, doc, rows))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(i, rows), pa.array(key[:, 0].copy()), pa.array(key[:, 1].copy()), pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, rows * BANDS + 1, BANDS, dtype=np.int32)), pa.array(bands.ravel())),
                ],
                names=["doc_id", "c1", "c2", "n_shingles", "bands"],
            )


def sign(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, c1 and c2 (hashes of the word sequence), n_shingles, bands."""
    return text_columns(docs).mapInArrow(released(_sign), "doc_id bigint, c1 bigint, c2 bigint, n_shingles bigint, bands array<bigint>")


# ----------------------------------------------------------------- exact checks


def _sets(batch: pa.RecordBatch):
    """(row, first hash of the word sequence, sorted distinct shingles) of each text of a batch."""
    for i, j, data, off in text_slices(batch, "text"):
        h, doc, key, _ = word_sets(data, off)
        edge = np.searchsorted(doc, np.arange(j - i + 1)).tolist()
        for k in range(j - i):
            yield i + k, int(key[k, 0]), np.unique(h[edge[k] : edge[k + 1]])


def _compare(batches):
    """Rows come by leader and part, the leader's text first; links go out."""
    at, leaders = None, {}
    for batch in batches:
        a, part, member, a1, b, b1 = (batch.column(c).to_pylist() for c in ("a", "part", "member", "a1", "b", "b1"))
        left, right = [], []
        for k, own, s in _sets(batch):
            if (a[k], part[k]) != at:
                at, leaders = (a[k], part[k]), {}
            if not member[k]:
                leaders[own] = s
            elif own == b1[k] and (lead := leaders.get(a1[k])) is not None:
                shared = len(np.intersect1d(lead, s, assume_unique=True))
                if 100 * shared >= PERCENT * (len(lead) + len(s) - shared):
                    left.append(a[k])
                    right.append(b[k])
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, a1, b, b1) whose full sets are alike enough, as (a, b).

    A leader with many partners goes out once for each STAR_ROWS of them.
    """
    load = materialize(pairs.groupBy("a").agg(F.ceil(F.count("*") / STAR_ROWS).cast("int").alias("parts")), "load")
    dealt = pairs.join(load, "a").select("a", F.pmod(F.xxhash64("b", "b1"), "parts").cast("int").alias("part"), "a1", "b", "b1")
    members = dealt.join(texts, dealt["b"] == texts["node"]).select("a", "part", F.lit(True).alias("member"), "a1", "b", "b1", "text")
    null = F.lit(None).cast("bigint")
    leaders = load.join(texts, load["a"] == texts["node"]).select(
        "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(False).alias("member"), null.alias("a1"), null.alias("b"), null.alias("b1"), "text"
    )
    rows = leaders.unionByName(members).repartition("a", "part").sortWithinPartitions("a", "part", "member")
    return rows.mapInArrow(released(_compare), "a bigint, b bigint")


def parted(rows: DataFrame, column: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose ``column`` may be among ``ids`` (one column, each once), and the others, which surely are not.

    Each id sets one bit of a map for its hash; the maps (two bytes an id) go
    to all tasks, so rows are told apart where they are read, and only those
    that may be among the ids need a shuffle.
    """
    maps = max(1, -(-ids.count() // IDS_PER_MAP))
    number, bits, may = (fresh_name(rows, x) for x in ("_map", "_bits", "_may"))
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(maps))
    bit = lambda c: F.shiftrightunsigned(F.xxhash64(c), 49)
    table = ids.groupBy(place(ids.columns[0]).alias(number)).agg(F.bitmap_construct_agg(bit(ids.columns[0])).alias(bits))
    both = rows.join(F.broadcast(table), place(rows[column]) == F.col(number), "left")
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.shiftright(bit(column), 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    both = both.withColumn(may, F.coalesce(F.getbit(byte, F.pmod(bit(column), F.lit(8)).cast("int")) == 1, F.lit(False))).drop(number, bits)
    return both.where(F.col(may)).drop(may), both.where(~F.col(may)).drop(may)


def node_texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) of the classes in ``nodes``; the one step that moves the documents' texts."""
    need = materialize(nodes.select("node").distinct(), "need")
    own, _ = parted(text_columns(docs), "doc_id", need)
    return own.join(need, own["doc_id"] == need["node"]).select("node", "text")


def _compare_blocks(batches):
    """Rows come by target, block and part, the block of query texts first; links go out."""
    at, index, queries = None, None, []
    for batch in batches:
        target, block, part, member, node = (batch.column(c).to_pylist() for c in ("target", "block", "part", "member", "node"))
        left, right = [], []
        for k, _, s in _sets(batch):
            if (target[k], block[k], part[k]) != at:
                at, index, queries = (target[k], block[k], part[k]), None, []
            if not member[k]:
                queries.append((node[k], s))
                continue
            if not queries:
                continue
            if index is None:
                size = np.array([len(q) for _, q in queries])
                h, owner = np.concatenate([q for _, q in queries]), np.repeat(np.arange(len(queries)), size)
                order = np.argsort(h)
                index = (h[order], owner[order], size, [q for q, _ in queries])
            h, owner, size, names = index
            lo, hi = np.searchsorted(h, s, "left"), np.searchsorted(h, s, "right")
            n = hi - lo
            hits = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            shared = np.bincount(owner[hits], minlength=len(size))
            for q in np.flatnonzero(100 * shared >= PERCENT * (size + len(s) - shared)).tolist():
                left.append(node[k])
                right.append(names[q])
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


def linked_components(meets: DataFrame, members: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) between the members of components that meet.

    ``meets``: (p, q) pairs of components; ``members``: (node, component).
    The larger component of a pair is the target; its members are dealt into
    parts, the members of all components that it meets into blocks, and each
    part sees each block.
    """
    sizes = materialize(members.groupBy("component").agg(F.count("*").alias("size")), "sizes")
    p, q = (sizes.select(F.col("component").alias(c), F.struct(F.col("size").alias("n"), F.col("component").alias("c")).alias(f"{c}s")) for c in ("p", "q"))
    both = meets.join(p, "p").join(q, "q").select(F.greatest("ps", "qs").alias("big"), F.least("ps", "qs").alias("small"))
    aims = materialize(both.select(F.col("big.c").alias("target"), F.col("small.c").alias("component"), F.col("big.n").alias("size"), F.col("small.n").alias("n")), "aims")
    shape = materialize(aims.groupBy("target").agg(
        F.ceil(F.sum("n") / BLOCK_ROWS).cast("int").alias("blocks"), F.ceil(F.max("size") / BLOCK_ROWS).cast("int").alias("parts")
    ), "shape")
    own = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    ask = aims.join(members, "component").join(shape, "target").select("target", own("blocks").alias("block"), "parts", "node")
    ask = ask.select("target", "block", each("parts").alias("part"), F.lit(False).alias("member"), "node")
    given = shape.join(members, shape["target"] == members["component"]).select("target", own("parts").alias("part"), "blocks", "node")
    given = given.select("target", each("blocks").alias("block"), "part", F.lit(True).alias("member"), "node")
    rows = ask.unionByName(given).join(texts, "node").repartition("target", "block", "part").sortWithinPartitions("target", "block", "part", "member")
    return rows.mapInArrow(released(_compare_blocks), "a bigint, b bigint")


# ------------------------------------------------------------------- components


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of ``edges`` (a, b): the smallest node that each reaches.

    Large-star and small-star steps by turns, until nothing changes; each
    round is written to the shared folder.
    """
    e = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = materialize(e, "edges")
    seen = _fingerprint(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialize(least.select("u", F.col("m").alias("v")).unionByName(moved).distinct(), "edges")
        now = _fingerprint(e)
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).groupBy("node").agg(F.min("component").alias("component"))


# -------------------------------------------------------------------- candidates


def _alike_sizes(x: str, y: str):
    """Sets of these sizes can reach the threshold."""
    return 100 * F.least(x, y) >= PERCENT * F.greatest(x, y)


def _ordered(pairs: DataFrame) -> DataFrame:
    """Pairs (x, x1, y, y1) with the smaller class first, each once."""
    first = F.struct("x", "x1") <= F.struct("y", "y1")
    pick = lambda p, q: F.when(first, F.col(p)).otherwise(F.col(q))
    return pairs.select(pick("x", "y").alias("a"), pick("x1", "y1").alias("a1"), pick("y", "x").alias("b"), pick("y1", "x1").alias("b1")).distinct()


def _meeting(rows: DataFrame, *key: str) -> DataFrame:
    """Pairs (p, q) of components that have a key in common and sizes of sets that can link."""
    held = rows.groupBy(*key, "component").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    x = held.select(*key, F.col("component").alias("p"), F.col("lo").alias("pl"), F.col("hi").alias("ph"))
    y = held.select(*key, F.col("component").alias("q"), F.col("lo").alias("ql"), F.col("hi").alias("qh"))
    fits = (100 * F.col("ph") >= PERCENT * F.col("ql")) & (100 * F.col("qh") >= PERCENT * F.col("pl"))
    return x.join(y, list(key)).where((F.col("p") < F.col("q")) & fits).select("p", "q")


def _shingle_rows(batches):
    for batch in batches:
        node = batch.column("node").to_pylist()
        for k, own, s in _sets(batch):
            n = len(s)
            yield pa.RecordBatch.from_arrays([pa.array([node[k]] * n, pa.int64()), pa.array([own] * n, pa.int64()), pa.array(s.view(np.int64))], names=["node", "c1", "shingle"])


def _rare_meeting(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs of components whose members share one of their rarest shingles within a bucket."""
    shingles = texts.join(rows.select("node").distinct(), "node", "left_semi").mapInArrow(released(_shingle_rows), "node bigint, c1 bigint, shingle bigint").distinct()
    every = materialize(rows.join(shingles, ["node", "c1"]), "bucket-shingles")
    common = materialize(every.groupBy("key", "shingle").agg(F.count("*").alias("df")), "common")
    rarest = Window.partitionBy("key", "node", "c1").orderBy("df", "shingle")
    short = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1
    prefix = every.join(common, ["key", "shingle"]).withColumn("place", F.row_number().over(rarest)).where(F.col("place") <= short)
    return _meeting(prefix, "key", "shingle")


def groups(docs: DataFrame, meet_limit: int = MEET_LIMIT, rounds: int = ROUNDS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    signed = materialize(sign(docs), "signed")
    classes = signed.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)).groupBy("c1", "c2").agg(
        F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")
    )
    classes = materialize(classes, "classes")
    spread = classes.select("node", "c1", "n", F.explode("bands").alias("key"))
    shared = spread.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > 1).select("key")
    # classes that share a bucket with another one; from round to round, of the buckets that hold several components
    rest = materialize(spread.join(shared, "key").withColumn("component", F.col("node")), "members")

    texts = materialize(node_texts(docs, rest), "texts")
    links, done, found = None, None, None
    for turn in range(rounds):
        lead = F.min(F.struct(F.xxhash64("c1", F.lit(turn)).alias("by"), F.col("node").alias("x"), F.col("c1").alias("x1"), F.col("n").alias("xn"), F.col("component").alias("xc")))
        leaders = rest.groupBy("key").agg(lead.alias("lead")).select("key", "lead.*")
        other = (F.col("component") != F.col("xc")) | ((F.col("node") == F.col("x")) & (F.col("c1") != F.col("x1")))
        stars = rest.join(leaders, "key").where(other & _alike_sizes("n", "xn")).select("x", "x1", F.col("node").alias("y"), F.col("c1").alias("y1"))
        stars = _ordered(stars)
        if done is not None:
            stars = stars.join(done, ["a", "a1", "b", "b1"], "left_anti")
        stars = materialize(stars, "stars")
        new = materialize(verified(stars, texts), "links")
        links, done = (new, stars) if links is None else (links.unionByName(new), done.unionByName(stars))
        if turn and new.isEmpty():
            break
        found = materialize(components(links), "components")
        rest = _mixed(rest, found)
    counted = rest.join(rest.groupBy("key").agg(F.count_distinct("component").alias("held")), "key")
    meets = _meeting(counted.where(F.col("held") <= meet_limit), "key")
    large = materialize(counted.where(F.col("held") > meet_limit).drop("held"), "large")
    if not large.isEmpty():
        meets = meets.unionByName(_rare_meeting(large, texts))
    meets = materialize(meets.distinct(), "meets")
    if not meets.isEmpty():
        members = materialize(rest.select("node", "component").distinct(), "nodes")
        late = materialize(linked_components(meets, members, texts), "links")
        if not late.isEmpty():
            found = materialize(components(links.unionByName(late)), "components")

    nodes = classes.select("c1", "c2", "node").join(found, "node", "left").select("c1", "c2", F.coalesce("component", "node").alias("component"))
    rows = signed.select("doc_id", "c1", "c2", "n_shingles").join(nodes, ["c1", "c2"], "left")
    linked = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    out = rows.select("doc_id", "n_shingles", F.when(linked, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _mixed(rest: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of buckets that hold several components, with their components as found."""
    placed = rest.drop("component").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where(F.col("lo") < F.col("hi")).select("key")
    return materialize(placed.join(mixed, "key"), "mixed")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns) with one row of each group: that of its smallest doc_id.

    Of rows that repeat that doc_id one stays; rows without a doc_id all stay.
    """
    rows = materialize(groups(docs).select(F.col("doc_id").alias("_id"), "kept"), "groups")
    gone = materialize(rows.where(~F.col("kept")).select("_id").distinct(), "gone")
    may, left = parted(docs, "doc_id", gone)
    left = left.unionByName(may.join(gone, may["doc_id"] == gone["_id"], "left_anti"))
    again = rows.where(F.col("_id").isNotNull()).groupBy("_id").agg(F.count("*").alias("_n")).where(F.col("_n") > 1).select("_id")
    if again.isEmpty():
        return left
    twice = left.join(again, left["doc_id"] == again["_id"], "left_semi").dropDuplicates(["doc_id"])
    return left.join(again, left["doc_id"] == again["_id"], "left_anti").unionByName(twice)
