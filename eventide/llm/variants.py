"""Spelling variants: words one edit apart, by k-d trees over letter counts.

A word is a point: how often it holds each letter.  One inserted or deleted
letter moves the point by an L1 distance of 1, one replaced letter by 2, so the
words near a word lie in small boxes around it.

* Words are counted in tasks and added up by Spark.
* For each length, the words are dealt to cells by the cuts of a k-d tree that
  the driver builds from a bounded sample (SAMPLE words, by hash; the cuts only
  deal words, every word is indexed).  A word is kept in its own cell and sent
  as a query to each cell of its length and of the next smaller one that may
  hold a word within distance: each cut that is crossed costs its distance, and
  at most two are allowed, so copies grow with the square of the tree's depth,
  not with the words.
* In a cell a k-d tree is built over all its words; blocks of queries go down
  together, and a branch keeps the queries whose box distance is within reach
  (exactly 2 for equal length, 1 for lengths that differ).  At the leaves the
  pairs at that very distance are verified letter by letter.
* A cell's queries are dealt in blocks, and each block's task builds the cell's
  tree for itself, so a crowded cell is many tasks.

Links are added up by word; ``form`` is the near word of largest count if that
is RATIO times the word's, and ``root`` follows forms to the last one by
pointer doubling (a form's count grows RATIO-fold each step, so this ends).

Defined cases: a null or empty text has no words; a null doc_id is an empty
one in the hash of the edit; an empty table gives no rows; repeated rows count
each; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_columns, text_slices

MIN_CHARS, MIN_COUNT, RATIO = 6, 5, 5
SAMPLE = 50_000
#: words a cell holds (by the sample), queries of one block, words of a leaf
CELL, BLOCK, LEAF = 8_192, 16_384, 48
#: letters a-z, then U+00C0 to U+00FF
LETTERS = 26 + 64
_LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})
#: takes (doc_id, lower-cased run)
Edit = Callable[[int | None, str], str]


# ---------------------------------------------------------------------- counts


def _count(edit: Edit | None, limit: int = 200_000):
    runs = re.compile(f"[A-Za-zÀ-ÿ]{{{MIN_CHARS},}}")

    def rows(n: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array(n.keys(), pa.string()), "n": pa.array(n.values(), pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for i, j, data, off in text_slices(batch, "text"):
                raw, cuts = data.tobytes(), off.tolist()
                for k, doc_id in enumerate(batch.column(0)[i:j].to_pylist()):
                    found = Counter(runs.findall(raw[cuts[k] : cuts[k + 1]].decode().translate(_LOWER)))
                    if edit is not None:
                        found = _edited(found, doc_id, edit)
                    total.update(found)
                if len(total) > limit:
                    yield rows(total)
                    total = Counter()
        yield rows(total)

    return run


def _edited(found: Counter, doc_id: int | None, edit: Edit) -> Counter:
    out: Counter = Counter()
    for word, n in found.items():
        word = edit(doc_id, word)
        if len(word) >= MIN_CHARS:
            out[word] += n
    return out


def word_counts(docs: DataFrame, edit: Edit | None = None) -> DataFrame:
    """word, n of the maximal letter runs of MIN_CHARS or more (A-Z lower-cased) found MIN_COUNT times or more.

    A run of fewer letters is no word even if ``edit`` lengthens it.
    """
    parts = text_columns(docs).select(F.col("doc_id").cast("string"), "text").mapInArrow(_count(edit), "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


# --------------------------------------------------------------------- vectors


def letters(words: list[str], width: int) -> np.ndarray:
    """The words' letters, one row each, 0 beyond the end."""
    return np.array(words, dtype=f"<U{width}").view(np.uint32).reshape(len(words), width).astype(np.uint8)


def vectors(chars: np.ndarray) -> np.ndarray:
    """How often each letter occurs in each row (at most 255 times)."""
    index = np.full(256, LETTERS, np.int64)
    index[97:123] = np.arange(26)
    index[0xC0:0x100] = np.arange(26, LETTERS)
    n = len(chars)
    flat = (np.arange(n)[:, None] * (LETTERS + 1) + index[chars]).ravel()
    return np.minimum(np.bincount(flat, minlength=n * (LETTERS + 1)), 255).reshape(n, LETTERS + 1)[:, :LETTERS].astype(np.uint8)


def split_at(points: np.ndarray) -> tuple[int, int] | None:
    """The letter and count that part the points best: those up to the count, and the others."""
    best = None
    for count in range(int(points.max(initial=0))):
        low = (points <= count).sum(axis=0)
        uneven = np.abs(2 * low - len(points))
        uneven[(low == 0) | (low == len(points))] = len(points) + 1
        d = int(uneven.argmin())
        if uneven[d] <= len(points) and (best is None or uneven[d] < best[0]):
            best = (int(uneven[d]), d, count)
    return best and best[1:]


# ------------------------------------------------------------------- k-d trees


class Tree:
    """A k-d tree over points, each node with its box.

    ``tight`` boxes are those of the points; others are given by the cuts alone
    and fill the space, so that any point has one leaf at distance 0.
    """

    def __init__(self, points: np.ndarray, per_leaf: float, tight: bool):
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.sides: list[tuple[int, int] | None] = []
        self.leaf: list[np.ndarray] = []  # the points of a leaf, by row
        full = np.zeros(LETTERS, np.uint8), np.full(LETTERS, 255, np.uint8)
        work = [(np.arange(len(points)), full, None)]
        while work:
            rows, (low, high), parent = work.pop()
            mine, here = points[rows], len(self.sides)
            if tight and len(rows):
                low, high = mine.min(axis=0), mine.max(axis=0)
            self.low.append(low)
            self.high.append(high)
            self.sides.append(None)
            self.leaf.append(rows)
            if parent is not None:
                self.sides[parent] = (*(self.sides[parent] or ()), here)
            cut = split_at(mine) if len(rows) > per_leaf else None
            if cut is None:
                continue
            letter, count = cut
            below = mine[:, letter] <= count
            ends, starts = high.copy(), low.copy()
            ends[letter], starts[letter] = count, count + 1
            work += [(rows[below], (low, ends), here), (rows[~below], (starts, high), here)]

    def within(self, points: np.ndarray, distance: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of ``points``) whose L1 distance to the leaf's box is within reach."""
        work = [(0, np.arange(len(points)))]
        while work:
            node, rows = work.pop()
            at = points[rows]
            gap = (np.maximum(at, self.low[node]) - np.minimum(at, self.high[node])).sum(axis=1, dtype=np.int32)
            rows = rows[gap <= distance]
            if not len(rows):
                continue
            if self.sides[node] is None:
                yield node, rows
            else:
                work += [(k, rows) for k in self.sides[node]]


def one_edit(longer: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Which rows of letters differ by one replaced letter (equal widths), or by one letter more."""
    if longer.shape[1] == shorter.shape[1]:
        return (longer != shorter).sum(axis=1) == 1
    same = np.logical_and.accumulate(longer[:, :-1] == shorter, axis=1).sum(axis=1)
    after = np.logical_and.accumulate((longer[:, 1:] == shorter)[:, ::-1], axis=1).sum(axis=1)
    return same + after >= shorter.shape[1]


def near_pairs(words: list[str], queries: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row of queries, row of words) of the pairs one edit apart; words are of one length, queries of that one or one more."""
    width = len(words[0])
    home = letters(words, width)
    points = vectors(home)
    tree = Tree(points, LEAF, tight=True)
    size = np.fromiter(map(len, queries), np.int64, len(queries))
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for extra, distance in ((0, 2), (1, 1)):
        rows = np.flatnonzero(size == width + extra)
        if not len(rows):
            continue
        asked = letters([queries[k] for k in rows.tolist()], width + extra)
        at = vectors(asked)
        for leaf, near in tree.within(at, distance):
            inside = tree.leaf[leaf]
            for k in range(0, len(near), 1024):
                some = near[k : k + 1024]
                a, b = at[some][:, None, :], points[inside][None, :, :]
                gap = (np.maximum(a, b) - np.minimum(a, b)).sum(axis=2, dtype=np.int32)
                q, w = np.nonzero(gap <= distance)
                q, w = some[q], inside[w]
                good = one_edit(asked[q], home[w])
                left.append(rows[q[good]])
                right.append(w[good])
    return np.concatenate(left), np.concatenate(right)


# ----------------------------------------------------------------------- cells

_DEALT = "length int, cell int, query boolean, word string, n bigint"


def _deal(cells: dict[int, Tree]):
    number = {size: np.cumsum([side is None for side in t.sides]) - 1 for size, t in cells.items()}

    def reach(words: list[str], points: np.ndarray, size: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
        if size not in cells:
            return np.arange(len(words)), np.zeros(len(words), np.int64)
        found = [(rows, np.full(len(rows), number[size][leaf])) for leaf, rows in cells[size].within(points, distance)]
        return tuple(np.concatenate(x) for x in zip(*found))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            by_size: dict[int, list[int]] = {}
            for k, w in enumerate(words):
                by_size.setdefault(len(w), []).append(k)
            for size, rows in by_size.items():
                some = [words[k] for k in rows]
                points = vectors(letters(some, size))
                for to, distance, query in ((size, 0, False), (size, 2, True), (size - 1, 1, True)):
                    if to < MIN_CHARS:
                        continue
                    at, cell = reach(some, points, to, distance)
                    picked = batch.take(pa.array(np.array(rows)[at]))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(at), to), pa.int32()), pa.array(cell, pa.int32()), pa.array(np.full(len(at), query)),
                        picked.column(0), picked.column(1),
                    ], names=["length", "cell", "query", "word", "n"])

    return run


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for home, queries in zip(batch.column(0), batch.column(1)):
            words, asked = home.values.field("word").to_pylist(), queries.values.field("word").to_pylist()
            n, m = home.values.field("n").to_numpy(), queries.values.field("n").to_numpy()
            q, w = near_pairs(words, asked)
            # of two words of one length, each asks for the other: the pair is taken once
            keep = np.array([len(asked[a]) > len(words[b]) or asked[a] < words[b] for a, b in zip(q.tolist(), w.tolist())], bool)
            q, w = q[keep], w[keep]
            a, b = [asked[k] for k in q.tolist()], [words[k] for k in w.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([*a, *b], pa.string()), pa.array([*b, *a], pa.string()), pa.array(np.concatenate((n[w], m[q])), pa.int64())], names=["word", "near", "near_n"])


def near_words(words: DataFrame) -> DataFrame:
    """word, near, near_n: both directions of every pair of ``words`` (word, n; distinct) one edit apart."""
    sized = words.select("word", "n", F.length("word").alias("size"))
    crowded = {r["size"]: r["count"] for r in sized.groupBy("size").count().where(F.col("count") > CELL).collect()}
    cells: dict[int, Tree] = {}
    if crowded:
        every = -(-sum(crowded.values()) // SAMPLE)
        picked = sized.where(F.col("size").isin(*crowded) & (F.pmod(F.xxhash64("word"), F.lit(every)) == 0)).select("word").toPandas()["word"]
        for size, some in picked.groupby(picked.str.len()):
            cells[int(size)] = Tree(vectors(letters(some.tolist(), int(size))), CELL * len(some) / crowded[int(size)], tight=False)
    dealt = materialize(words.select("word", "n").mapInArrow(_deal(cells), _DEALT), "variant-cells")
    key = ["length", "cell"]
    own = dealt.where(~F.col("query")).groupBy(*key).agg(F.collect_list(F.struct("word", "n")).alias("home"))
    asked = dealt.where("query")
    blocks = asked.groupBy(*key).agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    block = F.pmod(F.xxhash64("word"), F.col("blocks")).alias("block")
    asked = asked.join(blocks, key).groupBy(*key, block).agg(F.collect_list(F.struct("word", "n")).alias("asked"))
    return own.join(asked, key).select("home", "asked").mapInArrow(_links, "word string, near string, near_n bigint")


# ------------------------------------------------------------------ spellings


def spelling_forms(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every one of ``words`` (word, n; distinct)."""
    words = materialize(words.select("word", "n"), "variant-words")
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    top = -F.col("best.less")
    chosen = top >= RATIO * F.col("n")
    forms = materialize(words.join(near, "word", "left").select(
        "word", F.when(chosen, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(chosen, top).alias("form_n"),
    ), "variant-forms")
    steps = forms.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    # counts grow RATIO-fold a step, which bounds the steps of a chain; each round doubles what is followed
    most, longest, followed = forms.agg(F.max("n")).first()[0] or 0, 0, 1
    while most >= RATIO * MIN_COUNT:
        most, longest = most // RATIO, longest + 1
    while followed < longest:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = materialize(steps.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "variant-roots")
        followed *= 2
    return forms.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, edit: Edit | None = None) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the texts (see word_counts)."""
    return spelling_forms(word_counts(docs, edit))
