"""Runs (maximal periodic stretches of words) by suffix trees and Lyndon roots.

A run is a stretch of consecutive words with smallest period q and length of
at least max(MIN_WORDS, 2 q) that no neighbouring word extends keeping the
period.  Per text:

* a word of a run recurs q words before or after, inside the run.  So a word
  that occurs once is in no run and cuts the text; a word that occurs once in a
  stretch between cuts cuts that one, and so on until nothing changes.
  Stretches shorter than MIN_WORDS hold no run.  The trees are built over the
  stretches that are left, joined by separators that occur once, so no match
  crosses them: every run of the text is found, but the trees don't index the
  words that can't be in one;
* suffix trees of the stretches and of their reversal (Ukkonen, linear time);
  the Euler tour of a tree with a sparse table of depths answers the lowest
  common ancestor of two leaves, hence the longest common extension of two
  places, forwards and backwards, in constant time;
* every run has a Lyndon root in one of the two orders of words, and that is
  the longest Lyndon word at its place: it ends where the next smaller (or
  greater) suffix begins, by the leaves' order in the tour.  Each place's two
  roots are extended in both directions; what is at least two roots long is a
  run.

All of one text is done in one task, in time and memory linear in its words
(some 400 bytes a word of the stretches, one tree at a time), with no shuffle.
Texts share a tree by slices of about a megabyte, their words told apart, so
that the tables are made for a slice at once.

Defined cases: a null or empty text has no words and no runs; an empty table
gives no rows; repeated rows and null ids are kept as they are; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_columns, text_slices

MIN_WORDS = 12
SCHEMA = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
#: takes (doc_id, words) before the search
Edit = Callable[[int | None, list[bytes]], list[bytes]]


# ------------------------------------------------------------------ suffix tree


def suffix_tree(s: list[int]) -> tuple[dict[int, int], np.ndarray, int]:
    """Ukkonen's tree of ``s``, whose last word occurs once.

    Returns the children by (node * width + first word of the edge), the word
    depth of each inner node, and the width.  Node 0 is the root; the leaf of
    the suffix at i is node len(s) + 1 + i.
    """
    n, width = len(s), max(s) + 1
    first, last = [0] * (2 * n + 2), [n] * (2 * n + 2)  # a node's edge is s[first:last]
    depth, link, children = [0], [0], {}
    node = edge = length = pending = 0  # the active place, and the suffixes still to add
    leaf = n + 1
    for i, c in enumerate(s):
        pending += 1
        above = 0  # the inner node that waits for its suffix link
        while pending:
            if not length:
                edge = i
            key = node * width + s[edge]
            child = children.get(key)
            if child is None:
                children[key] = leaf
                first[leaf] = i
                leaf += 1
                if above:
                    link[above] = node
                    above = 0
            else:
                f = first[child]
                size = last[child] - f
                if length >= size:
                    node = child
                    length -= size
                    edge += size
                    continue
                if s[f + length] == c:
                    length += 1
                    if above:
                        link[above] = node
                    break
                inner = len(depth)
                depth.append(depth[node] + length)
                link.append(0)
                children[key] = inner
                first[inner], last[inner] = f, f + length
                first[child] = f + length
                children[inner * width + s[f + length]] = child
                children[inner * width + c] = leaf
                first[leaf] = i
                leaf += 1
                if above:
                    link[above] = inner
                above = inner
            pending -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - pending + 1
    return children, np.array(depth, np.int32), width


class Extensions:
    """Longest common extensions of the places of ``s`` (its last word occurs once), and the order of its suffixes."""

    def __init__(self, s: list[int]):
        n = len(s)
        children, depth, width = suffix_tree(s)
        keys = np.fromiter(children.keys(), np.int64, len(children))
        kids = np.fromiter(children.values(), np.int64, len(children))
        del children
        order = np.argsort(keys)
        kids, inner = kids[order], len(depth)
        begin = np.searchsorted(keys[order] // width, np.arange(inner + 1))
        # by levels: the tour of a node is the node, then each child's tour and the node again
        levels, front = [], np.zeros(1, np.int64)
        while len(front):
            n_kids = begin[front + 1] - begin[front]
            skip = np.cumsum(n_kids) - n_kids
            below = kids[np.repeat(begin[front] - skip, n_kids) + np.arange(n_kids.sum())]
            levels.append((front, n_kids, skip, below))
            front = below[below < inner]
        size, at = np.ones(2 * n + 2, np.int64), np.zeros(2 * n + 2, np.int64)
        for front, _, skip, below in levels[::-1]:
            size[front] = 1 + np.add.reduceat(size[below] + 1, skip)
        level = np.full(size[0], n, np.int32)
        level[0] = 0
        for front, n_kids, skip, below in levels:
            steps = np.cumsum(size[below] + 1)
            steps = steps - size[below] - 1
            at[below] = np.repeat(at[front] + 1 - steps[skip], n_kids) + steps
            level[at[below] + size[below]] = np.repeat(depth[front], n_kids)
            level[at[front]] = depth[front]
        self.visit = at[n + 1 : 2 * n + 1]
        self.rank = np.empty(n, np.int64)
        self.rank[np.argsort(self.visit)] = np.arange(n)
        self.table = [level]
        step = 1
        while 2 * step <= len(level):
            below = self.table[-1]
            self.table.append(np.minimum(below[:-step], below[step:]))
            step *= 2

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common extension at the places i and j (distinct)."""
        a, b = self.visit[i], self.visit[j]
        a, b = np.minimum(a, b), np.maximum(a, b) + 1
        k = np.frexp(b - a)[1] - 1  # the largest power of two within the stretch of the tour
        out = np.empty(len(a), np.int64)
        for level in np.unique(k).tolist():
            at = k == level
            row = self.table[level]
            out[at] = np.minimum(row[a[at]], row[b[at] - (1 << level)])
        return out


def root_ends(rank: list[int]) -> tuple[list[int], list[int]]:
    """Where the longest Lyndon word at each place ends, in the order of words and in its reverse (the last place excluded)."""
    m = len(rank) - 1
    smaller, greater = [m] * (m + 1), [m] * (m + 1)
    for i in range(m - 1, -1, -1):
        r, j = rank[i], i + 1
        if rank[j] < r:
            smaller[i] = j
            while j < m and rank[j] < r:
                j = greater[j]
            greater[i] = j
        else:
            greater[i] = j
            while j < m and rank[j] > r:
                j = smaller[j]
            smaller[i] = j
    return smaller, greater


def runs_of(s: list[int]) -> np.ndarray:
    """All runs of ``s`` (words from 1 on): rows of start, length, period, by start and period."""
    m = len(s)
    ahead = Extensions([*s, 0])
    place = np.arange(m)
    ends = root_ends(ahead.rank.tolist())
    i = np.concatenate((place, place))
    j = np.concatenate([np.array(e[:m], np.int64) for e in ends])
    inside = j < m  # a root that reaches the end is not repeated
    i, j = i[inside], j[inside]
    right = ahead.common(i, j)
    del ahead
    # of the words before the roots: place i - 1 is place m - i of the reversal
    back = Extensions([*s[::-1], 0]) if len(i) else None
    left = back.common(m - i, m - j) if back else right
    period, start, length = j - i, i - left, j - i + left + right
    found = length >= np.maximum(MIN_WORDS, 2 * period)
    return np.unique(np.stack((start, period, length), axis=1)[found], axis=0)[:, [0, 2, 1]]


# ------------------------------------------------------------------- texts


def _stretches(inside: np.ndarray, stretch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Beginnings and ends of the pieces of MIN_WORDS or more places that are inside and of one stretch."""
    label = np.where(inside, stretch + 1, 0)
    cut = np.flatnonzero(np.diff(label, prepend=-1, append=-1))
    begin, end = cut[:-1], cut[1:]
    keep = inside[begin] & (end - begin >= MIN_WORDS)
    return begin[keep], end[keep]


def runs_of_texts(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Runs of each text's words: rows of start, length, period by text, and the first row of each text (one entry more than texts)."""
    ids: list[int] = []
    n_ids = 1
    for words in texts:  # the words of different texts are told apart
        known = dict.fromkeys(words)
        known = dict(zip(known, range(n_ids, n_ids + len(known))))
        ids.extend(map(known.__getitem__, words))
        n_ids += len(known)
    ids = np.array(ids, np.int64)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.concatenate(([0], np.cumsum(size)))
    found = np.zeros((0, 3), np.int64)
    at = np.arange(len(ids))
    begin, end = _stretches(np.bincount(ids)[ids] > 1, np.repeat(np.arange(len(texts)), size)) if len(ids) else (at, at)
    while len(begin):  # places of ``at``, which holds the words not cut off yet
        size = end - begin
        stretch = np.repeat(np.arange(len(begin)), size)
        at = at[np.repeat(begin - np.cumsum(size) + size, size) + np.arange(len(stretch))]
        _, inverse, n = np.unique(stretch * n_ids + ids[at], return_inverse=True, return_counts=True)
        recurs = n[inverse] > 1
        if recurs.all():
            break
        begin, end = _stretches(recurs, stretch)
    if len(begin):
        last = np.flatnonzero(np.diff(stretch, append=-1))  # a separator follows each stretch
        _, short = np.unique(ids[at], return_inverse=True)
        s = np.insert(short + 1, last + 1, len(short) + 1 + np.arange(len(last)))
        place = np.insert(at, last + 1, -1)
        found = runs_of(s.tolist())
        found[:, 0] = place[found[:, 0]]
    cuts = np.searchsorted(found[:, 0], first)
    found[:, 0] -= np.repeat(first[:-1], np.diff(cuts))
    return found, cuts


def _kept(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that a run repeats."""
    if not len(runs):
        return words
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, runs[:, 0] + runs[:, 2], 1)
    np.add.at(step, runs[:, 0] + runs[:, 1], -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()]


def _search(edit: Edit | None):
    out = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()),
        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.string()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, off in text_slices(batch, "text"):
                ids = batch.column(0)[i:j].cast(pa.int64()).to_pylist()
                raw, cuts = data.tobytes(), off.tolist()
                texts = [raw[a:b].split() for a, b in zip(cuts, cuts[1:])]
                if edit is not None:
                    texts = [edit(doc_id, words) for doc_id, words in zip(ids, texts)]
                found, own = runs_of_texts(texts)
                collapsed = [b" ".join(_kept(words, found[a:b])).decode() for words, a, b in zip(texts, own[:-1].tolist(), own[1:].tolist())]
                listed = pa.ListArray.from_arrays(pa.array(own, pa.int32()), pa.StructArray.from_arrays([pa.array(c) for c in found.T.copy()], fields=list(out.field("runs").type.value_type)))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(w) for w in texts], pa.int64()), listed, pa.array(collapsed, pa.string())], schema=out)

    return run


def periodic_runs(docs: DataFrame, edit: Edit | None = None) -> DataFrame:
    """doc_id, n_words, runs (by start and period), collapsed (the words that no run repeats, joined by a space) of every row.

    Words are parted by ASCII white space.  A word is left out of ``collapsed``
    if a run holds it after the run's first period.
    """
    return text_columns(docs).select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_search(edit), SCHEMA)


def run_report(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one (ties: smallest start, then period) and digests of runs and collapsed text."""
    best: Column = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("size"), r["start"].alias("start"), r["period"].alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"), (-F.col("best.size")).alias("length"),
        F.col("best.period").alias("period"), F.floor(-F.col("best.size") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
