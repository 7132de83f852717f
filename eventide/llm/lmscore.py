"""Masked pseudo-likelihood scores from a bidirectional window network.

Tokens are words (runs without white space, A-Z as a-z).  The ``WORDS`` most
frequent words of the corpus, counted over all documents, have ids of their
own; the others share ``RARE`` ids by hash.  The network gives a rare word's
group, and the word has its share of the group: its count over the group's,
from the counts of all distinct words.

The network sees ``REACH`` words on either side of a place, never the word
itself: h = tanh(sum over offsets of D_o * E[word at o] + b).  The word's
probability is that of its class (ids in runs of ``CLASS``, by frequency)
times that of the word within its class, both softmax over h.

Training predicts every place of every document; no masking is needed, as the
network never sees the word itself.  Each task trains in numpy on its own
partition from the same start (Adagrad), and the tasks' parameters are
averaged, weighted by their places, in rounds of ``FAN_IN`` to one.

A document's score is the sum over all its words of log p(word | both sides).
The counts of rare words are joined to the documents' rare words by hash, and
their logarithms summed in units of 1 / ``UNIT``, so the order does not matter.

Defined cases: a null text, or one without words, has 0 tokens, a score of 0.0
and a mean of 0.0; repeated rows are trained on and scored each; words beyond
a text's ends are a token of their own; on an empty corpus the untrained
network is uniform; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NON_SPACE, Words, byte_values, materialize, text_columns, text_slices

WORDS, RARE, CLASS = 3968, 128, 64
SIZE = WORDS + RARE
CLASSES = SIZE // CLASS
REACH, DIM = 2, 16
BATCH, RATE, SEED = 2048, 0.15, 11
FAN_IN = 8
#: distinct words that a task holds before it hands on their counts
HELD_WORDS = 1 << 20
#: steps of a natural logarithm in the sums of word counts
UNIT = 1 << 24
_VALUES = byte_values(5)
_OFFSETS = [o for o in range(-REACH, REACH + 1) if o]
#: parameters by name, in the order of the flat vector
SHAPES = {
    "E": (SIZE + 1, DIM), "D": (len(_OFFSETS), DIM), "b": (DIM,),
    "C": (CLASSES, DIM), "c": (CLASSES,), "W": (SIZE, DIM), "w": (SIZE,),
}
PARAMETERS = sum(int(np.prod(s)) for s in SHAPES.values())


# ------------------------------------------------------------------ vocabulary


def _count(batches):
    hashes, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def total(h, n):
        order = np.argsort(h, kind="stable")
        h, n = h[order], n[order]
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
        return h[first], np.add.reduceat(n, first) if len(h) else n

    def out():
        return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts)], names=["word", "n"])

    fresh: list[np.ndarray] = []
    for batch in batches:
        for _, _, data, off in text_slices(batch, "text"):
            fresh.append(Words(data, off, NON_SPACE, _VALUES).hash)
            if sum(map(len, fresh)) >= HELD_WORDS:
                h, n = np.unique(np.concatenate(fresh), return_counts=True)
                hashes, counts = total(np.concatenate((hashes, h)), np.concatenate((counts, n)))
                fresh = []
                if len(hashes) >= HELD_WORDS:
                    yield out()
                    hashes, counts = hashes[:0], counts[:0]
    h, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *fresh]), return_counts=True)
    hashes, counts = total(np.concatenate((hashes, h)), np.concatenate((counts, n)))
    yield out()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): hash of each word and how often the documents hold it."""
    return text_columns(docs).mapInArrow(_count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Ids by frequency; ``share`` of all words for each id."""

    def __init__(self, words: list[int], counts: list[int], rest: np.ndarray):
        known = np.array(words, dtype=np.int64).view(np.uint64)
        order = np.argsort(known)
        self.known, self.id = known[order], order.astype(np.int32)
        n = np.zeros(SIZE)
        n[: len(counts)] = counts
        n[WORDS:] = rest
        self.share = (n + 0.5) / (n + 0.5).sum()
        #: log of the words counted in each group of rare words
        self.group = np.log(np.maximum(rest, 1))

    def ids(self, h: np.ndarray) -> np.ndarray:
        rare = (WORDS + (h >> np.uint64(40)) % np.uint64(RARE)).astype(np.int32)
        if not len(self.known):
            return rare
        at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        return np.where(self.known[at] == h, self.id[at], rare)


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The most frequent words (ties by hash), and the counts of the groups of rare words."""
    top = counts.orderBy(F.desc("n"), "word").limit(WORDS).collect()
    group = F.pmod(F.shiftrightunsigned("word", 40), F.lit(RARE)).cast("int")
    rest = np.zeros(RARE)
    for g, n in counts.groupBy(group).agg(F.sum("n")).collect():  # RARE rows
        rest[g] = n
    words = [r[0] for r in top]
    own = (np.array(words, dtype=np.int64).view(np.uint64) >> np.uint64(40)) % np.uint64(RARE)
    np.subtract.at(rest, own.astype(np.int64), np.array([r[1] for r in top], dtype=np.float64))
    return Vocabulary(words, [r[1] for r in top], rest)


# --------------------------------------------------------------------- network


def unflatten(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[name] = flat[at : at + size].reshape(shape)
        at += size
    return out


def start(share: np.ndarray) -> np.ndarray:
    """Parameters before training: small random weights, and biases that give each id its share."""
    rng = np.random.default_rng(SEED)
    p = {k: (rng.standard_normal(s) * 0.1).astype(np.float32) for k, s in SHAPES.items()}
    p["D"][:] = 1.0
    p["b"][:] = 0
    by_class = share.reshape(CLASSES, CLASS).sum(axis=1)
    p["c"] = np.log(by_class).astype(np.float32)
    p["w"] = np.log(share / np.repeat(by_class, CLASS)).astype(np.float32)
    return np.concatenate([v.ravel() for v in p.values()])


def places(w: Words, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids with REACH outside tokens around each text, and the place of each word."""
    at = np.arange(len(ids)) + REACH * (w.doc + 1)
    seq = np.full(len(ids) + REACH * (len(w.first) + 1), SIZE, dtype=np.int32)
    seq[at] = ids
    return seq, at


def log_probabilities(p: dict[str, np.ndarray], seq: np.ndarray, at: np.ndarray, rows: int = 1 << 14) -> np.ndarray:
    """log p of the word at each place given both its sides."""
    shifted = [p["E"] * p["D"][k] for k in range(len(_OFFSETS))]
    out = np.empty(len(at), dtype=np.float32)
    for a in range(0, len(at), rows):
        here = at[a : a + rows]
        h = np.tanh(sum(s.take(seq[here + o], axis=0) for s, o in zip(shifted, _OFFSETS, strict=True)) + p["b"])
        out[a : a + rows] = _log_p(p, h, seq[here])[0]
    return out


def _log_p(p, h, target, learn: bool = False):
    """log p of targets, the softmaxes over classes and (places sorted by class) over their words.

    A class has a product of its own; the rest is done for all places at once.
    """
    cls, every = target // CLASS, np.arange(len(h))
    soft = h @ p["C"].T
    soft += p["c"]
    out = soft[every, cls]
    np.exp(soft, out=soft)
    total = soft.sum(axis=1)
    out -= np.log(total)
    order = np.argsort(cls.astype(np.uint8), kind="stable")
    by_class = cls[order]
    edge = np.searchsorted(by_class, np.arange(CLASSES + 1)).tolist()
    runs = [(slice(k * CLASS, (k + 1) * CLASS), slice(edge[k], edge[k + 1])) for k in range(CLASSES) if edge[k] < edge[k + 1]]
    sides, inner = h.take(order, axis=0), target[order] - by_class * CLASS
    words = np.empty((len(h), CLASS), dtype=h.dtype)
    for own, rows in runs:
        part = words[rows]
        np.matmul(sides[rows], p["W"][own].T, out=part)
        part += p["w"][own]
    picked = words[every, inner]
    np.exp(words, out=words)
    within = words.sum(axis=1)
    out[order] += picked - np.log(within)
    if learn:
        soft /= total[:, None]
        words /= within[:, None]
    return out, soft, words, (cls, order, runs, sides, inner)


def _scatter(index: np.ndarray, values: np.ndarray, out: np.ndarray) -> None:
    """Sums of ``values`` (one row each) by ``index`` into ``out``, which holds zeros."""
    order = np.argsort(index.astype(np.uint16), kind="stable")
    index, values = index[order], values.take(order, axis=0)
    first = np.flatnonzero(np.concatenate(([True], index[1:] != index[:-1])))
    out[index[first]] = np.add.reduceat(values, first, axis=0)


def gradient(p: dict[str, np.ndarray], seq: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Gradient of the mean log p of the words at ``at``, flat."""
    context = [seq[at + o] for o in _OFFSETS]
    x = [p["E"].take(c, axis=0) for c in context]
    h = np.tanh(sum(v * d for v, d in zip(x, p["D"], strict=True)) + p["b"])
    _, soft, words, (cls, order, runs, sides, inner) = _log_p(p, h, seq[at], learn=True)
    flat, every = np.zeros(PARAMETERS, dtype=np.float32), np.arange(len(at))
    g = unflatten(flat)
    np.negative(soft, out=soft)
    soft[every, cls] += 1
    g["C"][:], g["c"][:] = soft.T @ h, soft.sum(axis=0)
    dh = soft @ p["C"]
    np.negative(words, out=words)
    words[every, inner] += 1
    back = np.empty_like(sides)
    for own, rows in runs:
        s = words[rows]
        np.matmul(s.T, sides[rows], out=g["W"][own])
        np.add.reduce(s, axis=0, out=g["w"][own])
        np.matmul(s, p["W"][own], out=back[rows])
    place = np.empty_like(order)
    place[order] = every
    dh += back.take(place, axis=0)
    dh *= 1 - h * h
    g["b"][:] = dh.sum(axis=0)
    for k, v in enumerate(x):
        g["D"][k] = (dh * v).sum(axis=0)
    _scatter(np.concatenate(context), np.concatenate([dh * d for d in p["D"]]), g["E"])
    flat /= len(at)
    return flat


def _train(vocab: Vocabulary, flat: np.ndarray):
    def run(batches):
        theta = flat.copy()
        p, power, seen = unflatten(theta), np.full(len(theta), 1e-6, dtype=np.float32), 0
        root = np.empty_like(power)

        for batch in batches:
            for _, _, data, off in text_slices(batch, "text"):
                w = Words(data, off, NON_SPACE, _VALUES)
                seq, at = places(w, vocab.ids(w.hash))
                for part in np.array_split(at, max(1, -(-len(at) // BATCH))):
                    if len(part):
                        g = gradient(p, seq, part)
                        power += np.multiply(g, g, out=root)
                        g *= RATE
                        theta += np.divide(g, np.sqrt(power, out=root), out=root)
                seen += len(at)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([theta.tobytes()], pa.binary())], names=["weight", "theta"])

    return run


def _average(batches):
    total, weight = None, 0
    for batch in batches:
        for n, raw in zip(batch.column("weight").to_pylist(), batch.column("theta"), strict=True):
            own = np.frombuffer(raw.as_py(), dtype=np.float32) * np.float64(n)
            total, weight = own if total is None else total + own, weight + n
    if weight:
        yield pa.RecordBatch.from_arrays([pa.array([weight], pa.int64()), pa.array([(total / weight).astype(np.float32).tobytes()], pa.binary())], names=["weight", "theta"])


def train(docs: DataFrame, vocab: Vocabulary) -> np.ndarray:
    """Parameters averaged over all tasks; each task trains on the whole of its partition."""
    flat = start(vocab.share)
    schema = "weight bigint, theta binary"
    models = materialize(text_columns(docs).mapInArrow(_train(vocab, flat), schema), "models")
    n = models.count()
    while n > 1:
        n = -(-n // FAN_IN)
        models = materialize(models.repartition(n).mapInArrow(_average, schema), "models")
        n = min(n, models.count())
    got = models.collect()  # one row at most
    return np.frombuffer(bytes(got[0]["theta"]), dtype=np.float32) if got else flat


# --------------------------------------------------------------------- scoring


def _score(vocab: Vocabulary, flat: np.ndarray):
    """Scores in which a rare word counts as found once; ``rare``: hashes of the rare words."""

    def run(batches):
        p = unflatten(flat)
        for batch in batches:
            for i, j, data, off in text_slices(batch, "text"):
                w = Words(data, off, NON_SPACE, _VALUES)
                own = vocab.ids(w.hash)
                seq, at = places(w, own)
                log_p = log_probabilities(p, seq, at).astype(np.float64)
                rare = np.flatnonzero(own >= WORDS)
                log_p[rare] -= vocab.group[own[rare] - WORDS]
                total = np.bincount(w.doc, weights=log_p, minlength=j - i)
                n = np.diff(w.first)
                ends = np.searchsorted(rare, w.first).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(i, j - i), pa.array(n, pa.int64()), pa.array(total), pa.array(total / np.maximum(n, 1)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(w.hash[rare].view(np.int64))),
                    ],
                    names=["doc_id", "n_tokens", "score", "mean_score", "rare"],
                )

    return run


def pseudo_likelihood(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_tokens, score (summed log p), mean_score."""
    counts = materialize(word_counts(docs), "word-counts")
    vocab = vocabulary(counts)
    flat = train(docs, vocab)
    schema = "doc_id bigint, n_tokens bigint, score double, mean_score double, rare array<bigint>"
    scored = text_columns(docs).mapInArrow(_score(vocab, flat), schema)
    scored = materialize(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    # a word found once adds log 1
    logs = counts.where("n > 1").select("word", F.round(F.log("n") * UNIT).cast("bigint").alias("log_n"))
    added = scored.select("row", F.explode("rare").alias("word")).join(logs, "word").groupBy("row").agg(F.sum("log_n").alias("log_n"))
    score = F.col("score") + F.coalesce("log_n", F.lit(0)) / UNIT
    return scored.drop("mean_score").join(added, "row", "left").select(
        "doc_id", "n_tokens", score.alias("score"), (score / F.greatest("n_tokens", F.lit(1))).alias("mean_score")
    )
