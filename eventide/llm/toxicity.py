"""Toxicity by compression distance: zstandard dictionaries of toxic and ordinary text.

Fitting takes a bounded sample of the labelled rows (``SAMPLE_DOCS`` and
``SAMPLE_CHARS`` for each class, in the order of a hash of the doc_id):

* the ordinary dictionary is trained by zstandard on windows of ordinary text;
* the toxic dictionary holds the same content and, before it, the segments of
  toxic text that are typical of it: words that stand in significantly more
  distinct contexts (neighbouring words) there than in ordinary text.  Counting
  contexts keeps copies of a text from making its words look typical;
* every text falls into windows of ``WINDOW`` words.  A window's gain is its
  compressed length with the ordinary dictionary less that with the toxic one.
  A text's features are its mean gain, the shares of its windows that gain at
  least ``STEPS`` bytes, and how much likelier its windows' gains are in toxic
  than in ordinary text (from two histograms), on average and in all;
* a logistic curve over the features is the calibrated score; ``THRESHOLD``
  cuts it.  Histograms and curve are fitted on the part of the sample that the
  dictionaries have not seen.

Scoring needs the text alone.

Defined cases: a null or empty text has one empty window (no gain); a label
that is null, or of a row that is not in the table, is not used; rows that
repeat a doc_id are used once and scored each; without labels of both classes
every score is 0.5, which is below the threshold; a null doc_id counts as
held out; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept, make_room, materialize, release, text_columns

THRESHOLD = 0.7
SAMPLE_DOCS, SAMPLE_CHARS = 3000, 12_000_000
WINDOW, STEPS = 16, (2, 4, 6)
ORDINARY_BYTES, TOXIC_BYTES = 24_000, 8192
#: gains from -8 to 15 bytes have a place in the histograms, larger ones the last
LOWEST, PLACES = -8, 24
#: weight of all ordinary texts against all toxic ones when the curve is fitted
ORDINARY_WEIGHT = 3.0
#: standard deviations by which a word's contexts exceed what ordinary text would give
EXCESS = 4.0
#: each third document of the sample, by hash, calibrates
_CALIBRATE = 3
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_OPEN: dict[bytes, tuple] = kept("toxicity")


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    likelier: tuple[float, ...] = ()
    weights: tuple[float, ...] = ()


def windows(text: str) -> list[bytes]:
    words = text.encode().lower().split()
    return [b" ".join(words[i : i + WINDOW]) for i in range(0, len(words), WINDOW)] or [b""]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters(
        window_log=17, hash_log=16, chain_log=16, search_log=6, min_match=4, target_length=16, strategy=zstandard.STRATEGY_LAZY2,
        write_content_size=False, write_dict_id=False, write_checksum=False,
    )
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=settings)


def gains(model: Model, text: str) -> np.ndarray:
    """Bytes that the toxic dictionary saves against the ordinary one, for each window."""
    key = model.toxic + model.ordinary
    if key not in _OPEN:
        _OPEN.clear()
        _OPEN[key] = (_compressor(model.ordinary).compress, _compressor(model.toxic).compress)
    ordinary, toxic = _OPEN[key]
    return np.array([len(ordinary(w)) - len(toxic(w)) for w in windows(text)], dtype=np.float64)


def _place(g: np.ndarray) -> np.ndarray:
    return np.clip(g - LOWEST, 0, PLACES - 1).astype(np.int64)


def features(model: Model, g: np.ndarray) -> list[float]:
    """Features of a text from its windows' gains."""
    n, ratio = len(g), np.array(model.likelier)[_place(g)]
    return [float(ratio.mean()) * 3, float(ratio.sum()) / math.sqrt(n + 1), float(g.mean()), *(float((g >= k).sum()) / (n + 1) * 10 for k in STEPS), 1.0]


def histograms(each: list[np.ndarray], labels: list[int]) -> tuple[float, ...]:
    """Log ratio of how often a gain comes up in toxic and in ordinary texts; a text counts as 20 windows at most."""
    seen = np.full((2, PLACES), 0.5)
    for g, label in zip(each, labels, strict=True):
        seen[label] += np.bincount(_place(g), minlength=PLACES) / len(g) * min(len(g), 20)
    share = seen / seen.sum(axis=1, keepdims=True)
    return tuple(np.log(share[1] / share[0]).tolist())


def score(model: Model | None, text: str | None) -> float:
    if model is None:
        return 0.5
    z = sum(w * x for w, x in zip(model.weights, features(model, gains(model, text or "")), strict=True))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


# --------------------------------------------------------------------- fitting


def _contexts(texts: list[bytes], words: set[bytes]) -> Counter:
    """Distinct pairs of neighbours of each of ``words``."""
    seen = set()
    for t in texts:
        w = [b"", *_WORD.findall(t), b""]
        seen.update((w[i - 1], w[i], w[i + 1]) for i in range(1, len(w) - 1) if w[i] in words)
    return Counter(x[1] for x in seen)


def typical_words(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Words of toxic text, the most typical last."""
    share = sum(map(len, toxic)) / max(1, sum(map(len, ordinary)))
    here, there = Counter(), Counter()
    for texts, count in ((toxic, here), (ordinary, there)):
        for t in texts:
            count.update(_WORD.findall(t))

    def excess(n: int, usual: int) -> float:
        expected = (usual + 1) * share
        return (n - expected) / math.sqrt(expected + 1)

    likely = {w for w, n in here.items() if excess(n, there[w]) >= EXCESS}
    a, b = _contexts(toxic, likely), _contexts(ordinary, likely)
    by = {w: excess(a[w], b[w]) for w in likely}
    return sorted((w for w in likely if by[w] >= EXCESS), key=lambda w: (by[w], w))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the classes weigh 1 to ORDINARY_WEIGHT."""
    w = np.zeros(x.shape[1])
    weight = np.where(y == 1, 1 / max(1, (y == 1).sum()), ORDINARY_WEIGHT / max(1, (y == 0).sum())) * len(y) / (1 + ORDINARY_WEIGHT)
    ridge = np.full(x.shape[1], 0.05)
    ridge[-1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + ridge * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(rows: list[tuple[int, str, int]]) -> Model | None:
    """A model from (doc_id, text, label) rows; None without both classes."""
    part = lambda i: zlib.crc32(f"calibrate/{i}".encode()) % _CALIBRATE == 0
    fit = [r for r in rows if not part(r[0])]
    check = [r for r in rows if part(r[0])]
    if len({r[2] for r in check}) < 2 or len({r[2] for r in fit}) < 2:
        fit = check = rows
    if len({r[2] for r in fit}) < 2:
        return None
    toxic, ordinary = ([r[1].encode().lower() for r in fit if r[2] == k] for k in (1, 0))
    samples = [w for r in fit if r[2] == 0 for w in windows(r[1]) if w]
    try:
        base = zstandard.train_dictionary(ORDINARY_BYTES, samples, d=6, k=64).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself is the dictionary
        base = b" ".join(samples)[-ORDINARY_BYTES:]
    segments = b"".join(b" " + w + b" " for w in typical_words(toxic, ordinary))[-TOXIC_BYTES:]
    model = Model(base, segments + base)
    each, labels = [gains(model, r[1]) for r in check], [r[2] for r in check]
    model = Model(model.ordinary, model.toxic, histograms(each, labels))
    x = np.array([features(model, g) for g in each])
    return Model(model.ordinary, model.toxic, model.likelier, tuple(_logistic(x, np.array(labels)).tolist()))


def remainder(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 3; rows with 1 are held out."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(remainder(doc_id) == 1, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> Model | None:
    """Learn from a bounded sample of the labelled rows that are not held out."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("label"))
    ids = None
    for label in (0, 1):
        own = known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
        ids = own if ids is None else ids.unionByName(own)
    # 2 * sample_docs ids at most
    wanted = F.broadcast(ids.select(F.col("doc_id").alias("_id"), "label"))
    rows = text_columns(docs).where(F.col("text").isNotNull())
    sample = materialize(rows.join(wanted, rows["doc_id"] == wanted["_id"]).select("doc_id", "text", "label"), "labelled").dropDuplicates(["doc_id"])
    size = sample.select("doc_id", "label", F.length("text").alias("n")).collect()
    take = []
    for label in (0, 1):
        room = sample_chars
        for doc_id, n in sorted(((r[0], r[2]) for r in size if r[1] == label), key=lambda r: zlib.crc32(f"order/{r[0]}".encode())):
            if n <= room:
                room -= n
                take.append(doc_id)
    got = sample.where(F.col("doc_id").isin(take)).collect() if take else []
    return train(sorted((r["doc_id"], r["text"], r["label"]) for r in got))


# --------------------------------------------------------------------- scoring


def score_column(model: Model | None, text: Column) -> Column:
    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        make_room("toxicity")
        out = pd.Series([score(model, t) for t in texts], dtype="float64")
        release()  # what batches before this one held; the worker lives on
        return out

    return scored(text)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    model = fit(docs, labels)
    rows = text_columns(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(model, F.col("text")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` (all columns) without the documents that are scored toxic."""
    return docs.where(score_column(fit(docs, labels), F.col("text")) < THRESHOLD)
