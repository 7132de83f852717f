"""Work of the operators' inner steps, counted in calls and rows rather than in seconds."""

from __future__ import annotations

import cProfile
import pstats

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from eventide.llm import common, dropout, lmscore, similarity, tokens

from .conftest import ROWS, make


def calls(run) -> int:
    profile = cProfile.Profile()
    profile.runcall(run)
    return pstats.Stats(profile).total_calls


def test_lm_gradient_makes_few_calls_a_class():
    rng = np.random.default_rng(3)
    p = lmscore.unflatten(lmscore.start(np.full(lmscore.SIZE, 1 / lmscore.SIZE)))
    seq = rng.integers(0, lmscore.SIZE, 2052).astype(np.int32)
    at = np.arange(2, 2050)
    assert calls(lambda: lmscore.gradient(p, seq, at)) < 6 * lmscore.CLASSES
    # the same sums as with each class on its own
    h = np.tanh(sum(p["E"][seq[at + o]] * d for o, d in zip(lmscore._OFFSETS, p["D"], strict=True)) + p["b"])
    want = np.zeros_like(p["W"])
    for k in range(lmscore.CLASSES):
        own = slice(k * lmscore.CLASS, (k + 1) * lmscore.CLASS)
        rows = np.flatnonzero(seq[at] // lmscore.CLASS == k)
        e = np.exp(h[rows] @ p["W"][own].T + p["w"][own])
        s = -e / e.sum(axis=1)[:, None]
        s[np.arange(len(rows)), seq[at][rows] % lmscore.CLASS] += 1
        want[own] = s.T @ h[rows] / len(at)
    assert lmscore.unflatten(lmscore.gradient(p, seq, at))["W"] == pytest.approx(want, abs=1e-7)


def test_dropout_learns_segmentations_in_bulk():
    c = dropout.Codec(public_tokenizers.path("piece_bpe_32k.model"), 0.3, 5)
    rng = np.random.default_rng(4)
    letters = np.array(list("etaoinshrdlu"))
    words = ["".join(rng.choice(letters, n)) for n in rng.integers(3, 12, 4000)]
    text, got = " ".join(words), []
    made = calls(lambda: got.extend(c.encode([text], [77])))
    learnt = len(c.ids_of)
    assert learnt > 8000 and made < 4 * learnt
    # each node has its parent's skips and its own, and any order of learning gives the same ids
    nodes = np.array([learnt - 1, 1])
    path = c._skips(nodes.copy())[0]
    assert path[c.depth[learnt - 1] - 1] == c.skip[learnt - 1] and path[c.depth[learnt - 1]] == -1
    other = dropout.Codec(public_tokenizers.path("piece_bpe_32k.model"), 0.3, 5)
    for k in range(3600, -1, -400):
        other.encode([" ".join(words[k : k + 400])], [1])
    assert other.encode([text], [77]) == got
    chunks = c.chunks(text)
    assert b"".join(c.segment_one(x, 77, k) for k, x in enumerate(chunks)) == got[0]


def test_part_encoder_keeps_short_parts_when_full(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_PARTS", 100)
    e = tokens.PartEncoder(public_tokenizers.path("byte_bpe_50k.json"), False)
    often = "so the cat sat on the mat, and that was that"
    texts = [often, *(" ".join(["head", *(f"longlonglong{n}x{k}" for n in range(40)), "the", " ", "end\n", "a.\nB", ""]) for k in range(6)), "", " the", "the ", "a  b", "one"]
    plain = [np.array(x.ids, "<u4").tobytes() for x in e.library.encode_batch(texts, add_special_tokens=False)]
    assert [e.encode([t])[0] for t in texts] == plain and e.encode(texts) == plain
    e.memo.clear()
    for t in texts[:3]:
        e.encode([t])
    # these 40 and 40 long parts do not fit with what was there; the short ones stay
    e.encode([texts[3]])
    assert {"the", "cat", "mat,"} <= set(e.memo) and len(e.memo) <= 100


class Counted(dict):
    """A dictionary that counts what is asked of it."""

    asked = 0

    def get(self, key):
        self.asked += 1
        return super().get(key)


@pytest.mark.parametrize("count_only", [False, True])
def test_part_encoder_looks_up_and_learns_each_word_once(monkeypatch, count_only):
    e = tokens.PartEncoder(public_tokenizers.path("byte_bpe_50k.json"), count_only)
    e.memo, sent = Counted(), []
    joined = e.joined
    monkeypatch.setattr(e, "joined", lambda parts: sent.extend(parts) or joined(parts))
    words = ["the", "thing", "élan", "日本語", "Straße", "\U00020000", "it's", "x1", "²", "dogs'", "a<|endoftext|>", "<|endoftext|>!!", "e\u0301", "\ufb01"]
    marks = ["", ",", "!!", ".***", "'", "'!", "|>", "..........", "_"]
    lines = ["\n", "\n\n", "\r\n", "\n\u00a0", ".\n", "'\n"]
    rng = np.random.default_rng(8)
    pick = [w + m for w in words for m in marks]
    pick += [a + n + b for a, n, b in zip(rng.choice(pick, 60), rng.choice(lines, 60), rng.choice(pick, 60))]
    texts = [" ".join(rng.choice(pick, 30)) for _ in range(60)]
    texts += ["", " ", "\n", "the", "the thing\n", "the \nthing the", " the", "the\tthing, the  thing", "one\nthe!!\nthing the\nthe!! the\nthing"]
    got = [x.ids for x in e.library.encode_batch(texts, add_special_tokens=False)]
    plain = [len(x) for x in got] if count_only else [np.array(x, "<u4").tobytes() for x in got]
    assert e.encode(texts) == plain and e.encode(texts) == plain and [e.encode([t])[0] for t in texts] == plain
    e = tokens.PartEncoder(public_tokenizers.path("byte_bpe_50k.json"), count_only)
    e.memo, sent[:] = Counted(), []
    monkeypatch.setattr(e, "joined", lambda parts: sent.extend(parts) or joined(parts))
    e.encode(["so the thing\nthe thing!! the thing, the élan\nthing's x1 the"] * 50)
    # 7 different parts after a space, and words that a part holds; words of letters do not go through whole texts
    assert e.memo.asked < 20 and sent == ["x1"]
    assert {"the", "thing", "thing!!", "thing,", "élan", "x1"} <= set(e.memo) and not any("\n" in p for p in e.memo)


def test_near_dedup_shuffles_only_rows_that_may_match(spark):
    docs = make(spark, [(None, "x"), (None, None), *((k // 2 * 7919 - 40_000, f"text {k}") for k in range(6000))])
    ids = spark.createDataFrame([(k * 7919 - 40_000,) for k in range(0, 3000, 300)] + [(5,)], "id bigint")
    may, others = similarity.parted(docs, "doc_id", ids)
    found, rest = ([(r.doc_id, r.text) for r in x.collect()] for x in (may, others))
    assert sorted(found + rest, key=str) == sorted(((r.doc_id, r.text) for r in docs.collect()), key=str)
    wanted = {r.id for r in ids.collect()}
    assert wanted - {5} <= {i for i, _ in found} and not wanted & {i for i, _ in rest} and len(found) < 100
    assert may.columns == others.columns == docs.columns
    none, every = similarity.parted(docs, "doc_id", ids.limit(0))
    assert none.isEmpty() and every.count() == 6002


def test_near_dedup_leaves_other_rows_where_they_are(spark, capsys):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = similarity.drop_near_duplicates(make(spark, [r for r in ROWS if r[0] != 3]))
        left.explain()
        plan = capsys.readouterr().out
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    kept = plan[plan.index("Union") :].split("SortMergeJoin")[0]
    assert "BroadcastHashJoin" in kept and "Exchange hashpartitioning(doc_id" not in kept
    assert "LeftAnti" in plan


def test_dropout_keeps_numbers_rather_than_objects():
    c = dropout.Codec(public_tokenizers.path("piece_bpe_32k.model"), 0.1, 5)
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("etaoinshrdlu"), n)) for n in rng.integers(3, 12, 300)]
    odd = "▁a \U0001f984\U0001f984b ▁" + "y" * 100
    texts = [" ".join(words * 40), "", odd, " ".join(words[:50]), odd + "\nq"]
    got = c.encode(texts, [1, 2, 3, 4, 5])
    # each occurrence is a number in an array, not a call
    assert calls(lambda: c.encode(texts, [1, 2, 3, 4, 5])) < 6000 and c.encode(texts, [1, 2, 3, 4, 5]) == got
    assert [c.encode([t], [k])[0] for k, t in enumerate(texts, 1)] == got
    ids = np.frombuffer(b"".join(got), dtype="<u2").astype(np.int64)
    assert c.decode(ids, np.cumsum([len(x) // 2 for x in got])) == [t.encode() for t in texts]
    assert len(c.ids) == 2 * c.ids_of[-1] and c.ids_of.itemsize == 8
    for k in range(0, 300, 7):
        assert c.segment([f"▁{words[k]}"], 9, np.array([k], np.uint64)) == [c.segment_one(f"▁{words[k]}", 9, k)]


def test_workers_keep_only_what_their_operator_needs():
    for name in ("one", "two"):
        common.kept(name)["memo"] = {k: str(k) for k in range(1000)}
    seen = []
    run = common.released(lambda batches: (seen.append((len(common.kept("one")), len(common.kept("two")))) or b for b in batches), "two")
    assert list(run([1, 2])) == [1, 2] and seen == [(0, 1)] * 2
    assert list(common.released(iter)([])) == [] and not common.kept("two")
    assert dropout._OPEN is common.kept("dropout") and tokens._OPEN is common.kept("tokens")


def test_small_batches_bound_bytes(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(key)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    rows = spark.range(0, 2000, 1, 1).selectExpr("id AS doc_id", "repeat('x', 10000) AS text")
    try:
        common.small_batches(spark)
        got = [r.n for r in rows.mapInArrow(sizes, "n bigint").collect()]
    finally:
        spark.conf.set(key, old)
    assert len(got) >= 4 and max(got) < 2 * common.BATCH_BYTES and sum(got) >= 20_000_000
