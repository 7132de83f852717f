"""Every operator on nulls, empty and long texts, repeated rows, an empty table and clashing column names."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from eventide.llm import bottomk, chat, decontaminate, dropout, linededup, lmscore, similarity, tokencount, tokenfile, toxicity
from eventide.llm.common import scratch, ship

from .conftest import LINE, ROWS, make

BPE, WORD, PIECE = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
IDS = Counter(r[0] for r in ROWS)


@pytest.fixture(autouse=True, scope="module")
def _shipped(spark):
    ship(spark)


def ids(df):
    return Counter(r.doc_id for r in df.collect())


# ------------------------------------------------------------------ LM scoring


def test_lm_scores_every_row(docs, nothing):
    rows = lmscore.pseudo_likelihood(docs).collect()
    assert Counter(r.doc_id for r in rows) == IDS
    for r in rows:
        assert np.isfinite(r.score) and (r.n_tokens > 0) == (r.score < 0)
    assert {(r.score, r.n_tokens) for r in rows if r.doc_id in (7, 8, 10)} == {(0.0, 0)}
    assert len({r.score for r in rows if r.doc_id == 3}) == 1
    assert lmscore.pseudo_likelihood(nothing).count() == 0


def test_lm_gradient_and_training():
    import pyarrow as pa

    text = " ".join("a b c d e f g h".split() * 400)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": [text]})
    c = next(lmscore._count([batch]))
    n = c["n"].to_numpy()
    order = np.argsort(-n)
    vocab = lmscore.Vocabulary(c["word"].to_numpy()[order].tolist(), n[order].tolist(), np.zeros(lmscore.RARE))
    flat = lmscore.start(vocab.share)
    before = next(lmscore._score(vocab, flat)([batch]))["mean_score"][0].as_py()
    trained = np.frombuffer(next(lmscore._train(vocab, flat)([batch]))["theta"][0].as_py(), np.float32)
    after = next(lmscore._score(vocab, trained)([batch]))["mean_score"][0].as_py()
    assert after > before + 0.1
    p, at = lmscore.unflatten(flat), np.arange(2, 30)
    seq = np.concatenate(([lmscore.SIZE] * 2, vocab.ids(lmscore.Words(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]), lmscore.NON_SPACE, lmscore._VALUES).hash), [lmscore.SIZE] * 2))
    g = lmscore.gradient(p, seq, at)
    wide = flat.astype(np.float64)
    for k in np.argsort(-np.abs(g))[:5].tolist():
        up, down = wide.copy(), wide.copy()
        up[k], down[k] = up[k] + 1e-3, down[k] - 1e-3
        slope = (lmscore.log_probabilities(lmscore.unflatten(up), seq, at).astype(float).mean() - lmscore.log_probabilities(lmscore.unflatten(down), seq, at).astype(float).mean()) / 2e-3
        assert abs(slope - g[k]) < 0.02 * abs(g[k]) + 1e-3
    # probabilities of all words at a place add up to 1
    seq = np.tile(seq[:8], lmscore.SIZE)
    seq[3::8] = np.arange(lmscore.SIZE)
    assert np.exp(lmscore.log_probabilities(p, seq, np.arange(lmscore.SIZE) * 8 + 3).astype(float)).sum() == pytest.approx(1, abs=1e-3)


def test_lm_trains_on_every_place(monkeypatch):
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 1, 2, None, 3], "text": ["a b c " * 900, "a b c " * 900, "header one", None, "header two"]})
    c = next(lmscore._count([batch]))
    vocab = lmscore.Vocabulary(c["word"].to_pylist(), c["n"].to_pylist(), np.zeros(lmscore.RARE))
    seen, gradient = [], lmscore.gradient
    monkeypatch.setattr(lmscore, "gradient", lambda p, seq, at: seen.append(at) or gradient(p, seq, at))
    trained = next(lmscore._train(vocab, lmscore.start(vocab.share))([batch]))
    assert trained["weight"].to_pylist() == [5404]
    outside = lmscore.REACH * 6
    places = np.concatenate(seen)
    assert len(places) == len(set(places.tolist())) == 5404 and places.max() < 5404 + outside


def test_lm_gives_every_rare_word_its_own_probability(spark, monkeypatch):
    monkeypatch.setattr(lmscore, "train", lambda docs, vocab: lmscore.start(vocab.share))
    often = [(k, " ".join(f"common{(137 * k + i) % 5000}" for i in range(1000))) for k in range(40)]
    # words that no document of the others has, each a different number of times
    rare = [(100 + n, " ".join([f"seldom{n}"] * n)) for n in (1, 2, 5)]
    docs = make(spark, [*often, *rare])
    words = {r.word: r.n for r in lmscore.word_counts(docs).collect()}
    assert len(words) > lmscore.WORDS
    vocab = lmscore.vocabulary(lmscore.word_counts(docs))
    known = set(vocab.known.view(np.int64).tolist())
    group, word = Counter(), {}
    for h, n in words.items():
        if h not in known:
            g = int(vocab.ids(np.array([h]).view(np.uint64))[0])
            group[g] += n
            word[h] = (g, n)
    flat = lmscore.start(vocab.share)
    p = lmscore.unflatten(flat)
    got = {r.doc_id: r for r in lmscore.pseudo_likelihood(docs).collect()}
    assert len(got) == 43
    for i, t in [*often[:3], *rare]:
        w = lmscore.Words(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]), lmscore.NON_SPACE, lmscore._VALUES)
        want = lmscore.log_probabilities(p, *lmscore.places(w, vocab.ids(w.hash))).astype(float).sum()
        for h in w.hash.view(np.int64).tolist():
            if h in word:
                want += np.log(word[h][1] / group[word[h][0]])
        assert got[i].score == pytest.approx(want, rel=1e-6) and got[i].mean_score == pytest.approx(want / len(w.hash), rel=1e-6)
    # the shares of a group's words add up to the group
    total = Counter()
    for g, n in word.values():
        total[g] += n / np.exp(vocab.group[g - lmscore.WORDS])
    assert all(x == pytest.approx(1) for x in total.values())


# --------------------------------------------------------------- near duplicates


def brute_groups(rows):
    def words(t):
        return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            s = len(sets[i] & sets[j])
            if s and rows[i][0] is not None and rows[j][0] is not None and 100 * s >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[root(i)].append(r[0])
    return Counter((r[0], len(sets[i]), min(groups[root(i)], key=lambda x: (x is None, x)) if r[0] is not None else None) for i, r in enumerate(rows))


def test_near_duplicates_equal_brute_force(spark, docs, nothing):
    got = similarity.groups(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_groups(ROWS)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert similarity.groups(nothing).count() == 0
    left = similarity.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert ids(left) == Counter({None: 2} | {i: 1 for i in (2, 3, 7, 8, 10, 11, 13, 14, 15, 16, 17, 18, 20, 21, 22)} | {2: 1}) - Counter(
        {r.doc_id: 1 for r in got if r.doc_id is not None and not r.kept}
    )


@pytest.mark.parametrize("limit, rounds", [(1, 1), (64, 1), (64, 3)])
def test_chains_and_mixed_buckets(spark, limit, rounds):
    """Drifting copies: neighbours are linked, the ends are not; also with every mixed bucket taken as large."""
    rng = np.random.default_rng(5)
    vocab = [f"w{i}" for i in range(3000)]
    rows, at = [], 0
    for _ in range(6):
        text = rng.choice(vocab, 60).tolist()
        for _ in range(25):
            rows.append((at, " ".join(text)))
            at += 1
            text[int(rng.integers(60))] = str(rng.choice(vocab))
    got = similarity.groups(make(spark, rows), meet_limit=limit, rounds=rounds).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_groups(rows)


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(1)
    a = rng.integers(1, 1 << 60, 400).astype(np.uint64)
    b = np.concatenate((a[:300], rng.integers(1, 1 << 60, 100).astype(np.uint64)))
    h, doc = np.concatenate((a, b, a[:1], a[:3])), np.repeat([0, 1, 3, 4], [400, 400, 1, 3])
    s = similarity.fill(h, doc, 5)
    assert (s[2] == similarity._FULL).all() and not (s[[0, 1, 3, 4]] == similarity._FULL).any()
    assert abs((s[0] == s[1]).mean() - 0.6) < 0.15
    assert (similarity.fill(a[::-1].copy(), np.zeros(400, int), 1)[0] == s[0]).all()


# --------------------------------------------------------------- decontamination


def brute_hits(rows, items, window=10):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    out = []
    for d, t in rows:
        w, hit, names, longest = words(t), set(), set(), 0
        for i, u in items:
            v = words(u)
            n = min(window, len(v))
            for s in range(len(v) - n + 1) if n else ():
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == v[s : s + n]:
                        hit.update(range(p, p + n))
                        names.add("" if i is None else str(i))
                        m = n
                        while s + m < len(v) and p + m < len(w) and v[s + m] == w[p + m]:
                            m += 1
                        longest = max(longest, m)
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit), longest))
    return Counter(out)


ITEMS = [
    (1, "The QUICK brown fox, jumps over the lazy dog while seven wizards sing"), (10, "summer rain and"), (2, "ab"), (None, "old stone walls"),
    (3, None), (4, "..."), (5, "word1 thing1 word2 thing2 word3 thing3 word4 thing4 word5 thing5 word6 thing6"), (5, "ab"), (6, "nowhere to be found"),
]


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_decontamination_equals_brute_force(spark, docs, nothing, block):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    small = docs.where("doc_id is null or doc_id <> 13")
    got = decontaminate.contamination(small, items, block_chars=block)
    assert Counter(tuple(r) for r in got.collect()) == brute_hits([r for r in ROWS if r[0] != 13], ITEMS)
    long = decontaminate.contamination(docs.where("doc_id = 13"), items, block_chars=block).first()
    assert long.contaminated and long.n_words == 80_000 and long.longest == 12
    assert decontaminate.contamination(nothing, items).count() == 0
    assert not any(r.contaminated for r in decontaminate.contamination(docs, items.limit(0)).collect())


def test_matches_name_their_places(spark, docs):
    items = spark.createDataFrame(ITEMS[:1], "item_id bigint, text string")
    m = decontaminate.find_matches(docs.where("doc_id = 5"), items).first().matches
    assert [tuple(x) for x in m] == [("1", 0, 0, 13)]
    more = spark.createDataFrame([*ITEMS[:1], (77, "this very line of more than forty code points comes up again")], "item_id bigint, text string")
    for table, block, gone in ((items, 1 << 20, {3, 5, 9}), (more, 40, {3, 5, 9, 14, 15, 16, 17, 18, 2})):
        left = decontaminate.drop_contaminated(docs, table, block_chars=block)
        assert left.columns == docs.columns
        assert ids(left) == Counter({k: v for k, v in IDS.items() if k not in gone} | {None: 1})


def test_matches_are_the_same_in_blocks(spark, docs):
    # one id with two texts, which give the same hits in some document but not the same places in the item
    items = spark.createDataFrame([*ITEMS, (8, "fox jumps over"), (8, "and a fox jumps over"), (8, "the fox jumps over")], "item_id bigint, text string")
    small = docs.where("doc_id is null or doc_id <> 13")

    def matches(block):
        return Counter((r.doc_id, r.n_words, tuple(r["items"]), r.longest, tuple(map(tuple, r.matches))) for r in decontaminate.find_matches(small, items, 3, block).collect())

    one = matches(1 << 20)
    assert sum(bool(k[4]) for k in one) > 5
    assert matches(40) == one


def test_copies_of_an_item_are_taken_once(spark, docs):
    copies = spark.createDataFrame([*ITEMS, *[(1, ITEMS[0][1])] * 50, *[(None, "old stone walls")] * 50], "item_id bigint, text string")
    small = docs.where("doc_id is null or doc_id <> 13")
    got = [(i.ids, n) for i, n in decontaminate.item_blocks(copies, 10, 200)]
    assert len(got) == got[0][1] == 2 and Counter(x for i, _ in got for x in i) == Counter("" if i is None else str(i) for i, _ in ITEMS)
    assert Counter(tuple(r) for r in decontaminate.contamination(small, copies).collect()) == brute_hits([r for r in ROWS if r[0] != 13], ITEMS)


# ---------------------------------------------------------------------- tokens


def test_token_counts_equal_the_library(spark, docs, nothing):
    library = Tokenizer.from_file(WORD)
    path = scratch(spark, "cache")
    want = Counter((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False))) for i, t in ROWS)
    assert Counter(tuple(r) for r in tokencount.token_counts(docs, WORD, path).collect()) == want
    n = spark.read.parquet(path).count()
    # all hits the second time: nothing is appended
    assert Counter(tuple(r) for r in tokencount.token_counts(docs, WORD, path).collect()) == want
    assert spark.read.parquet(path).count() == n
    tokencount.fill_cache(make(spark, [(1, "a new text")]), WORD, path)
    assert spark.read.parquet(path).count() == n + 1
    assert tokencount.token_counts(nothing, WORD, path).count() == 0


@pytest.mark.parametrize("encoding", ["delta", "dictionary"])
def test_token_file(spark, docs, nothing, encoding):
    library = Tokenizer.from_file(BPE)
    path = scratch(spark, "tokens")
    tokenfile.write_tokens(docs, BPE, path, encoding=encoding, shard_bytes=50_000)
    rows = sorted(tokenfile.token_report(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r[0] for r in ROWS), key=lambda x: (x is not None, x))
    at = 0
    coded = defaultdict(list)
    for i, t in ROWS:
        coded[i].append([*library.encode(t or "", add_special_tokens=False).ids, tokenfile.END_ID])
    for r in rows:
        assert r.start == at
        at += r.n_tokens
        assert (r.n_tokens, r.ids_crc32) in {(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in coded[r.doc_id]}
    from pyspark.sql import functions as F

    assert "ids" not in tokenfile.read_metadata(spark, path).columns
    assert tokenfile.read_tokens(spark, path, F.col("doc_id") == 11).first().ids == coded[11][0]
    empty = scratch(spark, "tokens")
    tokenfile.write_tokens(nothing, BPE, empty)
    assert tokenfile.token_report(spark, empty).count() == 0


def test_token_file_layout(spark, docs):
    import glob

    import pyarrow.parquet as pq

    path = scratch(spark, "tokens")
    tokenfile.write_tokens(docs.where("text is not null"), BPE, path)
    meta = pq.ParquetFile(sorted(glob.glob(path + "/part*"))[-1]).metadata
    columns = {meta.row_group(0).column(k).path_in_schema: meta.row_group(0).column(k) for k in range(meta.num_columns)}
    ids_column = next(v for k, v in columns.items() if k.startswith("ids"))
    assert "DELTA_BINARY_PACKED" in ids_column.encodings
    assert ids_column.has_offset_index and columns["doc_id"].has_column_index


# --------------------------------------------------------------- merge dropout


def test_encoding_round_trip(spark, docs, nothing):
    rows = dropout.round_trip(docs, PIECE).collect()
    assert Counter(r.doc_id for r in rows) == IDS and all(r.lossless for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (7, 8)} == {0}
    back = dropout.encoded_report(docs, PIECE).collect()
    want = Counter((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in ROWS)
    assert Counter((r.doc_id, r.decoded_sha256) for r in back) == want
    assert dropout.round_trip(nothing, PIECE).count() == 0


def test_codec_against_the_library_and_the_heap():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    plain, varied = dropout.Codec(PIECE, 0.0, 1, 1), dropout.Codec(PIECE, 0.3, 7, 3)
    texts = [t for _, t in ROWS if t and "▁" not in t]
    for t, e in zip(texts, plain.encode(texts, [0] * len(texts)), strict=True):
        assert np.frombuffer(e, "<u2").tolist() == library.encode(t)
    words = [c for t in texts for c in varied.chunks(t)[:200] if 0 < len(c) <= dropout.WIDE]
    for v in range(3):
        assert varied.segment(words, v) == [varied.segment_one(c, v) for c in words]
    a, b = (varied.segment(words, v) for v in (0, 1))
    assert a != b and a == dropout.Codec(PIECE, 0.3, 7, 3).segment(words, 0) and a != dropout.Codec(PIECE, 0.3, 8, 3).segment(words, 0)
    texts = [t or "" for _, t in ROWS] + ["▁", "▁▁ ▁a", "a ▁ b", " ▁", "▁ "]
    coded = varied.encode(texts, [k % 3 for k in range(len(texts))])
    ends = np.cumsum([len(c) // 2 for c in coded])
    assert [x.decode() for x in varied.decode(np.frombuffer(b"".join(coded), "<u2").astype(np.int64), ends)] == texts


def drawn(pairs, symbols, rng, dropout=0.1):
    """Merge dropout by the book: symbols as (id, begin, end)."""
    now, gone = [(s, k, k + 1) for k, s in enumerate(symbols)], set()
    while True:
        best = min(((pairs[a[0], b[0]], k) for k, (a, b) in enumerate(zip(now, now[1:], strict=False)) if (a[0], b[0]) in pairs and (a[1], b[1], b[2]) not in gone), default=None)
        if best is None:
            return [x[0] for x in now]
        (_, merged), k = best
        if rng.random() < dropout:
            gone.add((now[k][1], now[k + 1][1], now[k + 1][2]))
        else:
            now[k : k + 2] = [(merged, now[k][1], now[k + 1][2])]


def test_every_occurrence_has_its_own_draws():
    """Over documents, within one and without doc_ids, a chunk's segmentations are as frequent as the method has them."""
    import random

    plain, varied, rng = dropout.Codec(PIECE, 0.0, 1), dropout.Codec(PIECE, 0.1, 7), random.Random(3)
    n = 4000
    for word in ("a", "of", "the", "people", "information"):
        chunk = dropout.MARK + word
        symbols = plain._symbols([chunk])[0, :-1].tolist()
        want = Counter(np.array(drawn(plain.pairs, symbols, rng), "<u2").tobytes() for _ in range(n))
        across = varied.encode([word] * n, dropout.text_keys(range(n), [word] * n))
        within = varied.segment([chunk] * n, 5, np.arange(n, dtype=np.uint64))
        for got in (Counter(across), Counter(within)):
            for x in want | got:
                p = (want[x] + got[x]) / (2 * n)
                assert abs(want[x] - got[x]) < 5 * (2 * n * p * (1 - p)) ** 0.5 + 5
        assert within == [varied.segment_one(chunk, 5, k) for k in range(n)]
        best = plain.segment([chunk], 0)[0]
        assert 0.02 < 1 - Counter(across)[best] / n < 0.75
    # more segmentations than a few turns of variants can give
    assert len(set(across)) > 20
    # documents without a doc_id differ by text
    assert len(set(dropout.text_keys([None, None, 1, 1], ["a", "b", "a", "a"]))) == 3


# -------------------------------------------------------------------- toxicity


def test_toxicity_learns_and_keeps_clean_rows(spark, docs, nothing):
    rng = np.random.default_rng(3)
    syllables = "an be ti on re la mo su ve ka lo mi tu pe sha dor".split()

    def clean():
        return " ".join("".join(rng.choice(syllables, int(rng.integers(1, 4)))) for _ in range(120))

    rows, labels = [], []
    for i in range(400):
        text = clean().split()
        if i % 4 == 0:
            for _ in range(6):
                text[int(rng.integers(120))] = str(rng.choice(["idiot", "worthless", "scumbag"]))
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(i % 4 == 0)))
    table = make(spark, rows + [(None, "an idiot"), (900, None), (901, ""), (902, rows[0][1]), (902, rows[0][1])])
    known = spark.createDataFrame(labels + [(5000, 1, 1), (1, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    got = toxicity.toxicity(table, known).collect()
    assert len(got) == 405 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    want = {i: t for i, _, t in labels}
    held = [r for r in got if r.held_out and r.doc_id in want]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in held)
    assert sum(r.predicted == want[r.doc_id] for r in held) >= 0.97 * len(held)
    assert [r.predicted for r in got if r.doc_id in (900, 901)] == [0, 0]
    left = toxicity.drop_toxic(table, known)
    assert left.columns == table.columns and left.count() == sum(1 - r.predicted for r in got)
    none = toxicity.toxicity(docs, known.limit(0)).collect()
    assert len(none) == len(ROWS) and {(r.score, r.predicted) for r in none} == {(0.5, 0)}
    assert toxicity.toxicity(nothing, known).count() == 0


# ---------------------------------------------------------------- fingerprints


@pytest.mark.parametrize("size", [1 << 20, 300])
def test_edited_texts(spark, docs, nothing, size):
    got = bottomk.edited_pairs(docs, range_bytes=size).collect()
    rows = sorted(((i, t or "") for i, t in ROWS), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = Counter()
    for k, (i, t) in enumerate(rows):
        cut, nxt = len(t) // 4, rows[(k + 1) % len(rows)][1]
        want[i, len(t), hashlib.sha256((t[: len(t) - cut] + nxt[:cut]).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    same = defaultdict(set)
    for r in got:
        same[r.doc_id].add(r.fingerprint)
    assert same[11] == same[12] and same[3] != same[5]
    assert bottomk.edited_pairs(nothing).count() == 0
    one = bottomk.edited_pairs(make(spark, [(1, "abcdefgh")])).collect()
    assert [(r.edited_sha256) for r in one] == [hashlib.sha256(b"abcdefab").hexdigest()]


def test_sketches_estimate_and_merge(spark):
    rng = np.random.default_rng(2)
    a = "".join(rng.choice(list("abcdefghij"), 4000))
    b = a[:2000] + "".join(rng.choice(list("klmnopqrst"), 2000))
    sa, sb = bottomk.sketch(a), bottomk.sketch(b)
    assert abs(bottomk.likeness(sa, sb) - 1 / 3) < 0.12 and abs(bottomk.containment(sa, sb) - 0.5) < 0.17
    assert abs(bottomk.distinct(sa) / 3992 - 1) < 0.25
    whole = bottomk.sketch(a)
    parts = bottomk.merge(bottomk.sketch(a[:2000]), bottomk.sketch(a[2000 - bottomk.SHINGLE + 1 :]))
    assert (whole == parts).all()
    df = spark.createDataFrame([(1, bottomk.to_text(bottomk.sketch(a[:2000]))), (1, bottomk.to_text(bottomk.sketch(a[1992:]))), (2, "")], "doc long, fingerprint string")
    got = {r.doc: r.fingerprint for r in bottomk.merged_fingerprints(df, "doc").collect()}
    assert got[1] == bottomk.to_text(whole)
    assert bottomk.likeness(np.zeros(0, np.uint32), np.zeros(0, np.uint32)) == 1.0


# ------------------------------------------------------------------ line dedup


def brute_lines(rows, least=5):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))

    held = defaultdict(list)
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= 40:
                held[k].append(-1 if i is None else i)
    last = {k: max(v) for k, v in held.items() if len(v) >= least}
    out = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if last.get(key(x), i) in (i, -1 if i is None else i)]
        out[i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()] += 1
    return out


def test_line_dedup_equals_brute_force(spark, docs, nothing):
    assert Counter(tuple(r) for r in linededup.line_report(docs).collect()) == brute_lines(ROWS)
    left = linededup.drop_repeated_lines(docs)
    assert left.columns == docs.columns
    assert {r.doc_id: r.text for r in left.collect()}[17] == "start"
    assert linededup.line_report(nothing).count() == 0


def test_many_shards_and_blocks(spark):
    rng = np.random.default_rng(4)
    lines = [f"line number {k} with enough characters to be counted {'é' * (k % 5)}" for k in range(300)]
    rows = [(i, "\n".join(rng.choice(lines, 12).tolist())) for i in range(200)]
    table = make(spark, rows)
    marked = linededup.dropped_lines(table, "gone", shard_lines=20, block_bytes=600)
    want = brute_lines(rows)
    got = Counter()
    for r in marked.collect():
        own = r.text.split("\n")
        kept = [x for k, x in enumerate(own) if k not in (r.gone or [])]
        got[r.doc_id, len(own), len(own) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()] += 1
    assert got == want


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(0)
    h = rng.integers(-(1 << 62), 1 << 62, (5000, 2))
    h1, h2 = h[:, 0].copy(), h[:, 1].copy()
    h1[:50] = h1[0]  # lines that agree in one half of the hash
    h2[50:90] = h2[50]
    for most in (200, 5000, 70_000, 1 << 40):
        count = np.arange(5000) % 7 + 1
        count[17] = most
        shard = linededup.Shard(linededup.build_shard(h1, h2, count, np.arange(5000) * 7, 5))
        assert sorted(shard.index(h1, h2).tolist()) == list(range(5000))
        got, last = shard.counts(h1, h2)
        assert (got == count).all()
        assert (last == np.where(count >= 5, np.arange(5000) * 7, linededup._NOWHERE)).all()
    strange = rng.integers(-(1 << 62), 1 << 62, (5000, 2))
    assert (shard.counts(strange[:, 0].copy(), strange[:, 1].copy())[0] > 0).sum() < 20
    empty = linededup.Shard(linededup.build_shard(*(np.zeros(0, dtype=np.int64) for _ in range(4)), 5))
    assert empty.counts(h1[:3], h2[:3])[0].tolist() == [0, 0, 0]
    assert len(linededup.build_shard(h1, h2, count * 0 + 1, count, 5)) < 4 * 5000
    assert LINE  # used by the fixtures


# ------------------------------------------------------------- chat formatting

TURNS = [
    (1, 0, "user", [("text", "a <turn> & \"b\" &lt; </turn>\n", None, None), ("image", None, "s3/img.png", 4), ("text", "after", None, None)]),
    (1, 1, "assistant", [("text", "one", None, None), None, ("audio", None, "x.wav", None), ("video", "no", "y", 3), ("document", None, "d.pdf", 2), ("text", " two</turn>\n", None, None)]),
    (1, 2, "assistant", None), (2, None, None, []), (2, 3, "user", [("text", None, None, None)]), (2, 3, "assistant", [("text", "\\ & ", None, None)]),
    (None, 0, "as\"<sis", [("text", "x", None, None)]), (None, 0, "assistant", [("text", "y" * 5000, None, None)]),
]


def test_chat_parts(spark):
    df = spark.createDataFrame(TURNS, f"conv_id bigint, turn bigint, role string, parts array<{chat.PART}>")
    rows = {r.conv_id: r for r in chat.format_chat(df.withColumn("formatted", df["role"]).withColumn("piece", df["role"])).collect()}
    one = rows[1]
    assert one.formatted == (
        '<turn role="user">a &lt;turn> &amp; &quot;b&quot; &amp;lt; &lt;/turn>\n<image/>after</turn>\n<turn role="assistant">one<audio/><document/> two&lt;/turn>\n</turn>\n<turn role="assistant"></turn>\n'
    )
    assert [tuple(a) for a in one.attachments] == [(0, 1, "image", "s3/img.png", 1024), (1, 2, "audio", "x.wav", 25), (1, 4, "document", "d.pdf", 1024)]
    assert one.attachment_tokens == 2073
    assert [one.formatted[s.start : s.end] for s in one.loss_spans] == ["one<audio/><document/> two&lt;/turn>\n", ""]
    report = {r.conv_id: r for r in chat.chat_report(chat.format_chat(df.where("conv_id is null or conv_id = 2"))).collect()}
    assert (report[2].n_turns, report[2].loss_chars, report[2].loss_sha256) == (3, 4, hashlib.sha256(b"\\ & ").hexdigest())
    told = "as\"<sis\nx\nassistant\n" + "y" * 5000 + "\n"
    assert report[None].turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
    assert chat.format_chat(df.limit(0)).count() == 0


def test_workers_give_back_what_arrow_keeps():
    import pyarrow as pa

    from eventide.llm.common import released

    def held():
        return int(next(x for x in open("/proc/self/status") if x.startswith("VmRSS")).split()[1]) // 1024

    def copies(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(b.column(0).to_pylist())], names=["t"])

    rows = pa.RecordBatch.from_arrays([pa.array(["x" * 2000] * 20_000)], names=["t"])
    for _ in copies([rows]):  # what the interpreter itself keeps
        pass
    del _
    pool, before = pa.default_memory_pool(), held()
    grown = [pool.bytes_allocated()]
    assert [b.num_rows for b in released(copies)([rows] * 3)] == [20_000] * 3
    assert pool.bytes_allocated() == grown[0] and held() < before + 60
