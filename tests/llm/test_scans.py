"""Licence scan, spelling variants and periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from eventide.llm import licenses, periodic, queries, variants
from eventide.llm.common import ship

from ..conftest import SF001
from .conftest import ROWS, make

IDS = Counter(r[0] for r in ROWS)
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(autouse=True, scope="module")
def _shipped(spark):
    ship(spark)


# ---------------------------------------------------------------- licence scan

TEXTS = [
    "Licensed under the MIT License, or not.", "émit license, and MIT\n--License", "GNU General Public License v3 or the GNU\tGENERAL public license",
    "This is CC BY-SA 4.0 and cc-by; xcc by", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "SPDX-License-Identifier: GPL-2.0-or-later", "released under the weird old foo license. See the license.", "Apache License, Version 2.0 " * 300,
    "mit license " * 700 + "Copyright 2020 by someone. All rights reserved", "the licence is here", "commons", "",
]


def brute_licences(text):
    """Detections by rule, resolved pair by pair."""
    spaced = " " + re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "  ", (text or "").translate(ASCII_LOWER)).strip(" ") + " "
    words = spaced.split("  ") if spaced.strip() else []
    found = [(m.start(1) and spaced[: m.start(1)].count("  "), m[1].count("  "), rule, label, level)
             for rule, label, level, _, pattern in licenses.rules() for m in re.finditer(pattern, spaced)]
    found = [(a, a + n, rule, label, level) for a, n, rule, label, level in found]
    base, rest = [d for d in found if d[2] < 0], [d for d in found if d[2] >= 0]

    def beats(e, d):
        if e[2] == d[2]:
            return False
        if e[0] <= d[0] and e[1] >= d[1] and e[4] >= d[4]:
            return (e[0], e[1]) != (d[0], d[1]) or e[4] > d[4] or e[2] < d[2]
        return e[0] >= d[0] and e[1] <= d[1] and e[4] > d[4]

    kept = [d for d in rest if not any(beats(e, d) for e in rest)]
    return len(words), sorted((a, b, r) for a, b, r, _, _ in base), sorted((a, b, r) for a, b, r, _, _ in kept)


def sample(parsed, rnd):
    """A random text that a parsed pattern matches."""
    out = []
    for op, arg in parsed:
        op = str(op)
        if op == "LITERAL":
            out.append(chr(arg))
        elif op == "SUBPATTERN":
            out.append(sample(arg[3], rnd))
        elif op == "BRANCH":
            out.append(sample(rnd.choice(arg[1]), rnd))
        elif op == "MAX_REPEAT":
            out += [sample(arg[2], rnd) for _ in range(rnd.randint(arg[0], min(int(arg[1]), arg[0] + 3)))]
        elif op == "IN":
            out.append(chr(rnd.choice([x for kind, v in arg for x in (range(v[0], v[1] + 1) if str(kind) == "RANGE" else [v])])))
        else:
            assert op == "NOT_LITERAL", op
            out.append("w")
    return "".join(out)


def test_licence_rules_are_gated():
    """Whatever a rule matches holds its keyword, and a stem or "cc by"; patterns are bounded."""
    rules, rnd = licenses.rules(), random.Random(2)
    assert len(rules) > 250
    for _, label, level, word, pattern in rules:
        assert level in (0, *licenses.CONFIDENCE) and "*" not in pattern and "+" not in pattern.replace("[^  ]+", "")
        for _ in range(20):
            text = sample(re._parser.parse(pattern), rnd)
            assert re.fullmatch(pattern, text) and f" {word} " in text, (label, word, text)
            assert any(s in text for s in licenses.STEMS) or " cc  by " in text, (label, text)


def test_licence_scan_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(licenses, "BLOCK", 16)
    rnd = random.Random(3)
    vocabulary = "gnu general public license version 2 3 0 or any later lgpl gpl apache mit cc by sa nc 4 creative commons attribution spdx identifier licensed under the bsd style".split()
    texts = [*TEXTS, *(" ".join(rnd.choices(vocabulary, k=rnd.randrange(5, 300))) for _ in range(60)), None]
    for r in licenses.scan_licenses(make(spark, list(enumerate(texts)))).collect():
        n, base, kept = brute_licences(texts[r.doc_id])
        assert r.n_words == n
        assert sorted((d.start, d.end, d.rule) for d in r.base) == base
        assert [(d.start, d.end, d.rule) for d in sorted(r.detections)] == kept


def test_licence_scan_on_odd_rows(docs, nothing):
    out = licenses.license_report(licenses.scan_licenses(docs))
    assert Counter(r.doc_id for r in out.collect()) == IDS
    assert {(r.n_words, r.n_base, r.first_word, r.labels, r.score) for r in out.collect() if r.doc_id in (7, 8, 10)} == {(0, 0, None, "", 0.0)}
    assert licenses.scan_licenses(nothing).count() == 0
    plan = queries.op11_license_scan(docs.sparkSession, SF001)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Exchange", plan)


# ----------------------------------------------------------- spelling variants


def brute_words(rows, edit=None):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(ASCII_LOWER)
            run = edit(doc_id, run) if edit else run
            if len(run) >= 6:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= 5}


def brute_variants(n):
    """All forms within one edit of each word, by all places and letters that occur."""
    alphabet = sorted({c for w in n for c in w})
    out = {}
    for w in n:
        cut = {w[:k] + w[k + 1 :] for k in range(len(w))}
        put = {w[:k] + c + w[k:] for k in range(len(w) + 1) for c in alphabet}
        swap = {w[:k] + c + w[k + 1 :] for k in range(len(w)) for c in alphabet}
        near = ((cut | put | swap) - {w}) & n.keys()
        best = min(near, key=lambda v: (-n[v], v), default=None)
        form = best if best is not None and n[best] >= 5 * n[w] else None
        out[w] = (form, n[w], len(near), n[form] if form else None)
    for w, (form, *rest) in list(out.items()):
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w] = (form, root, *rest)
    return out


def misspelt_rows():
    rnd = random.Random(5)
    stems = ["".join(rnd.choices("abcdeé", k=rnd.randrange(6, 10))) for _ in range(25)]
    rows = []
    for i in range(400):
        words = []
        for _ in range(30):
            w = stems[min(int(rnd.expovariate(0.3)), 24)]
            k = rnd.randrange(len(w))
            words.append(rnd.choice([w, w.upper(), w, w[:k] + w[k + 1 :], w[:k] + "z" + w[k:], w[:k] + "q" + w[k + 1 :], w[1:] + w[0]]))
        rows.append((i, " 7,".join(words)))
    # a chain of forms: each five times as frequent as the one before
    rows += [(1000 + k, " ".join([w] * 5 ** (k + 1))) for k, w in enumerate(("chainaaa", "chainaab", "chainabb", "chainbbb"))]
    return [*rows, (5000, "aaaaaaaa " * 9 + "aaaaaaaaa " * 9 + "x" * 700 + " " + "word" * 3), (None, stems[0]), (1, None)]


@pytest.mark.parametrize("cell", [30, variants.CELL])
def test_variants_equal_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(variants, "CELL", cell)
    monkeypatch.setattr(variants, "BLOCK", 50)
    monkeypatch.setattr(variants, "LEAF", 5)
    rows = misspelt_rows()
    want = brute_variants(brute_words(rows))
    got = variants.spelling_variants(make(spark, rows)).collect()
    assert len(got) == len(want) and {r.word: tuple(r)[1:] for r in got} == want
    assert want["chainaaa"][:2] == ("chainaab", "chainbbb")


def test_variants_of_odd_rows(docs, nothing):
    rows = [(r[0], r[1]) for r in ROWS]
    assert {r.word: r.n for r in variants.spelling_variants(docs).collect()} == brute_words(rows)
    assert variants.spelling_variants(nothing).count() == 0


def test_variants_query(spark):
    rows = [tuple(r) for r in queries.table(spark, SF001, "documents").select("doc_id", "text").collect()]
    want = brute_variants(brute_words(rows, queries.misspell))
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in queries.op12_spelling_variants(spark, SF001).collect()} == want


# --------------------------------------------------------------- periodic runs


def brute_runs(words):
    """Stretches of equal words at each distance, the smallest distance for each stretch."""
    ids = np.unique(words, return_inverse=True)[1] if len(words) else np.zeros(0, int)
    best = {}
    for q in range(1, len(ids) // 2 + 1):
        edge = np.diff(np.concatenate(([0], (ids[:-q] == ids[q:]).astype(int), [0])))
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            if b - a + q >= max(12, 2 * q):
                best.setdefault((a, b - a + q), q)
    return sorted((a, q, n) for (a, n), q in best.items())


def kept_words(words, runs):
    gone = {k for a, q, n in runs for k in range(a + q, a + n)}
    return [w for k, w in enumerate(words) if k not in gone]


def test_runs_equal_brute_force():
    rnd = random.Random(7)
    texts = []
    for _ in range(600):
        words = [bytes([97 + rnd.randrange(rnd.choice((1, 2, 3, 9)))]) for _ in range(rnd.randrange(70))]
        if words and rnd.random() < 0.5:
            a, p = rnd.randrange(len(words)), rnd.randrange(1, len(words) + 1)
            words[a:] = [words[a + k % p] for k in range(len(words) - a)]
        texts.append(words)
    found, cuts = periodic.runs_of_texts(texts)
    for k, words in enumerate(texts):
        assert [(a, q, n) for a, n, q in found[cuts[k] : cuts[k + 1]].tolist()] == brute_runs(words)


def test_suffix_tree_extensions():
    rnd = random.Random(8)
    for _ in range(50):
        s = [rnd.randrange(1, 4) for _ in range(rnd.randrange(2, 60))]
        e = periodic.Extensions([*s, 0])
        n = len(s) + 1
        assert np.argsort(e.rank).tolist() == sorted(range(n), key=lambda i: [*s, 0][i:])
        i, j = (np.array(x) for x in zip(*((i, j) for i in range(n) for j in range(n) if i != j)))
        want = [next(k for k in range(n) if i + k >= n or j + k >= n or [*s, 0][i + k] != [*s, 0][j + k]) for i, j in zip(i.tolist(), j.tolist())]
        assert e.common(i, j).tolist() == want


def brute_report(words):
    runs = brute_runs(words)
    top = min(((-n, a, q) for a, q, n in runs), default=None)
    listed = "".join(f"{a},{n},{q}\n" for a, q, n in runs)
    best = (top[1], -top[0], top[2], 1000 * -top[0] // top[2]) if top else (None,) * 4
    return len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(kept_words(words, runs))).hexdigest()


def test_runs_of_odd_rows(docs, nothing):
    got = periodic.run_report(periodic.periodic_runs(docs)).collect()
    assert Counter(r.doc_id for r in got) == IDS
    want = {(r[0], *brute_report((r[1] or "").encode().split())) for r in ROWS if len(r[1] or "") < 50_000}
    assert want <= {tuple(r) for r in got}
    assert periodic.periodic_runs(nothing).count() == 0


def test_runs_query(spark):
    def words(doc_id, text):
        words, h = text.encode().split(), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            for i in range(a, n):
                words[i] = words[a + (i - a) % p]
        return words

    rows = queries.table(spark, SF001, "documents").select("doc_id", "text").collect()
    want = {(i, *brute_report(words(i, t or ""))) for i, t in rows}
    got = queries.op13_periodic_runs(spark, SF001).collect()
    assert {tuple(r) for r in got} == want and sum(r.n_runs > 0 for r in got) > 5
