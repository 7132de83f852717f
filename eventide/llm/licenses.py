"""Licence scan by ordered signature rules, in DataFrame functions only.

Words are runs of ASCII letters, digits and all characters beyond ASCII, A-Z
lower-cased.  A text that holds none of a few stems (STEMS, or "cc" and "by"
side by side) can match no rule and is only counted.  Any other text is written
as its words, each between blanks of its own, and each rule whose keyword is
among them is matched against all of it; a match is marked at its first word,
so that the marks' places among the words are the matches' places.

Of two detections where one contains the other, the one of the higher level
stays; at equal level the container; of equal intervals and levels the earlier
rule.  (Whether the one that wins is itself dropped plays no part.)  The
detections are sorted by place, so the first and second kind of loser shows by
a running maximum of ends before it, the other by a running minimum of ends
after it; both are taken in blocks of BLOCK detections, in linear time.

Base phrases are rules of their own: their places are counted and their labels
kept whatever the other rules say.

Everything is one narrow pass: no shuffle, no Python worker.  Patterns span a
bounded number of words; a text is one row's work.

Defined cases: a null or empty text has no words, labels "" and score 0; an
empty table gives no rows; repeated rows and null ids are kept; other columns
are not read.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_columns
from .license_rules import RULES

#: fixed values: phrases and their labels
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: every keyword but "cc" holds one of these
STEMS = ("licen", "gpl", "commons", "copyright", "domain", "permission", "endorse", "eupl")
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_CC_BY = rf"(?i)cc{_GAP}+by"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: how far a detection of a level is believed
CONFIDENCE = {4: 0.95, 3: 0.85, 2: 0.7, 1: 0.25}
LEVELS = sorted(CONFIDENCE)
MARK, BLOCK = "\x01", 256
DETECTIONS = "array<struct<start:int,less_end:int,less_level:int,rule:int,label:string>>"


def rules() -> list[tuple[int, str, int, str, str]]:
    """(number, label, level, keyword, pattern over spaced words), in order; base phrases come first with numbers below 0."""
    base = [(k - len(BASE), label, 0, phrase.split()[0], phrase) for k, (phrase, label) in enumerate(BASE.items())]
    listed = [line.split(" ", 3) for line in RULES.strip().splitlines()]
    out = base + [(k, label, int(level), word, pattern) for k, (label, level, word, pattern) in enumerate(listed)]
    return [(k, label, level, word, f" ({pattern.replace(' ', '  ')}) ") for k, label, level, word, pattern in out]


def spaced_words(text: Column) -> Column:
    """The words, lower-cased, each between blanks of its own."""
    parted = F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), rf"{_GAP}+", "  "))
    return F.concat(F.lit(" "), parted, F.lit(" "))


def _may_match(text: Column) -> Column:
    low, out = F.lower(text), text.rlike(_CC_BY)
    for stem in STEMS:
        out = F.contains(low, F.lit(stem)) | out
    return out


def _rule_table() -> Column:
    rows = [{"rule": k, "label": label, "level": level, "gate": f" {word} ", "pattern": pattern} for k, label, level, word, pattern in rules()]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<rule:int,label:string,level:int,gate:string,pattern:string>>")


def _places(spaced: Column, rule: Column) -> Column:
    """Detections of a rule: first word, last word."""
    hits = F.regexp_extract_all(spaced, rule["pattern"], F.lit(1))
    marked = F.split(F.trim(F.regexp_replace(spaced, rule["pattern"], F.lit(f" {MARK}$1 "))), "  ", -1)
    starts = F.filter(F.transform(marked, lambda w, i: F.when(F.startswith(w, F.lit(MARK)), i)), lambda i: i.isNotNull())
    return F.zip_with(starts, hits, lambda i, hit: F.struct(
        i.alias("start"), (-i - F.size(F.split(hit, "  ", -1)) + 1).alias("less_end"), (-rule["level"]).alias("less_level"), rule["rule"].alias("rule"), rule["label"].alias("label")))


def _scan(items: Column, first: Column, merge) -> Column:
    """For each item, ``merge`` over ``first`` and the items before it."""
    return F.aggregate(
        items, F.struct(first.alias("now"), F.slice(F.array(first), 1, F.lit(0)).alias("seen")),
        lambda s, x: F.struct(merge(s["now"], x).alias("now"), F.concat(s["seen"], F.array(s["now"])).alias("seen")), lambda s: s["seen"])


def _blocks(items: Column) -> Column:
    n = F.floor((F.size(items) - 1) / BLOCK).cast("int")
    return F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(0))), lambda b: F.slice(items, b * BLOCK + 1, F.lit(BLOCK)))


def _running(rows: DataFrame, items: str, out: str, zero: Column, merge, join) -> DataFrame:
    """Adds ``out``: for each of ``items``, ``merge`` over all items before it (``join`` merges two such results).

    Each step is a column of its own, so that it is made once a row.
    """
    rows = rows.withColumn("blocks", _blocks(F.col(items)))
    rows = rows.withColumn("first", _scan(F.transform("blocks", lambda xs: F.aggregate(xs, zero, merge)), zero, join))
    rows = rows.withColumn(out, F.flatten(F.zip_with("blocks", "first", lambda xs, first: _scan(xs, first, merge))))
    return rows.drop("blocks", "first")


def _best(name: str, counts) -> tuple[Column, object, object]:
    """Running greatest value by level: where ``counts(level, item)`` holds, the item's ``name``."""
    least = F.lit(-(2**31 - 1))
    fields = [f"m{p}" for p in LEVELS]
    zero = F.struct(*(least.alias(f) for f in fields))
    merge = lambda s, d: F.struct(*(F.greatest(s[f], F.when(counts(p, -d["less_level"]), d[name]).otherwise(least)).alias(f) for p, f in zip(LEVELS, fields)))
    join = lambda s, t: F.struct(*(F.greatest(s[f], t[f]).alias(f) for f in fields))
    return zero, merge, join


def _at_level(best: Column, level: Column) -> Column:
    out = F.lit(None).cast("int")
    for p in LEVELS:
        out = F.when(level == p, best[f"m{p}"]).otherwise(out)
    return out


def resolve(rows: DataFrame) -> DataFrame:
    """``found`` becomes the detections that no other one suppresses, by place."""
    rows = rows.withColumn("found", F.array_sort(F.transform("found", lambda d: d.withField("end", -d["less_end"]))))
    rows = rows.withColumn("later", F.reverse("found"))
    # an earlier one that ends no earlier contains it; a later one that ends no later is contained in it
    rows = _running(rows, "found", "around", *_best("end", lambda p, level: level >= p))
    rows = _running(rows, "later", "inside", *_best("less_end", lambda p, level: level > p))
    rows = rows.withColumn("both", F.arrays_zip(F.col("found").alias("d"), F.col("around").alias("around"), F.reverse("inside").alias("inside")))
    lost = lambda z: (_at_level(z["around"], -z["d"]["less_level"]) >= z["d"]["end"]) | (_at_level(z["inside"], -z["d"]["less_level"]) >= z["d"]["less_end"])
    return rows.withColumn("found", F.transform(F.filter("both", lambda z: ~lost(z)), lambda z: z["d"])).drop("later", "around", "inside", "both")


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, base and detections (start, end, level, rule, label; words from 0, by place) of every row."""
    text = F.coalesce("text", F.lit(""))
    rows = text_columns(docs).select("doc_id", F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("n_words"), F.when(_may_match(text), spaced_words(text)).alias("spaced"))
    table = _rule_table()
    tried = F.filter(table, lambda r: F.contains(F.col("spaced"), r["gate"]))
    rows = rows.select("doc_id", "n_words", F.when(F.col("spaced").isNull(), F.array().cast(DETECTIONS)).otherwise(F.flatten(F.transform(tried, lambda r: _places(F.col("spaced"), r)))).alias("all"))
    rows = rows.select("doc_id", "n_words", F.filter("all", lambda d: d["rule"] < 0).alias("base"), F.filter("all", lambda d: d["rule"] >= 0).alias("found"))
    show = lambda d: F.struct(d["start"].cast("bigint").alias("start"), (-d["less_end"]).cast("bigint").alias("end"), (-d["less_level"]).alias("level"), d["rule"].alias("rule"), d["label"].alias("label"))
    return resolve(rows).select("doc_id", "n_words", F.transform("base", show).alias("base"), F.transform("found", show).alias("detections"))


def license_report(found: DataFrame) -> DataFrame:
    """Counts, places and labels per row; the score is the confidence of the highest level found (base phrases count as level 2)."""
    base, kept = F.transform("base", lambda d: d["label"]), F.transform("detections", lambda d: d["label"])
    named = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    top = F.array_max(F.concat(F.transform("base", lambda d: F.lit(2)), F.transform("detections", lambda d: d["level"])))
    score = F.lit(0.0)
    for level, sure in CONFIDENCE.items():
        score = F.when(top == level, F.lit(sure)).otherwise(score)
    starts = F.transform("base", lambda d: d["start"])
    return found.select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        named(base).alias("base_labels"), named(F.concat(base, kept)).alias("labels"), score.alias("score"), F.size("detections").cast("bigint").alias("n_detections"),
    )
