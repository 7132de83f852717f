"""One query per operator, over the whole of its tables with production parameters."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bottomk, chat, decontaminate, dropout, licenses, linededup, lmscore, periodic, similarity, tokencount, tokenfile, toxicity, variants
from .common import scratch, ship

ORACLE: dict[str, str] = {}
LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked pseudo-likelihood of all documents under a network trained on them."""
    return lmscore.pseudo_likelihood(table(spark, sf_dir, "documents"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return similarity.groups(table(spark, sf_dir, "documents"))


ORACLE["op2_near_dedup"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM shared JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 75 * (p.n + q.n - k)),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.doc_id, edge.y FROM reach JOIN edge ON reach.r = edge.x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
"""


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside occurrences of benchmark windows."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op3_decontamination"] = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
size AS (SELECT DISTINCT n FROM win),
pos AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, size)),
occ AS (SELECT pos.doc_id, pos.i, pos.n, win.item_id FROM pos JOIN win ON pos.g = win.g AND pos.n = win.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM occ) GROUP BY doc_id),
item AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM occ) GROUP BY doc_id),
-- longest verbatim match: n words beyond a window's length while the next places also match
run AS (SELECT o.doc_id, max(x.n_words) AS longest FROM (SELECT DISTINCT doc_id FROM occ) o JOIN (
  SELECT doc_id, item_id, s, max(e) - min(i) AS n_words FROM (
    SELECT doc_id, item_id, i, i + n AS e, i - j AS s, (i - row_number() OVER (PARTITION BY doc_id, item_id, i - j ORDER BY i)) AS grp FROM (
      SELECT DISTINCT a.doc_id, a.i, a.n, v.item_id, v.j FROM pos a JOIN (
        SELECT item_id, j, least(len(w), 10) AS n, array_to_string(w[j:j + least(len(w), 10) - 1], ' ') AS g
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS j FROM b WHERE len(w) > 0)) v ON a.g = v.g AND a.n = v.n))
  GROUP BY doc_id, item_id, s, grp) x ON o.doc_id = x.doc_id GROUP BY o.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(hit.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(item.n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(item.ids, '')) AS items_sha256, coalesce(hit.n_hit, 0) > 0 AS contaminated, CAST(coalesce(run.longest, 0) AS INTEGER) AS longest
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN item USING (doc_id) LEFT JOIN run USING (doc_id)
"""


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every text by way of a digest cache, which begins empty here."""
    counts = tokencount.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), scratch(spark, "token-cache"))
    return counts.withColumn("over_limit", F.col("n_tokens") > tokencount.LIMIT)


def op5_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded with merge dropout, and the digest of what its ids decode to."""
    return dropout.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents, learnt from labels that are not held out."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-k fingerprints of every text and of its edited text, compared."""
    return bottomk.edited_pairs(table(spark, sf_dir, "documents"))


def op8_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every text, written in doc_id order and read back."""
    path = scratch(spark, "token-file")
    tokenfile.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return tokenfile.token_report(spark, path)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document, how many go as repeated, and the digest of the rest."""
    return linededup.line_report(table(spark, sf_dir, "documents"))


ORACLE["op9_line_dedup"] = f"""
WITH l AS (SELECT doc_id, n, line, {LOWER.format("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n FROM documents)),
rep AS (SELECT key, max(doc_id) AS last FROM l WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT l.doc_id, l.n, l.line, rep.key IS NOT NULL AND l.doc_id <> rep.last AS gone FROM l LEFT JOIN rep ON l.key = rep.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

#: the added conversation's text
CONTROL = "\\### Assistant: </turn> ok"


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that holds control strings, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL).alias("text"),
    )
    turns = rows.unionByName(added).select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts"))
    return chat.chat_report(chat.format_chat(turns))


ORACLE["op10_chat_formatting"] = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, n, CASE n WHEN 0 THEN 'user' ELSE 'assistant' END, '{CONTROL}' FROM range(2) r(n)),
e AS (SELECT *, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '"', '&quot;') AS body,
  replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '"', '&quot;') AS escaped FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, body)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, body) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<turn role="' || escaped || '">' || body || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars, CAST(0 AS BIGINT) AS attachment_tokens
FROM e GROUP BY conv_id
"""


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and detections of the signature rules in all documents."""
    return licenses.license_report(licenses.scan_licenses(table(spark, sf_dir, "documents")))


_RULE_ROWS = ",\n  ".join(f"({k}, '{label}', {level}, ' {word} ', '{pattern}')" for k, label, level, word, pattern in licenses.rules())
ORACLE["op11_license_scan"] = f"""
WITH r(rule, label, level, gate, pattern) AS (VALUES
  {_RULE_ROWS}),
d AS (SELECT row_number() OVER () AS id, doc_id, regexp_replace({LOWER.format("coalesce(text, '')")}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', '  ', 'g') AS parted FROM documents),
t AS (SELECT id, doc_id, ' ' || trim(parted, ' ') || ' ' AS spaced, CASE WHEN trim(parted, ' ') = '' THEN 0 ELSE len(string_split(trim(parted, ' '), '  ')) END AS n_words FROM d),
m AS (SELECT id, rule, label, level, string_split(trim(regexp_replace(spaced, pattern, ' ' || chr(1) || '\\1 ', 'g'), ' '), '  ') AS w, regexp_extract_all(spaced, pattern, 1) AS hits
  FROM t JOIN r ON contains(spaced, gate)),
p AS (SELECT id, rule, label, level, unnest(list_filter(generate_series(1, len(w)), lambda i: starts_with(w[i], chr(1)))) - 1 AS s, unnest(hits) AS hit FROM m WHERE len(hits) > 0),
x AS (SELECT id, rule, label, level, s, s + len(string_split(hit, '  ')) - 1 AS e FROM p),
kept AS (SELECT * FROM x a WHERE rule >= 0 AND NOT EXISTS (SELECT 1 FROM x b WHERE b.id = a.id AND b.rule >= 0 AND b.rule <> a.rule AND (
    (b.s <= a.s AND b.e >= a.e AND b.level >= a.level AND (b.s < a.s OR b.e > a.e OR b.level > a.level OR b.rule < a.rule))
    OR (b.s >= a.s AND b.e <= a.e AND b.level > a.level)))),
b AS (SELECT id, count(*) AS n_base, min(s) AS first_word, max(s) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM x WHERE rule < 0 GROUP BY id),
l AS (SELECT id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(CASE WHEN rule < 0 THEN 2 ELSE level END) AS top, count(*) FILTER (WHERE rule >= 0) AS n
  FROM (SELECT id, label, level, rule FROM kept UNION ALL SELECT id, label, level, rule FROM x WHERE rule < 0) GROUP BY id)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(CASE top {" ".join(f"WHEN {k} THEN {v}" for k, v in licenses.CONFIDENCE.items())} ELSE 0 END AS DOUBLE) AS score,
  CAST(coalesce(n, 0) AS BIGINT) AS n_detections
FROM t LEFT JOIN b USING (id) LEFT JOIN l USING (id)
"""


def misspell(doc_id: str | None, run: str) -> str:
    """Takes one letter out of some runs, by a hash of document and run."""
    h = zlib.crc32(f"{doc_id or ''}:{run}".encode())
    k = h % len(run)
    return run if h % 199 else run[:k] + run[k + 1 :]


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents (some misspelt on purpose) with their near words, forms and roots."""
    return variants.spelling_variants(table(spark, sf_dir, "documents"), misspell)


def repeat_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Makes the tail of some documents periodic, by a hash of doc_id (none without one)."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document (some made periodic on purpose)."""
    return periodic.run_report(periodic.periodic_runs(table(spark, sf_dir, "documents"), repeat_tail))


QUERIES = {f.__name__: f for f in (op1_lm_scoring, op2_near_dedup, op3_decontamination, op4_token_counts, op5_merge_dropout, op6_toxicity, op7_fingerprints, op8_token_file, op9_line_dedup, op10_chat_formatting, op11_license_scan, op12_spelling_variants, op13_periodic_runs)}
