"""Fault rules, rule resolution, set-based fault injection, canary split and
fault-impact reports.

The reference injects faults per message in the producer with a random
generator and thread sleeps.  Here a fault is a deterministic function of
the record identity (md5 draws with a seed), applied to a whole table at
once: drop = filter, corrupt = ``substring``, duplicate = ``explode`` of a
two-element sequence, delay = timestamp shift.  The rules table is tiny
(one row per configured topic/type); how it is joined is left to AQE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import unit_draw
from ..functions.json_fields import json_text

RULE_FIELDS = ["p_drop", "p_dup", "max_delay_ms", "p_corrupt"]
RULES_SCHEMA = "key string, p_drop double, p_dup double, max_delay_ms int, p_corrupt double"
RULES_JSON_SCHEMA = "map<string, struct<pDrop:double, pDup:double, maxDelayMs:int, pCorrupt:double>>"


def read_rules_json(df: DataFrame, col: str = "rules_json") -> DataFrame:
    """Rules from a JSON map ``{"topic:x": {pDrop, pDup, maxDelayMs, pCorrupt}}``;
    missing numbers default to 0."""
    m = F.from_json(F.col(col), RULES_JSON_SCHEMA)
    e = df.select(F.explode(m).alias("key", "r"))
    return e.select(
        "key",
        F.coalesce(F.col("r.pDrop"), F.lit(0.0)).alias("p_drop"),
        F.coalesce(F.col("r.pDup"), F.lit(0.0)).alias("p_dup"),
        F.coalesce(F.col("r.maxDelayMs"), F.lit(0)).alias("max_delay_ms"),
        F.coalesce(F.col("r.pCorrupt"), F.lit(0.0)).alias("p_corrupt"),
    )


def merge_rules(current: DataFrame, changes: DataFrame) -> DataFrame:
    """Apply rule changes ``(key, op, seq, p_drop, p_dup, max_delay_ms, p_corrupt)``.

    op: ``put`` (upsert), ``delete`` (remove; a missing key is a no-op, the
    API answers "not found") or ``replace_all`` (every rule older than that
    change is dropped).  The latest change per key wins (``max_by``, partial
    aggregate), old rules not superseded are kept via ``left_anti``.
    """
    reset = changes.where(F.col("op") == "replace_all").agg(F.max("seq").alias("r")).first()["r"]
    puts = changes.where(F.col("op").isin("put", "delete"))
    if reset is not None:
        puts = puts.where(F.col("seq") > F.lit(reset))
        current = current.limit(0)
    latest = puts.groupBy("key").agg(
        F.max_by(F.struct("op", "seq", *RULE_FIELDS), F.col("seq")).alias("_c")).select("key", "_c.*")
    kept_old = current.join(latest.select("key"), "key", "left_anti").select("key", *RULE_FIELDS)
    new_rows = latest.where(F.col("op") == "put").select("key", *RULE_FIELDS)
    return kept_old.unionByName(new_rows)


def resolve_fault_rule(df: DataFrame, rules: DataFrame, topic: str = "topic", type_col: Column | None = None) -> DataFrame:
    """Rule by ``topic:<t>``, else ``type:<y>``, else all zeros (whole structs)."""
    r = rules
    rs = lambda prefix: r.select(
        F.col("key").alias(f"_{prefix}_key"),
        F.struct(*RULE_FIELDS).alias(f"_{prefix}_rule"))
    t = type_col if type_col is not None else json_text("value", "type")
    out = (df.withColumn("_tk", F.concat(F.lit("topic:"), F.col(topic)))
           .withColumn("_yk", F.concat(F.lit("type:"), t)))
    out = out.join(rs("t"), F.col("_tk") == F.col("_t_key"), "left").join(
        rs("y"), F.col("_yk") == F.col("_y_key"), "left")
    zero = F.struct(F.lit(0.0).alias("p_drop"), F.lit(0.0).alias("p_dup"), F.lit(0).alias("max_delay_ms"),
                    F.lit(0.0).alias("p_corrupt"))
    return out.withColumn("rule", F.coalesce(F.col("_t_rule"), F.col("_y_rule"), zero)).drop(
        "_tk", "_yk", "_t_key", "_y_key", "_t_rule", "_y_rule")


def inject_faults(df: DataFrame, rules: DataFrame, seed: int = 42, ts: str = "timestamp",
                  ident: list[str] | None = None) -> DataFrame:
    """Perturb a topic table: delay, drop, corrupt (truncate to max(1, len/2)),
    duplicate -- each an independent deterministic draw per record.

    Adds ``copy`` (1, or 2 for the duplicate) and ``fault`` flags.
    """
    ident = ident or ["topic", "partition", "offset"]
    rid = F.concat_ws("/", F.lit(str(seed)), *[F.col(c).cast("string") for c in ident])
    x = resolve_fault_rule(df, rules)
    u_drop, u_dup, u_cor, u_delay = (unit_draw(rid, s) for s in (":drop", ":dup", ":corrupt", ":delay"))
    x = x.where(~(u_drop < F.col("rule.p_drop")))
    corrupt = u_cor < F.col("rule.p_corrupt")
    half = F.greatest(F.lit(1), F.floor(F.length("value") / 2).cast("int"))
    delay_ms = F.floor(u_delay * (F.col("rule.max_delay_ms") + 1)).cast("bigint")
    x = x.select(
        *[c for c in df.columns if c not in ("value", ts)],
        F.when(corrupt, F.col("value").substr(F.lit(1), half)).otherwise(F.col("value")).alias("value"),
        (F.col(ts) + F.make_dt_interval(secs=delay_ms / F.lit(1000.0))).alias(ts),
        corrupt.alias("corrupted"),
        F.explode(F.sequence(F.lit(1), F.when(u_dup < F.col("rule.p_dup"), 2).otherwise(1))).alias("copy"),
    )
    return x


def canary_split(df: DataFrame, p: float, key: str = "key", main: str = "payment.requested",
                 canary: str = "payment.requested.canary", salt: str = "") -> DataFrame:
    """Route a deterministic share ``p`` of keys to the canary topic.

    The draw is ``conv(md5(key)[0:8], 16, 10) % 10000 < p * 10000`` (same in
    any engine with md5); p = 0 disables the canary."""
    k = F.col(key).cast("string")
    if salt:
        k = F.concat(k, F.lit(salt))
    bucket = F.conv(F.substring(F.md5(k), 1, 8), 16, 10).cast("bigint") % 10000
    is_canary = (F.lit(float(p)) > 0) & (bucket < F.lit(int(round(p * 10000))))
    return df.withColumn("channel", F.when(is_canary, F.lit("canary")).otherwise(F.lit("main"))).withColumn(
        "target_topic", F.when(is_canary, F.lit(canary)).otherwise(F.lit(main)))


def label_periods(df: DataFrame, ts: str, fault_start, fault_end) -> DataFrame:
    """Tag rows ``before`` / ``during`` / ``after`` a fault period."""
    s = F.lit(fault_start).cast("timestamp_ntz")
    e = F.lit(fault_end).cast("timestamp_ntz")
    return df.withColumn(
        "period", F.when(F.col(ts) < s, "before").when(F.col(ts) < e, "during").otherwise("after"))


def merge_channels(channels: dict[str, DataFrame], columns: list[str], out: str = "channel") -> DataFrame:
    """One record set from several (e.g. a topic and its canary), each row marked with its channel."""
    merged = None
    for name, records in channels.items():
        part = records.select(*columns, F.lit(name).alias(out))
        merged = part if merged is None else merged.unionByName(part)
    return merged
