"""De-duplication: first-seen per idempotency key, against history, and the
outbound TTL de-duplication of result messages.

``dedup_first_seen`` is one ``groupBy`` with ``min_by``: the aggregate is
partial, so even a key that carries a third of all rows is reduced map-side
and only one row per (task, key) is shuffled.

``dedup_outbound_ttl`` (accept a key, suppress it for ``ttl``, accept the
next one after that, ...) is sequential per key.  A message whose predecessor
of the same key is at least one TTL older is always accepted: it heads a run.
Only runs of several messages need the chain head, first message a TTL later,
and so on; it is resolved by pointer doubling over the messages of those runs,
until nothing is added.  Neighbours are looked up in grains of ``ttl / GRAINS``
(window groups of one key's messages in one grain) and, across grains, in one
aggregate row per key and grain.  Streaming form:
``streaming.stateful.outbound_ttl_dedup_stream``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import epoch_micros


def dedup_first_seen(
    df: DataFrame,
    key_cols: list[str],
    order_cols: list[str],
    scope_cols: list[str] | None = None,
    seen: DataFrame | None = None,
) -> DataFrame:
    """Keep the first record (by ``order_cols``) of every (scope, key).

    ``seen`` is the idempotency table of earlier runs (same scope/key
    columns); keys in it are dropped entirely (``left_anti``).  Rows whose key
    is NULL have no idempotency key and pass through untouched.

    Keyed rows are one partial aggregate (``min_by``); keyless rows bypass it,
    so nothing depends on an id made up while the job runs.
    """
    keys = (scope_cols or []) + key_cols
    cols = df.columns
    if seen is not None:
        df = df.join(seen.select(*keys).distinct(), keys, "left_anti")
    null_key = None
    for k in key_cols:
        null_key = F.col(k).isNull() if null_key is None else (null_key | F.col(k).isNull())
    row = F.struct(*[F.col(c) for c in cols])
    grouped = df.where(~null_key).groupBy(*keys).agg(F.min_by(row, F.struct(*[F.col(c) for c in order_cols])).alias("_r"))
    return grouped.select("_r.*").unionByName(df.where(null_key))


#: grains of a TTL; divides any whole number of seconds in microseconds
GRAINS = 64


def _grain(us: Column, ttl_us: int) -> Column:
    return us - F.pmod(us, F.lit(ttl_us // GRAINS))


def _with_neighbours(msgs: DataFrame, ttl_us: int) -> DataFrame:
    """Adds _prev and _next: times of the key's neighbouring messages, where they are less than a TTL away
    (else NULL or a time farther away)."""
    grains = msgs.where(F.col("_k").isNotNull()).groupBy("_k", "_g").agg(F.min("_us").alias("_lo"), F.max("_us").alias("_hi"))
    w = Window.partitionBy("_k").orderBy("_g")
    around = grains.select(
        "_k", "_g", F.max("_hi").over(w.rangeBetween(-ttl_us, -1)).alias("_before"),
        F.min("_lo").over(w.rangeBetween(1, ttl_us)).alias("_after"))
    own = Window.partitionBy("_k", "_g").orderBy("_us", "_rid")
    local = msgs.withColumn("_prev", F.lag("_us").over(own)).withColumn("_next", F.lead("_us").over(own))
    out = local.join(around, ["_k", "_g"], "left")
    return out.withColumn("_prev", F.coalesce("_prev", "_before")).withColumn("_next", F.coalesce("_next", "_after")).drop("_before", "_after")


def _first_after(msgs: DataFrame, ttl_us: int) -> DataFrame:
    """(_rid, _j): the key's first message at or after a TTL past each message, looked for one TTL long
    (what comes later heads a run of its own)."""
    none = F.lit(None).cast(msgs.schema["_rid"].dataType)
    late = F.col("_us") + F.lit(ttl_us)
    probes = msgs.select("_k", late.alias("_us"), _grain(late, ttl_us).alias("_g"), F.lit(0).alias("_kind"), F.col("_rid").alias("_src"), none.alias("_rid"))
    both = probes.unionByName(msgs.select("_k", "_us", "_g", F.lit(1).alias("_kind"), none.alias("_src"), "_rid"))
    follow = Window.partitionBy("_k", "_g").orderBy("_us", "_kind", "_rid").rowsBetween(0, Window.unboundedFollowing)
    found = both.withColumn("_j", F.first("_rid", ignorenulls=True).over(follow)).where(F.col("_kind") == 0)
    firsts = both.groupBy("_k", "_g").agg(F.min(F.when(F.col("_kind") == 1, F.struct("_us", "_rid"))).alias("_first"))
    after = firsts.select("_k", "_g", F.min("_first").over(Window.partitionBy("_k").orderBy("_g").rangeBetween(1, ttl_us)).alias("_after"))
    return found.join(after, ["_k", "_g"], "left").select(F.col("_src").alias("_rid"), F.coalesce("_j", "_after._rid").alias("_j"))


def dedup_outbound_ttl(df: DataFrame, key: str, ts: str, ttl_seconds: int = 600,
                       id_cols: list[str] | None = None) -> DataFrame:
    """Greedy TTL de-duplication: accept a message, suppress the same key for
    ``ttl`` (an entry expires exactly ``ttl`` after its write), accept the next
    message after that, and so on.  Returns the accepted rows; rows without a
    key are all accepted.

    ``id_cols`` together are unique per message and order messages of one
    instant (default topic, partition, offset: an offset alone repeats).
    The messages of runs, and each doubling round over them, are checkpointed
    to the shared folder.
    """
    from ..session import cut_lineage

    ids = id_cols or ["topic", "partition", "offset"]
    ttl_us = int(ttl_seconds) * 1_000_000
    us = epoch_micros(df, ts)
    base = df.withColumn("_k", F.col(key)).withColumn("_us", us).withColumn("_rid", F.struct(*ids))
    base = base.withColumn("_g", F.when(F.col("_k").isNull(), F.xxhash64("_rid")).otherwise(_grain(F.col("_us"), ttl_us)))
    near = _with_neighbours(base, ttl_us)
    head = F.col("_k").isNull() | F.col("_prev").isNull() | (F.col("_prev") <= F.col("_us") - F.lit(ttl_us))
    near = near.withColumn("_head", head)
    alone = F.col("_head") & (F.col("_k").isNull() | F.col("_next").isNull() | (F.col("_next") >= F.col("_us") + F.lit(ttl_us)))
    runs = cut_lineage(near.where(~alone).select("_k", "_us", "_g", "_rid", "_head"))
    followers = runs.where(~F.col("_head")).select(F.col("_rid").alias("_j"))
    jump = cut_lineage(_first_after(runs, ttl_us).join(followers, "_j").select("_rid", "_j"))
    reach = runs.where("_head").select("_rid")
    size = 0
    while True:
        step = reach.join(jump, "_rid").select(F.col("_j").alias("_rid"))
        reach = cut_lineage(reach.unionByName(step).distinct())
        grown = reach.count()  # reads the checkpoint
        if grown == size:
            break
        size = grown
        jump = cut_lineage(jump.alias("a").join(jump.alias("b"), F.col("a._j") == F.col("b._rid")).select(
            F.col("a._rid").alias("_rid"), F.col("b._j").alias("_j")))
    later = reach.join(followers.select(F.col("_j").alias("_rid")), "_rid", "left_semi").withColumn("_kept", F.lit(True))
    out = near.join(later, "_rid", "left").where(F.col("_head") | F.col("_kept"))
    return out.select(*df.columns)
