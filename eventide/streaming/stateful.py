"""Custom stateful streaming operator (``applyInPandasWithState``).

``outbound_ttl_dedup_stream`` keeps the last accepted time per result key
(one long) and a timer: once the watermark is a TTL past it the entry can
suppress nothing any more and is removed, so the state holds the keys of the
last TTL and of the watermark's delay.  Messages go in and out as JSON: a
pandas column for every field of every key costs far more than the check.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_NO_KEY = "\x00"
_OUT = "k:string,topic:string,partition:int,offset:bigint,ts_us:bigint"
_CELL = pd.Index(["kept"])


def watermarked_micros(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """``df`` with a watermark on TIMESTAMP ``ts``, which then holds microseconds: of all columns a zoned time is
    the dearest to make in pandas.  The watermark goes with the column's metadata, which a change of type would drop."""
    marked = df.withWatermark(ts, delay)
    micros = F.unix_micros(ts).alias(ts, metadata=marked.schema[ts].metadata)
    return marked.select(*(micros if c == ts else F.col(c) for c in marked.columns))


def _order(message: dict) -> tuple:
    return tuple((message.get(c) is None, message.get(c)) for c in ("ts_us", "topic", "partition", "offset"))


def _ttl_fn(ttl_us: int):
    def fn(key, pdfs, state):
        if state.hasTimedOut:
            state.remove()
            return
        batch = [json.loads(m) for pdf in pdfs for m in pdf["message"].tolist()]
        last = state.get[0] if state.exists else None
        keep = []
        for m in sorted(batch, key=_order) if len(batch) > 1 else batch:
            t = m.get("ts_us")
            if last is None or (t is not None and t >= last + ttl_us):
                keep.append({"k": key[0], **m})
                last = t
        state.update((int(last),))
        state.setTimeoutTimestamp(max((int(last) + ttl_us) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        if keep:
            yield pd.DataFrame(np.array([[json.dumps(keep)]], dtype=object), columns=_CELL, copy=False)

    return fn


def outbound_ttl_dedup_stream(df: DataFrame, key: str, ts: str, ttl_seconds: int = 600, delay: str = "10 minutes") -> DataFrame:
    """Streaming greedy TTL de-duplication keyed by ``key``; ``delay`` is the
    watermark's and bounds how late a record may come to meet its key's entry.

    A message's id is (topic, partition, offset), which also orders messages of
    one instant, as in the batch operator; topics without these columns get
    empty ones."""
    kinds = {"topic": "string", "partition": "int", "offset": "bigint"}
    ids = [(F.col(c) if c in df.columns else F.lit("" if t == "string" else 0)).cast(t).alias(c) for c, t in kinds.items()]
    x = df.select(F.col(key).cast("string").alias("k"), *ids, F.col(ts).cast("timestamp").alias("event_time"))
    # messages without a key are all accepted: each is a key of its own
    x = x.withColumn("k", F.coalesce("k", F.concat_ws(_NO_KEY, F.lit(""), *kinds)))
    message = F.to_json(F.struct(*kinds, F.unix_micros("event_time").alias("ts_us")))
    x = watermarked_micros(x.select("k", message.alias("message"), "event_time"), "event_time", delay)
    out = x.groupBy("k").applyInPandasWithState(_ttl_fn(ttl_seconds * 1_000_000), "kept string", "ts_us long", "Append", "EventTimeTimeout")
    out = out.select(F.inline(F.from_json("kept", f"array<struct<{_OUT}>>")))
    return out.withColumn("k", F.when(~F.startswith("k", F.lit(_NO_KEY)), F.col("k")))
