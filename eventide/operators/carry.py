"""Skew-safe "last earlier value" per key (an as-of lookup within a key).

``last(x, ignoreNulls) OVER (PARTITION BY key ORDER BY o ROWS ... -1)`` puts
every row of a key into one window group, so one hot key lands in one task.
``carry_last_before`` computes the same column without that:

1. every row gets the number of its range of ``order``: the bounds are
   quantiles of a fixed sample (the rows of smallest hash), read by a scalar
   subquery inside the plan.  The same rows give the same bounds, so a task
   that is run again, or a branch that is planned twice, agrees with the rest,
   and nothing is written or run while the plan is built;
2. inside each (key, range) the running last value is a window over that
   range only; a key that holds a third of the rows is many such groups;
3. the value entering a range is the last non-null of the earlier ranges of
   the same key: one aggregate row per (key, range), then a window over
   those few rows per key;
4. one join on (key, range) brings the carry-in back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: rows the bounds are taken from
SAMPLE = 4096


def with_range(df: DataFrame, key: str, order: str, ranges: int) -> DataFrame:
    """Adds _rng: the number of the range of ``order`` that a row belongs to, about as many rows in each."""
    sample = df.select(order).orderBy(F.xxhash64(key, order), order).limit(SAMPLE).agg(F.array_sort(F.collect_list(order)).alias("v"))
    picks = F.sequence(F.lit(1), F.lit(max(1, ranges - 1)))
    bounds = sample.select(F.transform(picks, lambda k: F.get("v", F.floor(k * F.size("v") / ranges).cast("int")))).scalar()
    placed = df.withColumn("_bounds", bounds)
    return placed.withColumn("_rng", F.size(F.filter("_bounds", lambda b: b <= F.col(order)))).drop("_bounds")


def carry_last_before(df: DataFrame, key: str, order: str, values: dict[str, tuple[Column, Column]],
                      num_ranges: int | None = None) -> DataFrame:
    """Add one column per ``values`` item: ``name -> (flag, value)``; the new
    column holds ``value`` of the latest earlier row (same key, smaller
    ``order``) where ``flag`` is true, NULL values included, else NULL."""
    spark = df.sparkSession
    n = num_ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = df
    for name, (flag, value) in values.items():
        tagged = tagged.withColumn(f"_t_{name}", F.when(flag, F.struct(value.alias("v"))))
    ranged = with_range(tagged, key, order, n)

    w_in = Window.partitionBy(key, "_rng").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged
    for name in values:
        local = local.withColumn(f"_l_{name}", F.last(f"_t_{name}", ignorenulls=True).over(w_in))
    # the number as a window's result: the optimiser must not carry its expression, which reads ``order``, over the join
    local = local.withColumn("_in", F.max("_rng").over(Window.partitionBy(key, "_rng")))

    per = ranged.groupBy(key, "_rng").agg(*[
        F.max_by(F.col(f"_t_{name}"), F.when(F.col(f"_t_{name}").isNotNull(), F.col(order))).alias(f"_p_{name}")
        for name in values])
    w_rng = Window.partitionBy(key).orderBy("_rng").rowsBetween(Window.unboundedPreceding, -1)
    carry_in = per.select(key, F.col("_rng").alias("_in"), *[
        F.last(f"_p_{name}", ignorenulls=True).over(w_rng).alias(f"_i_{name}") for name in values])

    out = local.join(carry_in, [key, "_in"], "left")
    for name in values:
        out = out.withColumn(name, F.coalesce(F.col(f"_l_{name}"), F.col(f"_i_{name}"))["v"])
    drop = ["_rng", "_in"] + [f"_{p}_{name}" for name in values for p in ("t", "l", "i")]
    return out.drop(*drop)
