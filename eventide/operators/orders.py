"""Order-table queries: pages, filters, top-k, counts (repository queries).

Sorted reads use a deterministic tie-break (the key) so pages are stable.
``limit``/``offset`` after ``orderBy`` plan as a top-k (``TakeOrderedAndProject``):
each task keeps ``offset + size`` rows, the driver merges those only.  A page
beyond the first SHALLOW rows is found by counts instead: rows per day, then
per second of the days that hold the page, and only the rows of those seconds
are sorted, with what is left of the offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_PAGE_SIZE = 100
#: rows that a plain top-k keeps per task
SHALLOW = 1000


def _order(df: DataFrame, ts: str, key: str):
    return df.orderBy(F.col(ts).desc(), F.col(key).desc())


def _paging(page: int, size: int) -> tuple[int, int]:
    if int(page) < 0 or int(size) < 1:
        raise ValueError(f"page must not be negative and size must be positive: {page}, {size}")
    return int(page), min(int(size), MAX_PAGE_SIZE)


def _rows_of_page(df: DataFrame, start: int, size: int, ts: str) -> tuple[DataFrame, int]:
    """The rows among which the page lies (newest first, no time last), and how many of them come before it."""
    for unit in ("DAY", "SECOND"):
        # a row per day, then per second of the days found; what comes back is one row
        counts = df.groupBy(F.date_trunc(unit, ts).alias("t")).agg(F.count("*").alias("n"))
        upto = Window.orderBy(F.col("t").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
        held = counts.withColumn("after", F.sum("n").over(upto)).where((F.col("after") > start) & (F.col("after") - F.col("n") < start + size))
        low, high, before, untimed = held.agg(F.min("t"), F.max("t"), F.min(F.col("after") - F.col("n")), F.count_if(F.col("t").isNull())).first()
        if before is None:
            return df.limit(0), 0
        kind, near = df.schema[ts].dataType, F.lit(False)
        if low is not None:
            near = (F.col(ts) >= F.lit(low).cast(kind)) & (F.col(ts) < F.lit(high).cast(kind) + F.expr(f"INTERVAL 1 {unit}"))
        df, start = df.where(near | F.col(ts).isNull() if untimed else near), start - before
    return df, start


def orders_page(df: DataFrame, page: int = 0, size: int = 20, ts: str = "created_at", key: str = "id") -> DataFrame:
    """One page by created_at desc; size capped at 100 as the API does, other bad arguments are refused."""
    page, size = _paging(page, size)
    start = page * size
    if start + size > SHALLOW:
        df, start = _rows_of_page(df, start, size, ts)
    return _order(df, ts, key).offset(start).limit(size)


def orders_page_info(df: DataFrame, page: int = 0, size: int = 20) -> DataFrame:
    """Totals of the paging response: total elements/pages, hasNext, hasPrevious."""
    page, size = _paging(page, size)
    c = df.agg(F.count(F.lit(1)).alias("total_elements"))
    pages = F.ceil(F.col("total_elements") / F.lit(size)).cast("bigint")
    return c.select(
        F.lit(int(page)).alias("page"), F.lit(size).alias("size"), "total_elements", pages.alias("total_pages"),
        (F.lit(int(page)) + 1 < pages).alias("has_next"), F.lit(int(page) > 0).alias("has_previous"),
    )


def orders_all(df: DataFrame, ts: str = "created_at", key: str = "id") -> DataFrame:
    return _order(df, ts, key)


def orders_by_status(df: DataFrame, status: str, col: str = "status") -> DataFrame:
    return df.where(F.col(col) == status)


def orders_by_customer(df: DataFrame, customer, col: str = "customer_id") -> DataFrame:
    return df.where(F.col(col) == customer)


def order_by_id(df: DataFrame, oid, col: str = "id") -> DataFrame:
    return df.where(F.col(col) == oid)


def high_value_orders(df: DataFrame, threshold, total: str = "total", ts: str = "created_at",
                      key: str = "id") -> DataFrame:
    return _order(df.where(F.col(total) > F.lit(threshold)), ts, key)


def count_by_status(df: DataFrame, col: str = "status") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("cnt"))


def recent(df: DataFrame, ts: str, key: str, n: int = 5) -> DataFrame:
    """Last ``n`` rows by time (top-k, not a full sort)."""
    return _order(df, ts, key).limit(n)
