"""Rules that once gave wrong rows, and branches that the registered results must reach."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from eventide.functions import columns as C
from eventide.functions.json_fields import blank
from eventide.operators import dedup, listeners, orders, saga
from eventide.plans import QUERIES
from eventide.streaming import sinks, streams

from .conftest import SF01

T0 = dt.datetime(2024, 1, 1)
OID = "e7a4f431-b2e3-4b43-8a24-8e2b1d3a0e4"


def test_money_rounds_once(spark):
    df = spark.createDataFrame([(Decimal("1.0046"), 1.0046), (Decimal("1.0050"), 1.005), (Decimal("-2.3450"), 2.675)], "d decimal(10,4), x double")
    got = [tuple(r) for r in df.select(C.money("d"), C.money("x")).collect()]
    assert got == [(Decimal("1.00"), Decimal("1.00")), (Decimal("1.01"), Decimal("1.01")), (Decimal("-2.35"), Decimal("2.68"))]


def test_blank_covers_all_white_space(spark):
    df = spark.createDataFrame([("\t",), (" \n",), ("",), (None,), (" x ",)], "s string")
    assert [r[0] for r in df.select(blank("s")).collect()] == [True, True, True, True, False]
    assert [r[0] for r in df.select(C.default_address("s")).collect()][-1] == " x "
    assert df.select(C.default_address("s").alias("a")).where("a = ' x '").count() == 1


def _command(key, offset, oid, reason=None, ref=None):
    body = f'{{"orderId":"{oid}","reason":"{reason}"' + (f',"reservationId":"{ref}"' if ref else "") + "}"
    return key, offset, f'{{"orderId":"{oid}","payload":{body}}}'


def test_two_cancellations_of_one_order(spark):
    table = spark.createDataFrame([(OID + "6", "NEW", None)], "id string, status string, review_reason string")
    msgs = spark.createDataFrame([_command("k2", 2, OID + "6", "second"), _command("k1", 1, OID + "6", "first")], "key string, offset long, value string")
    new, results = listeners.apply_cancellations(table, msgs)
    assert [(r.status, r.review_reason) for r in new.collect()] == [("CANCELLED", "Cancelled: first")]
    assert results.count() == 2


def test_second_release_is_not_counted(spark):
    held = spark.createDataFrame([(OID + "6", "res-1")], "order_id string, reservation_id string")
    msgs = spark.createDataFrame([_command("a", 1, OID + "6"), _command("b", 2, OID + "6"), _command("c", 3, OID + "7", ref="res-9")], "key string, offset long, value string")
    left, released, _ = listeners.apply_releases(held, msgs)
    assert sorted((r.seq, r.counted, r.reservation_id) for r in released.collect()) == [(1, True, "res-1"), (2, False, None), (3, True, "res-9")]
    assert left.count() == 0


def test_keyless_rows_pass_the_dedup(spark):
    df = spark.createDataFrame([("t", None, 1), ("t", None, 1), ("t", "k", 2), ("t", "k", 1)], "topic string, key string, seq long").repartition(3)
    got = sorted((r.key or "", r.seq) for r in dedup.dedup_first_seen(df, ["key"], ["seq"], ["topic"]).collect())
    assert got == [("", 1), ("", 1), ("k", 1)]


def test_swept_compensation_is_left_alone_by_the_next_sweep(spark):
    cols = "order_id string, state string, failed_state string, payment_id string, inventory_reservation_id string, shipping_id string, shipping_address string, failure_reason string, retry_count int, created_at timestamp_ntz, updated_at timestamp_ntz"
    one = spark.createDataFrame([("o", "COMPENSATING", "SHIPPING_FAILED", "p", "r", None, None, "x", 0, T0, T0)], cols)
    as_of = "2024-01-01 01:00:00"
    new, cmds = saga.stuck_compensations(one, as_of)
    assert cmds.count() == 3 and new.first().updated_at == dt.datetime(2024, 1, 1, 1) and new.first().retry_count == 1
    assert saga.stuck_compensations(new, "2024-01-01 01:04:00")[1].count() == 0


@pytest.mark.parametrize("page, size", [(-1, 10), (0, 0)])
def test_bad_page_arguments_are_refused(spark, page, size):
    with pytest.raises(ValueError):
        orders.orders_page(spark.range(1), page=page, size=size)
    with pytest.raises(ValueError):
        orders.orders_page_info(spark.range(1), page=page, size=size)


def test_grace_follows_the_window():
    assert streams.default_grace("1 hour") == streams.default_grace("60 minutes") == f"{23 * 3600} seconds"
    assert streams.default_grace("6 hours") == f"{18 * 3600} seconds" and streams.default_grace("2 days") == "0 seconds"
    with pytest.raises(ValueError):
        streams.interval_seconds("hour")


def test_upsert_sink_unique_and_restartable(spark, tmpdir_fresh):
    table = f"{tmpdir_fresh}/t"
    write = sinks.upsert_writer(table, ["id"], ["v"])
    write(spark.createDataFrame([(1, 1), (1, 2)], "id long, v long"), 0)
    assert [tuple(r) for r in sinks.latest_version(spark, table).collect()] == [(1, 2)]
    os.makedirs(f"{table}/v={1:012d}")  # left behind by a writer that died
    for _ in range(2):  # the retry, and a replay after it
        write(spark.createDataFrame([(2, 1), (1, 3)], "id long, v long"), 1)
        assert sorted(tuple(r) for r in sinks.latest_version(spark, table).collect()) == [(1, 3), (2, 1)]


def test_dead_letters_carry_their_cause(spark, tmpdir_fresh):
    from eventide.operators import dlq

    rows = spark.createDataFrame([("t", "a", None), ("t", "b", "Envelope parse failed"), ("t", "c", "Missing orderId")], "topic string, value string, error_reason string")
    sinks.split_writer(f"{tmpdir_fresh}/good", f"{tmpdir_fresh}/dead")(rows, 0)
    dead = spark.read.parquet(f"{tmpdir_fresh}/dead")
    causes = {r.cause: r.cnt for r in dlq.dlt_causes(dead).collect()}
    assert causes == {"Envelope parse failed": 1, "Missing orderId": 1}


KINDS = {
    "parse_payment_result_mixed": {"Failed to parse payment.result", "Missing orderId"},
    "parse_inventory_result_mixed": {"Failed to parse inventory.result", "Missing orderId"},
    "parse_shipping_result_mixed": {"Failed to parse shipping.result", "Missing orderId"},
    "parse_status_update_mixed": {"Invalid JSON", "Invalid status update message", "Invalid UUID format"},
    "validate_inventory_request_mixed": {"Invalid JSON", "Invalid items count"},
    "validate_shipping_request_mixed": {"Invalid JSON", "Invalid address"},
    "parse_order_created_mixed": {"Failed to parse order.created", "Missing orderId"},
    "validate_create_order_mixed": {"customerId must not be blank", "currency must not be blank", "total must be >= 0.01"},
}


@pytest.mark.parametrize("name", sorted(KINDS))
def test_each_kind_of_error_occurs(spark, name):
    rows = QUERIES[name](spark, SF01).groupBy("error_reason").agg(F.count("*").alias("n")).collect()
    seen = {part for r in rows if r.error_reason for part in r.error_reason.split("; ")}
    assert seen == KINDS[name] and any(r.error_reason is None for r in rows)


def test_the_same_commands_again_change_nothing(spark):
    table = spark.createDataFrame([(OID + "6", "NEW", None), (OID + "7", "NEW", None)], "id string, status string, review_reason string")
    paid = spark.createDataFrame([(OID + "6", "CHARGED")], "order_id string, status string")
    held = spark.createDataFrame([(OID + "6", "res-1")], "order_id string, reservation_id string")
    msgs = spark.createDataFrame([_command("k1", 1, OID + "6", "first"), _command("k2", 2, OID + "7")], "key string, offset long, value string")
    for scope, apply, state in (("order.cancel", listeners.apply_cancellations, table), ("payment.refund", listeners.apply_refunds, paid), ("inventory.release", listeners.apply_releases, held)):
        first = apply(state, msgs)
        store = listeners.processed_keys(msgs, scope)
        again = apply(first[0], msgs, seen=store)
        assert sorted(map(tuple, again[0].collect())) == sorted(map(tuple, first[0].collect()))
        assert all(x.count() == 0 for x in again[1:]) and first[-1].count() == 2


def test_jdbc_reads_must_be_partitioned(spark):
    from eventide.sources.tables import read_table

    with pytest.raises(ValueError):
        read_table(spark, jdbc_url="jdbc:none", table="t")


@pytest.mark.parametrize("name", ["refund_results", "cancellation_results"])
def test_results_of_commands_succeed_and_fail(spark, name):
    rows = QUERIES[name](spark, SF01).select(F.get_json_object("value", "$.success").alias("ok")).distinct().collect()
    assert {r.ok for r in rows} == {"true", "false"}
