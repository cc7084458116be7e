"""Dashboard payloads, delivery, health verdicts, backups."""

import time
from datetime import timedelta

import pytest
from helpers import T0
from pyspark.sql import functions as F

from fraudloom import schemas
from fraudloom.functions import dashboard as fn
from fraudloom.functions import cells, keys
from fraudloom.functions.times import instant
from fraudloom.operators.profiles import retained
from fraudloom.plans import dashboard, health
from fraudloom.sources import backup, topics
from fraudloom.streaming import sinks


@pytest.mark.parametrize("card, mask", [("C12", "1212"), ("Cabc", "0000"), ("C123456", "3456")])
def test_card_mask(spark, card, mask):
    assert spark.range(1).select(fn.card_mask(F.lit(card))).first()[0] == f"**** **** **** {mask}"


def test_keys_are_stable(spark):
    row = spark.range(1).select(
        keys.salt(F.lit("C1")), keys.alert_key(F.lit("C1"), F.lit(0).cast("bigint")), keys.key_range(F.lit("f0"))).first()
    assert tuple(row) == ("1a", "1a_C1_09223372036854775807", 15)


@pytest.mark.parametrize("n, sizes", [(0, []), (20, [20]), (21, [20, 1])])
def test_payload_sizes(spark, tx_of, n, sizes):
    feed = dashboard.enrich(tx_of(*[("C1", T0 + i, i, 1) for i in range(n)]))
    got = dashboard.push_payloads(feed)
    assert sorted((r.n_rows for r in got.collect()), reverse=True) == sizes


def test_payloads_of_a_busy_interval_hold_every_row_once(spark, tx_of):
    feed = dashboard.enrich(tx_of(*[("C1", T0, i, 1) for i in range(500)]))
    got = dashboard.push_payloads(feed, id_digits=1).collect()
    assert sorted(got) == sorted(dashboard.push_payloads(feed, id_digits=0).collect())
    assert sum(r.n_rows for r in got) == 500 and max(r.n_rows for r in got) <= 20
    assert sum(r.payload_json.count('"Transaction_ID"') for r in got) == 500


def test_rows_without_time_are_sent(spark, tx_of):
    feed = dashboard.enrich(tx_of(*[("C1", T0, i, 1) for i in range(30)])).withColumn("Time", F.lit(None).cast("string"))
    got = dashboard.push_payloads(feed).collect()
    assert sorted((r.flush_interval, r.n_rows) for r in got) == [(None, 10), (None, 20)]


def test_severity_borders(spark):
    df = spark.createDataFrame([(0.95,), (0.85,), (0.5,), (0.49,)], "s double")
    assert [r[0] for r in df.select(fn.severity(F.col("s"))).collect()] == ["Critical", "High", "Medium", "Low"]


def flaky(refusals):
    """A receiver that refuses the first tries of every payload."""
    seen = {}

    def send(payload):
        seen[payload] = seen.get(payload, 0) + 1
        if seen[payload] <= refusals:
            raise OSError("no answer")
        return 202

    return send


@pytest.mark.parametrize("refusals, delivered, attempts", [(0, True, 1), (3, True, 4), (9, False, 4)])
def test_delivery_retries_then_drops(spark, refusals, delivered, attempts):
    payloads = spark.createDataFrame([("{}", 1)], "payload_json string, n_rows int")
    row = sinks.deliver(payloads, flaky(refusals), pauses=(0.0, 0.0, 0.0)).first()
    assert (row.delivered, row.attempts) == (delivered, attempts)


def test_consumer_lag(spark):
    offsets = spark.createDataFrame(
        [("t", 0, -1, 5, 12), ("t", 1, 99, 0, 50), ("t", 2, 10, 0, 30), ("u", 0, 0, 0, 200_000)],
        "topic string, partition int, committed bigint, low bigint, high bigint")
    got = {r.topic: (r.total_lag, r.over_threshold) for r in health.consumer_lag(offsets).collect()}
    assert got == {"t": (27, False), "u": (200_000, True)}


def test_topic_verdicts(spark):
    topics_ = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "topic string")
    parts = spark.createDataFrame(
        [("a", 0, 1), ("a", 1, 2), ("b", 0, -1), ("b", 3, -1), ("c", None, None)], "topic string, partition int, leader int")
    got = {r.topic: (r.healthy, r.reason, r.partition_count) for r in health.topic_health(topics_, parts).collect()}
    assert got["a"] == (True, "OK", 2)
    assert got["b"] == (False, "Partitions without leader: [0, 3]", 2)
    assert got["c"] == (False, "Topic 'c' has no partitions", 0)
    assert got["d"] == (False, "Topic 'd' does not exist", 0)


@pytest.mark.parametrize("state, active", [("RUNNING", False), ("FINISHED", False), ("FAILED", True), (None, True)])
def test_safe_mode(spark, state, active):
    assert spark.range(1).select(health.safe_mode(F.lit(state).cast("string"))).first()[0] == active


def test_backup_of_empty_and_failing_tables(spark, tmp_path):
    def broken():
        raise RuntimeError("connection refused")

    listed = spark.createDataFrame([("C1", "1")], "card_id string, is_active string")
    base, taken = str(tmp_path), instant("2024-01-31 00:30:00")
    entries = backup.write_backup(
        spark, {"blacklist": listed, "user_profiles": spark.createDataFrame([], schemas.USER_PROFILES),
                "fraud_alerts": broken}, base, taken)
    got = {r.table: (r.rows, r.status) for r in entries.collect()}
    assert got["blacklist"] == (1, "OK") and got["user_profiles"] == (0, "OK")
    assert got["fraud_alerts"] == (0, "FAILED: connection refused")
    assert not (tmp_path / "2024-01-31" / "user_profiles_backup").exists()
    summary = backup.summarize(entries).first()
    assert (summary.total_rows, summary.success) == (1, False)


def test_restore_round_trip_with_nulls_and_unreadable_cells(spark):
    rows = [("C1", "202401", 5.0, None, None, None, 2.5, None, "Cairo", 77, None, None, "0")]
    table = spark.createDataFrame(rows, schemas.USER_PROFILES)
    stored = backup.to_rows("user_profiles", table, 1)
    assert backup.restore("user_profiles", stored, schemas.USER_PROFILES).exceptAll(table).count() == 0
    bad = stored.withColumn("columns", F.map_concat(
        F.map_filter("columns", lambda k, _: k != "geo:last_tx_ts"), F.create_map(F.lit("geo:last_tx_ts"), F.lit("x"))))
    row = backup.restore("user_profiles", bad, schemas.USER_PROFILES).first()
    assert (row.last_tx_ts, row.last_city) == (None, None)


def test_raw_cells_are_repaired(spark):
    raw = spark.range(1).select(
        F.lit(b"k\xff").alias("row_key"), F.create_map(F.lit(b"info:a"), F.lit(b"\xc3\xa9\xfe")).alias("columns"))
    row = backup.raw_to_rows(raw, 9).first()
    assert row.row_key == "k�" and row.columns == {"info:a": "é�"} and row.backup_ts == 9
    assert spark.range(1).select(cells.utf8(F.lit(b"ok"))).first()[0] == "ok"


def test_expiry_border(spark):
    as_of = instant("2024-04-30 10:00:00")
    days = [((as_of - timedelta(days=n)).strftime("%Y-%m-%d"),) for n in (89, 90, 91)]
    got = backup.expired(spark.createDataFrame(days, "backup_date string"), as_of)
    assert [r[0] for r in got.collect()] == [days[2][0]]


@pytest.mark.parametrize("value", [b"", b"\x00\x00\x00\x00\x01", b"\x01\x00\x00\x00\x01{}", b"\x00\x00\x00\x00\x01{}", b"\x00\x00\x00\x00\x01{"])
def test_unreadable_messages_are_null(spark, value):
    df = spark.range(1).select(F.lit(value).alias("value"))
    assert topics.decode_messages(df).first().tx is None
    assert topics.readable(topics.decode_messages(df)).count() == 0


def test_retention_keeps_families_without_limits(spark):
    rows = [("r", family, "q", "v", instant("2020-01-01 00:00:00")) for family in ("audit", "other", None)]
    found = spark.createDataFrame(
        rows, "row_key string, family string, qualifier string, value string, version_ts timestamp")
    kept = retained(found, "blacklist", instant("2024-01-31 00:00:00"))
    assert {r.family for r in kept.collect()} == {"other", None}


def test_one_pause_serves_all_refused_payloads(spark):
    payloads = spark.createDataFrame([(str(i), 1) for i in range(30)], "payload_json string, n_rows int").coalesce(1)
    began = time.perf_counter()
    outcome = sinks.deliver(payloads, lambda _: 500, pauses=(1.0,)).collect()
    assert time.perf_counter() - began < 20
    assert {(r.delivered, r.attempts) for r in outcome} == {(False, 2)}
