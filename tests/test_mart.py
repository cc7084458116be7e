"""Mart, KPI and profile edge rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from fraudloom import schemas
from fraudloom.functions import times
from fraudloom.functions.times import instant
from fraudloom.operators import alerts, profiles
from fraudloom.plans import kpi, mart


def alert(alert_id, rules="R1_BLACKLIST", score="0.9", status="PENDING", label=0, ts=datetime(2024, 1, 5)):
    from decimal import Decimal
    return (
        alert_id, ts, int(ts.strftime("%Y%m%d")), "C1", "M1", "PAYMENT", Decimal("10.50"), rules,
        Decimal(score), label, 0, status, None, None, ts,
    )


def facts(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.FRAUD_ALERTS)


def test_precision_over_no_alerts(spark):
    assert kpi.detection_precision(facts(spark)).first() == (0, None, None, None)


def test_rule_frequency_counts_each_alert_once_and_keeps_silent_rules(spark):
    rows = facts(
        spark, alert(1, "R1_BLACKLIST, R2_CREDIT_LIMIT"), alert(2, "R1_BLACKLIST,R1_BLACKLIST"),
        alert(3, "R4_HIGH_VALUE_BURST"))
    got = {r.rule_code: (r.trigger_count, r.pct_of_all_alerts) for r in
           kpi.rule_frequency(rows, mart.rule_seeds(spark)).collect()}
    assert got["R1_BLACKLIST"] == (2, 66.67)
    assert got["R2_CREDIT_LIMIT"] == (1, 33.33)
    assert got["R6_VELOCITY_BURST"] == (0, 0.0)
    assert len(got) == 6


def test_rule_frequency_equals_find_in_set_join(spark):
    rows = facts(spark, *[alert(i, r) for i, r in enumerate(
        ["R1_BLACKLIST", "R1_BLACKLIST, R3_GEO_VELOCITY", "R6_VELOCITY_BURST,R1_BLACKLIST", "R5_BEHAVIORAL_ANOMALY"])])
    rows.createOrReplaceTempView("fa_literal")
    mart.rule_seeds(spark).createOrReplaceTempView("dim_rule_literal")
    literal = spark.sql("""
        select r.rule_code, count(fa.alert_id) as n from dim_rule_literal r
        left join fa_literal fa on find_in_set(r.rule_code, replace(fa.rules_triggered, ' ', '')) > 0
        group by r.rule_code""")
    ours = kpi.rule_frequency(rows, mart.rule_seeds(spark)).select("rule_code", F.col("trigger_count").alias("n"))
    assert sorted(literal.collect()) == sorted(ours.collect())


def test_share_over_no_alerts_is_null(spark):
    got = kpi.rule_frequency(facts(spark), mart.rule_seeds(spark)).collect()
    assert len(got) == 6 and {r.pct_of_all_alerts for r in got} == {None}


def test_latest_health_keeps_ties(spark):
    at = datetime(2024, 1, 1)
    rows = [(i, at if i else datetime(2023, 1, 1), 20240101, "KAFKA", "lag", float(i), "n", "OK", "") for i in range(3)]
    got = mart.latest_health(spark.createDataFrame(rows, schemas.HEALTH_METRICS))
    assert sorted(r.metric_value for r in got.collect()) == [1.0, 2.0]


@pytest.mark.parametrize("day, week", [(date(2024, 12, 30), 202501), (date(2021, 1, 3), 202053), (date(2024, 1, 1), 202401)])
def test_iso_week(spark, day, week):
    assert spark.range(1).select(times.iso_week(F.lit(day))).first()[0] == week


def test_exposure_includes_the_threshold(spark):
    got = kpi.exposure(facts(spark, alert(1, score="0.7000"), alert(2, score="0.6999"), alert(3, status="FALSE_POSITIVE")))
    assert got.first().high_risk_pending_alerts == 1


def test_daily_summary_fills_gaps(spark):
    dates = mart.dim_date(spark, date(2024, 1, 1), date(2024, 1, 3))
    none = spark.createDataFrame([], schemas.TRANSACTION_SUMMARIES)
    got = kpi.daily_summary(none, dates, instant("2024-01-03 12:00:00")).collect()
    assert [(str(r.full_date), r.total_transactions, float(r.avg_fraud_rate_pct)) for r in got] == [
        ("2024-01-01", 0, 0.0), ("2024-01-02", 0, 0.0), ("2024-01-03", 0, 0.0)]


def test_dim_date_attributes(spark):
    got = mart.dim_date(spark, date(2024, 2, 29), date(2024, 3, 2)).collect()
    assert [(r.date_key, r.day_of_week, r.is_weekend, r.month_name) for r in got] == [
        (20240229, 4, 0, "February"), (20240301, 5, 0, "March"), (20240302, 6, 1, "March")]


def test_fact_round_trip_prunes_days(spark, tmp_path):
    path = str(tmp_path / "fa")
    mart.write_fact(facts(spark, alert(1), alert(2, ts=datetime(2024, 1, 20))), path)
    stored = mart.read_fact(spark, path, schemas.FRAUD_ALERTS)
    recent = mart.since(stored, "alert_ts", instant("2024-01-21 00:00:00"), "7 DAYS")
    assert [r.alert_id for r in recent.collect()] == [2]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_key" in plan and "GreaterThanOrEqual(alert_ts" in plan


def test_upsert_keeps_the_last_arrival(spark, tx_of):
    fired = tx_of(("C1", 5, 1, 1.0), ("C1", 5, 2, 2.0)).withColumns(
        {"rules_triggered": F.array(F.lit("R1_BLACKLIST")), "risk_score": F.lit(1.0)})
    got = alerts.upsert_alerts(fired).collect()
    assert [r.amount for r in got] == [2.0]


def test_upsert_keeps_alerts_without_arrival_number(spark, tx_of):
    fired = tx_of(("C1", 5, 1, 1.0), ("C1", 5, 2, 2.0)).withColumns({
        "seq": F.lit(None).cast("bigint"), "rules_triggered": F.array(F.lit("R1_BLACKLIST")), "risk_score": F.lit(1.0)})
    got = alerts.upsert_alerts(fired).collect()
    assert [(r.amount, r.rules) for r in got] == [(2.0, "R1_BLACKLIST")]


def test_amounts_beyond_the_mart_become_null(spark, tx_of):
    fired = tx_of(("C1", 5, 1, 1e17)).withColumns(
        {"rules_triggered": F.array(F.lit("R1_BLACKLIST")), "risk_score": F.lit(1.0)})
    assert [r.amount for r in alerts.load_alert_fact(fired).collect()] == [None]


def test_write_back_leaves_rule_inputs_alone(spark, tx_of):
    scored = tx_of(("C1", 1_704_067_200_000, 1, 5.0), ("C2", 1_704_067_200_000, 2, 7.0)).withColumns(
        {"risk_score": F.lit(0.9), "flagged": F.lit(True)})
    before = spark.createDataFrame(
        [("C1", "202401", 100.0, "Cairo", 1), ("C3", "202401", 50.0, "Giza", 2)],
        "card_id string, year_month string, credit_limit double, last_city string, last_tx_ts bigint")
    got = {r.card_id: r for r in profiles.merge_profiles(before, scored).collect()}
    assert (got["C1"].credit_limit, got["C1"].last_city, got["C1"].last_amount) == (100.0, "Cairo", 5.0)
    assert got["C1"].last_tx_ts == 1_704_067_200_000 and got["C1"].flagged == "1"
    assert (got["C2"].credit_limit, got["C2"].last_amount, got["C3"].last_tx_ts) == (None, 7.0, 2)
    assert got["C3"].last_amount is None
