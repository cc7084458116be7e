"""The twelve KPI queries over the mart tables.

Relative time always counts back from ``as_of``, so that a query can be
repeated. Ranked lists carry a unique tie-break.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudloom.functions import parsing, times
from fraudloom.plans.mart import latest_health, on_day, since


def share_pct(part: Column, whole: Column) -> Column:
    return F.round(100.0 * part / F.nullif(whole, F.lit(0)), 2)


def sum_if(condition: Column) -> Column:
    """Like count_if, but null over no rows at all."""
    return F.sum(F.when(condition, 1).otherwise(0))


def alerts_today(alerts: DataFrame, as_of: datetime) -> DataFrame:
    """KPI 1."""
    return on_day(alerts, "alert_ts", as_of).agg(F.count(F.lit(1)).alias("alerts_today"))


def detection_precision(alerts: DataFrame) -> DataFrame:
    """KPI 2."""
    true_positive = sum_if(F.col("is_fraud_label") == 1)
    return alerts.agg(
        F.count(F.lit(1)).alias("total_alerts"),
        true_positive.alias("true_positives"),
        sum_if(F.col("is_fraud_label") == 0).alias("false_positives"),
        share_pct(true_positive, F.count(F.lit(1))).alias("precision_pct"),
    )


def risk_by_type(alerts: DataFrame) -> DataFrame:
    """KPI 3."""
    return (
        alerts.groupBy("transaction_type")
        .agg(
            F.round(F.avg("risk_score"), 4).alias("avg_risk_score"),
            F.count(F.lit(1)).alias("alert_count"),
            F.sum("amount").alias("total_flagged_amount"),
        )
        .orderBy(F.desc("avg_risk_score"), "transaction_type")
    )


def busiest_cards(alerts: DataFrame, limit: int = 10) -> DataFrame:
    """Cards with most alerts."""
    return (
        alerts.groupBy("card_id")
        .agg(
            F.count(F.lit(1)).alias("total_alerts"),
            F.round(F.avg("risk_score"), 4).alias("avg_risk_score"),
            F.sum("amount").alias("total_flagged_amount"),
            F.max("alert_ts").alias("last_seen"),
        )
        .orderBy(F.desc("total_alerts"), "card_id")
        .limit(limit)
    )


def top_cards(alerts: DataFrame, as_of: datetime, limit: int = 10) -> DataFrame:
    """KPI 4."""
    return busiest_cards(since(alerts, "alert_ts", as_of, "7 DAYS"), limit)


def hourly_volume(summaries: DataFrame, as_of: datetime) -> DataFrame:
    """KPI 5. The rate is the plain mean of the rates per type."""
    return (
        since(summaries, "summary_hour", as_of, "24 HOURS")
        .groupBy(times.hour_label(F.col("summary_hour")).alias("hour_label"))
        .agg(
            F.sum("total_transactions").alias("total_txn"),
            F.sum("fraud_count").alias("fraud_txn"),
            F.round(F.avg("fraud_rate_pct"), 4).alias("avg_fraud_rate_pct"),
            F.sum("total_amount").alias("total_volume"),
            F.sum("fraud_amount").alias("fraud_volume"),
        )
        .orderBy("hour_label")
    )


def rule_members(alerts: DataFrame, *columns: str) -> DataFrame:
    """One row per rule that an alert (or a group of equal rule lists) names: ``columns`` and ``rule_code``."""
    return alerts.select(*columns, F.explode(parsing.rule_list(F.col("rules_triggered"))).alias("rule_code"))


def share_of_all(alerts: DataFrame, key: str) -> DataFrame:
    """Percentage of all rows by ``key``; the total is the sum of the groups, so rows are read once."""
    groups = alerts.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = groups.agg(F.sum("n").alias("total"))
    return groups.crossJoin(F.broadcast(total)).select(  # exactly one row
        key, share_pct(F.col("n"), F.col("total")).alias("pct_of_all_alerts"))


def rule_frequency(alerts: DataFrame, rules: DataFrame) -> DataFrame:
    """KPI 6. Rules that never fired stay with 0.

    Six rules allow 64 rule lists, so alerts are first counted per list in one
    pass with map-side combine. Lists are split after that: the join sees a few
    dozen rows, and membership is an equi-join in place of a theta join.
    """
    per_list = alerts.groupBy("rules_triggered").agg(F.count("alert_id").alias("n"))
    per_rule = (
        rule_members(per_list, "n").groupBy("rule_code").agg(F.sum("n").alias("n"))
    )
    total = per_list.agg(F.sum("n").alias("total"))
    return (
        rules.join(per_rule, "rule_code", "left")
        .crossJoin(F.broadcast(total))  # exactly one row
        .select(
            "rule_code", "rule_name", "severity",
            F.coalesce("n", F.lit(0)).alias("trigger_count"),
            share_pct(F.coalesce("n", F.lit(0)), F.col("total")).alias("pct_of_all_alerts"),
        )
        .orderBy(F.desc("trigger_count"), "rule_code")
    )


def on_days(spine: DataFrame, per_day: DataFrame) -> DataFrame:
    """The days of ``spine`` with the measures of ``per_day`` (one row per date_key), zeros on days without."""
    measures = [c for c in per_day.columns if c != "date_key"]
    kept = [c for c in spine.columns if c != "date_key"]
    return spine.join(per_day, "date_key", "left").select(*kept, *[F.coalesce(c, F.lit(0)).alias(c) for c in measures])


def daily_summary(summaries: DataFrame, dates: DataFrame, as_of: datetime) -> DataFrame:
    """KPI 7. Days without traffic show zeros. Facts are summed per day before the join."""
    first = F.date_sub(F.to_date(F.lit(as_of)), 30)
    spine = dates.where(F.col("full_date") >= first).select("date_key", "full_date", "day_name")
    per_day = (
        summaries.where(F.col("date_key") >= times.date_key(first))
        .groupBy("date_key")
        .agg(
            F.sum("total_transactions").alias("total_transactions"),
            F.sum("fraud_count").alias("fraud_count"),
            F.sum("fraud_amount").alias("fraud_amount"),
            F.sum("alerts_generated").alias("alerts_generated"),
            F.avg("fraud_rate_pct").alias("avg_fraud_rate_pct"),
        )
    )
    return on_days(spine, per_day).orderBy("full_date")


def health_summary(metrics: DataFrame) -> DataFrame:
    """KPI 8."""
    return latest_health(metrics).orderBy("component", "metric_name")


def open_reviews(alerts: DataFrame) -> DataFrame:
    return alerts.where(F.col("review_status").isin("PENDING", "UNDER_REVIEW"))


def high_risk_pending(alerts: DataFrame) -> DataFrame:
    """Alerts nobody has looked at; the threshold itself counts as high risk."""
    return alerts.where((F.col("risk_score") >= 0.7) & (F.col("review_status") == "PENDING"))


def worst_hours(summaries: DataFrame, limit: int = 100) -> DataFrame:
    """Hours and types with the highest fraud rates, with their places: a ranked report."""
    order = [F.desc("fraud_rate_pct"), F.desc("summary_hour"), F.col("transaction_type")]
    top = summaries.select("summary_hour", "transaction_type", "fraud_rate_pct").orderBy(*order).limit(limit)
    # `limit` rows at most are left to number
    return top.withColumn("place", F.row_number().over(Window.partitionBy().orderBy(*order)))


def review_queue(alerts: DataFrame, limit: int = 200) -> DataFrame:
    """KPI 9."""
    return (
        open_reviews(alerts)
        .select(
            "alert_id", "alert_ts", "card_id", "transaction_type", "amount", "risk_score",
            "rules_triggered", "is_fraud_label", "review_status",
        )
        .orderBy(F.desc("risk_score"), F.desc("alert_ts"), "alert_id")
        .limit(limit)
    )


def weekly_outcomes(alerts: DataFrame, as_of: datetime) -> DataFrame:
    """KPI 10. Alerts under review only show in the total."""
    status = F.col("review_status")
    return (
        since(alerts, "alert_ts", as_of, "84 DAYS")
        .groupBy(times.iso_week(F.col("alert_ts")).alias("iso_week"))
        .agg(
            F.min(F.to_date("alert_ts")).alias("week_start"),
            F.count_if(status == "CONFIRMED_FRAUD").alias("confirmed_fraud"),
            F.count_if(status == "FALSE_POSITIVE").alias("false_positives"),
            F.count_if(status == "PENDING").alias("pending"),
            F.count(F.lit(1)).alias("total_alerts"),
        )
        .orderBy("iso_week")
    )


def exposure(alerts: DataFrame) -> DataFrame:
    """KPI 11."""
    return high_risk_pending(alerts).agg(
        F.count(F.lit(1)).alias("high_risk_pending_alerts"),
        F.sum("amount").alias("total_exposure"),
        F.max("risk_score").alias("max_risk_score"),
        F.avg("amount").alias("avg_high_risk_amount"),
    )


def safe_mode_timeline(events: DataFrame, as_of: datetime) -> DataFrame:
    """KPI 12."""
    return (
        since(events.where(F.col("event_type") == "SAFE_MODE"), "event_ts", as_of, "30 DAYS")
        .select("event_ts", "event_type", "component", "severity", "dag_run_id", "message")
        .orderBy(F.desc("event_ts"))
    )
