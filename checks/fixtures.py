"""Card-fraud input tables derived from the given ``events`` table.

The adapter keeps every row. Window and geo limits of ``FIXTURE`` are longer
than the production defaults so that all six rules fire on sparse test data.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudloom import schemas
from fraudloom.config import RuleConfig
from fraudloom.functions.times import event_time, instant
from fraudloom.operators.alerts import load_alert_fact
from fraudloom.plans.dashboard import enrich
from fraudloom.plans.health import safe_mode_events
from fraudloom.plans.mart import (
    dim_date_covering, hourly_summary, read_fact, rule_seeds, type_seeds, write_fact,
)
from fraudloom.plans.scoring import fired, score
from fraudloom.session import prepare, work_dir

AS_OF = instant("2024-01-31 00:00:00")
FIXTURE = RuleConfig(window_ms=172_800_000, geo_ms=21_600_000)
# Every card counts as hot: exercises the slot-splitting path on all rows.
ALL_HOT = replace(FIXTURE, hot_card_rows=1, slot_ms=3_600_000)

_EPOCH_MS = "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts) div 1000"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/events.parquet")


def to_transactions(events_df: DataFrame) -> DataFrame:
    """Stateless, so it applies to the batch table and to a stream of it."""
    user, number = F.col("user_id"), F.col("event_id")
    kind = (
        F.when(F.col("event_type") == "click", "PAYMENT")
        .when(F.col("event_type") == "purchase", "TRANSFER")
        .when(F.col("event_type") == "view", "CASH_OUT")
        .when(F.col("event_type") == "error", "DEBIT")
        .otherwise("CASH_IN")
    )
    fraud = (number % 97 == 0) | ((F.col("value") >= 150) & (number % 3 == 0))
    flag = (F.col("event_type") == "purchase") & (F.col("value") > 200)
    named = events_df.select(
        number.alias("seq"),
        F.expr(_EPOCH_MS).alias("ingestion_timestamp_ms"),
        kind.alias("type"),
        F.round(F.col("value") * 100, 2).alias("amount"),
        F.concat(F.lit("C"), user.cast("string")).alias("nameOrig"),
        F.concat(
            F.lit("M"), F.lpad((number % 4).cast("string"), 2, "0"), number.cast("string")
        ).alias("nameDest"),
        F.when(fraud, 1).otherwise(0).alias("isFraud"),
        F.when(flag, 1).otherwise(0).alias("isFlaggedFraud"),
    )
    step = F.expr("cast((ingestion_timestamp_ms - 1704067200000) div 3600000 + 1 as int)")
    return named.select(
        step.alias("step"), "type", "amount", "nameOrig",
        F.round(F.col("amount") * 2, 2).alias("oldbalanceOrg"),
        F.col("amount").alias("newbalanceOrig"),
        "nameDest",
        F.lit(0.0).alias("oldbalanceDest"),
        F.col("amount").alias("newbalanceDest"),
        "isFraud", "isFlaggedFraud", "ingestion_timestamp_ms", "seq",
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_transactions(events(spark, sf_dir))


def blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = events(spark, sf_dir).where("user_id % 25 in (0, 1)").select("user_id").distinct()
    return users.select(
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("card_id"),
        F.when(F.col("user_id") % 25 == 0, "1").otherwise("0").alias("is_active"),
    )


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = events(spark, sf_dir).where("user_id % 10 <> 9").select("user_id").distinct()
    user = F.col("user_id")
    return users.select(
        F.concat(F.lit("C"), user.cast("string")).alias("card_id"),
        F.lit("202401").alias("year_month"),
        (15000.0 + (user % 5) * 5000).alias("credit_limit"),
        (2000.0 + (user % 4) * 1000).alias("avg_amount"),
        F.concat(F.lit("M"), F.lpad((user % 4).cast("string"), 2, "0")).alias("last_city"),
    )


def scored(spark: SparkSession, sf_dir: str, cfg: RuleConfig = FIXTURE) -> DataFrame:
    return score(
        transactions(spark, sf_dir), blacklist(spark, sf_dir), profiles(spark, sf_dir), cfg
    )


def reviewed(fired_rows: DataFrame) -> DataFrame:
    """Review outcomes by event number; every fourth has none and gets the default."""
    outcome = (
        F.when(F.col("seq") % 4 == 1, "CONFIRMED_FRAUD")
        .when(F.col("seq") % 4 == 2, "FALSE_POSITIVE")
        .when(F.col("seq") % 4 == 3, "UNDER_REVIEW")
    )
    return fired_rows.withColumn("review_status", outcome)


def health_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, user, value = F.col("event_type"), F.col("user_id") % 3, F.col("value")
    recorded = F.date_trunc("hour", F.timestamp_micros(F.expr(_EPOCH_MS + " * 1000")))
    return events(spark, sf_dir).select(
        F.col("event_id").alias("metric_id"),
        recorded.alias("recorded_at"),
        F.date_format(recorded, "yyyyMMdd").cast("int").alias("date_key"),
        F.when(kind == "click", "KAFKA").when(kind == "purchase", "FLINK")
        .when(kind == "view", "HBASE").when(kind == "error", "HDFS")
        .otherwise("AIRFLOW").alias("component"),
        F.when(user == 0, "lag").when(user == 1, "latency").otherwise("throughput").alias("metric_name"),
        value.alias("metric_value"),
        F.when(user == 0, "count").when(user == 1, "ms").otherwise("pct").alias("unit"),
        F.when(value < 100, "OK").when(value < 200, "WARNING").otherwise("CRITICAL").alias("status"),
        F.col("props").alias("detail"),
    )


def job_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    at = F.timestamp_micros(F.expr(_EPOCH_MS.removesuffix(" div 1000")))
    state = (
        F.when(kind == "click", "RUNNING").when(kind == "purchase", "FINISHED")
        .when(kind == "view", "FAILED").when(kind == "error", "CANCELED")
    )
    return events(spark, sf_dir).select(
        "event_id", at.alias("event_ts"),
        F.concat(F.lit("run-"), F.date_format(at, "yyyyMMdd")).alias("dag_run_id"),
        F.lit("rules_guard").alias("task_id"),
        F.concat(F.lit("job-"), F.col("user_id").cast("string")).alias("job_id"),
        state.alias("job_state"),
    )


_STORED: dict[tuple[str, str], dict[str, str]] = {}


def mart(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The mart of a test folder, written once per application and read back.

    KPI queries read stored tables, as they would in production, and do not
    score all transactions again.
    """
    spark = prepare(spark)
    slot = (spark.sparkContext.applicationId, sf_dir)
    if slot not in _STORED:
        base = work_dir(spark, "mart")
        paths = {name: f"{base}/{name}" for name in (*_FACTS, "dim_date")}
        tx = transactions(spark, sf_dir)
        loaded = F.lit(AS_OF)
        fact = load_alert_fact(reviewed(fired(scored(spark, sf_dir))), loaded)
        write_fact(fact, paths["fraud_alerts"])
        alerts = read_fact(spark, paths["fraud_alerts"], schemas.FRAUD_ALERTS)
        write_fact(hourly_summary(tx, alerts, loaded), paths["transaction_summaries"])
        write_fact(health_metrics(spark, sf_dir), paths["pipeline_health_metrics"])
        write_fact(safe_mode_events(job_runs(spark, sf_dir)), paths["pipeline_events"])
        enrich(tx).write.parquet(paths["feed"])
        at = event_time(F.col("ingestion_timestamp_ms")).alias("at")
        dim_date_covering(tx.select(at), "at").write.parquet(paths["dim_date"])
        _STORED[slot] = paths
    paths = _STORED[slot]
    tables = {
        name: read_fact(spark, paths[name], schema)
        for name, schema in _FACTS.items() if schema is not None
    }
    tables["feed"] = spark.read.parquet(paths["feed"])
    tables["dim_date"] = spark.read.parquet(paths["dim_date"])
    tables["dim_rule"] = rule_seeds(spark)
    tables["dim_transaction_type"] = type_seeds(spark)
    return tables


_FACTS = {
    "fraud_alerts": schemas.FRAUD_ALERTS,
    "transaction_summaries": schemas.TRANSACTION_SUMMARIES,
    "pipeline_health_metrics": schemas.HEALTH_METRICS,
    "pipeline_events": schemas.PIPELINE_EVENTS,
    "feed": None,
}
