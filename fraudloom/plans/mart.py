"""Star schema: dimensions, facts, views, integrity checks, storage."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fraudloom import config
from fraudloom.functions import times


# ---- dimensions ---------------------------------------------------------------
def dim_date(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per calendar day from ``first`` to ``last``."""
    bounds = spark.range(1).select(F.lit(first).alias("first_day"), F.lit(last).alias("last_day"))
    return calendar(bounds)


def dim_date_covering(facts: DataFrame, column: str) -> DataFrame:
    """One row per calendar day from the oldest to the newest time stamp of ``facts``."""
    return calendar(facts.agg(
        F.to_date(F.min(column)).alias("first_day"), F.to_date(F.max(column)).alias("last_day")
    ))


def calendar(bounds: DataFrame) -> DataFrame:
    """Date attributes for each day between ``first_day`` and ``last_day``; Monday is day 1."""
    day = F.col("full_date")
    days = bounds.select(
        F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("full_date")
    )
    weekday = F.weekday(day) + 1
    return days.select(
        times.date_key(day).alias("date_key"),
        "full_date",
        F.year(day).cast("smallint").alias("year"),
        F.quarter(day).cast("tinyint").alias("quarter"),
        F.month(day).cast("tinyint").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).cast("tinyint").alias("week_of_year"),
        F.dayofmonth(day).cast("tinyint").alias("day_of_month"),
        weekday.cast("tinyint").alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.when(weekday >= 6, 1).otherwise(0).cast("tinyint").alias("is_weekend"),
    )


def type_seeds(spark: SparkSession) -> DataFrame:
    rows = [(i, name, text) for i, (name, text) in enumerate(config.TYPE_SEEDS, 1)]
    return spark.createDataFrame(rows, "type_id tinyint, type_name string, description string")


def rule_seeds(spark: SparkSession) -> DataFrame:
    rows = [
        (i, code, name, text, severity)
        for i, (code, name, severity, text) in enumerate(config.RULE_SEEDS, 1)
    ]
    return spark.createDataFrame(
        rows,
        "rule_id tinyint, rule_code string, rule_name string, description string, severity string",
    )


def insert_ignore(existing: DataFrame, rows: DataFrame, unique: str) -> DataFrame:
    """``existing`` plus those rows whose unique value it does not hold yet."""
    new = rows.join(existing.select(unique), unique, "left_anti").select(*existing.columns)
    return existing.unionByName(new)


# ---- facts ----------------------------------------------------------------------
def hourly_summary(
    tx: DataFrame, alerts: DataFrame, created_at: Column | None = None
) -> DataFrame:
    """Rollup per hour and transaction type.

    Both sides are aggregated with map-side combine before they are joined; the
    join sees one row per hour and type. (hour, type) determines the key, so a
    repeated run replaces rows instead of adding some.
    """
    amount = F.col("amount").try_cast("decimal(18,2)")
    fraud = F.col("isFraud") == 1
    hour = F.date_trunc("hour", times.event_time(F.col("ingestion_timestamp_ms")))
    traffic = tx.groupBy(hour.alias("summary_hour"), F.col("type").alias("transaction_type")).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum(amount).cast("decimal(22,2)").alias("total_amount"),
        F.max(amount).alias("max_amount"),
        F.count_if(fraud).cast("int").alias("fraud_count"),
        F.coalesce(F.sum(F.when(fraud, amount)), F.lit(0)).cast("decimal(18,2)").alias("fraud_amount"),
    )
    raised = alerts.groupBy(
        F.date_trunc("hour", "alert_ts").alias("summary_hour"), "transaction_type"
    ).agg(F.count(F.lit(1)).cast("int").alias("alerts_generated"))
    joined = traffic.join(raised, ["summary_hour", "transaction_type"], "left")
    return finish_summary(joined, created_at)


def finish_summary(rollup: DataFrame, created_at: Column | None = None) -> DataFrame:
    """Keys, averages, rates and defaults of summary rows; shared with the stream."""
    type_number = F.array_position(
        F.array(*[F.lit(t) for t in config.TRANSACTION_TYPES]), F.col("transaction_type")
    )
    hours = F.expr("unix_seconds(summary_hour) div 3600")
    rate = 100 * F.col("fraud_count") / F.nullif(F.col("total_transactions"), F.lit(0))
    return rollup.select(
        (hours * 10 + type_number).alias("summary_id"),
        "summary_hour",
        times.date_key(F.col("summary_hour")).alias("date_key"),
        "transaction_type",
        "total_transactions",
        "total_amount",
        (F.col("total_amount") / F.col("total_transactions")).cast("decimal(18,2)").alias("avg_amount"),
        "max_amount",
        "fraud_count",
        "fraud_amount",
        F.coalesce(rate, F.lit(0.0)).cast("decimal(8,4)").alias("fraud_rate_pct"),
        F.coalesce("alerts_generated", F.lit(0)).alias("alerts_generated"),
        (F.current_timestamp() if created_at is None else created_at).alias("created_at"),
    )


# ---- views ----------------------------------------------------------------------
def fraud_alert_detail(alerts: DataFrame, dates: DataFrame) -> DataFrame:
    """Alerts with calendar attributes. Spark broadcasts the calendar if its size allows."""
    return alerts.join(dates, "date_key").select(
        "alert_id", "alert_ts", "full_date", "year", "month", "month_name", "day_of_week",
        "day_name", "is_weekend", "card_id", "dest_id", "transaction_type", "amount",
        "rules_triggered", "risk_score", "is_fraud_label", "is_flagged_fraud", "review_status",
    )


def hourly_fraud_rate(summaries: DataFrame) -> DataFrame:
    return summaries.select(
        "summary_hour", "transaction_type", "total_transactions", "fraud_count",
        "fraud_rate_pct", "total_amount", "fraud_amount", "alerts_generated",
    ).orderBy(F.desc("summary_hour"))


def latest_health(metrics: DataFrame) -> DataFrame:
    """Newest row per component and metric; rows that share the newest time all stay.

    ``rank() = 1`` is applied per task before the exchange, which leaves a hot
    component with a handful of rows per task.
    """
    newest = Window.partitionBy("component", "metric_name").orderBy(F.desc("recorded_at"))
    return (
        metrics.withColumn("_rank", F.rank().over(newest))
        .where("_rank = 1")
        .select(
            "component", "metric_name", "metric_value", "unit", "status", "recorded_at", "detail"
        )
    )


def newest_in_group(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the largest ``order`` of each group; each task is cut down to one row a group before the exchange."""
    newest = Window.partitionBy(*keys).orderBy(*map(F.desc_nulls_last, order))
    return df.withColumn("_back", F.row_number().over(newest)).where("_back = 1").drop("_back")


def register_views(tables: dict[str, DataFrame]) -> None:
    """Tables and views under the names that SQL users query."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    fraud_alert_detail(tables["fraud_alerts"], tables["dim_date"]).createOrReplaceTempView(
        "vw_fraud_alert_detail"
    )
    hourly_fraud_rate(tables["transaction_summaries"]).createOrReplaceTempView(
        "vw_hourly_fraud_rate"
    )
    latest_health(tables["pipeline_health_metrics"]).createOrReplaceTempView(
        "vw_pipeline_health_latest"
    )


# ---- integrity ------------------------------------------------------------------
def date_orphans(facts: DataFrame, dates: DataFrame) -> DataFrame:
    """Fact rows whose date_key has no row in the date dimension."""
    return facts.join(dates.select("date_key"), "date_key", "left_anti")


# ---- storage --------------------------------------------------------------------
def write_fact(fact: DataFrame, path: str) -> None:
    """Parquet in one folder per day; only the days that ``fact`` contains are replaced.

    The rebalance hint gathers a day's rows into few files and splits a day that
    is too large for one task. Loading a day again replaces it.
    """
    (
        fact.hint("rebalance", "date_key")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("date_key").parquet(path)
    )


def read_fact(spark: SparkSession, path: str, schema) -> DataFrame:
    """A stored fact in its declared column order; date_key comes from the folder."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def since(df: DataFrame, column: str, as_of: datetime, interval: str) -> DataFrame:
    """Rows not older than ``interval`` before ``as_of``.

    Stated as a range on the column, which reaches the Parquet statistics, and
    on date_key, which prunes folders.
    """
    start = F.lit(as_of) - F.expr(f"INTERVAL {interval}")
    recent = F.col(column) >= start
    if "date_key" in df.columns:
        recent = recent & (F.col("date_key") >= times.date_key(start))
    return df.where(recent)


def on_day(df: DataFrame, column: str, as_of: datetime) -> DataFrame:
    """Rows of the calendar day of ``as_of``."""
    day = F.date_trunc("day", F.lit(as_of))
    same = (F.col(column) >= day) & (F.col(column) < day + F.expr("INTERVAL 1 DAY"))
    if "date_key" in df.columns:
        same = same & (F.col("date_key") == times.date_key(F.lit(as_of)))
    return df.where(same)
