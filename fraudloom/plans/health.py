"""Pipeline health: consumer lag, topic verdict, component status, safe mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudloom import config
from fraudloom.functions import times


def consumer_lag(offsets: DataFrame, threshold: int = config.LAG_THRESHOLD) -> DataFrame:
    """Lag per topic. A negative committed offset means none: counting starts at the low mark.

    A lag above the threshold is a warning and does not make a topic unhealthy.
    """
    position = F.when(F.col("committed") >= 0, F.col("committed")).otherwise(F.col("low"))
    lag = F.greatest(F.lit(0), F.col("high") - position)
    return (
        offsets.groupBy("topic")
        .agg(F.coalesce(F.sum(lag), F.lit(0)).alias("total_lag"))
        .withColumn("over_threshold", F.col("total_lag") > threshold)
    )


def topic_health(topics: DataFrame, partitions: DataFrame) -> DataFrame:
    """One verdict per expected topic, from (topic, partition, leader) rows; leader -1 is none.

    A partition-less topic is a row with a null partition.
    """
    per_topic = partitions.groupBy("topic").agg(
        F.count("partition").alias("partition_count"),
        F.array_sort(F.collect_set(F.when(F.col("leader") == -1, F.col("partition")))).alias("leaderless"),
    )
    leaderless = F.concat(
        F.lit("Partitions without leader: ["), F.array_join(F.col("leaderless").cast("array<string>"), ", "),
        F.lit("]"),
    )
    reason = (
        F.when(F.col("partition_count").isNull(), F.concat(F.lit("Topic '"), "topic", F.lit("' does not exist")))
        .when(F.col("partition_count") == 0, F.concat(F.lit("Topic '"), "topic", F.lit("' has no partitions")))
        .when(F.size("leaderless") > 0, leaderless)
        .otherwise("OK")
    )
    return topics.select("topic").join(per_topic, "topic", "left").select(
        "topic",
        (reason == "OK").alias("healthy"),
        reason.alias("reason"),
        F.coalesce("partition_count", F.lit(0)).alias("partition_count"),
    )


def health_rows(probes: DataFrame) -> DataFrame:
    """Dashboard rows from (probe_ts, component, latency_ms); no latency means down."""
    latency = F.col("latency_ms")
    return probes.select(
        F.date_format("probe_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("Time"),
        F.col("component").alias("System_Component"),
        F.when(latency.isNull(), "Down").otherwise("Healthy").alias("Component_Status"),
        F.coalesce(F.round(latency, 1), F.lit(-1.0)).alias("Latency_ms"),
    )


def latest_status(rows: DataFrame) -> DataFrame:
    """The newest row of each component; each task is cut down to one row a component before the exchange."""
    last = Window.partitionBy("System_Component").orderBy(*map(
        F.desc_nulls_last, ("Time", "Component_Status", "Latency_ms")))
    return rows.withColumn("_back", F.row_number().over(last)).where("_back = 1").select(
        "System_Component", "Time", "Component_Status", "Latency_ms")


def safe_mode(job_state: Column) -> Column:
    """True unless the scoring job runs or has finished."""
    return ~F.coalesce(job_state.isin(*config.HEALTHY_JOB_STATES), F.lit(False))


def apply_safe_mode(scored: DataFrame, active: Column) -> DataFrame:
    """Adds ``decision``: automatic approval, block, or manual review of everything in safe mode."""
    decision = (
        F.when(active, "MANUAL_REVIEW").when(F.col("flagged"), "BLOCK").otherwise("APPROVE")
    )
    return scored.withColumn("decision", decision)


def safe_mode_events(runs: DataFrame) -> DataFrame:
    """Audit rows for runs (event_id, event_ts, dag_run_id, task_id, job_id, job_state) in safe mode."""
    return runs.where(safe_mode(F.col("job_state"))).select(
        "event_id",
        "event_ts",
        times.date_key(F.col("event_ts")).alias("date_key"),
        F.lit("SAFE_MODE").alias("event_type"),
        F.lit("FLINK").alias("component"),
        F.lit("CRITICAL").alias("severity"),
        "dag_run_id",
        "task_id",
        F.concat(
            F.lit("Job "), "job_id", F.lit(" status="), F.coalesce("job_state", F.lit("UNKNOWN"))
        ).alias("message"),
    )
