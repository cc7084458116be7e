"""The streaming jobs: scoring, rollups, dashboard feed."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from fraudloom.config import RuleConfig
from fraudloom.functions import times
from fraudloom.operators.alerts import alert_messages, load_alert_fact, upsert_alerts
from fraudloom.operators.profiles import batch_activity
from fraudloom.operators.reference import card_reference, month_fields
from fraudloom.operators.rules import evaluate
from fraudloom.plans.dashboard import enrich, push_payloads
from fraudloom.plans.mart import finish_summary, write_fact
from fraudloom.plans.scoring import fired
from fraudloom.sources.profilestore import ProfileStore
from fraudloom.sources.versions import Folder
from fraudloom.streaming.features import STATE, batch_features, living_state, newest_state, next_state
from fraudloom.streaming.sinks import (
    PAUSES, batch_path, deliver, finished_batches, forget_batches, latest_by_key, merge_batches, newest_rows,
    read_batches, write_batch,
)

# ---- fixed values: checkpoint pacing and lateness -------------------------------
TRIGGER = "30 seconds"
LATENESS = "10 seconds"
DELAY_MS = 10_000
FAN_IN = 8  # merged folders of a growing table that become one

# Gets the cards and months of a batch (card_id, year_month), returns rows to look up in.
Snapshot = Callable[[DataFrame], DataFrame]
Publish = Callable[[DataFrame, int], None]


def with_event_time(tx: DataFrame, lateness: str = LATENESS) -> DataFrame:
    return tx.withColumn(
        "event_time", times.event_time(F.col("ingestion_timestamp_ms"))
    ).withWatermark("event_time", lateness)


def _at_once(write: Callable[[str], object], tables: Iterable[str]) -> None:
    """Write tables that do not depend on each other: small jobs that leave most of a cluster idle one by one."""
    names = list(tables)
    with ThreadPoolExecutor(len(names)) as pool:
        list(pool.map(write, names))


# ---- scoring ----------------------------------------------------------------------
def score_batch(
    spark: SparkSession, arrived: DataFrame, batch_id: int, base: str,
    blacklist: Snapshot, profiles: Snapshot, cfg: RuleConfig, publish: Publish | None = None,
) -> None:
    """One micro-batch: transactions in; scored rows, alerts, profile activity and the cards' new tails out.

    ``publish`` takes the alert messages of the batch (key, value) and its number,
    for instance to ``topics.send`` them. A replayed batch is published again, with
    the same keys: ``topics.read_alerts`` drops them. Without it they go to a batch
    table, which a replay overwrites.

    The transactions are written before anything reads them: the source is read
    once, what follows survives the loss of executors, and Spark knows the size of
    the batch, from which it decides whether the batch's keys can be broadcast. A
    batch reads the tails that earlier batches wrote, so a replay sees what the
    first try saw.
    """
    def stored(df: DataFrame, table: str) -> DataFrame:
        return spark.read.schema(df.schema).parquet(write_batch(df, base, table, batch_id))

    tx = stored(arrived, "arrived")
    cards = tx.select("nameOrig").distinct()
    months = tx.select(
        F.col("nameOrig").alias("card_id"), times.year_month(F.col("ingestion_timestamp_ms")).alias("year_month")).distinct()
    tails = read_batches(spark, base, "tails", before=batch_id, schema=STATE)
    # Stored, as five places read it: windows, lookups by card and the new tails.
    state = stored(newest_state(tails.join(cards, "nameOrig", "left_semi")).drop("batch_id"), "state")
    listed = blacklist(months).join(cards.withColumnRenamed("nameOrig", "card_id"), "card_id", "left_semi")
    known = profiles(months).join(months, ["card_id", "year_month"], "left_semi")

    # Fewer rows than make a hot card: none is looked for (a count of the files' footers).
    hot_cards = tx.count() > cfg.hot_card_rows
    featured = batch_features(tx, state, cfg, DELAY_MS, card_reference(listed, known), month_fields, hot_cards)
    scored = stored(evaluate(featured, cfg), "scored")
    alerts = fired(scored)
    outputs = {"tails": next_state(tx, state, cfg), "alerts": upsert_alerts(alerts), "activity": batch_activity(scored)}
    if publish is None:
        outputs["alert_topic"] = alert_messages(alerts)
    _at_once(lambda table: write_batch(outputs[table], base, table, batch_id), outputs)
    if publish is not None:
        # Last, so that a batch that fails before has published nothing.
        publish(alert_messages(alerts), batch_id)
    forget_batches(spark, base, "state", batch_id)
    # The batch before is committed: its copy of the source is not needed any more.
    forget_batches(spark, base, "arrived", batch_id - 1)


def score_stream(
    spark: SparkSession, tx: DataFrame, base: str,
    blacklist: Snapshot, profiles: Snapshot, cfg: RuleConfig = RuleConfig(),
    publish: Publish | None = None,
) -> DataStreamWriter:
    """Writer of the scoring job; its checkpoint lives below ``base``.

    Snapshots are callables: they are asked anew in every batch, so a changed
    blacklist takes effect with the next batch, and ``ProfileStore.lookup`` opens
    only what the batch needs.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        score_batch(spark, batch, batch_id, base, blacklist, profiles, cfg, publish)

    return (
        tx.writeStream.foreachBatch(run)
        .option("checkpointLocation", f"{base.rstrip('/')}/checkpoint")
        .outputMode("append").trigger(processingTime=TRIGGER)
    )


def compact(spark: SparkSession, base: str, idle_days: int = 20) -> None:
    """Merge the scoring job's batch folders; may run beside the job, at whatever interval suits.

    Tails are cut down to the newest of each card, and cards that have been idle
    for ``idle_days`` of event time are dropped: that table does not grow with time.
    Alerts and scored rows do and are merged level by level.
    """
    merges = {
        "tails": lambda: merge_batches(
            spark, base, "tails", lambda rows: living_state(rows, idle_days), schema=STATE),
        "alerts": lambda: merge_batches(
            spark, base, "alerts", lambda rows: newest_rows(rows, ["row_key"]), fan_in=FAN_IN),
        "scored": lambda: merge_batches(spark, base, "scored", fan_in=FAN_IN),
    }
    _at_once(lambda table: merges[table](), merges)


def stored_alerts(spark: SparkSession, base: str) -> DataFrame:
    """Keyed alert rows of all batches."""
    return latest_by_key(read_batches(spark, base, "alerts"), ["row_key"])


def load_alerts(
    spark: SparkSession, base: str, path: str,
    since: datetime | None = None, until: datetime | None = None, loaded_at: Column | None = None,
) -> None:
    """Mart facts of what the scoring job stored, one row per alert.

    ``since`` and ``until`` (exclusive) are days: days within are replaced by all
    their alerts, so a load can be repeated. They bound the time stamps that are
    read from the batch files.
    """
    scored = read_batches(spark, base, "scored")
    for day, late in ((since, False), (until, True)):
        if day is not None:
            edge, ts = int(day.timestamp() * 1000), F.col("ingestion_timestamp_ms")
            scored = scored.where(ts < edge if late else ts >= edge)
    write_fact(load_alert_fact(fired(scored), loaded_at), path)


def write_back_profiles(spark: SparkSession, base: str, store: ProfileStore, averages: bool = False) -> None:
    """A new profile version with all activity the store does not hold yet, but for the batch that may still be replayed.

    Only months and buckets with activity are copied. What is merged is deleted
    one write-back later.
    """
    done, held = finished_batches(spark, base, "activity"), store.upto()
    upto = max((b for b in done[:-1] if b > held), default=None)
    if upto is not None:
        activity = read_batches(spark, base, "activity", after=held, before=upto + 1)
        store.write_back(activity, upto, averages)
        forget_batches(spark, base, "activity", held)


def close_profiles(spark: SparkSession, base: str, store: ProfileStore, averages: bool = False) -> None:
    """The same with the newest batch, for a job that has ended."""
    done, held = finished_batches(spark, base, "activity"), store.upto()
    if done and done[-1] > held:
        store.write_back(read_batches(spark, base, "activity", after=held), done[-1], averages)


# ---- rollups ----------------------------------------------------------------------
def hourly_rollup(tx: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Streaming counterpart of the hourly summary, without alert counts.

    State is one row per open hour and type. In append mode an hour appears when
    the watermark closes it; in update mode it appears at once and is replaced
    by key.
    """
    amount = F.col("amount").try_cast("decimal(18,2)")
    fraud = F.col("isFraud") == 1
    return (
        with_event_time(tx, lateness)
        .groupBy(F.window("event_time", "1 hour"), F.col("type").alias("transaction_type"))
        .agg(
            F.count(F.lit(1)).alias("total_transactions"),
            F.sum(amount).cast("decimal(22,2)").alias("total_amount"),
            F.max(amount).alias("max_amount"),
            F.count_if(fraud).cast("int").alias("fraud_count"),
            F.coalesce(F.sum(F.when(fraud, amount)), F.lit(0)).cast("decimal(18,2)").alias("fraud_amount"),
        )
        .withColumn("summary_hour", F.col("window.start"))
        .drop("window")
    )


def minute_throughput(tx: DataFrame, width: str = "1 minute", lateness: str = LATENESS) -> DataFrame:
    return (
        with_event_time(tx, lateness)
        .groupBy(F.window("event_time", width))
        .agg(
            F.count(F.lit(1)).alias("total_transactions"),
            F.count_if(F.col("isFraud") == 1).alias("fraud_transactions"),
        )
        .select(F.col("window.start").alias("bucket"), "total_transactions", "fraud_transactions")
    )


def upsert_stream(rollup: DataFrame, base: str, table: str) -> DataStreamWriter:
    """Keep a streaming aggregate as an upsert table: changed rows per batch."""
    def run(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, base, table, batch_id)

    return (
        rollup.writeStream.foreachBatch(run)
        .option("checkpointLocation", f"{base.rstrip('/')}/{table}_checkpoint")
        .outputMode("update").trigger(processingTime=TRIGGER)
    )


def compact_upserts(spark: SparkSession, base: str, table: str, keys: list[str]) -> bool:
    """Merge the batch folders of an upsert table, the last write of each key."""
    return merge_batches(spark, base, table, lambda rows: newest_rows(rows, keys))


def stored_summaries(
    spark: SparkSession, base: str, table: str, alerts: DataFrame | None = None
) -> DataFrame:
    """Summary rows out of the upsert table of ``hourly_rollup``."""
    keys = ["summary_hour", "transaction_type"]
    rollup = latest_by_key(read_batches(spark, base, table), keys)
    if alerts is None:
        return finish_summary(rollup.withColumn("alerts_generated", F.lit(0)))
    raised = alerts.groupBy(
        F.date_trunc("hour", "alert_ts").alias("summary_hour"), "transaction_type"
    ).agg(F.count(F.lit(1)).cast("int").alias("alerts_generated"))
    return finish_summary(rollup.join(raised, keys, "left"))


# ---- dashboard ----------------------------------------------------------------------
def dashboard_stream(
    tx: DataFrame, base: str, send: Callable[[str], int], pauses: tuple[float, ...] = PAUSES
) -> DataStreamWriter:
    """Enrich, pack and push; outcomes are stored, refused payloads are not sent again.

    At most once: payloads are fixed in a table before the first goes out, and a
    replayed batch or task sends none that an earlier try had claimed.
    """
    spark = tx.sparkSession

    def run(batch: DataFrame, batch_id: int) -> None:
        if batch_id not in finished_batches(spark, base, "payloads"):
            write_batch(push_payloads(enrich(batch)), base, "payloads", batch_id)
        payloads = spark.read.parquet(batch_path(base, "payloads", batch_id))
        outcome = deliver(payloads, send, pauses, claims=f"{base.rstrip('/')}/claims/batch_id={batch_id}")
        write_batch(outcome, base, "delivery", batch_id)
        forget_batches(spark, base, "payloads", batch_id - 1)
        Folder(spark, f"{base.rstrip('/')}/claims").delete(f"batch_id={batch_id - 1}")

    return (
        tx.writeStream.foreachBatch(run)
        .option("checkpointLocation", f"{base.rstrip('/')}/delivery_checkpoint")
        .outputMode("append").trigger(processingTime="1 second")
    )
