"""Alert shapes: published payload, keyed alert rows, mart fact rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudloom.functions import keys, parsing, times


def _payload() -> list[Column]:
    return [
        F.col("nameOrig").alias("card_id"),
        F.col("amount"),
        F.col("type"),
        F.col("rules_triggered"),
        F.col("risk_score"),
        F.col("isFraud").alias("is_fraud_label"),
        F.col("ingestion_timestamp_ms").alias("alert_ts_ms"),
    ]


def alert_payload(fired: DataFrame) -> DataFrame:
    """What is published for one alert."""
    return fired.select(*_payload())


def as_json(df: DataFrame) -> DataFrame:
    """One JSON text per row, column ``value``."""
    return df.select(parsing.json_text().alias("value"))


def alert_messages(fired: DataFrame) -> DataFrame:
    """Alerts as topic messages: ``key`` is the alert's id, equal whenever the same alert is sent again."""
    row_key = keys.alert_key(F.col("nameOrig"), F.col("ingestion_timestamp_ms"))
    return fired.select(
        F.encode(F.concat_ws("_", row_key, F.col("seq").cast("string")), "UTF-8").alias("key"),
        F.to_json(F.struct(*_payload())).alias("value"))


def upsert_alerts(fired: DataFrame) -> DataFrame:
    """Keyed alert rows; of several alerts of a card in one millisecond the last arrival stays.

    An alert without arrival number counts as the earliest. The row-number filter
    cuts each task down to one row per key before the exchange.
    """
    alerts = fired.select(
        parsing.rule_text(F.col("rules_triggered")).alias("rules"), "risk_score",
        F.col("ingestion_timestamp_ms").alias("ts"), "nameOrig", "amount", "type", "nameDest", "seq",
    )
    last = Window.partitionBy("nameOrig", "ts").orderBy(
        F.desc_nulls_last("seq"), *map(F.desc_nulls_last, ("risk_score", "rules", "amount", "type", "nameDest")))
    return alerts.withColumn("back", F.row_number().over(last)).where("back = 1").select(
        keys.alert_key(F.col("nameOrig"), F.col("ts")).alias("row_key"),
        "rules", "risk_score", "ts", "nameOrig", "amount", "type", "nameDest",
    )


def alert_history(alerts: DataFrame, cards: DataFrame) -> DataFrame:
    """Alerts of the given cards (``card_id``), newest first within a card: row-key order."""
    wanted = cards.select(F.col("card_id").alias("nameOrig")).distinct()
    return alerts.join(wanted, "nameOrig", "left_semi").orderBy("row_key")


def load_alert_fact(fired: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Fact rows for the mart, defaults filled in.

    ``seq`` numbers events uniquely and becomes the surrogate key, which makes a
    repeated load produce the same rows. ``review_status``, ``reviewed_by`` and
    ``reviewed_at`` are taken over where the input has them.
    """
    alert_ts = times.event_time(F.col("ingestion_timestamp_ms"))

    def given(name: str, data_type: str) -> Column:
        value = F.col(name) if name in fired.columns else F.lit(None)
        return value.cast(data_type)

    return fired.select(
        F.col("seq").alias("alert_id"),
        alert_ts.alias("alert_ts"),
        times.date_key(alert_ts).alias("date_key"),
        F.col("nameOrig").alias("card_id"),
        F.col("nameDest").alias("dest_id"),
        F.col("type").alias("transaction_type"),
        F.col("amount").try_cast("decimal(18,2)").alias("amount"),
        parsing.rule_text(F.col("rules_triggered")).alias("rules_triggered"),
        F.col("risk_score").cast("decimal(5,4)").alias("risk_score"),
        F.coalesce("isFraud", F.lit(0)).cast("tinyint").alias("is_fraud_label"),
        F.coalesce("isFlaggedFraud", F.lit(0)).cast("tinyint").alias("is_flagged_fraud"),
        F.coalesce(given("review_status", "string"), F.lit("PENDING")).alias("review_status"),
        given("reviewed_by", "string").alias("reviewed_by"),
        given("reviewed_at", "timestamp").alias("reviewed_at"),
        (F.current_timestamp() if loaded_at is None else loaded_at).alias("created_at"),
    )
