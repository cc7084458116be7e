"""Event topics: reading, writing, and the message envelope.

Format and payload codec are settings. ``kafka`` and ``avro`` need the Spark
packages of the same name on the class path; ``parquet``/``json`` folders and
the JSON codec need nothing and carry the same columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from fraudloom import schemas
from fraudloom.functions.parsing import from_json_text

# ---- fixed values: message envelope and producer settings ---------------------
MAGIC_BYTE = b"\x00"
HEADER_BYTES = 5  # magic byte and a 4-byte schema id
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.enable.idempotence": "true",
    "kafka.compression.type": "lz4",
    "kafka.linger.ms": "10",
    "kafka.batch.size": "102400",
}


def encode_payload(codec: str) -> Column:
    """All transaction columns as one binary payload."""
    record = F.struct(*schemas.TRANSACTION.names)
    if codec == "avro":
        from pyspark.sql.avro.functions import to_avro
        return to_avro(record, schemas.TRANSACTION_AVRO)
    return F.encode(F.to_json(record), "UTF-8")


def decode_payload(payload: Column, codec: str) -> Column:
    """The transaction struct; its fields are null where the payload cannot be read."""
    if codec == "avro":
        from pyspark.sql.avro.functions import from_avro
        return from_avro(payload, schemas.TRANSACTION_AVRO, {"mode": "PERMISSIVE"})
    return from_json_text(F.decode(payload, "UTF-8"), schemas.TRANSACTION)


def _complete(tx: Column) -> Column:
    """Every field is required."""
    present = tx.isNotNull()
    for name in schemas.TRANSACTION.names:
        present = present & tx.getField(name).isNotNull()
    return present


def publishable(tx: DataFrame, schema_id: int = 1, codec: str = "json") -> DataFrame:
    """Messages keyed by card, so that one card's events stay in one partition, in order."""
    header = F.lit(MAGIC_BYTE + schema_id.to_bytes(HEADER_BYTES - 1, "big"))
    extra = [c for c in tx.columns if c not in schemas.TRANSACTION.names]
    return tx.select(
        F.encode("nameOrig", "UTF-8").alias("key"),
        F.concat(header, encode_payload(codec)).alias("value"),
        *extra,
    )


def evenly(tx: DataFrame) -> DataFrame:
    """Rows of a finite set dealt evenly to tasks ahead of ``publishable``.

    A source of few or uneven files would otherwise be encoded by few tasks, and
    would leave uneven files, which the readers of a folder cannot cut.
    """
    return tx.hint("rebalance")


def decode_messages(messages: DataFrame, codec: str = "json") -> DataFrame:
    """``messages`` plus ``tx``: null for a short, foreign or unreadable value.

    The payload is parsed inside a generator. Written as a plain column it would
    be copied into every later filter and field access, and parsed once for each.
    """
    value = F.col("value")
    framed = (F.length(value) > HEADER_BYTES) & (F.substring(value, 1, 1) == F.lit(MAGIC_BYTE))
    payload = F.when(framed, F.substring(value, HEADER_BYTES + 1, 2_147_483_647))
    parsed = F.filter(F.array(decode_payload(payload, codec)), _complete)
    return messages.select("*", F.explode_outer(parsed).alias("tx"))


def readable(decoded: DataFrame) -> DataFrame:
    """Transaction columns of all readable messages, other message columns kept."""
    extra = [c for c in decoded.columns if c not in ("key", "value", "tx")]
    return decoded.where(F.col("tx").isNotNull()).select("tx.*", *extra)


def event_number(partition: Column, offset: Column) -> Column:
    """One number for a message: offsets repeat between partitions, this does not.

    It rises with the offset, which orders the events of a card: they share one
    partition. There is room for 32,768 partitions of 2^48 messages.
    """
    return F.shiftleft(partition.cast("bigint"), 48) + offset.cast("bigint")


def read_topic(
    spark: SparkSession, path_or_topic: str, start: str = "latest",
    fmt: str = "parquet", servers: str | None = None, schema=None, **options: str,
) -> DataFrame:
    """A stream of messages (key, value, and ``seq`` as arrival order).

    ``start`` is ``latest`` for scoring and dashboard, ``earliest`` for the
    archive. A folder stream always begins with what the folder holds. Progress
    is kept in the query's checkpoint and only advances after the sink commits.
    """
    if fmt == "kafka":
        raw = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", path_or_topic)
            .option("startingOffsets", start)
            .options(**options).load()
        )
        return raw.select("key", "value", event_number(F.col("partition"), F.col("offset")).alias("seq"))
    schema = schema or "key binary, value binary, seq bigint"
    return spark.readStream.schema(schema).options(**options).format(fmt).load(path_or_topic)


def read_alerts(messages: DataFrame, within: str = "1 hour") -> DataFrame:
    """Alerts of a stream of alert messages, each once: a message sent again has the key of the first.

    Spark forgets a key when the watermark is ``within`` beyond its event time, so
    that is how late a repetition may come.
    """
    alert = from_json_text(F.col("value").cast("string"), schemas.ALERT)
    return (
        messages.select(F.decode("key", "UTF-8").alias("alert_id"), alert.alias("alert"))
        .select("alert_id", "alert.*")
        .withColumn("alert_ts", F.timestamp_millis("alert_ts_ms")).withWatermark("alert_ts", within)
        .dropDuplicatesWithinWatermark(["alert_id"])
    )


def send(
    messages: DataFrame, path_or_topic: str, fmt: str = "parquet", servers: str | None = None,
) -> None:
    """Append a finite set of messages, such as a load or a micro-batch of alerts."""
    if fmt == "kafka":
        (
            messages.select(*[c for c in ("key", "value") if c in messages.columns])
            .write.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", path_or_topic).options(**PRODUCER_OPTIONS).save()
        )
    else:
        messages.write.mode("append").format(fmt).save(path_or_topic)


def write_topic(
    messages: DataFrame, path_or_topic: str, checkpoint: str,
    fmt: str = "parquet", servers: str | None = None,
) -> DataStreamWriter:
    """A writer for (key, value) or JSON ``value`` messages; the caller sets trigger and starts it."""
    writer = messages.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    if fmt == "kafka":
        return (
            writer.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", path_or_topic).options(**PRODUCER_OPTIONS)
        )
    return writer.format(fmt).option("path", path_or_topic)
