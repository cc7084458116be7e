"""The hour-partitioned transaction archive.

Folders are named by the hour of the event. ``partition_time="ingest"`` names
them by the hour of writing instead, which is where a plain append log would
put late events.
"""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from fraudloom import schemas
from fraudloom.functions import times

PARTS = ("year", "month", "day", "hour")
LOAD = "load"  # folder of one load inside an hour


def with_hour_parts(tx: DataFrame, partition_time: str = "event") -> DataFrame:
    moment: Column = (
        times.event_time(F.col("ingestion_timestamp_ms"))
        if partition_time == "event" else F.current_timestamp()
    )
    return tx.withColumns(times.hour_parts(moment))


def archive(
    tx: DataFrame, base: str, fmt: str = "parquet", partition_time: str = "event", load: str | None = None,
) -> None:
    """Append one load. The rebalance hint sizes files by bytes: a small hour gets one, a crowded one as many as it needs.

    Inside its hours a load has folders of its own, named ``load`` (a new name if
    none is given). The same load written again replaces them and nothing else.
    """
    (
        with_hour_parts(tx, partition_time).withColumn(LOAD, F.lit(load or uuid.uuid4().hex))
        .hint("rebalance", *PARTS)
        .write.mode("overwrite").partitionBy(*PARTS, LOAD).option("compression", "snappy")
        .option("partitionOverwriteMode", "dynamic").format(fmt).save(base)
    )


def archive_stream(
    tx: DataFrame, base: str, checkpoint: str, fmt: str = "parquet", partition_time: str = "event",
) -> DataStreamWriter:
    """Streaming append, once a minute, each micro-batch as one load: a batch that is replayed replaces itself.

    With ``partition_time="ingest"`` a replay may fall into the next hour and then
    leaves both; event hours do not move.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        archive(batch, base, fmt, partition_time, load=f"batch-{batch_id}")

    return (
        tx.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(processingTime="60 seconds")
    )


def replay(
    spark: SparkSession, base: str, start: datetime | None = None, end: datetime | None = None,
    fmt: str = "parquet", partition_time: str = "event",
) -> DataFrame:
    """Archived transactions of [start, end). Folders outside the range are not listed as input.

    Folder values are text. The hour text built from them compares like time, so
    the range becomes a partition filter; the exact bound is on the event itself.
    Folders of ingest time (``partition_time="ingest"``) hold events of that hour
    or earlier ones, so there only the lower bound prunes.
    """
    folders = ", ".join(f"{p} string" for p in (*PARTS, LOAD))
    schema = schemas.SEQUENCED.simpleString()[len("struct<"):-1].replace(":", " ")
    df = spark.read.schema(f"{schema}, {folders}").format(fmt).load(base)
    hour = F.concat("year", "month", "day", "hour")
    stamp = F.col("ingestion_timestamp_ms")
    if start is not None:
        df = df.where(hour >= start.astimezone(UTC).strftime("%Y%m%d%H")).where(stamp >= int(start.timestamp() * 1000))
    if end is not None:
        df = df.where(stamp < int(end.timestamp() * 1000))
        if partition_time == "event":
            df = df.where(hour <= end.astimezone(UTC).strftime("%Y%m%d%H"))
    return df.select(*schemas.SEQUENCED.names)
