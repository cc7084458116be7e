"""From CSV files to a topic: arrival number, time stamp, validation, publishing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fraudloom.functions import parsing
from fraudloom.operators import validate
from fraudloom.sources import topics
from fraudloom.sources.csv import read_csv

_HOUR_MS = 3_600_000


def numbered(raw: DataFrame) -> DataFrame:
    """``raw`` plus ``seq``: unique, and rising with the line within a piece of a file.

    Numbers cost no exchange. They are assigned once, before publishing, and the
    topic keeps them: computed again over other splits they would differ.
    """
    return raw.withColumn("seq", F.monotonically_increasing_id())


def replay_stamp(start: datetime) -> Column:
    """Event time of a raw row: its ``step`` is the hour after ``start``, counted from 1.

    The place within the hour comes from md5 of both account names, so a replay
    gives every row the same stamp again. Rows with equal stamps are ordered by
    ``seq``. Null where the step or a name is missing, which validation rejects.
    """
    step = parsing.to_int(F.col("step")).cast("bigint")
    pair = F.md5(F.concat_ws(":", F.col("nameOrig"), F.col("nameDest")))
    within = F.conv(F.substring(pair, 1, 8), 16, 10).cast("bigint") % _HOUR_MS
    return F.lit(int(start.timestamp() * 1000)) + (step - 1) * _HOUR_MS + within


def publish_csv(
    spark: SparkSession, path: str, topic: str, start: datetime,
    fmt: str = "parquet", servers: str | None = None, codec: str = "json",
) -> dict[str, int]:
    """Validate the files below ``path`` and publish the good rows.

    Returns the ingest counters ``sent`` and ``skipped``, which are collected
    while the rows are written.
    """
    checked = validate.check(numbered(read_csv(spark, path)), replay_stamp(start))
    counters = Observation("ingest")
    counted = checked.observe(
        counters,
        F.count_if(F.col("reason").isNull()).alias("sent"),
        F.count_if(F.col("reason").isNotNull()).alias("skipped"),
    )
    topics.send(topics.publishable(topics.evenly(validate.valid(counted)), codec=codec), topic, fmt, servers)
    return counters.get


def quarantine(spark: SparkSession, path: str) -> DataFrame:
    """The rows that ``publish_csv`` skips, with the column that failed."""
    return validate.rejected(validate.check(read_csv(spark, path)))
