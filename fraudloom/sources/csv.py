"""Raw transaction CSV files with a header row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudloom import schemas

_OPTIONS = {"header": "true", "encoding": "UTF-8", "quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, found by their header name; further columns are ignored.

    Without type inference Spark reads nothing but one header line up front. A
    column that the files lack comes back null and fails validation. The second
    reader holds every file's own header against the first one found: a file
    with its columns in another order fails the read instead of being misread.
    """
    header = spark.read.options(**_OPTIONS).csv(path).schema
    found = spark.read.schema(header).options(**_OPTIONS, enforceSchema="false").csv(path)
    return found.select(*[
        F.col(f"`{c}`") if c in found.columns else F.lit(None).cast("string").alias(c)
        for c in schemas.RAW_CSV.names
    ])


def stream_csv(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Files of a folder as a stream. ``files_per_trigger`` paces the replay.

    A stream needs its schema up front, so columns must stand in declared order;
    the header is checked against it.
    """
    reader = spark.readStream.schema(schemas.RAW_CSV).options(**_OPTIONS, enforceSchema="false")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.csv(folder)
