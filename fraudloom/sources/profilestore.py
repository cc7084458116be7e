"""Versioned snapshots of the card profiles.

A snapshot is cut by month and card bucket. Writing back activity copies only the
parts it touches into a new folder and publishes a new version, which names the
folder of every part; older versions stay readable until they are dropped. A
lookup opens the parts of its months and buckets, and no others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudloom import schemas
from fraudloom.operators.profiles import complete, merge_activity, refresh_stats
from fraudloom.sources.versions import Folder, Versions

# Sums behind the averages: they merge, averages do not.
STORED = T.StructType([
    *schemas.USER_PROFILES.fields, T.StructField("tx_total", T.DecimalType(22, 2)), T.StructField("tx_n", T.LongType())])
_PARTS = ["part_month", "part_bucket"]


class ProfileStore:
    """``buckets`` is fixed when the store is made; every part of it is one folder a month."""

    def __init__(self, spark: SparkSession, base: str, buckets: int = 64):
        self.spark, self.base = spark, base.rstrip("/")
        self.versions = Versions(spark, f"{self.base}/versions")
        newest = self.versions.newest()
        self.buckets = buckets if newest is None else self.versions.read(newest)["buckets"]

    def _placed(self, rows: DataFrame) -> DataFrame:
        bucket: Column = F.pmod(F.xxhash64("card_id"), F.lit(self.buckets)).cast("int")
        return rows.withColumns({"part_month": F.col("year_month"), "part_bucket": bucket})

    def _parts(self, rows: DataFrame) -> set[str]:
        """Parts that ``rows`` (card_id, year_month) fall into: at most months x buckets of them."""
        found = self._placed(rows.dropna(subset=["card_id", "year_month"]).select("card_id", "year_month"))
        return {f"{_PARTS[0]}={r[0]}/{_PARTS[1]}={r[1]}" for r in found.select(*_PARTS).distinct().collect()}

    def _publish(self, number: int, rows: DataFrame, kept: dict[str, int], upto: int) -> None:
        self._placed(rows).hint("rebalance", *_PARTS).write.mode("overwrite").partitionBy(*_PARTS).parquet(
            f"{self.base}/data/{number}")
        made = Folder(self.spark, f"{self.base}/data/{number}")
        months = [n for n in made.names() if n.startswith(f"{_PARTS[0]}=")]
        parts = {f"{m}/{b}": number for m in months for b in made.names(m) if b.startswith(f"{_PARTS[1]}=")}
        self.versions.publish(number, {"buckets": self.buckets, "upto": upto, "parts": {**kept, **parts}})

    def create(self, profiles: DataFrame) -> None:
        """The first version; rows without card or month are left out."""
        if self.versions.newest() is not None:
            raise ValueError(f"{self.base} holds profiles already")
        self._publish(0, complete(profiles.dropna(subset=["card_id", "year_month"]), STORED), {}, -1)

    def upto(self) -> int:
        """The last batch whose activity the newest version holds."""
        return self.versions.read(self.versions.newest())["upto"]

    def read(self, version: int | None = None, parts: set[str] | None = None) -> DataFrame:
        """A version (the newest), or those of its ``parts`` that hold rows."""
        held = self.versions.read(self.versions.newest() if version is None else version)["parts"]
        paths = [f"{self.base}/data/{n}/{part}" for part, n in sorted(held.items()) if parts is None or part in parts]
        if not paths:
            return self.spark.createDataFrame([], STORED)
        return self.spark.read.schema(STORED).parquet(*paths)

    def lookup(self, wanted: DataFrame) -> DataFrame:
        """Profiles of the cards and months in ``wanted`` (card_id, year_month), from the parts they lie in."""
        return self.read(parts=self._parts(wanted)).join(wanted, ["card_id", "year_month"], "left_semi")

    def write_back(self, activity: DataFrame, upto: int, averages: bool = False) -> None:
        """A new version with what batches up to ``upto`` stored as activity (``jobs.score_batch``).

        ``averages`` also renews the averages that rule 5 compares with.
        """
        newest = self.versions.newest()
        parts = self._parts(activity)
        merged = merge_activity(self.read(newest, parts), activity, STORED)
        kept = self.versions.read(newest)["parts"]
        self._publish(newest + 1, refresh_stats(merged) if averages else merged, kept, upto)

    def retain(self, keep: int = 2) -> None:
        """Drop all but the newest ``keep`` versions, and the folders that only they name."""
        numbers = self.versions.numbers()
        used = {(part, n) for v in numbers[-keep:] for part, n in self.versions.read(v)["parts"].items()}
        for number in numbers[:-keep]:
            self.versions.forget(number)
        data = Folder(self.spark, f"{self.base}/data")
        for number in data.names():
            if int(number) > numbers[-1]:
                continue  # a version under way
            for month in data.names(number):
                for bucket in data.names(f"{number}/{month}") if month.startswith(_PARTS[0]) else []:
                    if (f"{month}/{bucket}", int(number)) not in used:
                        data.delete(f"{number}/{month}/{bucket}")
