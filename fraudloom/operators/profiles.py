"""Card profiles: write-back, rolling statistics, versions and retention."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from fraudloom import config, schemas
from fraudloom.functions import keys
from fraudloom.functions.times import year_month

_KEY = ["card_id", "year_month"]
_SUMS = ("tx_total", "tx_n")


def _last_event(rows: DataFrame) -> DataFrame:
    """The last row per card and month; the row-number filter cuts each task down before the exchange."""
    last = Window.partitionBy(*_KEY).orderBy(F.desc("ingestion_timestamp_ms"), F.desc("seq"))
    keyed = rows.withColumns({
        "card_id": F.col("nameOrig"), "year_month": year_month(F.col("ingestion_timestamp_ms"))})
    return keyed.withColumn("_back", F.row_number().over(last)).where("_back = 1")


def _activity() -> list[Column]:
    return [
        F.col("amount").alias("last_amount"), F.col("risk_score").alias("score"),
        F.when(F.col("flagged"), "1").otherwise("0").alias("flagged"),
        F.col("ingestion_timestamp_ms").alias("last_tx_ts")]


def latest_activity(scored: DataFrame) -> DataFrame:
    """Last amount, score, flag and time stamp per card and month."""
    return _last_event(scored).select(*_KEY, *_activity())


def complete(profiles: DataFrame, schema: StructType = schemas.USER_PROFILES) -> DataFrame:
    """All profile columns, null where the snapshot has none."""
    return profiles.select(*[
        (F.col(f.name) if f.name in profiles.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def _overlay(profiles: DataFrame, newer: DataFrame, schema: StructType = schemas.USER_PROFILES) -> DataFrame:
    """Full outer merge on the profile key: non-null values of ``newer`` win, sums add up."""
    updated = [c for c in newer.columns if c not in _KEY]
    renamed = newer.select(*_KEY, *[F.col(c).alias("_new_" + c) for c in updated])
    merged = complete(profiles, schema).join(renamed, _KEY, "full")

    def value(name: str, kind: DataType) -> Column:
        if name not in updated:
            return F.col(name)
        if name in _SUMS:
            parts = [F.coalesce(F.col(c), F.lit(0)) for c in (name, "_new_" + name)]
            both = F.when(F.col(name).isNotNull() | F.col("_new_" + name).isNotNull(), parts[0] + parts[1])
            return both.cast(kind).alias(name)
        return F.coalesce("_new_" + name, name).alias(name)

    return merged.select(*[value(f.name, f.dataType) for f in schema.fields])


def merge_profiles(profiles: DataFrame, scored: DataFrame) -> DataFrame:
    """The snapshot after the write-back of all scored transactions.

    City, limit and average are inputs of the rules and stay untouched.
    """
    return _overlay(profiles, latest_activity(scored))


def _window() -> list[Column]:
    return [F.col("n_window").alias("tx_count_5m"), F.col("amount_window").cast("double").alias("amount_sum_5m")]


def _sums(featured: DataFrame) -> DataFrame:
    return featured.groupBy(
        F.col("nameOrig").alias("card_id"), year_month(F.col("ingestion_timestamp_ms")).alias("year_month"),
    ).agg(
        F.sum(F.col("amount").try_cast("decimal(18,2)")).cast("decimal(22,2)").alias("tx_total"),
        F.count("amount").alias("tx_n"),
    )


def window_stats(featured: DataFrame) -> DataFrame:
    """Trailing count and sum at the last event per card and month, and the sums behind the average.

    ``featured`` comes from ``trailing_features(..., amounts=True)`` or the stream.
    """
    return _last_event(featured).select(*_KEY, *_window()).join(_sums(featured), _KEY)


def _average() -> Column:
    return F.when(F.col("tx_n") > 0, F.col("tx_total").cast("double") / F.col("tx_n"))


def rolling_stats(featured: DataFrame) -> DataFrame:
    """Average amount per card and month, and the trailing count and sum at its last event.

    Averages go into the next snapshot, never into the pass that judges the same events.
    """
    return window_stats(featured).select(*_KEY, "tx_count_5m", "amount_sum_5m", _average().alias("avg_amount"))


def batch_activity(scored: DataFrame) -> DataFrame:
    """What one batch of the scoring job changes in the profiles, statistics included."""
    return _last_event(scored).select(*_KEY, *_activity(), *_window()).join(_sums(scored), _KEY)


def merge_activity(profiles: DataFrame, activity: DataFrame, schema: StructType) -> DataFrame:
    """The snapshot after the activity of several batches (``batch_id``): last values of the last batch, sums of all.

    Nothing is recomputed from transactions.
    """
    last = Window.partitionBy(*_KEY).orderBy(F.desc("batch_id"))
    newest = activity.withColumn("_back", F.row_number().over(last)).where("_back = 1").drop("_back", "batch_id", *_SUMS)
    sums = activity.groupBy(*_KEY).agg(*[F.sum(c).alias(c) for c in _SUMS])
    return _overlay(profiles, newest.join(sums, _KEY), schema)


def refresh_stats(profiles: DataFrame) -> DataFrame:
    """The snapshot with averages from its sums; rows without events keep theirs."""
    return profiles.withColumn("avg_amount", F.coalesce(_average(), "avg_amount"))


def with_row_key(profiles: DataFrame) -> DataFrame:
    return profiles.withColumn("row_key", keys.profile_key(F.col("card_id"), F.col("year_month")))


def profile_months(profiles: DataFrame, cards: DataFrame) -> DataFrame:
    """All months of the given cards (``card_id``) in row-key order."""
    wanted = cards.select("card_id").distinct()
    return with_row_key(profiles).join(wanted, "card_id", "left_semi").orderBy("row_key")


def latest_versions(cells: DataFrame, key: list[str], version: str, keep: int) -> DataFrame:
    """The newest ``keep`` versions per key.

    Spark turns the row-number filter into a per-task top-k before the exchange.
    """
    newest = Window.partitionBy(*key).orderBy(F.desc(version))
    return cells.withColumn("version_rank", F.row_number().over(newest)).where(
        F.col("version_rank") <= keep
    )


def retained(cells: DataFrame, table: str, as_of: datetime) -> DataFrame:
    """Cells that are neither too old nor too many versions back for their family.

    ``cells`` has row_key, family, qualifier, value, version_ts (timestamp). Age
    limit and version count depend on the family; one pass serves all families.
    Cells of families without limits are kept as they are, without a rank.
    """
    limits = {f: limit for (owner, f), limit in config.RETENTION.items() if owner == table}
    family = F.col("family")
    young, kept = F, F
    for name, (days, versions) in limits.items():
        oldest = F.lit(as_of) - F.make_dt_interval(F.lit(days)) if days is not None else None
        young = young.when(
            family == name, F.lit(True) if oldest is None else F.col("version_ts") >= oldest
        )
        kept = kept.when(family == name, versions)
    most = max(versions for _, versions in limits.values())
    ranked = latest_versions(
        cells.where(young), ["row_key", "family", "qualifier"], "version_ts", most
    )
    listed = F.coalesce(family.isin(*limits), F.lit(False))
    free = cells.where(~listed).withColumn("version_rank", F.lit(None).cast("int"))
    return ranked.where(F.col("version_rank") <= kept).unionByName(free)
