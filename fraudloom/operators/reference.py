"""Blacklist and profile lookups for transactions.

Set-wise joins in place of one key-value read per event. A missing snapshot is
an empty DataFrame and a missing row is null; both mean that no lookup rule
fires.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudloom.functions.times import year_month

PROFILE_FIELDS = ("credit_limit", "avg_amount", "last_city", "last_tx_ts")


def _profile_columns(profiles: DataFrame) -> list[Column]:
    """The looked-up fields, null where a snapshot has no such column."""
    types = {"credit_limit": "double", "avg_amount": "double", "last_tx_ts": "bigint"}
    return [
        (F.col(c) if c in profiles.columns else F.lit(None))
        .try_cast(types.get(c, "string")).alias(c)
        for c in PROFILE_FIELDS
    ]


def _newest(table: DataFrame, key: list[str], versions: list[str]) -> DataFrame:
    """One row per key, the one with the largest ``versions``; rows without a key are left out.

    Tables may hold several versions of a row. The row-number filter becomes a
    per-task top-1 before the exchange.
    """
    newest = Window.partitionBy(*key).orderBy(*[F.desc_nulls_last(c) for c in versions])
    known = table.dropna(subset=key)
    return known.withColumn("_back", F.row_number().over(newest)).where("_back = 1").drop("_back", "version_ts")


def _version(table: DataFrame) -> Column:
    """When a row was written (``version_ts``), null where a table does not say."""
    stamp = F.col("version_ts") if "version_ts" in table.columns else F.lit(None).cast("timestamp")
    return stamp.alias("version_ts")


def listed_cards(blacklist: DataFrame) -> DataFrame:
    """``nameOrig, is_active``: the newest row of each card, an active one among equals."""
    rows = blacklist.select(F.col("card_id").alias("nameOrig"), "is_active", _version(blacklist))
    return _newest(rows, ["nameOrig"], ["version_ts", "is_active"])


def known_profiles(profiles: DataFrame) -> DataFrame:
    """``nameOrig, _month`` and the profile fields: the newest row of each card and month."""
    rows = profiles.select(
        F.col("card_id").alias("nameOrig"), F.col("year_month").alias("_month"),
        *_profile_columns(profiles), _version(profiles),
    )
    order = ["version_ts", "last_tx_ts", "credit_limit", "avg_amount", "last_city"]
    return _newest(rows, ["nameOrig", "_month"], order)


def blacklist_lookup(df: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Left join on the card. Spark broadcasts the list if its size allows."""
    return df.join(listed_cards(blacklist), "nameOrig", "left")


def profile_lookup(df: DataFrame, profiles: DataFrame) -> DataFrame:
    """Left join on card and UTC month of the event."""
    return (
        df.withColumn("_month", year_month(F.col("ingestion_timestamp_ms")))
        .join(known_profiles(profiles), ["nameOrig", "_month"], "left")
        .drop("_month")
    )


def attach_reference(df: DataFrame, blacklist: DataFrame, profiles: DataFrame) -> DataFrame:
    """Both lookups, for micro-batches that carry their features already."""
    return profile_lookup(blacklist_lookup(df, blacklist), profiles)


def card_reference(blacklist: DataFrame, profiles: DataFrame) -> DataFrame:
    """One row per card: blacklist state and a map from month to profile fields.

    A card has one profile per calendar month, so the map stays small. Keyed by
    the card alone it can share the exchange of the trailing window, which a
    join on (card, month) could not.
    """
    listed = listed_cards(blacklist).select("nameOrig", "is_active", F.lit(None).alias("month"))
    monthly = known_profiles(profiles).select(
        "nameOrig",
        F.lit(None).cast("string").alias("is_active"),
        F.struct(F.col("_month"), F.struct(*PROFILE_FIELDS)).alias("month"),
    )
    return (
        listed.unionByName(monthly)
        .groupBy("nameOrig")
        .agg(
            F.max("is_active").alias("is_active"),
            F.map_from_entries(F.collect_list("month")).alias("months"),
        )
    )


def month_fields(df: DataFrame) -> DataFrame:
    """Profile fields of the event's month out of the ``months`` map."""
    profile = F.try_element_at("months", year_month(F.col("ingestion_timestamp_ms")))
    return df.withColumns({c: profile.getField(c) for c in PROFILE_FIELDS}).drop("months")
