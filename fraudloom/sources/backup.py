"""Backup of keyed tables as generic rows, manifest, restore, retention."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fraudloom import config, schemas
from fraudloom.functions import cells, keys

# ---- fixed values: column families of the keyed tables --------------------------
FAMILIES = {
    "blacklist": {
        "card_id": "info", "block_reason": "info", "is_active": "info",
        "blacklisted_at": "audit", "source": "audit", "analyst_id": "audit",
    },
    "user_profiles": {
        "card_id": "account", "credit_limit": "account", "currency": "account",
        "tx_count_5m": "stats", "amount_sum_5m": "stats", "avg_amount": "stats",
        "last_amount": "stats", "last_country": "geo", "last_city": "geo", "last_tx_ts": "geo",
        "score": "risk", "flagged": "risk",
    },
    "fraud_alerts": {
        "rules": "alert", "risk_score": "alert", "ts": "alert",
        "nameOrig": "tx", "amount": "tx", "type": "tx", "nameDest": "tx",
    },
}


def row_key(table: str) -> Column:
    """The row key of a typed table's rows."""
    if table == "blacklist":
        return keys.blacklist_key(F.col("card_id"))
    if table == "user_profiles":
        return keys.profile_key(F.col("card_id"), F.col("year_month"))
    return keys.alert_key(F.col("nameOrig"), F.col("ts"))


def to_rows(table: str, df: DataFrame, backup_ts: int) -> DataFrame:
    """Typed rows as (row_key, columns map, backup_ts); null cells are left out."""
    named = {
        f"{family}:{name}": F.col(name)
        for name, family in FAMILIES[table].items() if name in df.columns
    }
    return df.select(
        row_key(table).alias("row_key"),
        cells.cell_map(named).alias("columns"),
        F.lit(backup_ts).cast("bigint").alias("backup_ts"),
    )


def raw_to_rows(df: DataFrame, backup_ts: int) -> DataFrame:
    """Generic rows from binary key and cells (row_key, columns map<binary,binary>)."""
    repaired = F.map_from_entries(F.transform(
        F.map_entries("columns"),
        lambda e: F.struct(cells.utf8(e["key"]).alias("key"), cells.utf8(e["value"]).alias("value")),
    ))
    return df.select(
        cells.utf8(F.col("row_key")).alias("row_key"), repaired.alias("columns"),
        F.lit(backup_ts).cast("bigint").alias("backup_ts"),
    )


def backup_path(base: str, day: str, table: str) -> str:
    return f"{base.rstrip('/')}/{day}/{table}_backup"


def write_backup(
    spark: SparkSession, tables: dict[str, DataFrame | Callable[[], DataFrame]], base: str,
    taken_at: datetime, fmt: str = "parquet",
) -> DataFrame:
    """Write every table below a dated folder and return the manifest.

    A table that fails is recorded and does not stop the others; an empty table
    leaves no files. Row counts come from the written files, not from a second
    scan of the source.
    """
    day, stamp = taken_at.strftime("%Y-%m-%d"), int(taken_at.timestamp() * 1000)
    entries = []
    for table, source in tables.items():
        path = backup_path(base, day, table)
        try:
            df = source() if callable(source) else source
            rows = to_rows(table, df, stamp)
            if rows.isEmpty():
                written = 0
            else:
                rows.write.mode("overwrite").option("compression", "snappy").format(fmt).save(path)
                written = spark.read.schema(schemas.BACKUP).format(fmt).load(path).count()
            entries.append((table, written, "OK", day))
        except Exception as error:  # one table's failure must not lose the others
            entries.append((table, 0, f"FAILED: {str(error).splitlines()[0]}", day))
    return spark.createDataFrame(entries, "table string, rows bigint, status string, backup_date string")


def manifest(backups: dict[str, DataFrame]) -> DataFrame:
    """Rows per table of backups at hand."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(table).alias("table"), "rows", F.lit("OK").alias("status")
        )
        for table, df in backups.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def summarize(entries: DataFrame) -> DataFrame:
    """Total rows, overall success and its reason."""
    success = F.bool_and(F.col("status") == "OK")
    return entries.agg(
        F.sum("rows").alias("total_rows"),
        success.alias("success"),
        F.when(success, "OK").otherwise("One or more table backups failed").alias("reason"),
    )


def restore(table: str, backup: DataFrame, schema: StructType) -> DataFrame:
    """Generic rows back to a typed table. A cell that does not parse comes back null.

    A profile whose stored time is unreadable counts as having no known city
    either: both belong to the same failed lookup.
    """
    columns = F.col("columns")
    families = FAMILIES[table]
    typed: dict[str, Column] = {
        f.name: cells.cell(columns, f"{families[f.name]}:{f.name}", f.dataType.simpleString())
        for f in schema.fields if f.name in families
    }
    if table == "user_profiles":
        typed["year_month"] = F.substring("row_key", -6, 6)
        if "last_city" in typed:
            stored = cells.cell(columns, "geo:last_tx_ts")
            unreadable = stored.isNotNull() & cells.cell(columns, "geo:last_tx_ts", "bigint").isNull()
            typed["last_city"] = F.when(~unreadable, typed["last_city"])
    return backup.select(*[typed[f.name].alias(f.name) for f in schema.fields if f.name in typed])


def expired(manifests: DataFrame, as_of: datetime, days: int = config.BACKUP_RETENTION_DAYS) -> DataFrame:
    """Backups older than the retention time."""
    return manifests.where(
        F.to_date("backup_date") < F.date_sub(F.to_date(F.lit(as_of)), days)
    )
