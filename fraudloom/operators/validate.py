"""Turning raw CSV text into typed transactions, and keeping what fails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudloom import config, schemas
from fraudloom.functions import parsing

_PARSERS = {"int": parsing.to_int, "double": parsing.to_double, "string": parsing.strip}


def check(raw: DataFrame, ingested_ms: Column | None = None) -> DataFrame:
    """``raw`` plus a ``parsed`` struct and ``reason``, which is null for good rows.

    One pass; ``valid`` and ``rejected`` are two filters over it. Columns beyond
    the raw schema (such as ``seq``) stay where they are.
    """
    stamp = F.unix_millis(F.current_timestamp()) if ingested_ms is None else ingested_ms
    typed: dict[str, Column] = {}
    for field in schemas.TRANSACTION.fields:
        if field.name == "ingestion_timestamp_ms":
            typed[field.name] = stamp.cast("bigint")
        elif field.name == "type":
            typed[field.name] = parsing.clean_code(F.col("type"))
        else:
            typed[field.name] = _PARSERS[field.dataType.simpleString()](F.col(field.name))
    parsed = F.struct(*[value.alias(name) for name, value in typed.items()])
    known = F.col("parsed.type").isin(*config.TRANSACTION_TYPES)
    reason = F.when(~F.coalesce(known, F.lit(False)), "type")
    for name in schemas.RAW_CSV.names:
        if name == "amount":
            # beyond the mart's range, infinite or not a number (which compares as largest)
            fits = F.abs("parsed.amount") < config.AMOUNT_BELOW
            reason = reason.when(~F.coalesce(fits, F.lit(False)), name)
        elif name != "type":
            reason = reason.when(F.col(f"parsed.{name}").isNull(), name)
    return raw.withColumn("parsed", parsed).withColumn("reason", reason)


def valid(checked: DataFrame) -> DataFrame:
    """Typed transactions, with any extra columns of the raw rows kept."""
    extra = [c for c in checked.columns if c not in (*schemas.RAW_CSV.names, "parsed", "reason")]
    return checked.where(F.col("reason").isNull()).select("parsed.*", *extra)


def rejected(checked: DataFrame) -> DataFrame:
    """Quarantine: the raw text and the first column that failed."""
    return checked.where(F.col("reason").isNotNull()).drop("parsed")


def ingest_counts(checked: DataFrame) -> DataFrame:
    """Rows sent and rows skipped."""
    return checked.agg(
        F.count_if(F.col("reason").isNull()).alias("sent"),
        F.count_if(F.col("reason").isNotNull()).alias("skipped"),
    )


def domain_violations(df: DataFrame, column: str, allowed: tuple[str, ...]) -> DataFrame:
    """Rows whose code is missing or outside its domain."""
    return df.where(~F.coalesce(F.col(column).isin(*allowed), F.lit(False)))


def violations(facts: dict[str, DataFrame], domains: dict[tuple[str, str], tuple[str, ...]]) -> DataFrame:
    """``fact, column, rows, first_offender`` for every declared domain (``{(fact, column): codes}``).

    Each fact is read once, whatever its number of domains, and sums are combined
    in the tasks. Missing codes offend, except where the column itself is missing
    from a fact, which is an error. ``first_offender`` is the smallest bad code
    (null if only missing ones offend); a domain without offenders has 0 rows.
    """
    parts = []
    for fact, df in facts.items():
        rules = {column: codes for (owner, column), codes in domains.items() if owner == fact}
        if not rules:
            continue
        bad = {c: ~F.coalesce(F.col(c).isin(*codes), F.lit(False)) for c, codes in rules.items()}
        found = df.agg(*[
            F.struct(F.count_if(hit).alias("rows"), F.min(F.when(hit, F.col(c).cast("string"))).alias("first_offender")).alias(c)
            for c, hit in bad.items()])
        listed = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("held")) for c in bad]))
        parts.append(found.select(F.lit(fact).alias("fact"), listed.alias("rule")).select(
            "fact", "rule.column", "rule.held.rows", "rule.held.first_offender"))
    if not parts:
        raise ValueError("no domain is declared for any of the facts")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def system_flag(threshold: float = config.SYSTEM_FLAG_AMOUNT) -> Column:
    """What the system flag should be: a transfer above the threshold."""
    hit = (F.col("type") == config.SYSTEM_FLAG_TYPE) & (F.col("amount") > threshold)
    return F.when(hit, 1).otherwise(0)


def flag_mismatches(tx: DataFrame, threshold: float = config.SYSTEM_FLAG_AMOUNT) -> DataFrame:
    """Transactions whose stored system flag contradicts the rule."""
    expected = system_flag(threshold)
    return tx.withColumn("expected_flag", expected).where("isFlaggedFraud <> expected_flag")
