"""Presentation expressions of the dashboard feed.

Score and rule are drawn from a hash of the event key instead of a random
generator: a replayed event always shows the same values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fraudloom import config


def _hash_number(text: Column, first: int) -> Column:
    """32 bits of md5, starting at hex digit ``first``, as a whole number."""
    return F.conv(F.substring(F.md5(text), first, 8), 16, 10).cast("bigint")


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def card_mask(account: Column) -> Column:
    digits = F.regexp_replace(account, "[^0-9]", "")
    digits = F.when(digits == "", F.lit("0")).otherwise(digits)
    return F.concat(F.lit("**** **** **** "), F.substring(F.repeat(digits, F.lit(4)), -4, 4))


def country(account: Column) -> Column:
    return _pick(config.COUNTRIES, _hash_number(account, 1) % len(config.COUNTRIES))


def transaction_id(event_key: Column) -> Column:
    return F.concat(F.lit("TXN-"), F.upper(F.substring(F.md5(event_key), 1, 8)))


def status(is_fraud: Column) -> Column:
    return F.when(is_fraud != 0, "Blocked").otherwise("Approved")


def score(is_fraud: Column, event_key: Column) -> Column:
    """0.85 to 1.00 for fraud, 0.01 to 0.20 otherwise, in steps of 0.01."""
    draw = _hash_number(event_key, 9)
    return F.when(is_fraud != 0, (draw % 16 + 85) / 100.0).otherwise((draw % 20 + 1) / 100.0)


def rule(is_fraud: Column, amount: Column, event_key: Column) -> Column:
    drawn = _pick(config.DASHBOARD_RULES, _hash_number(event_key, 17) % len(config.DASHBOARD_RULES))
    return (
        F.when(is_fraud == 0, "None")
        .when(amount >= config.HIGH_AMOUNT, "High Amount")
        .otherwise(drawn)
    )


def severity(score_col: Column) -> Column:
    bands = F
    for name, floor in config.SEVERITY_BANDS:
        bands = bands.when(score_col >= floor, name)
    return bands.otherwise("Low")
