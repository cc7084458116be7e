"""Row keys of the card tables.

The salt is taken from md5 and not from a process-seeded hash, so that every
writer and reader derives the same key for a card.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LONG_MAX = 9_223_372_036_854_775_807


def salt(card: Column) -> Column:
    """Two hex digits that spread cards evenly over the key space."""
    return F.substring(F.md5(card), 1, 2)


def blacklist_key(card: Column) -> Column:
    return F.concat_ws("_", salt(card), card)


def profile_key(card: Column, year_month: Column) -> Column:
    return F.concat_ws("_", salt(card), card, year_month)


def alert_key(card: Column, ts_ms: Column) -> Column:
    """Sorts the newest alert of a card first."""
    newest_first = F.lpad((F.lit(_LONG_MAX) - ts_ms).cast("string"), 20, "0")
    return F.concat_ws("_", salt(card), card, newest_first)


def key_range(salt_hex: Column) -> Column:
    """Which of the 16 equal key ranges a salt falls into (0 to 15)."""
    return F.floor(F.conv(salt_hex, 16, 10).cast("bigint") / 16).cast("bigint")
