"""Generic rows: a map from 'family:qualifier' to text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utf8(raw: Column) -> Column:
    """Text of a binary cell, with a replacement mark for every invalid byte run."""
    return F.make_valid_utf8(raw.cast("string"))


def cell_map(cells: dict[str, Column]) -> Column:
    """Map of all non-null cells; every value is kept as text."""
    names = F.array(*[F.lit(name) for name in cells])
    values = F.array(*[value.cast("string") for value in cells.values()])
    return F.map_filter(F.map_from_arrays(names, values), lambda _, value: value.isNotNull())


def cell(columns: Column, name: str, data_type: str = "string") -> Column:
    """One cell back as a typed value; missing or unreadable gives null."""
    return F.try_element_at(columns, F.lit(name)).try_cast(data_type)
