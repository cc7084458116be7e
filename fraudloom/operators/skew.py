"""Finding the keys that would overload one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def heavy_keys(df: DataFrame, keys: list[str], min_rows: int) -> DataFrame:
    """All keys with more than ``min_rows`` rows, and their counts.

    The count is combined on the map side, so the hot key itself costs one row
    per task. The result has fewer than one row per ``min_rows`` rows of input.
    """
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > min_rows)
    )
