"""Cardinality checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their ``row_count``."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where(F.col("row_count") > 1)
    )


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raise if ``keys`` repeat, else return ``df``. Costs one pass."""
    repeated = duplicate_keys(df, keys).first()
    if repeated is not None:
        raise ValueError(f"rows repeat for {repeated.asDict()}")
    return df
