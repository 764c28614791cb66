"""Row with the smallest or largest value of a column, per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def pick_extremes(
    df: DataFrame,
    by: Sequence[str],
    condition_var: str,
    conditions: Sequence[str],
    keep: Sequence[str] | None = None,
    *,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """One row per group with columns ``{min|max}_{condition_var}_{column}``.

    Rows without a value of ``condition_var`` are ignored. Among equal extremes
    the row smallest in ``tie_break`` wins, for both conditions; without
    ``tie_break`` the kept columns break the tie. Aggregates combine on the map
    side, so a group of any size arrives as one row per task.
    """
    by, conditions = list(by), list(conditions)
    unknown = set(conditions) - {"min", "max"}
    if unknown or not conditions:
        raise ValueError(f"conditions must be 'min' and/or 'max', not {conditions}")
    keep = [c for c in (keep if keep is not None else df.columns) if c not in by]
    ties = list(tie_break) or keep
    present = df.where(F.col(condition_var).isNotNull())
    for c in by:
        present = present.where(F.col(c).isNotNull())

    kept = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)])
    tie = [F.col(c).alias(f"t{i}") for i, c in enumerate(ties)]
    value = F.col(condition_var)
    downwards = _descending(value, df.schema[condition_var].dataType)
    if "max" in conditions and downwards is None:
        # No negation exists: settle ties per value first, then compare values.
        present = present.groupBy(*by, condition_var).agg(F.min_by(kept, F.struct(*tie)).alias("_kept"))
        picks = {"min": F.min_by("_kept", value), "max": F.max_by("_kept", value)}
    else:
        picks = {
            "min": F.min_by(kept, F.struct(value.alias("v"), *tie)),
            "max": F.min_by(kept, F.struct((value if downwards is None else downwards).alias("v"), *tie)),
        }
    picked = present.groupBy(*by).agg(*[picks[c].alias(f"_{c}") for c in conditions])
    return picked.select(
        *by,
        *[
            F.col(f"_{c}.k{i}").alias(f"{c}_{condition_var}_{name}")
            for c in conditions
            for i, name in enumerate(keep)
        ],
    )


def _descending(value: Column, kind: T.DataType) -> Column | None:
    """An expression that orders ``value`` the other way round, if there is one."""
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        return -value
    if isinstance(kind, T.IntegralType):
        return -value.cast("decimal(20,0)")
    if isinstance(kind, T.DateType):
        return -F.unix_date(value)
    if isinstance(kind, T.TimestampType):
        return -F.unix_micros(value)
    return None
