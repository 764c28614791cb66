"""Longest runs of consecutive periods, without expanding to base periods first.

A run is found once per key in period order. Inside TRAIL(N) of base m only the
part from m-N+1 on counts, so the longest run there is the largest
``period - max(run start, m-N+1) + 1`` over the rows of the window: an ordinary
aggregate that joins the other trailing features.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcraft.spec import RISING_STREAK, Feature

# Fixed value: stands in for a missing previous period.
MISSING_PREVIOUS = -1.0


def _mark(f: Feature) -> str:
    label = f"{f.kind}_{f.value}_{float(f.threshold)!r}"
    return "_run_" + "".join(c if c.isascii() and c.isalnum() else f"_{ord(c)}_" for c in label)


def _gaps_break_runs(f: Feature) -> bool:
    """Below -1 the stand-in for a missing period itself exceeds the threshold."""
    return f.threshold >= MISSING_PREVIOUS


def add_run_marks(
    rows: DataFrame,
    group: Sequence[str],
    period: str,
    features: Sequence[Feature],
    numbers_of: Mapping[str, str],
) -> DataFrame:
    """Add, per (kind, value, threshold), what ``longest_run`` needs to know.

    That is the first period of the row's run or, where a run may span missing
    periods, the run's own periods of the last N. Repeated (key, period) rows
    have no previous period, so they are an error.
    """
    ordered = Window.partitionBy(*group).orderBy(period)
    upto = ordered.rowsBetween(Window.unboundedPreceding, 0)
    before = F.lag(period).over(ordered)
    distinct: dict[str, Feature] = {}
    reach: dict[str, int] = {}
    for f in features:
        distinct[_mark(f)] = f
        reach[_mark(f)] = max(reach.get(_mark(f), 1), f.months)
    values = sorted({f.value for f in distinct.values()})
    rows = rows.withColumn(
        "_adjacent",
        F.when(
            before == F.col(period),
            F.raise_error(F.lit("streaks need one row per key and period")).cast("boolean"),
        ).otherwise(F.coalesce(before == F.col(period) - 1, F.lit(False))),
    ).withColumns({f"_before_{numbers_of[v]}": F.lag(numbers_of[v]).over(ordered) for v in values})

    marks, numbers = {}, {}
    for name, f in distinct.items():
        value = F.col(numbers_of[f.value])
        previous = F.coalesce(
            F.when(F.col("_adjacent"), F.col(f"_before_{numbers_of[f.value]}")),
            F.lit(MISSING_PREVIOUS),
        )
        above = F.coalesce(value > f.threshold, F.lit(False))
        if f.kind == RISING_STREAK:
            breaks = ~(above & (value > previous) & (previous > f.threshold))
        else:
            breaks = above != (previous > f.threshold)
        if _gaps_break_runs(f):
            marks[name] = F.max(F.when(breaks & above, F.col(period))).over(upto)
        else:
            numbers[f"{name}_id"] = F.sum(breaks.cast("int")).over(upto)
    rows = rows.withColumns({**marks, **numbers})
    for name, f in distinct.items():
        if not _gaps_break_runs(f):
            recent = (
                Window.partitionBy(*group, f"{name}_id")
                .orderBy(period)
                .rangeBetween(-(reach[name] - 1), 0)
            )
            above = F.col(numbers_of[f.value]) > f.threshold
            rows = rows.withColumn(
                name, F.collect_list(F.when(above, F.col(period))).over(recent)
            )
    return rows


def longest_run(f: Feature, inside: str, base: str, period: str, value: str) -> str:
    """SQL aggregate: length of the longest run in the window, null without one."""
    first = f"{base} - {f.months - 1}"
    if f.rows_from is not None:
        first = f"greatest({first}, {f.rows_from})"
    if _gaps_break_runs(f):
        length = f"{period} - greatest({_mark(f)}, {first}) + 1"
    else:
        length = f"size(filter({_mark(f)}, p -> p >= {first}))"
    return f"max(CAST({length} AS BIGINT)) FILTER (WHERE {inside} AND {value} > double('{float(f.threshold)!r}'))"
