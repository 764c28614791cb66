"""Data check: presence patterns and column profiles of the sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcraft.operators.profile import (
    RANGE_POINTS,
    category_profile,
    numeric_profile,
    presence_pattern,
)
from panelcraft.plans.config import Source
from panelcraft.sources.tables import columns_of_type


@dataclass(frozen=True)
class CheckReport:
    """Presence strings, numeric profiles and category profiles of all sources."""

    presence: DataFrame
    numbers: DataFrame | None
    categories: DataFrame | None


def check(
    panels: Mapping[str, DataFrame], meta: list[dict], sources: Sequence[Source]
) -> CheckReport:
    """Profile every source; ``meta`` says which columns are numbers or text."""
    presence, numbers, categories = [], [], []
    for source in sources:
        panel = panels[source.name]
        without = (source.key, source.period, *source.exclude)
        filename = F.lit(source.name).alias("filename")
        pattern = presence_pattern(
            panel, source.key, source.period, source.first_period, source.last_period
        )
        presence.append(pattern.select(filename, "month_str", "month_str_count"))
        numeric = columns_of_type(meta, source.name, "Numbers", without=without)
        if numeric:
            profile = numeric_profile(panel, numeric, ranges=True)
            numbers.append(
                profile.select(
                    filename, "var_name", "cnt", "cnt_isna", "pct_isna", "sum", "min", "max",
                    "avg", "med",
                    *[f"P{q}_num" for q in RANGE_POINTS],
                    *[f"P{q}_pct" for q in RANGE_POINTS],
                )
            )
        text = columns_of_type(meta, source.name, "String", without=without)
        if text:
            categories.append(
                category_profile(panel, text).select(
                    filename, "var_name", "var_value", "cnt", "pct"
                )
            )

    def union(parts: list[DataFrame]) -> DataFrame | None:
        return reduce(lambda a, b: a.unionByName(b), parts) if parts else None

    return CheckReport(union(presence), union(numbers), union(categories))
