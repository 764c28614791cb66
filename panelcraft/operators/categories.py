"""Category lists for count and share features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcraft.operators.trailing import trailing_features
from panelcraft.spec import CATEGORY, Feature, category_features, numbered

# A category becomes two columns of the result; a column with more of them becomes two maps.
MAX_CATEGORIES = 1000


def category_lists(
    panel: DataFrame, features: Sequence[Feature], max_categories: int = MAX_CATEGORIES
) -> dict[str, list[str] | None]:
    """Sorted distinct values inside each feature's windows, over all keys.

    One pass serves all features. A feature with more values than
    ``max_categories`` has None: its categories do not become columns.
    """
    if not features:
        return {}
    period = F.col(features[0].period)
    tagged = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("name"),
                F.when(_in_any_window(f, period), F.col(f"`{f.value}`").cast("string")).alias("v"),
            )
            for f in features
        ]
    )
    first = Window.partitionBy("name").orderBy("v")
    found = (
        panel.where(F.col(features[0].key).isNotNull())
        .select(F.explode(tagged).alias("t"))
        .select("t.*")
        .where(F.col("v").isNotNull())
        .distinct()
        .withColumn("_rank", F.row_number().over(first))
        .where(F.col("_rank") <= max_categories + 1)
        .collect()
    )
    lists: dict[str, list[str]] = {f.name: [] for f in features}
    for row in found:
        lists[row["name"]].append(row["v"])
    return {
        name: sorted(values) if len(values) <= max_categories else None for name, values in lists.items()
    }


def _in_any_window(f: Feature, period):
    inside = period.between(f.first_base - f.months + 1, f.last_base)
    if f.rows_from is not None:
        inside = inside & period.between(f.rows_from, f.rows_to)
    return inside


def category_shares_long(
    panel: DataFrame,
    key: str,
    period: str,
    value: str,
    months: int,
    first_base: int,
    last_base: int | None = None,
) -> DataFrame:
    """(key, base_period, category, cnt, pct) for any number of categories.

    One row per category that occurs in the window, so nothing is listed
    beforehand. Shares are of all rows of the window, those without a value
    included, which have a row with a null category. Rows are counted per (key,
    period, category) before they are copied to their base periods.
    """
    last_base = first_base if last_base is None else last_base
    at = F.col(f"`{period}`")
    counted = (
        panel.where(F.col(f"`{key}`").isNotNull() & at.between(first_base - months + 1, last_base))
        .groupBy(F.col(f"`{key}`"), at.cast("int").alias("_period"), F.col(f"`{value}`").cast("string").alias("category"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    bases = F.sequence(
        F.greatest(F.col("_period"), F.lit(first_base)),
        F.least(F.col("_period") + (months - 1), F.lit(last_base)),
    )
    copied = counted.withColumn("base_period", F.explode(bases))
    shares = copied.groupBy(F.col(f"`{key}`"), "base_period", "category").agg(F.sum("_rows").alias("cnt"))
    totals = shares.groupBy(F.col(f"`{key}`"), "base_period").agg(F.sum("cnt").alias("_total"))
    return shares.join(totals, [key, "base_period"]).select(
        f"`{key}`", "base_period", "category", "cnt", (F.col("cnt") / F.col("_total")).alias("pct")
    )


def category_shares(
    panel: DataFrame,
    key: str,
    period: str,
    value: str,
    months: int,
    first_base: int,
    last_base: int | None = None,
    *,
    categories: Sequence[str] | None = None,
    unique_periods: bool = False,
    max_categories: int = MAX_CATEGORIES,
) -> tuple[list[Feature], DataFrame]:
    """Per key: count and share of each category, as var_1, var_2, ... columns.

    A column with over ``max_categories`` categories gives two maps instead,
    from category to count and to share.

    The category list is the same for all base periods; a category absent from
    one of them counts 0 there.
    """
    spec = Feature("c", CATEGORY, key, period, value, months).at(first_base, last_base)
    if categories is None:
        categories = category_lists(panel, [spec], max_categories)["c"]
    features = [
        f.at(spec.first_base, spec.last_base)
        for f in category_features(key, period, value, months, categories, numbered())
    ]
    return features, trailing_features(panel, features, unique_periods=unique_periods)
