"""Row-level combination ratios over moving sums (the row layer)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from panelcraft.functions.columns import as_number
from panelcraft.spec import Feature, numbered, ratio_features

# Longest history per key that one window partition sorts. With one row per
# (key, period) a period range of this width bounds every key's rows.
LONGEST_HISTORY = 4096


def moving_sum(column: Column, window: WindowSpec, months: int) -> Column:
    """Sum over the last N rows; null until N rows with a value exist."""
    return F.when(F.count(column).over(window) == months, F.sum(column).over(window))


def add_ratios(
    panel: DataFrame,
    features: Sequence[Feature],
    *,
    period_span: tuple[int, int] | None = None,
    frame: str = "rows",
    longest_history: int = LONGEST_HISTORY,
    within: Sequence[str] = (),
) -> DataFrame:
    """The panel with one ratio column per feature.

    A window counts rows, not periods, unless ``frame="period"``. The panel
    must hold one row per (key, period); repeated rows raise an error, since
    their order would decide the answer. Rows without a period keep their place
    in the result, have null ratios and count in no window. ``period_span``
    states the panel's period range and so bounds a key's rows; without it the
    range is looked up. Longer histories are cut into overlapping stretches,
    which changes no result. Keys are told apart inside the ``within`` columns.
    """
    features = list(features)
    if not features:
        return panel
    if frame not in ("rows", "period"):
        raise ValueError(f"unknown frame {frame!r}, expected 'rows' or 'period'")
    key, period = features[0].key, features[0].period
    if period_span is None:
        low, high = panel.agg(F.min(period), F.max(period)).first()
        period_span = (0, 0) if low is None else (int(low), int(high))
    # At least one row before a stretch: it shows a period repeated across the cut.
    back = max(1, *(f.months - 1 for f in features))
    known = panel.where(F.col(key).isNotNull())
    rows, group, order = known, [*within, key], F.col(period)
    split = period_span[1] - period_span[0] >= longest_history
    if split and within:
        raise ValueError("keys inside other columns have no long histories")
    if split:
        cut = _by_row_number if frame == "rows" else _by_period
        rows = cut(known.where(F.col(period).isNotNull()), key, period, max(longest_history, 2 * back), back)
        group = [key, "_stretch"]

    ordered = Window.partitionBy(*group).orderBy(order)
    sums: dict[tuple[str, int], str] = {}
    for f in features:
        for c in {*f.numerator, *f.denominator}:
            sums.setdefault((c, f.months), f"_sum_{len(sums)}")
    added = {}
    for (c, months), name in sums.items():
        window = (
            ordered.rowsBetween(-(months - 1), 0)
            if frame == "rows"
            else ordered.rangeBetween(-(months - 1), 0)
        )
        dated = F.when(F.col(period).isNotNull(), as_number(F.col(f"`{c}`")))
        added[name] = moving_sum(dated, window, months)
    rows = rows.withColumns(added).withColumn("_twin", F.lag(period).over(ordered) == F.col(period))
    if split:
        rows = rows.where("_own")

    def total(columns: Sequence[str], months: int) -> str:
        return " + ".join(f"coalesce({sums[c, months]}, 0D)" for c in columns)

    repeated = "raise_error('ratios need one row per key and period')"
    made = rows.select(
        *[f"`{c}`" for c in panel.columns],
        *[
            F.expr(
                f"CASE WHEN _twin THEN CAST({repeated} AS DOUBLE) ELSE "
                f"try_divide({total(f.numerator, f.months)}, {total(f.denominator, f.months)}) "
                f"END AS `{f.name}`"
            )
            for f in features
        ],
    )
    if split:
        made = made.unionByName(known.where(F.col(period).isNull()), allowMissingColumns=True)
    return made


def _by_period(rows: DataFrame, key: str, period: str, length: int, back: int) -> DataFrame:
    """Cut histories by period; each stretch also gets the ``back`` periods before it."""
    stretch = F.floor(F.col(period) / length)
    return _with_context(rows, stretch, F.pmod(F.col(period), F.lit(length)), length, back)


def _by_row_number(rows: DataFrame, key: str, period: str, length: int, back: int) -> DataFrame:
    """Cut histories by row number, each stretch with the ``back`` rows before it.

    The number is a row's place in its block of periods plus the rows of the
    key's earlier blocks, so a long history is never sorted by one task.
    """
    block = F.floor(F.col(period) / length)
    sizes = rows.groupBy(key, block.alias("_block")).agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(key).orderBy("_block")
    starts = sizes.select(
        key, "_block", (F.sum("_size").over(earlier) - F.col("_size")).alias("_before")
    )
    place = Window.partitionBy(key, "_block").orderBy(period)
    numbered_rows = (
        rows.withColumn("_block", block)
        .join(starts, [key, "_block"])
        .withColumn("_number", F.col("_before") + F.row_number().over(place) - 1)
    )
    number = F.col("_number")
    return _with_context(
        numbered_rows, F.floor(number / length), F.pmod(number, F.lit(length)), length, back
    )


def _with_context(
    rows: DataFrame, stretch: Column, offset: Column, length: int, back: int
) -> DataFrame:
    """Rows with ``_stretch`` and ``_own``; a stretch's last rows also open the next."""
    copies = F.when(
        offset >= length - back,
        F.array(F.struct(stretch.alias("s"), F.lit(True).alias("own")),
                F.struct((stretch + 1).alias("s"), F.lit(False).alias("own"))),
    ).otherwise(F.array(F.struct(stretch.alias("s"), F.lit(True).alias("own"))))
    return (
        rows.withColumn("_copy", F.explode(copies))
        .withColumn("_stretch", F.col("_copy.s"))
        .withColumn("_own", F.col("_copy.own"))
    )


def combination_ratios(
    panel: DataFrame,
    key: str,
    period: str,
    columns: Sequence[str],
    months: int,
    *,
    first_id: int = 1,
    **options,
) -> tuple[list[Feature], DataFrame]:
    """Every numerator/denominator combination of ``columns`` as ratio columns."""
    features = ratio_features(key, period, columns, months, numbered(first_id))
    return features, add_ratios(panel, features, **options)
