"""Replay: compute the variables of a feature dictionary on a panel."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcraft.functions.columns import expression_column, predicate
from panelcraft.operators.ratios import add_ratios
from panelcraft.operators.trailing import HOT_ROWS, trailing_features
from panelcraft.spec import EXPRESSION, RATIO, Feature


def replay(
    panel: DataFrame,
    features: Sequence[Feature],
    base_period: int,
    *,
    key: str | None = None,
    where: str | None = None,
    unique_periods: bool = True,
    period_span: tuple[int, int] | None = None,
    within: Sequence[str] = (),
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """One row per key of ``panel`` with ``base_period`` and every variable.

    Ratio variables become row columns that later variables may read;
    expressions read finished variables before them in the list; all others are
    aggregates of one pass. Every key gets a row, also outside all windows.
    ``key`` overrides the dictionary's key column; ``within`` and ``hot_rows``
    are those of ``trailing_features``.
    """
    rows = panel.where(predicate(where, panel.schema)) if where else panel
    features = [replace(f, key=key or f.key).at(base_period) for f in features]
    key = key or next(f.key for f in features if f.key)
    features = [replace(f, key=key) for f in features]

    ratios = [f for f in features if f.kind == RATIO]
    rows = add_ratios(rows, ratios, period_span=period_span, within=within)
    aggregates = [f for f in features if f.kind not in (RATIO, EXPRESSION)]
    if aggregates:
        table = trailing_features(
            rows,
            aggregates,
            unique_periods=unique_periods,
            every_key=True,
            keyed=bool(ratios),
            within=within,
            hot_rows=hot_rows,
        )
    else:
        table = rows.where(F.col(key).isNotNull()).select(*within, key).distinct()

    finished = [f.name for f in aggregates]
    for f in features:
        if f.kind == EXPRESSION:
            before = finished + [g.name for g in features[: features.index(f)] if g.kind == EXPRESSION]
            table = table.withColumn(f.name, expression_column(f.expression, before))
    names = [f.name for f in features if f.kind != RATIO]
    return table.select(
        *within, key, F.lit(base_period).alias("base_period"), *[f"`{name}`" for name in names]
    )


def row_layer(
    panel: DataFrame,
    features: Sequence[Feature],
    *,
    period_span: tuple[int, int] | None = None,
) -> DataFrame:
    """The panel with the dictionary's ratio variables as row columns."""
    return add_ratios(
        panel, [f for f in features if f.kind == RATIO], period_span=period_span
    )
