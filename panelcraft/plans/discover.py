"""Discovery: generate all configured variables of a panel and record them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcraft.functions.columns import predicate
from panelcraft.operators.bins import bin_edges, edge_lookup
from panelcraft.operators.categories import MAX_CATEGORIES, category_lists
from panelcraft.operators.ratios import add_ratios
from panelcraft.operators.trailing import BASE, trailing_features
from panelcraft.plans.config import (
    Blocks,
    Row,
    Source,
    as_ints,
    as_list,
    optional_int,
    optional_text,
)
from panelcraft.spec import (
    CATEGORY,
    LOC_BIN,
    RISING_STREAK,
    STREAK,
    VAL_BIN,
    Feature,
    category_features,
    numbered,
    period_ratio_features,
    ratio_features,
    stat_features,
)

# Streak kinds of the configuration.
STREAK_KINDS = {"show": STREAK, "inc": RISING_STREAK}


@dataclass(frozen=True)
class Discovery:
    """Features in id order with the edges of bins, and the feature table.

    ``edges`` (rolling runs only) has the thresholds per base period, since a
    bin of a rolling run means a different threshold in each of them.
    """

    features: list[Feature]
    table: DataFrame
    edges: DataFrame | None = None


def filtered(panel: DataFrame, source: Source) -> DataFrame:
    """The source's period range and row filter, without excluded columns."""
    rows = panel.drop(*source.exclude).where(
        F.col(source.period).between(source.first_period, source.last_period)
    )
    return rows.where(predicate(source.where, rows.schema)) if source.where else rows


def discover(
    panel: DataFrame,
    source: Source,
    blocks: Blocks,
    *,
    rolling: bool = False,
    drop_unbinned: bool = False,
    unique_periods: bool = True,
    max_categories: int = MAX_CATEGORIES,
) -> Discovery:
    """Generate every variable that ``blocks`` configures for ``source``.

    One row per key, each variable at its configured last period; with
    ``rolling`` one row per (key, base period) for all configured periods,
    including the row layer's own columns at that period. Streak, bin and
    category blocks read the row layer, so ratio variables are legal there.
    ``drop_unbinned`` leaves out keys missing from any bin block's window.
    """
    if rolling and drop_unbinned:
        raise ValueError("a rolling run keeps keys without a bin; drop_unbinned does not apply to it")
    blocks = blocks.of(source)
    rows = filtered(panel, source)
    names = numbered()

    if any(optional_text(row, "where") for row in blocks.ratios):
        raise ValueError("a ratio block takes no row filter of its own; filter the source")
    ratios = [
        f
        for row in blocks.ratios
        for months in as_ints(row["month_combinations"])
        for f in ratio_features(
            source.key, source.period, as_list(row["var_combinations"]), months, names
        )
    ]
    layer = add_ratios(rows, ratios, period_span=(source.first_period, source.last_period))
    layer_range = _layer_range(blocks.ratios)
    # Outside a rolling run, blocks on the row layer see the ratio rows' range only.
    limits = {} if rolling or layer_range is None else dict(
        zip(("rows_from", "rows_to"), layer_range, strict=True)
    )

    stats = list(_stats(blocks.stats, source, names, rolling))
    streaks = [replace(f, **limits) for f in _streaks(blocks.streaks, source, names, rolling)]
    bins = [replace(f, **limits) for f in _bins(blocks.bins, source, names, rolling)]
    bin_vars, edges = _with_edges(layer, bins, names, rolling)
    kinds = [replace(f, **limits) for f in _categories(blocks.categories, source, rolling)]
    lists = category_lists(layer, kinds, max_categories)
    categories = [
        replace(made, first_base=f.first_base, last_base=f.last_base, where=f.where, **limits)
        for f in kinds
        for made in category_features(
            source.key, source.period, f.value, f.months, lists[f.name], names
        )
    ]

    features = [*stats, *streaks, *bin_vars, *categories]
    lookup = edge_lookup(edges) if rolling and bins else None
    if lookup is not None:
        bin_names = sorted({f.edge[0] for f in bin_vars})
        lookup = lookup.select(BASE, *[F.col("_edges")[n].alias(n) for n in bin_names])
    kept_range = layer_range or (source.first_period, source.last_period)
    own = [c for c in layer.columns if c not in (source.key, source.period)]
    table = trailing_features(
        layer,
        features,
        unique_periods=unique_periods,
        edges=lookup,
        keep_range=kept_range,
        carry=own if rolling else (),
        keyed=bool(ratios),
    )
    if drop_unbinned and bin_vars:
        for f in bin_vars:
            table = table.where(F.col(f.name).isNotNull())
    return Discovery([*ratios, *features], table, edges if rolling else None)


def _layer_range(rows: Sequence[Row]) -> tuple[int, int] | None:
    """Period range of the row layer; the last ratio row decides."""
    return (int(rows[-1]["month_start"]), int(rows[-1]["month_end"])) if rows else None


def _bases(row: Row, rolling: bool) -> tuple[int, int]:
    last = int(row["month_end"])
    return (int(row["month_start"]) if rolling else last, last)


def _stats(rows: Sequence[Row], source: Source, names: Iterator[str], rolling: bool):
    for row in rows:
        for months in as_ints(row["month_combinations"]):
            for f in (
                *stat_features(source.key, source.period, row["var_name"], months, names),
                *period_ratio_features(source.key, source.period, row["var_name"], months, names),
            ):
                yield replace(f.at(*_bases(row, rolling)), where=optional_text(row, "where"))


def _streaks(rows: Sequence[Row], source: Source, names: Iterator[str], rolling: bool):
    for row in rows:
        kind = STREAK_KINDS.get(str(row["continue_show_or_inc"]))
        if kind is None:
            continue
        for months in as_ints(row["month_combinations"]):
            yield Feature(
                next(names), kind, source.key, source.period, row["var_name"], months,
                threshold=float(row["threshold_value"]),
            ).at(*_bases(row, rolling))


def _bins(rows: Sequence[Row], source: Source, names: Iterator[str], rolling: bool):
    """Bin blocks before their edges are known; named set_1, set_2, ..."""
    count = 0
    for row in rows:
        for months in as_ints(row["month_combinations"]):
            for kind, column in ((LOC_BIN, "bin_by_loc"), (VAL_BIN, "bin_by_val")):
                bins = optional_int(row, column)
                if bins is None:
                    continue
                count += 1
                yield Feature(
                    f"set_{count}", kind, source.key, source.period, row["var_name"], months,
                    bins=bins, null_is_above=True,
                ).at(*_bases(row, rolling))


def _with_edges(
    layer: DataFrame, bins: Sequence[Feature], names: Iterator[str], rolling: bool
) -> tuple[list[Feature], DataFrame | None]:
    """One feature per edge: a fixed threshold, or an ordinal in a rolling run.

    Edges number at most bins x base periods per block, so the driver holds
    them; they are part of the dictionary.
    """
    if not bins:
        return [], None
    found = bin_edges(layer, bins)
    if rolling:
        # The dictionary keeps the edges of the last period, for replays there.
        last = {
            (r["edge_set"], r["ordinal"]): r["edge"]
            for f in bins
            for r in found.where((F.col("edge_set") == f.name) & (F.col(BASE) == f.last_base)).collect()
        }
        made = [
            replace(f, name=next(names), edge=(f.name, i), bin_value=last.get((f.name, i)))
            for f in bins
            for i in range(f.bins)
        ]
        return made, found
    by_set: dict[str, list[float]] = {}
    for row in found.orderBy("edge_set", "ordinal").collect():
        edges = by_set.setdefault(row["edge_set"], [])
        if not edges or edges[-1] != row["edge"]:  # equal edges are one threshold
            edges.append(row["edge"])
    return [
        replace(f, name=next(names), bin_value=edge) for f in bins for edge in by_set.get(f.name, [])
    ], found


def _categories(rows: Sequence[Row], source: Source, rolling: bool):
    for i, row in enumerate(rows):
        for months in as_ints(row["month_combinations"]):
            yield replace(
                Feature(
                    f"list_{i}_{months}", CATEGORY, source.key, source.period, row["var_name"], months
                ).at(*_bases(row, rolling)),
                where=optional_text(row, "where"),
            )
