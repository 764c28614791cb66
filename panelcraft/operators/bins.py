"""Threshold shares: per key, the share of window rows at or above each edge.

The edges come from the values of all keys in TRAIL(N): by rank position
(``loc``) or at equal widths between minimum and maximum (``val``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcraft.functions.columns import as_number
from panelcraft.operators.ranks import Copies, select_ranks
from panelcraft.operators.trailing import BASE, trailing_features
from panelcraft.spec import LOC_BIN, VAL_BIN, Feature

EDGE_SCHEMA = f"edge_set string, {BASE} int, ordinal int, edge double"


def _bases_of(period: Column, months: int, first: int, last: int) -> Column:
    """Base periods of [first, last] whose TRAIL(months) holds ``period``."""
    low = F.greatest(period, F.lit(first))
    high = F.least(period + (months - 1), F.lit(last))
    return F.when(low <= high, F.sequence(low, high))


def bin_edges(panel: DataFrame, features: Sequence[Feature]) -> DataFrame:
    """Edges of bin features: (edge_set, base_period, ordinal, edge).

    ``edge_set`` is the feature's name. Ordinals count from 0; the topmost edge
    (the maximum) is not a threshold and is left out. The edges are computed
    now and held by the driver: bins x base periods rows per feature, whatever
    the panel's size.
    """
    by_rank = [f for f in features if f.kind == LOC_BIN]
    by_width = [f for f in features if f.kind == VAL_BIN]
    parts = []
    if by_rank:
        parts.append(_rank_edges(panel, by_rank))
    if by_width:
        parts.append(_width_edges(panel, by_width))
    columns = ("edge_set", BASE, "ordinal", "edge")
    found = [tuple(r) for part in parts for r in part.select(*columns).collect()]
    return panel.sparkSession.createDataFrame(sorted(found), EDGE_SCHEMA)


def _windows(f: Feature, period: Column) -> Column:
    """The feature's base periods that a row of ``period`` counts for."""
    bases = _bases_of(period, f.months, f.first_base, f.last_base)
    if f.rows_from is None:
        return bases
    return F.when(period.between(f.rows_from, f.rows_to), bases)


def _edge_sets(f: Feature) -> Column:
    """The (edge set, base period) groups of the feature that period ``p`` is in."""
    groups = F.transform(
        _windows(f, F.col("p")),
        lambda base: F.struct(
            F.lit(f.name).alias("edge_set"), F.lit(f.bins).alias("bins"), base.alias(BASE)
        ),
    )
    return F.coalesce(groups, F.array())


def _rows_of(panel: DataFrame, features: Sequence[Feature]) -> DataFrame:
    """Rows with a key whose period any window can hold.

    An integer period is compared in its own type, so that the range reaches the scan.
    """
    key, period = F.col(features[0].key), F.col(features[0].period)
    if not isinstance(panel.schema[features[0].period].dataType, T.IntegralType):
        period = period.cast("int")
    first = min(f.first_base - f.months + 1 for f in features)
    return panel.where(key.isNotNull() & period.between(first, max(f.last_base for f in features)))


def _rank_edges(panel: DataFrame, features: Sequence[Feature]) -> DataFrame:
    columns = sorted({f.value for f in features})
    values = F.array(
        *[
            F.struct(F.lit(i).alias("column"), as_number(F.col(f"`{c}`")).alias("v"))
            for i, c in enumerate(columns)
        ]
    )
    rows = (
        _rows_of(panel, features)
        .select(F.col(features[0].period).cast("int").alias("p"), F.explode(values).alias("t"))
        .select("p", "t.*")
    )
    sets = F.array()
    for i, c in enumerate(columns):
        of_column = F.concat(*[_edge_sets(f) for f in features if f.value == c])
        sets = F.when(F.col("column") == i, of_column).otherwise(sets)
    # Position i of nb is trunc(i * step) with step = (n-1)/nb, in doubles.
    wanted = select_ranks(
        rows,
        ["edge_set", "bins", BASE],
        "v",
        lambda n: F.transform(
            F.sequence(F.lit(0), F.col("bins") - 1), lambda i: F.floor(i * ((n - 1) / F.col("bins")))
        ),
        few_groups=True,
        copies=Copies(["column", "p"], sets),
    )
    return wanted.select(
        "edge_set", BASE, F.col("position").alias("ordinal"), F.col("value").alias("edge")
    )


def _width_edges(panel: DataFrame, features: Sequence[Feature]) -> DataFrame:
    period = F.col(features[0].period).cast("int")
    values = sorted({f.value for f in features})
    # One row per period after the first aggregate, so copies are cheap.
    per_period = (
        _rows_of(panel, features)
        .groupBy(period.alias("p"))
        .agg(
            *[F.min(as_number(F.col(f"`{v}`"))).alias(f"min_{i}") for i, v in enumerate(values)],
            *[F.max(as_number(F.col(f"`{v}`"))).alias(f"max_{i}") for i, v in enumerate(values)],
        )
    )
    tagged = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("edge_set"),
                F.lit(f.bins).alias("bins"),
                F.col(f"min_{values.index(f.value)}").alias("low"),
                F.col(f"max_{values.index(f.value)}").alias("high"),
                _windows(f, F.col("p")).alias("bases"),
            )
            for f in features
        ]
    )
    bounds = (
        per_period.select(F.explode(tagged).alias("t"))
        .select("t.*", F.explode("t.bases").alias(BASE))
        .groupBy("edge_set", "bins", BASE)
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .where(F.col("low").isNotNull())
    )
    step = (F.col("high") - F.col("low")) / F.col("bins")
    return bounds.select(
        "edge_set",
        BASE,
        F.posexplode(
            F.transform(
                F.sequence(F.lit(0), F.col("bins") - 1), lambda i: i * step + F.col("low")
            )
        ).alias("ordinal", "edge"),
    )


def edge_lookup(edges: DataFrame) -> DataFrame:
    """One row per base period with an array of edges per edge set."""
    by_set = edges.groupBy(BASE, "edge_set").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("ordinal", "edge"))), lambda e: e["edge"]
        ).alias("edges")
    )
    return by_set.groupBy(BASE).agg(
        F.map_from_entries(F.collect_list(F.struct("edge_set", "edges"))).alias("_edges")
    )


def bin_shares(
    panel: DataFrame,
    key: str,
    period: str,
    value: str,
    months: int,
    bins: int,
    first_base: int,
    last_base: int | None = None,
    *,
    kind: str = LOC_BIN,
    null_is_above: bool = True,
    unique_periods: bool = False,
) -> DataFrame:
    """Shares at or above computed edges, one row per key, base period and edge.

    Columns: key, ``base_period``, ``ordinal``, ``edge``, ``share``. Null values
    count as above every edge unless ``null_is_above`` is off.
    """
    spec = Feature(
        "bins", kind, key, period, value, months, bins=bins, null_is_above=null_is_above
    ).at(first_base, last_base)
    edges = bin_edges(panel, [spec])
    lookup = edge_lookup(edges).select(BASE, F.col("_edges")["bins"].alias("_edges"))
    features = [replace(spec, name=f"share_{i}", edge=("_edges", i)) for i in range(bins)]
    shares = trailing_features(
        panel, features, edges=lookup, unique_periods=unique_periods
    )
    long = shares.select(
        key, BASE, F.posexplode(F.array(*[f.name for f in features])).alias("ordinal", "share")
    )
    edge = F.get(F.col("_edges"), F.col("ordinal"))
    return (
        long.join(F.broadcast(lookup), BASE)
        .where(edge.isNotNull())
        .select(key, BASE, "ordinal", edge.alias("edge"), "share")
    )


def threshold_share(
    panel: DataFrame,
    key: str,
    period: str,
    value: str,
    months: int,
    threshold: float,
    first_base: int,
    last_base: int | None = None,
    *,
    name: str = "share",
    null_is_above: bool = False,
    unique_periods: bool = False,
) -> DataFrame:
    """Share of window rows at or above a given threshold; null is not above."""
    spec = Feature(
        name, VAL_BIN, key, period, value, months, threshold=threshold, null_is_above=null_is_above
    ).at(first_base, last_base)
    return trailing_features(panel, [spec], unique_periods=unique_periods)
