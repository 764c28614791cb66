"""Exact rank selection inside groups of any size, by sketch and bracket.

A window function over a group, or a sort of it, would move the whole group.
Here one pass makes a mergeable quantile sketch per group, which brackets every
wanted rank between two of its values. A second pass counts: rows in a bracket
by value, all others by the gap between brackets that they lie in. Both combine
on the map side, so a group of any size arrives as a few small rows per task.
The running count over a group's brackets then says which value has the rank.

Brackets that hold too many values are narrowed by further sketches of the
values strictly inside them. A rank that falls into a gap shows that the sketch
was off; then the brackets are drawn again, eight times as wide. The values
themselves are never stored, sorted or moved.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcraft.session import materialize

#: Size parameter of a sketch; its ranks are off by about 0.2 % of the group at 99 % confidence.
SKETCH = 2_000
#: Evenly spaced quantiles that are read from a sketch.
GRID = 1_000
#: Share of the group, on either side of a wanted rank, that its bracket takes in.
SLACK = 0.004
#: Values in a bracket that are counted one by one; a wider bracket is narrowed first.
LIMIT = 1 << 16


@dataclass(frozen=True)
class Copies:
    """How one row stands for several groups.

    ``groups`` is an array of the group structs that a row belongs to, computed
    from ``columns``. Sketches and counts are made per ``columns`` and copied to
    the groups afterwards.
    """

    columns: Sequence[str]
    groups: Column


def sketch(value: Column) -> Column:
    """The aggregate that ``select_ranks`` accepts ready-made, as ``_sketch`` beside ``_n``."""
    return F.kll_sketch_agg_double(value, F.lit(SKETCH))


def select_ranks(
    values: DataFrame,
    groups: Sequence[str],
    value: str,
    ranks: Callable[[Column], Column],
    *,
    few_groups: bool = False,
    copies: Copies | None = None,
    sketched: DataFrame | None = None,
    thresholds: DataFrame | None = None,
    slack: float = SLACK,
    limit: int | None = None,
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """The values at given 0-based ranks of each group, nulls left out, as doubles.

    ``ranks`` maps the group's value count to an ascending array of ranks. The
    result has one row (groups..., ``position``, ``value``) per array element.
    ``few_groups`` says that groups x ranks is a small number by construction,
    so the brackets may pass through the driver; ``copies`` needs it. Groups
    with a null in their key are left out. ``sketched`` may hold (groups...,
    ``_sketch``, ``_n``) if another pass has made them. With ``thresholds``
    (groups..., ``name``, ``point``), the same pass counts the values below each
    point, and the result is a pair: the ranks, and (groups..., ``name``,
    ``below``). The work is done now.
    """
    groups, limit = list(groups), LIMIT if limit is None else limit
    stored = list(copies.columns) if copies else groups
    rows = values.select(*stored, F.col(value).cast("double").alias("value"))
    rows = rows.where(F.col("value").isNotNull() & ~F.isnan("value"))
    if sketched is None:
        sketched = rows.groupBy(*stored).agg(sketch(F.col("value")).alias("_sketch"), F.count("*").alias("_n"))
        if copies:
            # One small row per `columns`: read for the sketches of the groups and for their brackets.
            own = materialize(sketched)
            sketched = (
                own.select("_sketch", "_n", F.explode(copies.groups).alias("_group"))
                .groupBy(*[F.col(f"_group.{g}").alias(g) for g in groups])
                .agg(
                    F.kll_merge_agg_double("_sketch", F.lit(SKETCH)).alias("_sketch"), F.sum("_n").alias("_n")
                )
            )
    held = _on_driver if few_groups else materialize
    brackets = held(_bracketed(sketched.where(F.col("_n") > 0), groups, ranks, slack))
    narrowed = rows
    if copies:
        narrowed = rows.select("value", F.explode(copies.groups).alias("_group")).select("_group.*", "value")
    # Brackets as wide as the group cannot miss, and are counted as they are.
    while slack < 1 and not (wide := brackets.where(F.col("inside") > limit)).isEmpty():
        rest = brackets.where(F.col("inside") <= limit)
        drawn = _narrowed(narrowed, _small(wide, few_groups), groups, min(slack, 0.25))
        brackets = held(rest.unionByName(drawn))

    limits = brackets.select(*groups, "low", "high")
    if thresholds is not None:
        point = F.col("point").cast("double")
        limits = limits.unionByName(thresholds.select(*groups, point.alias("low"), point.alias("high")))
    bounds = _small(limits.groupBy(*groups).agg(_sorted("low"), _sorted("high")), few_groups)
    if copies:
        of_row = own.select(*stored, F.explode(copies.groups).alias("_group")).select(*stored, "_group.*")
        bounds = _on_driver(
            of_row.join(bounds, groups)
            .groupBy(*stored)
            .agg(*[F.sort_array(F.flatten(F.collect_set(c))).alias(c) for c in ("_lows", "_highs")])
        )
    entries = _entries_of(rows, bounds, groups, copies, few_groups)
    if thresholds is not None:
        entries = materialize(entries)
        below = F.col("value").isNull() | (F.col("value") < F.col("point"))
        counts = (
            thresholds.join(entries, groups, "left")
            .groupBy(*groups, "name")
            .agg(F.coalesce(F.sum(F.when(below, F.col("_times"))), F.lit(0)).alias("below"))
        )
    found = held(_placed(entries, brackets, groups, few_groups))
    missed = found.where("gap")
    hits = found.where(~F.col("gap")).select(*groups, "position", "value")
    if missed.isEmpty():
        return hits if thresholds is None else (hits, counts)
    wider = min(1.0, max(slack, 1 / GRID) * 8)
    if copies or thresholds is not None:
        again = select_ranks(
            values, groups, value, ranks, few_groups=few_groups, copies=copies, slack=wider, limit=limit
        )
        return again if thresholds is None else (again, counts)
    lost = _small(missed.select(*groups).distinct(), few_groups)
    again = select_ranks(
        values.join(lost, groups, "left_semi"), groups, value, ranks, few_groups=few_groups, slack=wider, limit=limit
    )
    return hits.join(lost, groups, "left_anti").unionByName(again)


def _on_driver(df: DataFrame) -> DataFrame:
    """``df`` as a local table; it has groups x ranks rows, few by construction."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def _small(df: DataFrame, few_groups: bool) -> DataFrame:
    return F.broadcast(df) if few_groups else df


def _between(rank: Column, n: Column, slack: float) -> tuple[Column, Column]:
    """Quantiles of ``_grid`` on either side of a 0-based rank among ``n`` values."""
    grid = F.col("_grid")
    low = F.greatest(F.lit(0), F.floor((rank / n - slack) * GRID).cast("int"))
    high = F.least(F.lit(GRID), F.ceil(((rank + 1) / n + slack) * GRID).cast("int"))
    return F.get(grid, low), F.get(grid, high)


def _grid() -> Column:
    points = ",".join(f"{i / GRID!r}D" for i in range(GRID + 1))
    return F.expr(f"kll_sketch_get_quantile_double(_sketch, array({points}))")


def _entries(n: Column, slack: float, low: Column, high: Column) -> Column:
    """About how many different values a bracket can hold."""
    return F.when(low == high, F.lit(0)).otherwise(F.ceil(n * min(1.0, 2 * slack + 2 / GRID))).cast("long")


def _sorted(bound: str) -> Column:
    return F.sort_array(F.collect_list(bound)).alias(f"_{bound}s")


def _bracketed(
    sketched: DataFrame, groups: list[str], ranks: Callable[[Column], Column], slack: float
) -> DataFrame:
    """(groups..., position, rank, low, high, inside) from the groups' sketches."""
    wanted = sketched.withColumn("_grid", _grid()).select(
        *groups, "_n", "_grid", F.posexplode(ranks(F.col("_n"))).alias("position", "rank")
    )
    low, high = _between(F.col("rank"), F.col("_n"), slack)
    return (
        wanted.withColumns({"rank": F.col("rank").cast("long"), "low": low, "high": high})
        .withColumn("inside", _entries(F.col("_n"), slack, F.col("low"), F.col("high")))
        .select(*groups, "position", "rank", "low", "high", "inside")
    )


def _narrowed(rows: DataFrame, wide: DataFrame, groups: list[str], slack: float) -> DataFrame:
    """The same brackets, drawn again by a sketch of the values strictly inside each.

    A rank that is outside its bracket leaves a bracket of one value, which the
    final count finds to be wrong.
    """
    v, low, high = F.col("value"), F.col("low"), F.col("high")
    strictly = (v > low) & (v < high)
    counted = (
        rows.join(wide, groups)
        .groupBy(*groups, "position", "rank", "low", "high")
        .agg(
            F.count_if(v < low).alias("_below"),
            F.count_if(v == low).alias("_low"),
            F.count_if(strictly).alias("_n"),
            F.count_if(v == high).alias("_high"),
            sketch(F.when(strictly, v)).alias("_sketch"),
        )
        .withColumn("_left", F.col("rank") - F.col("_below") - F.col("_low"))
        .withColumn("_grid", F.when(F.col("_n") > 0, _grid()))
    )
    left, n = F.col("_left"), F.col("_n")
    at_low = (left < 0) | (left >= n + F.col("_high"))
    new_low, new_high = _between(left, n, slack)
    return (
        counted.withColumns(
            {
                "_new_low": F.when(at_low, low).when(left >= n, high).otherwise(new_low),
                "_new_high": F.when(at_low, low).when(left >= n, high).otherwise(new_high),
            }
        )
        .withColumns({"low": F.col("_new_low"), "high": F.col("_new_high")})
        .withColumn("inside", _entries(n, slack, low, high))
        .select(*groups, "position", "rank", "low", "high", "inside")
    )


def _entries_of(
    rows: DataFrame, bounds: DataFrame, groups: list[str], copies: Copies | None, few_groups: bool
) -> DataFrame:
    """(groups..., value, gap, _times): how often each value in a bracket, and each gap, occurs.

    Of sorted lows and highs, a value lies in a bracket if more lows are at or
    below it than highs are below it. Otherwise it stands for its gap, which is
    named by the last high below it. With copies a row meets the brackets of all
    its groups, so one count serves them all.
    """
    stored = list(copies.columns) if copies else groups
    v = F.col("value")
    before = F.size(F.filter("_highs", lambda high: high < v))
    inside = F.size(F.filter("_lows", lambda low: low <= v)) > before
    entries = (
        rows.join(_small(bounds, few_groups), stored)
        .withColumn("_before", before)
        .select(
            *stored,
            (~inside).alias("gap"),
            F.when(inside, v).otherwise(F.get("_highs", F.col("_before") - 1)).alias("value"),
        )
        .groupBy(*stored, "value", "gap")
        .agg(F.count(F.lit(1)).alias("_times"))
    )
    if copies:
        entries = (
            entries.select("value", "gap", "_times", F.explode(copies.groups).alias("_group"))
            .groupBy(*[F.col(f"_group.{g}").alias(g) for g in groups], "value", "gap")
            .agg(F.sum("_times").alias("_times"))
        )
    return entries


def _placed(entries: DataFrame, brackets: DataFrame, groups: list[str], few_groups: bool) -> DataFrame:
    """(groups..., position, value, gap): where each wanted rank falls; outside its bracket it is missed."""
    # At most `limit` values and one gap per bracket, whatever the group's size.
    in_order = Window.partitionBy(*groups).orderBy(F.asc_nulls_first("value"), "gap")
    wanted = brackets.groupBy(*groups).agg(
        F.collect_list(F.struct("position", "rank", "low", "high")).alias("_wanted")
    )
    hit = F.explode(
        F.filter(
            "_wanted",
            lambda t: (t["rank"] < F.col("_upto")) & (t["rank"] >= F.col("_upto") - F.col("_times")),
        )
    )
    # Counts are exact inside a rank's own bracket; elsewhere, with copies, only some rows were told apart.
    own = F.col("value").between(F.col("_hit.low"), F.col("_hit.high"))
    return (
        entries.withColumn("_upto", F.sum("_times").over(in_order))
        .join(_small(wanted, few_groups), groups)
        .withColumn("_hit", hit)
        .select(
            *groups,
            F.col("_hit.position").alias("position"),
            "value",
            (F.col("gap") | ~F.coalesce(own, F.lit(False))).alias("gap"),
        )
    )


def middle_ranks(n: Column) -> Column:
    """The one or two ranks whose mean is the median."""
    return F.array(F.floor((n - 1) / 2), F.floor(n / 2))


def exact_medians(
    values: DataFrame,
    groups: Sequence[str],
    value: str,
    *,
    few_groups: bool = False,
    sketched: DataFrame | None = None,
) -> DataFrame:
    """(groups..., ``median``): midpoint median of each group with a value."""
    picked = select_ranks(values, groups, value, middle_ranks, few_groups=few_groups, sketched=sketched)
    return picked.groupBy(*groups).agg(F.avg("value").alias("median"))
