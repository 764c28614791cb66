"""Trailing-window features, many variables and base periods in one aggregate.

TRAIL(N) of a base period m holds the rows with m-N+1 <= period <= m. Every
variable is an aggregate with a FILTER over those rows, so all of them share
one ``groupBy``. Three physical shapes are used:

* one base period: no row is copied; partial aggregation runs before the
  shuffle, so a key of any size arrives as one small row per map task;
* many base periods, rows may repeat within (key, period): each row is copied
  to its base periods and partially aggregated before the shuffle;
* many base periods, (key, period) unique: rows are shuffled once by key (and
  by block of base periods when the range is long) and copied afterwards, so
  the copies never cross the network and a key's work is bounded by the block.

Grouping is correct in all of them even if the uniqueness claim is wrong.

Aggregates are written as SQL text: a specification can hold hundreds of
variables, and one parsed expression each is far quicker to set up than a tree
of Column calls.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcraft.functions.columns import as_number, predicate
from panelcraft.operators.ranks import exact_medians
from panelcraft.operators.streaks import add_run_marks, longest_run
from panelcraft.spec import (
    ADDED_FUNCS,
    CATEGORY,
    LOC_BIN,
    MAP_FUNCS,
    PERIOD_RATIO,
    RISING_STREAK,
    STAT,
    STREAK,
    VAL_BIN,
    Feature,
)

BASE = "base_period"
BLOCK = "_block"
BLOCK_LENGTH = 512
PERIOD = "_period"

# A group with more rows than this never has its median taken by one task.
HOT_ROWS = 1_000_000


def trailing_features(
    panel: DataFrame,
    features: Sequence[Feature],
    *,
    unique_periods: bool = False,
    every_key: bool = False,
    edges: DataFrame | None = None,
    keep_range: tuple[int, int] | None = None,
    carry: Sequence[str] = (),
    keyed: bool = False,
    block_length: int = BLOCK_LENGTH,
    hot_rows: int | None = HOT_ROWS,
    within: Sequence[str] = (),
) -> DataFrame:
    """Compute all ``features`` over ``panel``.

    With one base period per feature the result has one row per key; otherwise
    one per (key, ``base_period``). A key appears if it has a row in any window
    or in ``keep_range`` (``every_key``: always). ``edges`` is a small table with
    one row per base period holding the arrays that ``Feature.edge`` refers to.
    ``carry`` adds the panel's own columns at the base periods of ``keep_range``.
    ``keyed`` says that the panel is already hash-partitioned by its key, as
    after a window over the key, so it is not shuffled again for that. Groups of
    more than ``hot_rows`` rows get their medians by rank selection; where
    ``unique_periods`` claims that there are none, the rows per key are counted
    first, and a key with more makes the claim void; None says that no group has
    many rows, so nothing is counted. ``within`` names columns, such as a
    request's id, inside which keys are told apart; they lead the result. Rows
    that are already partitioned by some of them are not shuffled again.
    """
    asked, features = list(features), [f for f in features if f.func not in MAP_FUNCS]
    maps = [f for f in asked if f.func in MAP_FUNCS]
    key = asked[0].key
    period = next((f.period for f in asked if f.period), None)
    rolling = (
        bool(carry)
        or edges is not None
        or any(f.first_base != f.last_base for f in asked)
    )
    if maps and not features:
        # Which keys have a row in a window is a variable of its own.
        features = [replace(f, name=f"_rows_{i}", kind=STAT, func="np.size") for i, f in enumerate(maps)]
    medians = [f for f in features if f.kind == STAT and f.func == "np.median"]
    within = list(within)
    if medians and unique_periods and hot_rows is not None:
        known_key = panel.where(F.col(f"`{key}`").isNotNull())
        per_key = known_key.groupBy(*[F.col(f"`{c}`") for c in (*within, key)]).count()
        unique_periods = per_key.where(F.col("count") > hot_rows).isEmpty()
    zero_filled = [f for f in features if f.kind == RISING_STREAK]
    every_key = every_key or any(f.rows_from is None for f in zero_filled)
    runs = [f for f in features if f.kind in (STREAK, RISING_STREAK)]
    if any(f.where for f in runs):
        raise ValueError("streaks take no row filter of their own")
    clustered = bool(runs) or (unique_periods and rolling)

    names = _Names(features, rolling)
    own_period = F.col(f"`{period}`") if period else None
    if period and not isinstance(panel.schema[period].dataType, T.IntegralType):
        own_period = own_period.cast("int")
    # Compared in the source's own type, so that the range reaches the scan.
    near = panel.where(_any_window(features, keep_range, own_period)) if period else panel
    columns = [
        *[F.col(f"`{c}`") for c in (*within, key)],
        *([own_period.cast("int").alias(PERIOD)] if period else []),
        *[as_number(F.col(f"`{c}`")).alias(n) for c, n in names.values.items()],
        *[
            F.coalesce(F.col(f"`{c}`") == F.lit(v), F.lit(False)).alias(n)
            for (c, v), n in names.categories.items()
        ],
        *[F.coalesce(predicate(w, panel.schema), F.lit(False)).alias(n) for w, n in names.filters.items()],
        *[F.col(f"`{c}`").alias(f"_own_{i}") for i, c in enumerate(carry)],
    ]
    known = F.col(f"`{key}`").isNotNull()
    marked = every_key and (rolling or clustered)
    rows = (panel if every_key and not marked else near).where(known).select(*columns)
    if period and marked:
        # One marker row per key, without a period, keeps the key alive.
        alive = panel.where(known).select(*[f"`{c}`" for c in (*within, key)]).distinct()
        rows = rows.unionByName(alive, allowMissingColumns=True)

    group, blocks = [*within, key], False
    if rolling:
        ranges = [(f.first_base, f.last_base) for f in features]
        ranges += [keep_range] if keep_range else []
        start, end = min(low for low, _ in ranges), max(high for _, high in ranges)
        longest = max(f.months for f in features)
        blocks = clustered and end - start >= block_length
        first = F.greatest(F.col(PERIOD), F.lit(start))
        last = F.least(F.col(PERIOD) + (longest - 1), F.lit(end))
        if every_key:
            alive = F.col(PERIOD).isNull()
            first = F.when(alive, F.lit(start)).otherwise(first)
            last = F.when(alive, F.lit(end)).otherwise(last)
        if blocks:
            numbers = F.sequence(
                F.floor((first - start) / block_length).cast("int"),
                F.floor((last - start) / block_length).cast("int"),
            )
            rows = rows.withColumn(BLOCK, F.explode(numbers))
            first = F.greatest(first, F.col(BLOCK) * block_length + start)
            last = F.least(last, F.col(BLOCK) * block_length + (start + block_length - 1))
            group = [*within, key, BLOCK]
    if clustered and (blocks or not (runs or keyed)):
        # Windows over the key bring their own exchange, if one is needed.
        rows = rows.repartition(*group)
    if runs:
        rows = add_run_marks(rows, group, PERIOD, runs, names.values)
    if rolling:
        rows = rows.withColumn(BASE, F.explode(F.sequence(first, last)))
        group = [*group, BASE]
        if edges is not None:
            # One row per base period: bounded by the range, so it is broadcast.
            rows = rows.join(F.broadcast(edges), BASE, "left")
    rows = rows.withColumns({n: F.expr(text) for text, n in names.windows.items()})

    others = [f for f in features if f not in medians]
    aggregates = [F.expr(f"{_aggregate(f, names, rolling)} AS `{f.name}`") for f in others]
    for i, c in enumerate(carry):
        own = f"{PERIOD} = {BASE} AND {BASE} BETWEEN {keep_range[0]} AND {keep_range[1]}"
        aggregates.append(F.expr(f"max(_own_{i}) FILTER (WHERE {own}) AS `{c}`"))
    result = rows.groupBy(*group).agg(*(aggregates or [F.count(F.lit(1)).alias("_rows")]))
    if medians and (unique_periods or hot_rows is None):
        found = _group_medians(rows, group, medians, names)
        result = result.join(found, group, "left") if aggregates else found
    elif medians:
        found = _medians(rows, group, medians, names, hot_rows)
        result = result.join(found, group, "left") if aggregates else found
    out_keys = [*within, key, BASE] if rolling else [*within, key]
    for found in _category_maps(panel.where(known), [*within, key], maps, rolling):
        result = result.join(found, out_keys, "left")
    return result.select(
        *[f"`{c}`" for c in (*out_keys, *carry)], *[f"`{f.name}`" for f in asked]
    )


def _category_maps(
    panel: DataFrame, keys: list[str], features: Sequence[Feature], rolling: bool
) -> Iterator[DataFrame]:
    """Per window of a column: (keys, base period) with maps of all its categories there.

    Rows are counted per key, period and category before they are copied to
    base periods, and a row of the result holds the categories that its own
    window has, so the number of categories of the whole column bounds nothing.
    """
    together: dict[Feature, list[Feature]] = {}
    for f in features:
        together.setdefault(replace(f, name="", func=None), []).append(f)
    groups = [F.col(f"`{k}`") for k in keys]
    for f, same in together.items():
        rows = panel.where(predicate(f.where, panel.schema)) if f.where else panel
        category = F.col(f"`{f.value}`").cast("string").alias("_category")
        if f.period:
            at = F.col(f"`{f.period}`").cast("int")
            rows = rows.where(_any_window([replace(f, kind=CATEGORY)], None, at))
            counted = rows.groupBy(*groups, at.alias(PERIOD), category).agg(F.count(F.lit(1)).alias("_rows"))
            bases = F.sequence(
                F.greatest(F.col(PERIOD), F.lit(f.first_base)),
                F.least(F.col(PERIOD) + (f.months - 1), F.lit(f.last_base)),
            )
            counted = counted.withColumn(BASE, F.explode(bases))
        else:
            counted = rows.groupBy(*groups, category).agg(F.count(F.lit(1)).alias("_rows"))
        by = [*groups, F.col(BASE)] if rolling and f.period else groups
        shares = counted.groupBy(*by, "_category").agg(F.sum("_rows").alias("_cnt"))
        named = F.when(F.col("_category").isNotNull(), F.struct("_category", "_cnt"))
        found = shares.groupBy(*by).agg(
            F.array_sort(F.collect_list(named)).alias("_entries"), F.sum("_cnt").alias("_total")
        )
        share = F.transform(
            "_entries", lambda e: F.struct(e["_category"], (e["_cnt"] / F.col("_total")).alias("pct"))
        )
        made = {"cnt_map": F.map_from_entries("_entries"), "pct_map": F.map_from_entries(share)}
        yield found.select(*by, *[made[g.func].alias(g.name) for g in same])


class _Names:
    """Columns that several features share, each computed once per row."""

    def __init__(self, features: Sequence[Feature], rolling: bool):
        self.rolling = rolling
        self.values: dict[str, str] = {}
        self.categories: dict[tuple[str, str], str] = {}
        self.filters: dict[str, str] = {}
        self.windows: dict[str, str] = {}
        for f in features:
            if f.where:
                self.filters.setdefault(f.where, f"_kept_{len(self.filters)}")
            if f.kind == CATEGORY:
                hit = (f.value, f.category)
                self.categories.setdefault(hit, f"_is_{len(self.categories)}")
            elif f.value and not (f.kind == STAT and f.func == "np.size"):
                self.values.setdefault(f.value, f"_value_{len(self.values)}")
        for f in features:
            self.windows.setdefault(self._inside(f), f"_in_{len(self.windows)}")

    def window(self, f: Feature) -> str:
        return self.windows[self._inside(f)]

    def base(self, f: Feature) -> str:
        return BASE if self.rolling else str(f.first_base)

    def _inside(self, f: Feature) -> str:
        """Condition: the row lies in the feature's TRAIL(N) at its base period."""
        terms = [self.filters[f.where]] if f.where else []
        if f.period:
            base = self.base(f)
            terms.append(f"{PERIOD} BETWEEN {base} - {f.months - 1} AND {base}")
            if f.rows_from is not None:
                terms.append(f"{PERIOD} BETWEEN {f.rows_from} AND {f.rows_to}")
            if self.rolling:
                terms.append(f"{BASE} BETWEEN {f.first_base} AND {f.last_base}")
        return f"coalesce({' AND '.join(terms)}, false)" if terms else "true"


def _any_window(
    features: Sequence[Feature], keep_range: tuple[int, int] | None, period: Column
) -> Column:
    """Rows that can count for some feature, as few range conditions as possible."""
    spans = {keep_range} if keep_range else set()
    for f in features:
        if f.period is None:
            return F.lit(True)
        low, high = f.first_base - f.months + 1, f.last_base
        if f.rows_from is not None:
            low, high = (
                (f.rows_from, f.rows_to)
                if f.kind == RISING_STREAK
                else (max(low, f.rows_from), min(high, f.rows_to))
            )
        if low <= high:
            spans.add((low, high))
    merged: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if merged and low <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(merged[-1][1], high))
        else:
            merged.append((low, high))
    ranges = [period.between(low, high) for low, high in merged]
    return reduce(lambda a, b: a | b, ranges) if ranges else F.lit(False)


def _count(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def double(number: float) -> str:
    """A double literal that keeps every bit."""
    return f"double('{float(number)!r}')"


def _aggregate(f: Feature, names: _Names, rolling: bool) -> str:
    inside = names.window(f)
    rows = _count(inside)
    if f.kind == PERIOD_RATIO:
        return _period_ratio(f, names)
    if f.kind in (STREAK, RISING_STREAK):
        run = longest_run(f, inside, names.base(f), PERIOD, names.values[f.value])
        if f.kind == STREAK:
            return run
        # Every key of the input counts 0 without a run.
        filled = f"coalesce({run}, 0L)"
        if rolling:
            return f"CASE WHEN {BASE} BETWEEN {f.first_base} AND {f.last_base} THEN {filled} END"
        if f.rows_from is not None:
            seen = _count(f"{PERIOD} BETWEEN {f.rows_from} AND {f.rows_to}")
            return f"CASE WHEN {seen} > 0 THEN {filled} END"
        return filled
    if f.kind == STAT:
        value = _stat(f, inside, rows, names)
    elif f.kind == CATEGORY:
        value = _count(f"{inside} AND {names.categories[f.value, f.category]}")
        value = f"{value} / {rows}" if f.func == "pct" else value
    elif f.kind in (LOC_BIN, VAL_BIN):
        value = f"{_count(f'{inside} AND {_above(f, names)}')} / {rows}"
    else:
        raise ValueError(f"{f.name}: kind {f.kind} is not a trailing feature")
    return f"CASE WHEN {rows} > 0 THEN {value} END"


def _stat(f: Feature, inside: str, rows: str, names: _Names) -> str:
    if f.func == "np.size":
        return rows
    v = names.values[f.value]
    only = f"FILTER (WHERE {inside})"
    match f.func:
        case "cnt_gt_0":
            return _count(f"{inside} AND {v} > 0")
        case "pct_gt_0":
            return f"{_count(f'{inside} AND {v} > 0')} / {rows}"
        case "np.sum":
            return f"coalesce(sum({v}) {only}, 0D)"
        case "np.min":
            return f"min({v}) {only}"
        case "np.max":
            return f"max({v}) {only}"
        case "np.average":
            # Unlike a mean, one null makes it null.
            return f"CASE WHEN count({v}) {only} = {rows} THEN avg({v}) {only} END"
        case "np.mean":
            return f"avg({v}) {only}"
        case "np.median":
            return f"median({v}) {only}"
        case "cnt_isna":
            return f"{rows} - count({v}) {only}"
        case "pct_isna":
            return f"({rows} - count({v}) {only}) / {rows}"
    if f.func in ADDED_FUNCS:
        return ADDED_FUNCS[f.func](v, only)
    raise ValueError(f"{f.name}: unknown statistic {f.func!r}; added ones are registered first")


def _period_ratio(f: Feature, names: _Names) -> str:
    """f over the latest periods of the window / f over its earliest ones."""
    base, inside, v = names.base(f), names.window(f), names.values[f.value]
    earliest = f.numerator_months if f.denominator_span == "numerator" else f.denominator_months

    def over(condition: str) -> str:
        only = f"FILTER (WHERE {inside} AND {condition})"
        match f.func:
            case "np.sum":
                return f"CASE WHEN count(*) {only} > 0 THEN coalesce(sum({v}) {only}, 0D) END"
            case "np.max":
                return f"max({v}) {only}"
            case "np.mean":
                return f"avg({v}) {only}"
        raise ValueError(f"{f.name}: unknown period function {f.func!r}")

    latest_part = over(f"{PERIOD} > {base} - {f.numerator_months}")
    earliest_part = over(f"{PERIOD} <= {base} - {f.months - earliest}")
    return f"try_divide({latest_part}, {earliest_part})"


def _above(f: Feature, names: _Names) -> str:
    v = names.values[f.value]
    if f.edge is not None:
        edge = f"get(`{f.edge[0]}`, {f.edge[1]})"
    elif f.threshold is None and f.bin_value is None:
        edge = "CAST(NULL AS DOUBLE)"  # a bin whose window had no value
    else:
        edge = double(f.threshold if f.threshold is not None else f.bin_value)
    return f"({v} IS NULL OR {v} >= {edge})" if f.null_is_above else f"{v} >= {edge}"


def _group_medians(
    rows: DataFrame, keys: list[str], features: Sequence[Feature], names: _Names
) -> DataFrame:
    """Medians of groups that fit a task.

    Kept apart from the other features, because one median turns the whole
    aggregate into an object aggregate, which costs more than this join.
    """
    return rows.groupBy(*keys).agg(
        *[F.expr(f"{_aggregate(f, names, names.rolling)} AS `{f.name}`") for f in features]
    )


def _medians(
    rows: DataFrame, keys: list[str], features: Sequence[Feature], names: _Names, hot_rows: int
) -> DataFrame:
    """Medians of groups of any size, one row per group of ``rows``.

    A median holds its group's values in memory, so groups over ``hot_rows``
    rows go through rank selection. Which ones these are is looked up first. A
    group without a value has no rank, so all groups are kept by a join.
    """
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    hot = sizes.where(F.col("_rows") > hot_rows).select(*keys)
    if hot.isEmpty():
        return _group_medians(rows, keys, features, names)
    small = rows.join(hot, keys, "left_anti")
    large = rows.join(hot, keys, "left_semi")
    found = _group_medians(small, keys, features, names).unionByName(
        _ranked_medians(large, keys, features, names)
    )
    return sizes.select(*keys).join(found, keys, "left")


def _ranked_medians(
    rows: DataFrame, keys: list[str], features: Sequence[Feature], names: _Names
) -> DataFrame:
    tagged = ", ".join(
        f"struct({i} AS median_id, CASE WHEN {names.window(f)} THEN {names.values[f.value]} END AS v)"
        for i, f in enumerate(features)
    )
    values = rows.select(*keys, F.expr(f"explode(array({tagged})) AS t")).select(*keys, "t.*")
    found = exact_medians(values, [*keys, "median_id"], "v")
    return found.groupBy(*keys).agg(
        *[
            F.expr(f"max(median) FILTER (WHERE median_id = {i}) AS `{f.name}`")
            for i, f in enumerate(features)
        ]
    )
