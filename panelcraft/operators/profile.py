"""Input checks: presence patterns and column profiles of whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcraft.functions.columns import as_number
from panelcraft.operators.ranks import exact_medians, middle_ranks, select_ranks, sketch

# Positions in the range [min, max] of a column, in percent.
RANGE_POINTS = (25, 50, 75, 90, 95)
_BITS = 62


def presence_pattern(panel: DataFrame, key: str, period: str, start: int, end: int) -> DataFrame:
    """Number of keys per presence string over periods start..end.

    One character per period in order: '0' present, '1' missing. Every key of
    the input counts, also one without a row in the range. Presence is kept as
    bit masks, so the aggregate stays in hash aggregation with fixed buffers.
    """
    spans = [(low, min(low + _BITS - 1, end)) for low in range(start, end + 1, _BITS)]
    p = F.col(period).cast("int")
    masks = (
        panel.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            *[
                F.bit_or(
                    F.when(p.between(low, high), F.call_function("shiftleft", F.lit(1).cast("long"), p - low))
                    .otherwise(F.lit(0).cast("long"))
                ).alias(f"_mask_{i}")
                for i, (low, high) in enumerate(spans)
            ]
        )
    )
    text = F.concat(
        *[
            F.translate(
                F.reverse(F.lpad(F.bin(f"_mask_{i}"), high - low + 1, "0")), "01", "10"
            )
            for i, (low, high) in enumerate(spans)
        ]
    )
    return (
        masks.groupBy(text.alias("month_str"))
        .agg(F.count(F.lit(1)).alias("month_str_count"))
        .orderBy(F.desc("month_str_count"), "month_str")
    )


def _number(name: str) -> Column:
    return as_number(F.col(f"`{name}`"))


def _long_form(columns: Sequence[str], fields: Sequence[str]) -> Column:
    """Turn one row with ``{field}_{i}`` columns into one row per column."""
    return F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("var_name"), *[F.col(f"{f}_{i}").alias(f) for f in fields]
                )
                for i, c in enumerate(columns)
            ]
        )
    )


def numeric_profile(df: DataFrame, columns: Sequence[str], *, ranges: bool = False) -> DataFrame:
    """cnt, sum, min, max, avg, med, cnt_isna, pct_isna: one row per column.

    With ``ranges`` also what ``range_profile`` gives. Two passes make all of
    it: the second counts around the medians and range points that the first found.
    """
    columns = list(columns)
    fields = ("cnt", "sum", "min", "max", "avg", "cnt_isna", "pct_isna", "_sketch", "_n")
    aggregates = []
    rows = F.count(F.lit(1))
    for i, c in enumerate(columns):
        v = _number(c)
        missing = rows - F.count(v)
        for field, value in zip(
            fields,
            (
                rows,
                F.coalesce(F.sum(v), F.lit(0.0)),
                F.min(v),
                F.max(v),
                F.avg(v),
                missing,
                F.coalesce(safe_share(missing, rows), F.lit(0.0)),
                sketch(v),
                F.count(v),
            ),
            strict=True,
        ):
            aggregates.append(value.alias(f"{field}_{i}"))
    # One row, whose sketches bracket the medians for the second pass.
    whole = df.agg(*aggregates)
    whole = df.sparkSession.createDataFrame(whole.collect(), whole.schema)
    stats = whole.select(_long_form(columns, fields).alias("s")).select("s.*")
    values = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("var_name"), _number(c).alias("v")) for c in columns])
        ).alias("t")
    ).select("t.*")
    names = ["var_name", "cnt", "cnt_isna", "pct_isna", "sum", "min", "max", "avg", "med"]
    points = {}
    if ranges:
        points = {
            (r["var_name"], q): (q / 100) * (r["max"] - r["min"]) + r["min"]
            for r in stats.select("var_name", "min", "max").collect()
            for q in RANGE_POINTS
            if r["min"] is not None
        }
        names += [f"P{q}_num" for q in RANGE_POINTS] + [f"P{q}_pct" for q in RANGE_POINTS]
    below = None
    sketched = stats.select("var_name", "_sketch", "_n")
    if points:
        rows = [(c, q, x) for (c, q), x in points.items()]
        thresholds = df.sparkSession.createDataFrame(rows, "var_name string, name int, point double")
        ranked, below = select_ranks(
            values, ["var_name"], "v", middle_ranks, few_groups=True, sketched=sketched, thresholds=thresholds
        )
        medians = ranked.groupBy("var_name").agg(F.avg("value").alias("med"))
        below = below.groupBy("var_name").agg(
            *[F.max(F.when(F.col("name") == q, F.col("below"))).alias(f"_below_{q}") for q in RANGE_POINTS]
        )
    else:
        medians = exact_medians(values, ["var_name"], "v", few_groups=True, sketched=sketched)
        medians = medians.withColumnRenamed("median", "med")
    found = stats.join(medians, "var_name", "left")
    if below is not None:
        found = found.join(below, "var_name", "left")
    for q in RANGE_POINTS if ranges else ():
        edge = F.lit(None).cast("double")
        for c in columns:
            edge = F.when(F.col("var_name") == c, F.lit(points.get((c, q))).cast("double")).otherwise(edge)
        less = F.coalesce(F.col(f"_below_{q}"), F.lit(0)) if points else F.lit(0)
        found = found.withColumn(f"P{q}_num", edge).withColumn(
            f"P{q}_pct", safe_share(F.col("cnt") - less, F.col("cnt"))
        )
    return found.select(*names)


def safe_share(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def range_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P{q}_num = min + q% of (max - min), and P{q}_pct = share of rows at or above.

    Null values count as above every point. The bounds are one row, looked up
    first, so that counting is a single pass with constant thresholds.
    """
    columns = list(columns)
    bounds = df.agg(
        *[F.min(_number(c)).alias(f"low_{i}") for i, c in enumerate(columns)],
        *[F.max(_number(c)).alias(f"high_{i}") for i, c in enumerate(columns)],
    ).first()
    edges = {}
    for i in range(len(columns)):
        low, high = bounds[f"low_{i}"], bounds[f"high_{i}"]
        for q in RANGE_POINTS:
            point = None if low is None else (q / 100) * (high - low) + low
            edges[f"P{q}_num_{i}"] = F.lit(point).cast("double")
    fields = [f"P{q}_num" for q in RANGE_POINTS] + [f"P{q}_pct" for q in RANGE_POINTS]
    shares = df.agg(
        *[
            safe_share(
                F.count(F.when(_number(c).isNull() | (_number(c) >= edges[f"P{q}_num_{i}"]), 1)),
                F.count(F.lit(1)),
            ).alias(f"P{q}_pct_{i}")
            for i, c in enumerate(columns)
            for q in RANGE_POINTS
        ]
    )
    with_edges = shares.withColumns(
        {f"P{q}_num_{i}": edges[f"P{q}_num_{i}"] for i in range(len(columns)) for q in RANGE_POINTS}
    )
    return with_edges.select(_long_form(columns, fields).alias("s")).select("s.*")


def category_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """cnt and pct of every value of each column, always including null."""
    columns = list(columns)

    def values(weight: int, value) -> Column:
        return F.array(
            *[
                F.struct(
                    F.lit(c).alias("var_name"),
                    value(c).alias("var_value"),
                    F.lit(weight).cast("long").alias("weight"),
                )
                for c in columns
            ]
        )

    found = df.select(F.explode(values(1, lambda c: F.col(f"`{c}`").cast("string"))).alias("t"))
    # One zero-weight row per column makes the null value appear even if unused.
    always = df.sparkSession.range(1).select(
        F.explode(values(0, lambda c: F.lit(None).cast("string"))).alias("t")
    )
    total = df.agg(F.count(F.lit(1))).scalar()
    return (
        found.unionByName(always)
        .select("t.*")
        .groupBy("var_name", "var_value")
        .agg(F.sum("weight").alias("cnt"))
        .withColumn("pct", F.coalesce(safe_share(F.col("cnt"), total), F.lit(0.0)))
    )


def presence_grid(panel: DataFrame, key: str, period: str, start: int, end: int) -> DataFrame:
    """Every key with every period start..end, and '1' in ``missing`` if absent.

    The pairs come from the key's own presence mask: neither a cross join nor a
    join back to the panel is needed.
    """
    p = F.col(period).cast("int")
    present = (
        panel.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.collect_set(F.when(p.between(start, end), p)).alias("_periods"))
    )
    grid = present.select(key, F.explode(F.sequence(F.lit(start), F.lit(end))).alias(period), "_periods")
    return grid.select(
        key,
        period,
        (~F.array_contains("_periods", F.col(period))).cast("int").cast("string").alias("missing"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value, most frequent first (ties by value)."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.desc("cnt"), column)
    )
