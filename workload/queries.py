"""Registered queries: every operator and job over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcraft.functions.columns import as_number, keyword_flag, predicate
from panelcraft.operators.bins import bin_shares, threshold_share
from panelcraft.operators.categories import category_shares, category_shares_long
from panelcraft.operators.keywords import match_keywords
from panelcraft.operators.pick import pick_extremes
from panelcraft.operators.profile import (
    category_profile,
    numeric_profile,
    presence_grid,
    presence_pattern,
    range_profile,
    value_counts,
)
from panelcraft.operators.quality import duplicate_keys
from panelcraft.operators.ratios import add_ratios, combination_ratios
from panelcraft.operators.status import STATUS_ORDER, worst_status
from panelcraft.operators.trailing import trailing_features
from panelcraft.plans.check import check
from panelcraft.plans.config import Blocks, Source
from panelcraft.plans.discover import discover, filtered
from panelcraft.plans.replay import replay
from panelcraft.session import materialize, shared_folder
from panelcraft.sources.dictionary import dictionary_frame, read_dictionary, write_dictionary
from panelcraft.sources.documents import explode_rows, read_documents, row_array
from panelcraft.sources.tables import read_panel, store_panel, write_features
from panelcraft.spec import (
    CATEGORY,
    EXPRESSION,
    LOC_BIN,
    PERIOD_RATIO,
    RATIO,
    RISING_STREAK,
    STAT,
    STAT_FUNCS,
    STREAK,
    VAL_BIN,
    Feature,
    numbered,
    period_ratio_features,
    register_statistic,
    stat_features,
)
from panelcraft.streaming.online import Step, online_features, start_online
from workload.panels import customer_month, table, user_day

KEY, DAY = "user_id", "day"
FIRST, LAST = 7, 12

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- panels and the row layer ------------------------------------------------


@query
def panel_user_day(spark, sf_dir):
    return user_day(spark, sf_dir)


@query
def panel_filter(spark, sf_dir):
    panel = user_day(spark, sf_dir)
    return panel.where(F.col(DAY).between(5, 20)).where(predicate("day > 6 and amt1 >= 2"))


@query
def combo_ratio(spark, sf_dir):
    _, rows = combination_ratios(
        user_day(spark, sf_dir), KEY, DAY, ["amt2", "amt3", "amt4"], 3, period_span=(1, 31)
    )
    return rows.drop("cat")


@query
def panel_filter_nulls(spark, sf_dir):
    """A missing value satisfies != and negated comparisons."""
    text = "amt2 != 0 and not amt2 > 5000 and 3 < day <= 20 and cat in ['click', 'view', 'purchase']"
    return user_day(spark, sf_dir).where(predicate(text))


@query
def panel_filter_types(spark, sf_dir):
    """Text against numbers: text that spells no number differs from all of them."""
    number = F.when(F.col("event_id") % 3 == 0, F.get_json_object("props", "$.k"))
    tag = F.when(number.isNotNull(), number).otherwise(F.col("event_type"))
    rows = table(spark, sf_dir, "events").select("event_id", tag.alias("tag"))
    return rows.where(predicate("tag != 50 and not tag > 80 and tag not in [7, 'click']", rows.schema))


@query
def combo_ratio_long_history(spark, sf_dir):
    """Histories cut into short stretches; N is longer than half of one."""
    features = [
        Feature("order_share", RATIO, "o_custkey", "month", months=3,
                numerator=("orders",), denominator=("orders", "cents")),
        Feature("own", RATIO, "o_custkey", "month", months=1,
                numerator=("orders",), denominator=("orders", "cents")),
    ]
    return add_ratios(customer_month(spark, sf_dir), features, longest_history=4)


@query
def combo_ratio_named(spark, sf_dir):
    ratio = Feature(
        "share_of_three", RATIO, KEY, DAY, months=2,
        numerator=("amt2", "amt3"), denominator=("amt2", "amt3", "amt4"),
    )
    rows = add_ratios(user_day(spark, sf_dir), [ratio], period_span=(1, 31))
    return rows.select(KEY, DAY, "share_of_three")


# --- trailing windows --------------------------------------------------------


def _stats(value: str, months: int | None, period: str | None = DAY) -> list[Feature]:
    names = (func.replace("np.", "") for func in STAT_FUNCS)
    return stat_features(KEY, period, value, months, names)


@query
def trailing_stats(spark, sf_dir):
    features = [f.at(LAST) for f in _stats("amt2", 3)]
    return trailing_features(user_day(spark, sf_dir), features, unique_periods=True)


@query
def trailing_stats_rolling(spark, sf_dir):
    features = [f.at(FIRST, LAST) for f in _stats("amt2", 3)]
    return trailing_features(user_day(spark, sf_dir), features, unique_periods=True)


@query
def trailing_stats_events(spark, sf_dir):
    """Many rows per (key, period): straight from the events, no panel first."""
    events = table(spark, sf_dir, "events").select(
        KEY,
        (F.datediff("ts", F.lit("2024-01-01").cast("date")) + 1).alias(DAY),
        F.round(F.col("value") * 100).alias("cents"),
    )
    return trailing_features(events, [f.at(FIRST, LAST) for f in _stats("cents", 3)])


@query
def trailing_stats_no_period(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        KEY, F.round(F.col("value") * 100).alias("cents")
    )
    return trailing_features(events, _stats("cents", None, None))


@query
def trailing_many_windows(spark, sf_dir):
    """Several values and window lengths in one aggregate."""
    names = (
        f"{func}_{value}_{months}"
        for value in ("amt2", "amt3", "amt4")
        for months in (1, 3, 6)
        for func in ("sum", "max", "rows")
    )
    features = [
        f.at(FIRST, LAST)
        for value in ("amt2", "amt3", "amt4")
        for months in (1, 3, 6)
        for f in stat_features(KEY, DAY, value, months, names, ("np.sum", "np.max", "np.size"))
    ]
    return trailing_features(user_day(spark, sf_dir), features, unique_periods=True)


@query
def trailing_medians_only_hot(spark, sf_dir):
    """Medians alone, by rank selection for all groups of over two rows."""
    features = [Feature("mid", STAT, KEY, DAY, "amt4", 6, "np.median").at(FIRST, LAST)]
    return trailing_features(user_day(spark, sf_dir), features, hot_rows=2)


@query
def period_ratio(spark, sf_dir):
    features = [f.at(LAST) for f in period_ratio_features(KEY, DAY, "amt2", 12, numbered())]
    return trailing_features(user_day(spark, sf_dir), features, unique_periods=True)


@query
def period_ratio_rolling(spark, sf_dir):
    features = [
        f.at(FIRST, LAST) for f in period_ratio_features(KEY, DAY, "amt2", 6, numbered())
    ]
    return trailing_features(user_day(spark, sf_dir), features, unique_periods=True)


def _runs(kind: str, first: int, last: int, threshold: float = 3000.0) -> list[Feature]:
    return [Feature("run", kind, KEY, DAY, "amt2", 6, threshold=threshold).at(first, last)]


@query
def streak_above(spark, sf_dir):
    return trailing_features(user_day(spark, sf_dir), _runs(STREAK, LAST, LAST))


@query
def streak_above_rolling(spark, sf_dir):
    return trailing_features(user_day(spark, sf_dir), _runs(STREAK, FIRST, LAST))


@query
def streak_increasing(spark, sf_dir):
    return trailing_features(user_day(spark, sf_dir), _runs(RISING_STREAK, LAST, LAST))


@query
def streak_increasing_rolling(spark, sf_dir):
    return trailing_features(user_day(spark, sf_dir), _runs(RISING_STREAK, FIRST, LAST))


@query
def streak_increasing_months(spark, sf_dir):
    """Longest rise of order value within 24 months, for every month of a long range."""
    run = Feature("run", RISING_STREAK, "o_custkey", "month", "cents", 24, threshold=0.0)
    return trailing_features(
        customer_month(spark, sf_dir), [run.at(23952, 23999)], block_length=16
    )


# --- bins and categories -----------------------------------------------------


@query
def loc_bins(spark, sf_dir):
    return bin_shares(
        user_day(spark, sf_dir), KEY, DAY, "amt2", 6, 8, LAST, unique_periods=True
    )


@query
def loc_bins_rolling(spark, sf_dir):
    return bin_shares(
        user_day(spark, sf_dir), KEY, DAY, "amt2", 6, 8, FIRST, LAST, unique_periods=True
    )


@query
def val_bins(spark, sf_dir):
    return bin_shares(
        user_day(spark, sf_dir), KEY, DAY, "amt2", 6, 8, LAST, kind=VAL_BIN, unique_periods=True
    )


@query
def val_bins_rolling(spark, sf_dir):
    return bin_shares(
        user_day(spark, sf_dir), KEY, DAY, "amt2", 6, 8, FIRST, LAST,
        kind=VAL_BIN, unique_periods=True,
    )


@query
def bin_named(spark, sf_dir):
    return threshold_share(
        user_day(spark, sf_dir), KEY, DAY, "amt2", 6, 3000.0, FIRST, LAST, unique_periods=True
    )


@query
def category_share(spark, sf_dir):
    return category_shares(user_day(spark, sf_dir), KEY, DAY, "cat", 6, LAST)[1]


@query
def category_share_rolling(spark, sf_dir):
    _, table_ = category_shares(
        user_day(spark, sf_dir), KEY, DAY, "cat", 6, FIRST, LAST, unique_periods=True
    )
    return table_


@query
def category_share_long(spark, sf_dir):
    """A column with as many values as the table has customers."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderpriority",
        F.month("o_orderdate").alias("month"),
        F.col("o_custkey").cast("string").alias("customer"),
    )
    return category_shares_long(orders, "o_orderpriority", "month", "customer", 3, 6, 9)


@query
def category_named(spark, sf_dir):
    features = [
        Feature(f"purchase_{func}", CATEGORY, KEY, DAY, "cat", 6, func, category="purchase").at(LAST)
        for func in ("cnt", "pct")
    ]
    return trailing_features(user_day(spark, sf_dir), features)


# --- input checks ------------------------------------------------------------


@query
def presence_pattern_days(spark, sf_dir):
    return presence_pattern(user_day(spark, sf_dir), KEY, DAY, 1, 30)


@query
def presence_pattern_months(spark, sf_dir):
    """A range of more periods than one bit mask holds."""
    return presence_pattern(customer_month(spark, sf_dir), "o_custkey", "month", 23941, 24024)


@query
def presence_flags(spark, sf_dir):
    return presence_grid(user_day(spark, sf_dir), KEY, DAY, FIRST, LAST)


@query
def numeric_profile_lineitem(spark, sf_dir):
    profile = numeric_profile(
        table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_linenumber"]
    )
    return profile.withColumns({"sum": F.round("sum", 1), "avg": F.round("avg", 4)})


@query
def range_profile_lineitem(spark, sf_dir):
    return range_profile(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"])


@query
def range_profile_nulls(spark, sf_dir):
    return range_profile(user_day(spark, sf_dir), ["amt2", "amt3"])


@query
def category_profile_lineitem(spark, sf_dir):
    return category_profile(
        table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"]
    )


@query
def value_frequency(spark, sf_dir):
    return value_counts(table(spark, sf_dir, "documents"), "source")


@query
def assert_unique(spark, sf_dir):
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def check_report(spark: SparkSession, sf_dir: str):
    """Both panels checked, as the data-check job reports them."""
    panels = {
        "user_day": stored_user_day(spark, sf_dir),
        "customer_month": materialize(customer_month(spark, sf_dir)),
    }
    meta = [
        {"filename": name, "var_name": column, "var_type": kind}
        for name, column, kind in (
            ("user_day", "day", "Numbers"),
            ("user_day", "amt1", "Numbers"),
            ("user_day", "amt2", "Numbers"),
            ("user_day", "cat", "String"),
            ("customer_month", "orders", "Numbers"),
        )
    ]
    sources = [
        Source("user_day", KEY, DAY, 1, 10),
        Source("customer_month", "o_custkey", "month", 23953, 23964),
    ]
    return check(panels, meta, sources)


@query
def data_check(spark, sf_dir):
    report = check_report(spark, sf_dir)
    measures = [c for c in report.numbers.columns if c not in ("filename", "var_name")]
    numbers = report.numbers.select(
        "filename",
        F.lit("number").alias("section"),
        "var_name",
        F.explode(
            F.array(*[F.struct(F.lit(m).alias("item"), F.col(m).cast("double").alias("amount")) for m in measures])
        ).alias("m"),
    ).select("filename", "section", "var_name", "m.item", F.round("m.amount", 6).alias("amount"))
    presence = report.presence.select(
        "filename",
        F.lit("presence").alias("section"),
        F.lit(None).cast("string").alias("var_name"),
        F.col("month_str").alias("item"),
        F.col("month_str_count").cast("double").alias("amount"),
    )
    categories = report.categories.select(
        "filename",
        F.lit("category").alias("section"),
        "var_name",
        F.col("var_value").alias("item"),
        F.round("pct", 6).alias("amount"),
    )
    return presence.unionByName(numbers).unionByName(categories)


# --- row picking, keywords, status ------------------------------------------


@query
def pick_extreme_rows(spark, sf_dir):
    return pick_extremes(
        table(spark, sf_dir, "orders"), ["o_custkey"], "o_totalprice", ["min", "max"],
        ["o_orderkey", "o_orderpriority"], tie_break=["o_orderkey"],
    )


@query
def pick_latest_event(spark, sf_dir):
    return pick_extremes(
        table(spark, sf_dir, "events"), [KEY, "event_type"], "ts", ["max"],
        ["event_id", "value"], tie_break=["event_id"],
    )


@query
def keyword_match(spark, sf_dir):
    name = F.col("p_name")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        keyword_flag(name, ["red widget", "blue bolt"]).alias("is_word"),
        keyword_flag(name, ["ring", "bolt"], "contain").alias("has_word"),
        keyword_flag(name, ["a small ring box", "red widgets"], "contained").alias("in_word"),
    )


@query
def keyword_match_text(spark, sf_dir):
    words = ["the", "entre", "license", "password"]
    return table(spark, sf_dir, "documents").select(
        "doc_id", keyword_flag(F.col("text"), words, "contain").alias("has_word")
    )


@query
def keyword_match_large(spark, sf_dir):
    """Values against a table of words: one per order, 15,000 at sf0.01."""
    words = table(spark, sf_dir, "orders").select(
        F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 5).alias("word")
    )
    line = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.md5(line).alias("code"),
        F.substring(F.md5(line), 1, 3).alias("short"),
        F.substring(F.md5(line), 1, 5).alias("start"),
    )
    rows = match_keywords(rows, "start", words, "word", "equal", "is_word")
    rows = match_keywords(rows, "code", words, "word", "contain", "has_word")
    rows = match_keywords(rows, "short", words, "word", "contained", "in_word")
    return rows.drop("code", "short", "start")


def order_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A status string per order, read as the account history of its customer."""
    digits = (F.col("o_orderkey") * 7919 + 104729).cast("string")
    return table(spark, sf_dir, "orders").select(
        "o_custkey", F.translate(digits, "0123456789", "N1234567*?").alias("status")
    )


@query
def worst_status_summary(spark, sf_dir):
    return worst_status(order_statuses(spark, sf_dir), "o_custkey", "status")


@query
def worst_status_codes(spark, sf_dir):
    """Accounts whose histories hold all fifteen codes."""
    place = (F.col("o_orderkey") * 7 + F.col("o_custkey")) % 15
    codes = F.concat(*[F.substring(F.lit(STATUS_ORDER), ((place + k * k) % 15 + 1).cast("int"), F.lit(1)) for k in range(6)])
    accounts = table(spark, sf_dir, "orders").select("o_custkey", codes.alias("status"))
    return worst_status(accounts, "o_custkey", "status")


# --- jobs --------------------------------------------------------------------

SOURCE = Source("user_day", KEY, DAY, 3, 14, "day > 3", ("amt1",))


def _row(**cells) -> dict:
    return {"datasource": "user_day", "month_start": str(FIRST), "month_end": str(LAST), **cells}


BLOCKS = Blocks(
    ratios=[_row(var_combinations="amt2, amt3, amt4", month_combinations="1,3")],
    stats=[_row(var_name="amt2", month_combinations="1, 3"), _row(var_name="amt3", month_combinations="4")],
    streaks=[
        _row(var_name="amt2", month_combinations="3,6", continue_show_or_inc="show", threshold_value="3000"),
        _row(var_name="amt3", month_combinations="6", continue_show_or_inc="inc", threshold_value="1000"),
        _row(var_name="var_7", month_combinations="3", continue_show_or_inc="show", threshold_value="0.2"),
    ],
    bins=[
        _row(var_name="amt2", month_combinations="3", bin_by_loc="4", bin_by_val=None),
        _row(var_name="amt4", month_combinations="3,6", bin_by_loc=None, bin_by_val="3"),
    ],
    categories=[_row(var_name="cat", month_combinations="5,6")],
)


def stored_user_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived panel as a stored table, for jobs that read it several times."""
    return materialize(user_day(spark, sf_dir))


@query
def discover_features(spark, sf_dir):
    return discover(stored_user_day(spark, sf_dir), SOURCE, BLOCKS).table


@query
def discover_rolling(spark, sf_dir):
    return discover(stored_user_day(spark, sf_dir), SOURCE, BLOCKS, rolling=True).table


WHERE_BLOCKS = Blocks(
    stats=[_row(var_name="amt2", month_combinations="3", where="amt3 > 1000 or cat == 'view'")],
    bins=[_row(var_name="amt2", month_combinations="6", bin_by_loc=None, bin_by_val="3")],
)


@query
def replay_of_discovered(spark, sf_dir):
    """Discovered with a row filter, its dictionary written, read and replayed."""
    panel = filtered(stored_user_day(spark, sf_dir), SOURCE)
    found = discover(panel, replace(SOURCE, exclude=()), WHERE_BLOCKS)
    path = f"{shared_folder(spark)}/dictionary-{uuid.uuid4().hex}"
    write_dictionary(spark, found.features, path)
    return replay(panel, read_dictionary(spark, path), LAST)


@query
def discover_dictionary(spark, sf_dir):
    """The feature dictionary of a discovery run, thresholds included."""
    found = discover(stored_user_day(spark, sf_dir), SOURCE, BLOCKS)
    return dictionary_frame(spark, found.features).select(
        "var_name", "module", "N_Months", "value_column", "func_name", "bin_value", "category_value"
    )


REPLAYED = [
    Feature("pct", RATIO, KEY, DAY, months=3, numerator=("amt2",), denominator=("amt2", "amt3")),
    Feature("total", STAT, KEY, DAY, "amt2", 6, "np.sum"),
    Feature("best", STAT, KEY, DAY, "amt2", 6, "np.max"),
    Feature("mid", STAT, KEY, DAY, "amt3", 6, "np.median"),
    Feature("pct_run", STREAK, KEY, DAY, "pct", 6, threshold=0.3),
    Feature("rise", RISING_STREAK, KEY, DAY, "amt2", 6, threshold=1000.0),
    Feature("trend", PERIOD_RATIO, KEY, DAY, "amt2", 6, "np.mean", numerator_months=2, denominator_months=3),
    Feature("high", LOC_BIN, KEY, DAY, "amt2", 6, bins=4, bin_value=5000.0, null_is_above=True),
    Feature("over", VAL_BIN, KEY, DAY, "amt2", 6, threshold=5000.0),
    Feature("clicks", CATEGORY, KEY, DAY, "cat", 6, "pct", category="click"),
    Feature("spread", EXPRESSION, KEY, expression='df["best"] / (df["total"] + 1) - 0.5'),
]


@query
def discover_many_categories(spark, sf_dir):
    """A column with more categories than columns can hold: one map per row, replayed from a file."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderpriority",
        (F.year("o_orderdate") * 12 + F.month("o_orderdate") - 23_940).cast("int").alias("month"),
        F.col("o_custkey").cast("string").alias("customer"),
    )
    source = Source("orders", "o_orderpriority", "month", 1, 200)
    row = _row(datasource="orders", var_name="customer", month_end="36", month_combinations="24")
    found = discover(
        orders, source, Blocks([], [], [], [], [row]), unique_periods=False, max_categories=20
    )
    path = f"{shared_folder(spark)}/maps-{uuid.uuid4().hex}"
    write_dictionary(spark, found.features, path)
    again = replay(orders, read_dictionary(spark, path), 36, unique_periods=False)

    def text(name: str) -> Column:
        entry = lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))
        return F.array_join(F.transform(F.array_sort(F.map_entries(name)), entry), ",")

    replayed = again.select("o_orderpriority", text("var_1").alias("replayed"))
    return found.table.select(
        "o_orderpriority",
        text("var_1").alias("counts"),
        F.round(F.aggregate(F.map_values("var_2"), F.lit(0.0), lambda a, x: a + x), 6).alias("whole"),
        F.array_max(F.map_values("var_2")).alias("largest"),
    ).join(replayed, "o_orderpriority")


@query
def custom_statistic(spark, sf_dir):
    """Statistics that are not the library's own, recorded in a dictionary and replayed from its file."""
    register_statistic("spread", lambda v, only: f"max({v}) {only} - min({v}) {only}")
    register_statistic("squares", lambda v, only: f"sum({v} * {v}) {only}")
    features = [
        Feature("spread_amt2", STAT, KEY, DAY, "amt2", 6, "spread"),
        Feature("squares_amt1", STAT, KEY, DAY, "amt1", 3, "squares"),
        Feature("size", STAT, KEY, DAY, "amt2", 6, "np.size"),
        Feature("mixed", EXPRESSION, KEY, expression='df["spread_amt2"] / df["size"]'),
    ]
    path = f"{shared_folder(spark)}/added-{uuid.uuid4().hex}"
    write_dictionary(spark, features, path)
    return replay(user_day(spark, sf_dir), read_dictionary(spark, path), LAST)


@query
def stored_panel_features(spark, sf_dir):
    """Rolling features from a stored panel: only its periods are read, and nothing is shuffled by key."""
    name = f"panel_{uuid.uuid4().hex}"
    panel = store_panel(user_day(spark, sf_dir), name, KEY, DAY, buckets=8)
    features = [
        Feature("total", STAT, KEY, DAY, "amt2", 3, "np.sum").at(FIRST, LAST),
        Feature("n_rows", STAT, KEY, DAY, "amt2", 6, "np.size").at(FIRST, LAST),
        Feature("run", STREAK, KEY, DAY, "amt2", 6, threshold=3000.0).at(FIRST, LAST),
    ]
    return trailing_features(panel, features, unique_periods=True, keyed=True)


@query
def replay_features(spark, sf_dir):
    return replay(user_day(spark, sf_dir), REPLAYED, LAST, period_span=(1, 31))


@query
def custom_expr(spark, sf_dir):
    features = [
        Feature("total", STAT, KEY, DAY, "amt2", 6, "np.sum"),
        Feature("size", STAT, KEY, DAY, "amt2", 6, "np.size"),
        Feature("mean_all", EXPRESSION, KEY, expression='df["total"]/df["size"]'),
        Feature("twice", EXPRESSION, KEY, expression='2*df["mean_all"] + df["size"]'),
    ]
    return replay(user_day(spark, sf_dir), features, LAST)


@query
def custom_expr_large(spark, sf_dir):
    """Whole division of doubles beyond the 64-bit integers."""
    features = [
        Feature("best", STAT, KEY, DAY, "amt2", 6, "np.max"),
        Feature("size", STAT, KEY, DAY, "amt2", 6, "np.size"),
        Feature("huge", EXPRESSION, KEY, expression='(df["best"] * 100000000000000000000.0) // 1'),
        Feature("low", EXPRESSION, KEY, expression='(df["size"] * -90000000000000000000000.0) // 0.5'),
        Feature("parts", EXPRESSION, KEY, expression='(df["best"] - 5000) // 7'),
    ]
    return replay(user_day(spark, sf_dir), features, LAST)


@query
def custom_expr_more(spark, sf_dir):
    """Remainders of negative numbers, whole division, comparisons and filled nulls."""
    features = [
        Feature("total", STAT, KEY, DAY, "amt2", 6, "np.sum"),
        Feature("best", STAT, KEY, DAY, "amt2", 6, "np.max"),
        Feature("size", STAT, KEY, DAY, "amt2", 6, "np.size"),
        Feature("rest", EXPRESSION, KEY, expression='(7 - df["total"]) % 360'),
        Feature("back", EXPRESSION, KEY, expression='df["total"] % -360'),
        Feature("whole", EXPRESSION, KEY, expression='(7 - df["total"]) // df["size"]'),
        Feature("large", EXPRESSION, KEY, expression='(df["best"] > 5000) + (df["best"] != 0)'),
        Feature("filled", EXPRESSION, KEY, expression='df["best"].fillna(-1) * 2'),
    ]
    return replay(user_day(spark, sf_dir), features, LAST)


# --- JSON requests -----------------------------------------------------------


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON request per event; errors lack a step, large values a number."""
    number = F.when(F.col("value") >= 200, F.lit("n/a")).otherwise(
        F.round(F.col("value") * 100).cast("long").cast("string")
    )
    step = F.when(F.col("event_type") != "error", F.lit("201"))
    row = lambda **fields: F.struct(*[v.alias(k) for k, v in fields.items()])
    data = F.array(
        row(case_id=F.col("event_id").cast("string"), some_number=F.get_json_object("props", "$.k"),
            event=F.struct(F.col("event_type").alias("type"))),
        row(case_id=number, some_number=F.lit(None).cast("string"),
            event=F.struct(F.lit(None).cast("string").alias("type"))),
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("request_id"),
        F.to_json(
            F.struct(
                F.lit("10000").alias("code"),
                step.alias("workflow_step"),
                F.col(KEY).cast("string").alias("seqNo"),
                data.alias("data"),
            )
        ).alias("document"),
    )


STEP = Step(
    "201", "$.data[*]", "seqNo", "$.seqNo",
    (
        Feature("var_22", STAT, "seqNo", None, "case_id", None, "np.sum"),
        Feature("var_23", STAT, "seqNo", None, "case_id", None, "np.max"),
        Feature("var_24", STAT, "seqNo", None, "some_number", None, "cnt_isna"),
        Feature("var_25", STAT, "seqNo", None, "event.type", None, "np.size"),
        Feature("var_26", CATEGORY, "seqNo", None, "event.type", None, "pct", category="click"),
        Feature("var_31", EXPRESSION, "seqNo", expression='df["var_22"]+df["var_25"]'),
    ),
)


@query
def json_explode_features(spark, sf_dir):
    fields = ["case_id", "some_number", "event.type"]
    rows = explode_rows(
        requests(spark, sf_dir),
        row_array(F.col("document"), "$.data[*]", fields),
        fields,
        keep=("request_id",),
    )
    return rows.withColumnRenamed("event.type", "event_type")


@query
def json_nested_rows(spark, sf_dir):
    """Rows of arrays inside arrays: every third request has an element without them."""
    item = lambda n: F.struct(
        n.cast("string").alias("case_id"), F.struct(F.col("event_type").alias("type")).alias("event")
    )
    some = F.array(item(F.col("event_id")), item(F.col("event_id") * 10))
    lists = F.array(some, F.when(F.col("event_id") % 3 != 0, F.array(item(F.col("event_id") + 1))))
    data = F.transform(lists, lambda x: F.struct(F.struct(x.alias("items")).alias("info")))
    documents = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("request_id"), F.to_json(F.struct(data.alias("data"))).alias("document")
    )
    fields = ["case_id", "event.type"]
    rows = row_array(F.col("document"), "$.data[*].info.items[*]", fields)
    return explode_rows(documents, rows, fields, keep=("request_id",)).withColumnRenamed("event.type", "event_type")


@query
def online_requests(spark, sf_dir):
    return online_features(requests(spark, sf_dir), [STEP], LAST)[0]["201"]


@query
def online_rejects(spark, sf_dir):
    return online_features(requests(spark, sf_dir), [STEP], LAST)[1]


@query
def online_repeated_requests(spark, sf_dir):
    """Every document comes twice, and ten ids are shared by all requests."""
    shared = requests(spark, sf_dir).withColumn(
        "request_id", (F.col("request_id").cast("long") % 10).cast("string")
    )
    return online_features(shared.unionByName(shared), [STEP], LAST)[0]["201"]


SECOND_PART = Step(
    "201", "$.data[*]", "seqNo", "$.seqNo",
    (Feature("var_41", STAT, "seqNo", None, "case_id", None, "np.min"),),
)


@query
def online_two_parts(spark, sf_dir):
    """Two configuration rows of one step, joined on request and key."""
    return online_features(requests(spark, sf_dir), [STEP, SECOND_PART], LAST)[0]["201"]


@query
def online_stream(spark, sf_dir):
    """The requests as files of JSON lines, read as a stream until all are done."""
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    requests(spark, sf_dir).select("document").repartition(4).write.text(f"{folder}/in")
    lines = spark.readStream.option("maxFilesPerTrigger", 2).text(f"{folder}/in")
    documents = lines.select(F.sha2("value", 256).alias("request_id"), F.col("value").alias("document"))
    start_online(documents, [STEP], LAST, f"{folder}/out", f"{folder}/progress").awaitTermination()
    return spark.read.parquet(f"{folder}/out/step=201").drop("batch", "request_id")


@query
def online_stream_repeats(spark, sf_dir):
    """Every request in several files, one file per micro-batch: each is answered once."""
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    own_number = F.concat(F.lit('{"requestNo":"'), "request_id", F.lit('",'))
    numbered = requests(spark, sf_dir).select(F.regexp_replace("document", "^[{]", own_number).alias("value"))
    numbered.unionByName(numbered).repartition(3).write.text(f"{folder}/in")
    documents = read_documents(
        spark, f"{folder}/in", one_per_line=True, id_path="$.requestNo", stream=True, maxFilesPerTrigger=1
    )
    start_online(documents, [STEP], LAST, f"{folder}/out", f"{folder}/progress").awaitTermination()
    return spark.read.parquet(f"{folder}/out/step=201").drop("batch")


@query
def csv_round_trip(spark, sf_dir):
    """The panel written as a feature table and read back as text, numbers cast."""
    path = f"{shared_folder(spark)}/panel-{uuid.uuid4().hex}"
    write_features(user_day(spark, sf_dir), path, file_format="csv")
    rows = read_panel(spark, path, sep=",")
    numbers = ("amt1", "amt2", "amt3", "amt4")
    return rows.select(
        F.col(KEY).cast("long").alias(KEY),
        F.col(DAY).cast("int").alias(DAY),
        *[as_number(F.col(c)).alias(c) for c in numbers],
        "cat",
    )
