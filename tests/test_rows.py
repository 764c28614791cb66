"""Row layer, picks, keywords, status, profiles and column expressions."""

from __future__ import annotations

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcraft.functions.columns import (
    as_number,
    expression_column,
    keyword_flag,
    null_flag,
    null_skipping_sum,
    period_index,
    predicate,
)
from panelcraft.operators.categories import category_shares
from panelcraft.operators.pick import pick_extremes
from panelcraft.operators.profile import (
    category_profile,
    numeric_profile,
    presence_grid,
    presence_pattern,
    range_profile,
    value_counts,
)
from panelcraft.operators.quality import assert_unique, duplicate_keys
from panelcraft.operators.ratios import add_ratios, combination_ratios
from panelcraft.operators.status import worst_status
from panelcraft.operators.trailing import trailing_features
from panelcraft.sources.documents import row_array
from panelcraft.sources.tables import write_features
from panelcraft.spec import CATEGORY, RATIO, STAT, Feature, ratio_pairs
from tests.helpers import SCHEMA, by_key, panel_rows

ROWS = panel_rows(seed=11)
PANEL = by_key(ROWS)


@pytest.fixture(scope="module")
def panel(spark):
    return spark.createDataFrame(ROWS, SCHEMA).cache()


def test_number_of_ratio_combinations():
    assert [len(ratio_pairs("abcde"[:n])) for n in (1, 2, 3, 4)] == [0, 0, 6, 36]


def pandas_ratios(features):
    frame = pd.DataFrame(ROWS, columns=["customer", "month", "a", "b", "c", "kind"])
    frame = frame.sort_values(["customer", "month"], ignore_index=True)
    out = {}
    for f in features:
        sums = frame.groupby("customer")[["a", "b", "c"]].rolling(f.months).sum().droplevel(0)
        top, bottom = (sums[list(cols)].sum(axis=1) for cols in (f.numerator, f.denominator))
        out[f.name] = (top / bottom).where(bottom.round(9) != 0)
    return frame, pd.DataFrame(out)


@pytest.mark.parametrize("options", [{}, {"period_span": (1, 12)}, {"longest_history": 4}])
@pytest.mark.parametrize("months", [1, 3])
def test_combination_ratios(panel, months, options):
    features, rows = combination_ratios(panel, "customer", "month", ["a", "b", "c"], months, **options)
    frame, expected = pandas_ratios(features)
    got = rows.orderBy("customer", "month").collect()
    assert len(got) == len(frame)
    for i, row in enumerate(got):
        assert (row["customer"], row["month"]) == (frame.customer[i], frame.month[i])
        for f in features:
            e = expected[f.name][i]
            assert row[f.name] == (None if pd.isna(e) else pytest.approx(e)), (i, f)


def test_period_frame_needs_every_period(spark):
    rows = [("x", p, 1.0, 3.0) for p in (1, 2, 4, 5, 6)]
    df = spark.createDataFrame(rows, "k string, p int, a double, b double")
    f = Feature("r", RATIO, "k", "p", months=2, numerator=("a",), denominator=("a", "b"))
    for options in ({}, {"longest_history": 3}):
        by_rows = [r["r"] for r in add_ratios(df, [f], **options).orderBy("p").collect()]
        by_period = [r["r"] for r in add_ratios(df, [f], frame="period", **options).orderBy("p").collect()]
        assert by_rows == [None, 0.25, 0.25, 0.25, 0.25]
        assert by_period == [None, 0.25, None, 0.25, 0.25]


def test_ratios_refuse_repeated_periods(spark):
    df = spark.createDataFrame([("x", 1, 1.0, 1.0)] * 2, "k string, p int, a double, b double")
    f = Feature("r", RATIO, "k", "p", months=1, numerator=("a",), denominator=("a", "b"))
    with pytest.raises(Exception, match="one row per key and period"):
        add_ratios(df, [f]).collect()


def test_category_list_and_limit(panel):
    features, _ = category_shares(panel, "customer", "month", "kind", 3, 12)
    assert [f.category for f in features] == ["A", "A", "B", "B", "C", "C"]
    features, table = category_shares(panel, "customer", "month", "kind", 3, 12, max_categories=2)
    assert [(f.name, f.func, f.category) for f in features] == [("var_1", "cnt_map", None), ("var_2", "pct_map", None)]
    _, wide = category_shares(panel, "customer", "month", "kind", 3, 12)
    columns = {r["customer"]: r for r in wide.collect()}
    for r in table.collect():
        own = columns.pop(r["customer"])
        shown = {"A": (own["var_1"], own["var_2"]), "B": (own["var_3"], own["var_4"]), "C": (own["var_5"], own["var_6"])}
        assert {k: (n, r["var_2"][k]) for k, n in r["var_1"].items()} == {k: v for k, v in shown.items() if v[0]}
    assert not columns


def test_category_maps_in_rolling_windows_and_files(spark, panel, tmp_path):
    """Maps of every base period against the rows, with a row filter, nulls and keys without categories."""
    asked = [
        Feature(f"{func}_{months}", CATEGORY, "customer", "month", "kind", months, func, where="a > 0").at(10, 12)
        for months in (1, 4)
        for func in ("cnt_map", "pct_map")
    ] + [Feature("n", STAT, "customer", "month", "a", 4, "np.size").at(10, 12)]
    rows = panel.collect()
    got = trailing_features(panel, asked).collect()
    assert {(r["customer"], r["base_period"]) for r in got} == {
        (r["customer"], b) for r in rows for b in (10, 11, 12) if b - 3 <= r["month"] <= b
    }
    for r in got:
        for months in (1, 4):
            inside = [
                x["kind"] for x in rows
                if x["customer"] == r["customer"] and r["base_period"] - months < x["month"] <= r["base_period"]
                and x["a"] is not None and x["a"] > 0
            ]
            counts = {k: inside.count(k) for k in inside if k is not None}
            assert r[f"cnt_map_{months}"] == (counts if inside else None)
            shares = {k: n / len(inside) for k, n in counts.items()}
            assert r[f"pct_map_{months}"] == (pytest.approx(shares) if inside else None)
    alone = trailing_features(panel, [asked[2].at(12)])
    assert alone.columns == ["customer", "cnt_map_4"]
    write_features(alone, f"{tmp_path}/maps", file_format="csv")
    text = {r["customer"]: r["cnt_map_4"] for r in spark.read.csv(f"{tmp_path}/maps", header=True).collect()}
    assert text == {
        r["customer"]: None if r["cnt_map_4"] is None else json.dumps(r["cnt_map_4"], separators=(",", ":")) for r in alone.collect()
    }


def test_nested_row_paths(spark):
    documents = [
        '{"a":{"d":[{"i":{"x":[{"v":1},{"w":2}]}},{"i":null},{},{"i":{"x":[]}},{"i":{"x":[{"v":"z"}]}}]}}',
        '{"a":{"d":[]}}', "{}", "no json", None,
    ]
    df = spark.createDataFrame(list(enumerate(documents)), "n int, document string")
    rows = row_array(F.col("document"), "$.a.d[*].i.x[*]", ["v"])
    got = {r["n"]: None if r["rows"] is None else [x["v"] for x in r["rows"]] for r in df.select("n", rows.alias("rows")).collect()}
    assert got == {0: ["1", None, "z"], 1: [], 2: None, 3: None, 4: None}
    with pytest.raises(ValueError):
        row_array(F.col("document"), "$.a[0].b[*]", ["v"])


def test_pick_extremes(spark):
    rows = [("a", 1, 5.0, "p"), ("a", 2, 5.0, "q"), ("a", 3, 1.0, "r"), ("a", 4, None, "s"),
            ("b", 1, 2.0, None), ("c", 1, None, "t")]
    df = spark.createDataFrame(rows, "k string, p int, v double, w string")
    got = pick_extremes(df, ["k"], "v", ["min", "max"], ["w"], tie_break=["p"]).orderBy("k").collect()
    assert [tuple(r) for r in got] == [("a", "r", "p"), ("b", None, None)]
    assert got[0].asDict().keys() == {"k", "min_v_w", "max_v_w"}
    text = pick_extremes(df, ["k"], "w", ["max"], ["p"]).orderBy("k").collect()
    assert [tuple(r) for r in text] == [("a", 4), ("c", 1)]
    whole = pick_extremes(df, ["k"], "p", ["max"])
    assert whole.columns == ["k", "max_p_p", "max_p_v", "max_p_w"]
    with pytest.raises(ValueError):
        pick_extremes(df, ["k"], "v", ["mean"])


def test_keyword_flag(spark):
    df = spark.createDataFrame([("red",), ("dark red",), ("re",), (None,)], "w string")
    words = ["red", "blue"]
    got = df.select(*[keyword_flag(F.col("w"), words, m) for m in ("equal", "contain", "contained")])
    assert [tuple(r) for r in got.collect()] == [(1, 1, 1), (0, 1, 0), (0, 0, 1), (0, 0, 0)]
    with pytest.raises(ValueError):
        keyword_flag(F.col("w"), words, "starts")


def test_worst_status(spark):
    rows = [("c", "1234567"), ("c", "ZDGN*C/"), ("c", "6666666"), ("d", "N?1"), ("d", "C"), ("e", "??")]
    df = spark.createDataFrame(rows, "k string, s string")
    got = {r["k"]: r["summary"] for r in worst_status(df, "k", "s").collect()}
    assert got == {"c": "ZDG6667", "d": "N1", "e": ""}


def test_presence(panel):
    got = {r["month_str"]: r["month_str_count"] for r in presence_pattern(panel, "customer", "month", 2, 9).collect()}
    expected: dict[str, int] = {}
    for periods in PANEL.values():
        text = "".join("0" if m in periods else "1" for m in range(2, 10))
        expected[text] = expected.get(text, 0) + 1
    assert got == expected
    grid = presence_grid(panel, "customer", "month", 2, 9).collect()
    assert len(grid) == len(PANEL) * 8
    assert all((r["missing"] == "0") == (r["month"] in PANEL[r["customer"]]) for r in grid)


def test_presence_over_several_masks(spark):
    df = spark.createDataFrame([("x", p) for p in (1, 62, 63, 124, 125, 130)], "k string, p int")
    (row,) = presence_pattern(df, "k", "p", 1, 130).collect()
    assert row["month_str"] == "".join("0" if p in (1, 62, 63, 124, 125, 130) else "1" for p in range(1, 131))


def test_profiles(spark):
    df = spark.createDataFrame(
        [(1.0, "u"), (9.0, "u"), (None, "v"), (5.0, None)], "x double, t string"
    ).withColumn("y", F.lit(None).cast("double"))
    numbers = {r["var_name"]: r.asDict() for r in numeric_profile(df, ["x", "y"]).collect()}
    assert numbers["x"] == {
        "var_name": "x", "cnt": 4, "cnt_isna": 1, "pct_isna": 0.25, "sum": 15.0, "min": 1.0,
        "max": 9.0, "avg": 5.0, "med": 5.0,
    }
    assert numbers["y"]["sum"] == 0.0 and numbers["y"]["med"] is None
    ranges = {r["var_name"]: r.asDict() for r in range_profile(df, ["x", "y"]).collect()}
    assert [ranges["x"][f"P{q}_num"] for q in (25, 50, 75)] == [3.0, 5.0, 7.0]
    assert [ranges["x"][f"P{q}_pct"] for q in (25, 50, 75)] == [0.75, 0.75, 0.5]
    kinds = {r["var_value"]: (r["cnt"], r["pct"]) for r in category_profile(df, ["t"]).collect()}
    assert kinds == {"u": (2, 0.5), "v": (1, 0.25), None: (1, 0.25)}
    always = {r["var_value"]: r["cnt"] for r in category_profile(df.where("t = 'u'"), ["t"]).collect()}
    assert always == {"u": 2, None: 0}
    assert [tuple(r) for r in value_counts(df, "t").collect()] == [("u", 2), ("v", 1)]


def test_uniqueness(panel):
    assert assert_unique(panel, ["customer", "month"]) is panel
    assert duplicate_keys(panel, ["customer"]).count() > 0
    with pytest.raises(ValueError, match="rows repeat"):
        assert_unique(panel, ["customer"])


def test_predicates(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (None, "y")], "m int, t string")
    assert df.where(predicate('m > 1 and t == "y"')).count() == 1
    assert df.where(predicate("not m > 1 or t = 'a|b'")).count() == 2  # a null is not over 1
    with pytest.raises(ValueError, match="and/or/not"):
        predicate("(m > 1) & (m < 3)")


def test_filters_with_nulls(spark):
    df = spark.createDataFrame([(None,), (0.0,), (5.0,)], "amt double")

    def kept(text):
        return [r[0] for r in df.where(predicate(text)).collect()]

    assert kept("amt != 0") == [None, 5.0]
    assert kept("not (amt > 3)") == [None, 0.0]
    assert kept("amt in [0, 7]") == [0.0]
    assert kept("amt not in [0, 7]") == [None, 5.0]
    assert kept("-1 < amt < 3") == [0.0]
    assert kept("not -1 < amt < 3") == [None, 5.0]
    assert kept("`amt` * 2 - 1 >= 9") == [5.0]
    refused = ("reflect('java.lang.System', 'exit')", "amt.sum() > 1", "amt is None", "f(amt)", "1 +", "amt > 0; 1")
    for text in refused:
        with pytest.raises(ValueError):
            predicate(text)


def test_more_expressions(spark):
    df = spark.createDataFrame([(-7.0, 3.0), (7.0, -3.0), (None, 0.0)], "a double, b double")

    def run(text):
        return [r[0] for r in df.select(expression_column(text, df.columns)).collect()]

    assert run('df["a"] % df["b"]') == [2.0, -2.0, None]
    assert run('df["a"] // df["b"]') == [-3.0, -3.0, None]
    assert run('df["a"] > 0') == [0.0, 1.0, 0.0]
    assert run('df["a"] != 7') == [1.0, 0.0, 1.0]
    assert run('df["a"].fillna(1) + (0 < df["b"] < 9)') == [-6.0, 7.0, 1.0]
    for text in ('df["a"].fillna(df["b"])', 'df["a"].abs()', 'df["a"].fillna(value=1)'):
        with pytest.raises(ValueError):
            expression_column(text, df.columns)


def test_both_ratio_paths_agree(spark):
    """Null periods, repeats at a stretch end, and windows longer than a stretch."""
    rows = [("k", p, float(p), 1.0) for p in range(1, 30)] + [("k", None, 9.0, 9.0), ("j", None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "customer string, month int, a double, b double")
    for months in (1, 2, 5, 12):
        ratio = [Feature("r", RATIO, "customer", "month", months=months, numerator=("a",), denominator=("a", "b"))]
        for frame in ("rows", "period"):
            short = sorted(map(str, add_ratios(df, ratio, frame=frame).collect()))
            cut = sorted(map(str, add_ratios(df, ratio, frame=frame, longest_history=4).collect()))
            assert short == cut
            assert len(cut) == len(rows)
    for month in (4, 5, 8, 29):
        twice = df.unionByName(df.where(f"month = {month}"))
        ratio = [Feature("r", RATIO, "customer", "month", months=1, numerator=("a",), denominator=("a", "b"))]
        for options in ({}, {"longest_history": 4}):
            with pytest.raises(Exception, match="one row per key and period"):
                add_ratios(twice, ratio, **options).collect()


def test_expressions(spark):
    df = spark.createDataFrame([(6.0, 2.0), (1.0, 0.0)], "`var_1` double, `var_2` double")
    names = df.columns

    def run(text):
        return [r[0] for r in df.select(expression_column(text, names)).collect()]

    assert run('df["var_1"]+df["var_2"]') == [8.0, 1.0]
    assert run('-(df["var_1"] - 2) * 3 ** 2') == [-36.0, 9.0]
    assert run('df["var_1"]/df["var_2"]') == [3.0, None]
    for text in ('__import__("os")', 'df["other"]', "df.var_1", 'df["var_1"] if 1 else 2', '"x"'):
        with pytest.raises(ValueError):
            expression_column(text, names)


def test_small_columns(spark):
    df = spark.createDataFrame([("1.5",), ("x",), ("NaN",), (None,)], "s string")
    assert [r[0] for r in df.select(as_number(F.col("s"))).collect()] == [1.5, None, None, None]
    assert [r[0] for r in df.select(null_flag(F.col("s"))).collect()] == ["0", "0", "0", "1"]
    sums = df.select(null_skipping_sum([as_number(F.col("s")), F.lit(2.0)])).collect()
    assert [r[0] for r in sums] == [3.5, 2.0, 2.0, 2.0]
    days = spark.createDataFrame([("2023-12-31",), ("2024-01-01",)], "d string").select(
        period_index(F.to_date("d"), "month"), period_index(F.to_date("d"), "day")
    )
    (a, b), (c, d) = (tuple(r) for r in days.collect())
    assert (c - a, d - b) == (1, 1)
    with pytest.raises(ValueError):
        period_index(F.col("d"), "week")


def test_text_meets_numbers_without_failing(spark):
    rows = [("A",), ("5",), ("5.0",), ("12",), (None,)]
    df = spark.createDataFrame(rows, "s string").withColumn("n", F.lit(5))

    def kept(text):
        return [r["s"] for r in df.where(predicate(text, df.schema)).collect()]

    assert kept("s != 5") == ["A", "12", None]
    assert kept("s == 5") == kept("s == n") == ["5", "5.0"]
    assert kept("4 < s < 13") == ["5", "5.0", "12"]
    assert kept("s in [12, 'A']") == ["A", "12"]
    assert kept("s not in [12, 'A']") == ["5", "5.0", None]
    assert kept("n == 'A'") == [] and len(kept("n != 'A'")) == 5


def test_integer_ranges_still_reach_the_scan(spark, tmp_path):
    spark.range(10).select(F.col("id").alias("m"), F.lit("x").alias("t")).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    plan = df.where(predicate("m > 3 and t != 4", df.schema))._jdf.queryExecution().toString()
    assert "GreaterThan(m,3)" in plan


@pytest.mark.parametrize("a, b, whole", [(1e20, 1.0, 1e20), (-7.0, 2.0, -4.0), (1e300, 1e-5, 1e305), (9.1e15, 1.0, 9.1e15)])
def test_whole_division_of_large_numbers(spark, a, b, whole):
    df = spark.createDataFrame([(a, b)], "a double, b double")
    assert df.select(expression_column('df["a"] // df["b"]', df.columns)).first()[0] == whole
