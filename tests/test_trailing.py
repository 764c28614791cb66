from __future__ import annotations

import pytest

from panelcraft.operators.trailing import trailing_features
from panelcraft.spec import (
    CATEGORY,
    PERIOD_RATIO,
    RISING_STREAK,
    STAT_FUNCS,
    STREAK,
    Feature,
    numbered,
    period_ratio_features,
    period_spans,
    stat_features,
)
from tests.helpers import SCHEMA, by_key, longest_run, panel_rows, stats, window

ROWS = panel_rows()
PANEL = by_key(ROWS)


@pytest.fixture(scope="module")
def panel(spark):
    return spark.createDataFrame(ROWS, SCHEMA).cache()


def approx(value):
    return value if value is None or isinstance(value, (int, str)) else pytest.approx(value)


def collected(df, keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}


@pytest.mark.parametrize("options", [{}, {"unique_periods": True}, {"unique_periods": True, "block_length": 2}])
def test_stats_for_several_windows(panel, options):
    features = [
        f.at(5, 12)
        for months in (1, 3, 6)
        for f in stat_features("customer", "month", "a", months, (f"{s}_{months}" for s in STAT_FUNCS))
    ]
    got = collected(trailing_features(panel, features, **options), ("customer", "base_period"))
    expected_groups = {
        (k, m) for k in PANEL for m in range(5, 13) if window(PANEL[k], m, 6)
    }
    assert set(got) == expected_groups
    for (k, m), row in got.items():
        for months in (1, 3, 6):
            inside = window(PANEL[k], m, months)
            expected = stats([r[2] for r in inside]) if inside else dict.fromkeys(STAT_FUNCS)
            for func, value in expected.items():
                assert row[f"{func}_{months}"] == approx(value), (k, m, func, months)


@pytest.mark.parametrize("unique", [False, True])
def test_one_base_period_equals_the_rolling_row(panel, unique):
    features = stat_features("customer", "month", "a", 4, numbered())
    one = collected(
        trailing_features(panel, [f.at(9) for f in features], unique_periods=unique), ("customer",)
    )
    many = collected(trailing_features(panel, [f.at(7, 12) for f in features]), ("customer", "base_period"))
    assert {k for (k,) in one} == {k for k, m in many if m == 9}
    for (k,), row in one.items():
        for f in features:
            assert row[f.name] == many[k, 9][f.name]


def test_repeated_rows_and_null_keys(spark):
    rows = [("x", 1, 4.0), ("x", 1, 2.0), ("x", 2, None), (None, 1, 9.0)]
    df = spark.createDataFrame(rows, "customer string, month int, a double")
    features = [f.at(2) for f in stat_features("customer", "month", "a", 2, iter(STAT_FUNCS))]
    for unique in (False, True):
        (row,) = trailing_features(df, features, unique_periods=unique).collect()
        assert row["customer"] == "x"
        for func, value in stats([4.0, 2.0, None]).items():
            assert row[func] == approx(value)


def test_no_period_column_means_one_window(panel):
    features = stat_features("customer", None, "a", None, iter(STAT_FUNCS))
    got = collected(trailing_features(panel, features), ("customer",))
    for k, periods in PANEL.items():
        for func, value in stats([r[2] for r in periods.values()]).items():
            assert got[(k,)][func] == approx(value)


def test_medians_of_hot_groups_by_rank_selection(panel):
    features = [f.at(5, 12) for f in stat_features("customer", "month", "a", 6, iter(STAT_FUNCS))]
    plain = collected(trailing_features(panel, features), ("customer", "base_period"))
    medians = [f for f in features if f.func == "np.median"]
    alone = collected(trailing_features(panel, medians), ("customer", "base_period"))
    assert alone.keys() == plain.keys()
    for hot_rows in (3, 0):
        again = trailing_features(panel, features, hot_rows=hot_rows)
        assert collected(again, ("customer", "base_period")) == plain
        # Groups of nulls only have no rank, but stay.
        again = trailing_features(panel, medians, hot_rows=hot_rows)
        assert collected(again, ("customer", "base_period")) == alone


def half(func, values):
    seen = [v for v in values if v is not None]
    if func == "np.sum":
        return float(sum(seen)) if values else None
    if not seen:
        return None
    return max(seen) if func == "np.max" else sum(seen) / len(seen)


def test_period_spans():
    assert period_spans(1) == [(1, 1)]
    assert period_spans(2) == [(1, 1), (1, 2)]
    assert period_spans(3) == [(1, 3), (2, 2), (2, 3), (1, 2)]
    assert period_spans(6) == [(1, 6), (3, 3), (3, 6)]
    assert period_spans(12)[-1] == (3, 9)
    with pytest.raises(ValueError):
        period_spans(0)


@pytest.mark.parametrize("months", [1, 2, 3, 6])
def test_period_ratios(panel, months):
    features = [f.at(6, 12) for f in period_ratio_features("customer", "month", "a", months, numbered())]
    got = collected(trailing_features(panel, features), ("customer", "base_period"))
    for (k, m), row in got.items():
        inside = window(PANEL[k], m, months)
        for f in features:
            top = half(f.func, [r[2] for r in inside if m - r[1] < f.numerator_months])
            bottom = half(f.func, [r[2] for r in inside if m - r[1] >= months - f.denominator_months])
            expected = None if top is None or not bottom else top / bottom
            assert row[f.name] == approx(expected), (k, m, f)


def test_denominator_over_the_numerator_span(panel):
    f = Feature("r", PERIOD_RATIO, "customer", "month", "b", 6, "np.sum", numerator_months=1, denominator_months=4)
    literal = Feature(**{**f.__dict__, "denominator_span": "numerator"})
    short = Feature(**{**f.__dict__, "denominator_months": 1})
    a, b = (collected(trailing_features(panel, [x.at(12)]), ("customer",)) for x in (literal, short))
    assert a == b


@pytest.mark.parametrize("threshold", [3.0, 0.0, -1.0, -1.5, -2.0])
@pytest.mark.parametrize("options", [{}, {"block_length": 3}])
def test_streaks(panel, threshold, options):
    features = [
        Feature("above", STREAK, "customer", "month", "a", 5, threshold=threshold).at(4, 12),
        Feature("above_3", STREAK, "customer", "month", "a", 3, threshold=threshold).at(4, 12),
        Feature("rising", RISING_STREAK, "customer", "month", "a", 5, threshold=threshold).at(4, 12),
    ]
    got = collected(trailing_features(panel, features, **options), ("customer", "base_period"))
    assert set(got) == {(k, m) for k in PANEL for m in range(4, 13)}
    for (k, m), row in got.items():
        assert row["above"] == longest_run(window(PANEL[k], m, 5), threshold, False), (k, m)
        assert row["above_3"] == longest_run(window(PANEL[k], m, 3), threshold, False), (k, m)
        assert row["rising"] == (longest_run(window(PANEL[k], m, 5), threshold, True) or 0), (k, m)


def test_single_base_streaks(panel):
    features = [
        Feature("above", STREAK, "customer", "month", "a", 6, threshold=2.0).at(12),
        Feature("rising", RISING_STREAK, "customer", "month", "a", 6, threshold=2.0).at(12),
    ]
    got = collected(trailing_features(panel, features), ("customer",))
    assert set(got) == {(k,) for k in PANEL}
    for (k,), row in got.items():
        assert row["above"] == longest_run(window(PANEL[k], 12, 6), 2.0, False)
        assert row["rising"] == (longest_run(window(PANEL[k], 12, 6), 2.0, True) or 0)


def test_streaks_refuse_repeated_periods(spark):
    df = spark.createDataFrame([("x", 1, 4.0), ("x", 1, 2.0)], "customer string, month int, a double")
    f = Feature("above", STREAK, "customer", "month", "a", 3, threshold=0.0).at(3)
    with pytest.raises(Exception, match="one row per key and period"):
        trailing_features(df, [f]).collect()


def test_category_features(panel):
    features = [
        Feature(f"{c}_{func}", CATEGORY, "customer", "month", "kind", 4, func, category=c).at(6, 12)
        for c in ("A", "C")
        for func in ("cnt", "pct")
    ]
    got = collected(trailing_features(panel, features), ("customer", "base_period"))
    for (k, m), row in got.items():
        kinds = [r[5] for r in window(PANEL[k], m, 4)]
        for c in ("A", "C"):
            assert row[f"{c}_cnt"] == kinds.count(c)
            assert row[f"{c}_pct"] == pytest.approx(kinds.count(c) / len(kinds))


def test_every_key_keeps_keys_outside_the_windows(panel):
    features = [f.at(12) for f in stat_features("customer", "month", "a", 1, iter(STAT_FUNCS))]
    for unique in (False, True):
        got = collected(
            trailing_features(panel, features, every_key=True, unique_periods=unique), ("customer",)
        )
        assert set(got) == {(k,) for k in PANEL}
        assert got[("early",)]["np.size"] is None


def test_copies_are_made_after_the_shuffle_when_periods_are_unique(panel):
    features = [f.at(5, 12) for f in stat_features("customer", "month", "a", 6, numbered(), ("np.sum",))]

    def exchanges(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return plan, plan.count("Exchange hashpartitioning")

    plan, count = exchanges(trailing_features(panel, features, unique_periods=True))
    assert count == 1
    assert plan.index("Generate") < plan.index("Exchange")
    plan, count = exchanges(trailing_features(panel, features))
    assert count == 1
    assert plan.index("Exchange") < plan.index("Generate")


def test_a_panel_bucketed_by_key_is_not_shuffled(spark, panel):
    panel.write.bucketBy(4, "customer").sortBy("customer").mode("overwrite").saveAsTable("bucketed_panel")
    features = [
        *[f.at(5, 12) for f in stat_features("customer", "month", "a", 6, numbered(), ("np.sum", "np.max"))],
        Feature("above", STREAK, "customer", "month", "a", 6, threshold=2.0).at(5, 12),
    ]
    stored = spark.table("bucketed_panel")
    for part in (features, features[:2]):
        df = trailing_features(stored, part, unique_periods=True, keyed=True)
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        keys = ("customer", "base_period")
        assert collected(df, keys) == collected(trailing_features(panel, part, unique_periods=True), keys)


@pytest.mark.parametrize("rolling", [False, True])
def test_a_wrong_claim_of_unique_periods_is_seen(spark, monkeypatch, rolling):
    """A hot key with repeated periods takes its median by rank selection, not in one task."""
    from panelcraft.operators import trailing
    from panelcraft.spec import STAT, Feature

    taken = []
    ranked = trailing._ranked_medians
    monkeypatch.setattr(trailing, "_ranked_medians", lambda *a: taken.append(1) or ranked(*a))
    rows = [("hot", 12, float(v)) for v in range(401)] + [("cold", m, float(m)) for m in range(1, 13)]
    df = spark.createDataFrame(rows, "customer string, month int, a double")
    features = [Feature("mid", STAT, "customer", "month", "a", 3, "np.median").at(11 if rolling else 12, 12)]
    got = trailing_features(df, features, unique_periods=True, hot_rows=100).collect()
    found = {(r["customer"], r["base_period"] if rolling else 12): r["mid"] for r in got}
    assert found["hot", 12] == 200.0 and found["cold", 12] == 11.0
    assert taken
    taken.clear()
    trailing_features(df.where("customer = 'cold'"), features, unique_periods=True, hot_rows=100).collect()
    assert not taken
