from __future__ import annotations

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcraft.operators.bins import bin_shares, threshold_share
from panelcraft.operators import ranks
from panelcraft.operators.ranks import exact_medians, select_ranks
from panelcraft.spec import LOC_BIN, VAL_BIN
from tests.helpers import SCHEMA, by_key, panel_rows, window

ROWS = panel_rows(seed=3)
PANEL = by_key(ROWS)


@pytest.fixture(scope="module")
def panel(spark):
    return spark.createDataFrame(ROWS, SCHEMA).cache()


@pytest.mark.parametrize("few", [False, True])
@pytest.mark.parametrize("size, slack, limit", [(2000, 0.004, 1 << 16), (16, 0.1, 40), (8, 0.02, 200)])
def test_ranks_of_a_hot_group(spark, monkeypatch, few, size, slack, limit):
    """Small sketches, narrow brackets and low limits make it narrow and widen; results stay exact."""
    monkeypatch.setattr(ranks, "SKETCH", size)
    rng = random.Random(1)
    groups = {
        "hot": [float(rng.randint(0, 900)) for _ in range(3000)],
        "one_value": [5.0] * 500,
        "half_equal": [7.0] * 1500 + [rng.uniform(-50, 50) for _ in range(1500)],
        "all_distinct": [rng.random() for _ in range(3000)],
        "single": [1.0],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("empty", None), ("hot", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(8)
    wanted = lambda n: F.array(F.lit(0), F.floor(n / 3), n - 1)
    got = select_ranks(df, ["g"], "v", wanted, few_groups=few, slack=slack, limit=limit).collect()
    found = {(r["g"], r["position"]): r["value"] for r in got}
    assert len(found) == len(got) == 15
    for g, values in groups.items():
        values = sorted(values)
        for position, rank in enumerate((0, len(values) // 3, len(values) - 1)):
            assert found[g, position] == values[rank]


def test_rank_selection_moves_and_stores_no_values(spark):
    """Only sketches and counts are shuffled: at most one partial row per task, group and gap or bracket value."""
    df = spark.range(200_000, numPartitions=8).select(
        (F.col("id") % 2).alias("g"), F.hash("id").cast("double").alias("v")
    )
    brackets = ranks._bracketed(
        df.groupBy("g").agg(ranks.sketch(F.col("v")).alias("_sketch"), F.count("*").alias("_n")),
        ["g"], ranks.middle_ranks, ranks.SLACK,
    )
    inside = brackets.join(df, "g").where("v between low and high").groupBy("g").count().collect()
    # Two ranks next to each other share nearly all of one bracket.
    assert all(0 < r["count"] / 2 < 100_000 * (2 * ranks.SLACK + 3 / ranks.GRID) for r in inside)
    found = exact_medians(df, ["g"], "v", few_groups=True)
    plan = found._jdf.queryExecution().toString()
    assert "Window" not in plan and "Sort" not in plan and "FileScan" not in plan
    medians = {r["g"]: r["m"] for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    assert {r["g"]: r["median"] for r in found.collect()} == medians


def test_counts_below_points_come_with_the_ranks(spark):
    rng = random.Random(9)
    groups = {"a": [float(rng.randint(0, 30)) for _ in range(800)], "b": [1.0, 2.0, 2.0]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in [*vs, None]], "g string, v double")
    points = [("a", 1, -5.0), ("a", 2, 7.0), ("a", 3, 7.5), ("a", 4, 30.0), ("a", 5, 99.0), ("b", 1, 2.0), ("c", 1, 0.0)]
    thresholds = spark.createDataFrame(points, "g string, name int, point double")
    picked, below = select_ranks(
        df, ["g"], "v", ranks.middle_ranks, few_groups=True, thresholds=thresholds, slack=0.01, limit=5
    )
    found = {(r["g"], r["name"]): r["below"] for r in below.collect()}
    assert found == {(g, n): sum(v < p for v in groups.get(g, [])) for g, n, p in points}
    medians = picked.groupBy("g").agg(F.avg("value").alias("m")).collect()
    assert {r["g"]: r["m"] for r in medians} == {g: statistics.median(v) for g, v in groups.items()}


def test_medians(spark):
    rng = random.Random(2)
    groups = {k: [rng.choice([-1.5, 0.0, 2.0, 7.25, 9.0]) for _ in range(k + 1)] for k in range(30)}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "g int, v double")
    got = {r["g"]: r["median"] for r in exact_medians(df, ["g"], "v").collect()}
    assert got == {k: statistics.median(v) for k, v in groups.items()}


def positions(n: int, bins: int) -> list[int]:
    return [int(x) for x in np.linspace(0, n - 1, bins + 1)][:-1]


def expected_edges(kind: str, base: int, months: int, bins: int) -> list[float]:
    values = sorted(
        r[2] for periods in PANEL.values() for r in window(periods, base, months) if r[2] is not None
    )
    if kind == LOC_BIN:
        return [values[i] for i in positions(len(values), bins)]
    return list(np.linspace(values[0], values[-1], bins + 1)[:-1])


@pytest.mark.parametrize("kind", [LOC_BIN, VAL_BIN])
@pytest.mark.parametrize("bins", [3, 7])
def test_bin_shares(panel, monkeypatch, kind, bins):
    monkeypatch.setattr(ranks, "SKETCH", 8)
    monkeypatch.setattr(ranks, "LIMIT", 4)
    for unique in (False, True):
        got = bin_shares(
            panel, "customer", "month", "a", 4, bins, 8, 12, kind=kind, unique_periods=unique
        ).collect()
        keys = {(k, m) for k in PANEL for m in range(8, 13) if window(PANEL[k], m, 4)}
        assert {(r["customer"], r["base_period"]) for r in got} == keys
        assert len(got) == len(keys) * bins
        for r in got:
            edge = expected_edges(kind, r["base_period"], 4, bins)[r["ordinal"]]
            assert r["edge"] == edge
            inside = [x[2] for x in window(PANEL[r["customer"]], r["base_period"], 4)]
            above = sum(v is None or v >= edge for v in inside)
            assert r["share"] == pytest.approx(above / len(inside))


def test_ranks_of_overlapping_windows_with_bad_sketches(spark, monkeypatch):
    """Rows stand for several groups; a rank that misses its bracket must not be taken from another one."""
    monkeypatch.setattr(ranks, "SKETCH", 8)
    rng = random.Random(5)
    rows = [(p, float(rng.randint(0, 40) + 3 * p)) for p in range(1, 13) for _ in range(60)]
    df = spark.createDataFrame(rows, "p int, v double").repartition(4)
    bases = F.filter(F.sequence(F.col("p"), F.col("p") + 3), lambda b: b <= 12)
    copies = ranks.Copies(["p"], F.transform(bases, lambda b: F.struct(b.alias("base"))))
    wanted = lambda n: F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.floor(i * (n - 1) / 6))
    for slack in (0.0, 0.01, 0.05):
        got = select_ranks(df, ["base"], "v", wanted, few_groups=True, copies=copies, slack=slack, limit=8).collect()
        for base in range(1, 13):
            values = sorted(v for p, v in rows if base - 3 <= p <= base)
            found = {r["position"]: r["value"] for r in got if r["base"] == base}
            assert found == {i: values[i * (len(values) - 1) // 6] for i in range(6)}


def test_rank_positions_follow_floating_steps(spark):
    """For 14 bins of 123 values the step rule and integer division differ."""
    n, bins = 123, 14
    assert positions(n, bins) != [i * (n - 1) // bins for i in range(bins)]
    df = spark.createDataFrame([("x", i + 1, float(i)) for i in range(n)], "k string, p int, v double")
    got = bin_shares(df, "k", "p", "v", n, bins, n).orderBy("ordinal").collect()
    assert [r["edge"] for r in got] == [float(i) for i in positions(n, bins)]


def test_named_threshold_leaves_nulls_below(panel):
    got = threshold_share(panel, "customer", "month", "a", 4, 5.0, 12).collect()
    for r in got:
        inside = [x[2] for x in window(PANEL[r["customer"]], 12, 4)]
        assert r["share"] == pytest.approx(sum(v is not None and v >= 5.0 for v in inside) / len(inside))
