"""Discovery, replay, data check, dictionary files and JSON requests."""

from __future__ import annotations

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from panelcraft.plans.check import check
from panelcraft.plans.config import Blocks, Source, as_ints, as_list
from panelcraft.plans.discover import discover, filtered
from panelcraft.plans.replay import replay, row_layer
from panelcraft.operators.trailing import trailing_features
from panelcraft.sources.dictionary import from_row, name_list, read_dictionary, write_dictionary
from panelcraft.sources.documents import read_documents, rows_schema
from panelcraft.sources.tables import (
    columns_of_type,
    read_config,
    read_panel,
    store_panel,
    write_features,
)
from panelcraft.spec import CATEGORY, EXPRESSION, RATIO, STAT, STREAK, Feature, register_statistic
from panelcraft.streaming.online import Step, online_features, start_online
from tests.helpers import SCHEMA, panel_rows

ROWS = panel_rows(seed=5, keys=12)


def row(**cells):
    return {"datasource": "panel", "month_start": "7", "month_end": "12", **cells}


SOURCE = Source("panel", "customer", "month", 2, 12, "month > 1")
BLOCKS = Blocks(
    ratios=[row(var_combinations="a, b,c", month_combinations="1,3")],
    stats=[row(var_name="a", month_combinations="1,3"), row(var_name="b", month_combinations="6")],
    streaks=[
        row(var_name="a", month_combinations="3", continue_show_or_inc="show", threshold_value="2"),
        row(var_name="b", month_combinations="6", continue_show_or_inc="inc", threshold_value="0"),
        row(var_name="var_7", month_combinations="3", continue_show_or_inc="show", threshold_value="0.1"),
    ],
    bins=[
        row(var_name="a", month_combinations="3", bin_by_loc="4", bin_by_val="3"),
        row(var_name="c", month_combinations="6", bin_by_loc=None, bin_by_val="5"),
    ],
    categories=[row(var_name="kind", month_combinations="3,6")],
)


@pytest.fixture(scope="module")
def panel(spark):
    return spark.createDataFrame(ROWS, SCHEMA).cache()


def table(df, *keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}


@pytest.fixture(scope="module")
def found(panel):
    return discover(panel, SOURCE, BLOCKS)


def test_cells():
    assert as_list(" a, b ,,c") == ["a", "b", "c"]
    assert as_ints("1, 3,12") == [1, 3, 12]


def test_discovery_counts_and_ids(found):
    kinds = Counter(f.module for f in found.features)
    assert kinds["ff_combination_pct"] == 12
    assert kinds["ff_common_stat"] == 30
    assert kinds["ff_period_compare_stat"] == 3 + 12 + 9
    assert kinds["ff_continue_gt_N"] == 2 and kinds["ff_continue_inc_gt_N"] == 1
    assert kinds["ff_category_cnt_pct"] == 12
    assert [f.name for f in found.features] == [f"var_{i + 1}" for i in range(len(found.features))]
    edges = [f.bin_value for f in found.features if f.module == "ff_bin_distribution_by_loc"]
    assert edges == sorted(set(edges))


def test_replay_of_a_dictionary_file_gives_the_discovered_table(spark, panel, found, tmp_path):
    write_dictionary(spark, found.features, str(tmp_path / "dic"))
    features = read_dictionary(spark, str(tmp_path / "dic"))
    assert [f.name for f in features] == [f.name for f in found.features]
    layer = filtered(panel, SOURCE)
    ratios = [f for f in features if f.kind == RATIO]
    rows = row_layer(layer, ratios).where("month between 7 and 12")
    others = [f for f in features if f.kind != RATIO]
    again = table(replay(rows, others, 12, where="month > 1"), "customer")
    first = table(found.table, "customer")
    assert set(again) == set(first)
    for key, values in first.items():
        for name, value in values.items():
            assert again[key][name] == value, (key, name)


def test_rolling_discovery_holds_single_features_and_the_rows(panel, found):
    rolling = discover(panel, SOURCE, BLOCKS, rolling=True)
    got = table(rolling.table, "customer", "base_period")
    stats = [f for f in found.features if f.kind == STAT]
    at_12 = table(found.table, "customer")
    for (k,), values in at_12.items():
        for f in stats:
            other = got.get((k, 12))
            assert (other[f.name] if other else None) == values[f.name], (k, f)
    for r in filtered(panel, SOURCE).where("month >= 7").collect():
        assert got[r["customer"], r["month"]]["a"] == r["a"]
        assert got[r["customer"], r["month"]]["kind"] == r["kind"]
    assert {m for _, m in got} == set(range(7, 13))
    assert rolling.edges.where("edge_set = 'set_1'").count() == 6 * 4


def test_fused_features_equal_one_by_one(panel, found):
    trailing = [f for f in found.features if f.kind in (STAT, CATEGORY)]
    fused = table(trailing_features(panel, trailing), "customer")
    for f in trailing[::7]:
        alone = table(trailing_features(panel, [f]), "customer")
        for key, values in fused.items():
            assert values[f.name] == alone.get(key, {f.name: None})[f.name]


def test_row_filter_of_a_variable(panel):
    blocks = Blocks(stats=[row(var_name="a", month_combinations="6", where="b > 0")])
    got = table(discover(panel, SOURCE, blocks).table, "customer")
    plain = Blocks(stats=[row(var_name="a", month_combinations="6")])
    expected = table(discover(panel.where("b > 0"), SOURCE, plain).table, "customer")
    for key, values in expected.items():
        assert got[key] == values


def test_dictionary_keeps_filters_and_rolling_edges(spark, panel, tmp_path):
    blocks = Blocks(
        stats=[row(var_name="a", month_combinations="6", where="b > 0")],
        bins=[row(var_name="a", month_combinations="3", bin_by_loc="4", bin_by_val="3")],
    )
    for rolling in (False, True):
        first = discover(panel, SOURCE, blocks, rolling=rolling)
        path = str(tmp_path / f"dic-{rolling}")
        write_dictionary(spark, first.features, path)
        again = table(replay(filtered(panel, SOURCE), read_dictionary(spark, path), 12), "customer")
        for key, values in table(first.table, "customer", *(["base_period"] if rolling else [])).items():
            if rolling and key[1] != 12:
                continue
            for f in first.features:
                assert again[(key[0],)][f.name] == values[f.name], (rolling, key, f.name)
    with pytest.raises(ValueError, match="drop_unbinned"):
        discover(panel, SOURCE, blocks, rolling=True, drop_unbinned=True)


def test_drop_unbinned_leaves_out_keys_without_bins(panel):
    blocks = Blocks(ratios=BLOCKS.ratios, bins=[row(var_name="a", month_combinations="1", bin_by_val="2")])
    kept = table(discover(panel, SOURCE, blocks).table, "customer")
    dropped = table(discover(panel, SOURCE, blocks, drop_unbinned=True).table, "customer")
    assert set(dropped) == {k for k, v in kept.items() if all(x is not None for x in v.values())}
    assert set(dropped) < set(kept)


def test_replay_keeps_every_key_and_reads_expressions(panel):
    features = [
        Feature("total", STAT, "customer", "month", "a", 3, "np.sum"),
        Feature("twice", EXPRESSION, "", expression='2 * df["total"]'),
        Feature("back", EXPRESSION, "", expression='df["twice"] / 2'),
    ]
    got = table(replay(panel, features, 12), "customer")
    assert set(got) == {(r[0],) for r in ROWS}
    assert got[("early",)]["total"] is None and got[("early",)]["base_period"] == 12
    for values in got.values():
        assert values["back"] == values["total"]
    with pytest.raises(ValueError, match="unknown column"):
        replay(panel, [features[0], Feature("x", EXPRESSION, "", expression='df["later"]')], 12)


def test_dictionary_rows():
    f = from_row({"var_name": "v", "module": "ff_period_compare_stat", "key_column": "k",
                  "month_column": "m", "N_Months": "3", "func_name": "np.sum",
                  "numerator_months": "1", "denomerator_months": "2"})
    assert (f.months, f.numerator_months, f.denominator_months) == (3, 1, 2)
    assert name_list("['a', 'b']") == name_list('["a","b"]') == ("a", "b")
    for bad in ("open('x')", "'a'", "[1]"):
        with pytest.raises((ValueError, SyntaxError)):
            name_list(bad)
    with pytest.raises(ValueError, match="unknown module"):
        from_row({"var_name": "v", "module": "os.system"})


def test_dictionary_file_with_mark_and_placeholder(spark, tmp_path):
    path = tmp_path / "d.dic"
    path.write_text(
        "﻿var_name,N_Months,expression,func_name,key_column,module,month_column,value_column\n"
        "var_0,,,,,placeholder,,\n"
        "var_1,,,np.sum,seqNo,ff_common_stat,,amount\n"
        'var_2,,"df[""var_1""]+1",,,ff_customized_var,,\n',
        encoding="utf-8",
    )
    first, second = read_dictionary(spark, str(path))
    assert (first.name, first.kind, first.period, first.value) == ("var_1", STAT, None, "amount")
    assert second.expression == 'df["var_1"]+1'


def test_panel_and_config_files(spark, tmp_path):
    (tmp_path / "p.txt").write_text("﻿m1\tc1\ta1\tkind\t\n1\tx\t2.5\tA\t0.1\n2\tx\t\tB\t0.2\n", encoding="utf-8")
    df = read_panel(spark, str(tmp_path / "p.txt"))
    assert df.columns == ["m1", "c1", "a1", "kind"]
    assert [tuple(r) for r in df.orderBy("m1").collect()] == [(1, "x", 2.5, "A"), (2, "x", None, "B")]
    write_features(df, str(tmp_path / "out.parquet"))
    assert read_panel(spark, str(tmp_path / "out.parquet")).count() == 2
    write_features(df, str(tmp_path / "csv"), file_format="csv")
    assert spark.read.csv(str(tmp_path / "csv"), header=True).columns == df.columns
    (tmp_path / "c.txt").write_text(
        "datasource\tmonth_col\tkey_col\tmonth_start\tmonth_end\twhere\np\tm1\tc1\t1\t2\t\n"
    )
    (config,) = read_config(spark, str(tmp_path / "c.txt"))
    assert Source.from_row(config) == Source("p", "c1", "m1", 1, 2)
    meta = [{"filename": "p", "var_name": c, "var_type": "Numbers"} for c in ("m1", "a1")]
    assert columns_of_type(meta, "p", "Numbers", without=("m1",)) == ["a1"]


def test_check_of_two_sources(panel):
    meta = [
        {"filename": name, "var_name": c, "var_type": t}
        for name in ("one", "two")
        for c, t in (("month", "Numbers"), ("a", "Numbers"), ("b", "Numbers"), ("kind", "String"))
    ]
    sources = [Source("one", "customer", "month", 1, 4), Source("two", "customer", "month", 3, 12, None, ("b",))]
    report = check({"one": panel, "two": panel}, meta, sources)
    assert {(r["filename"], r["var_name"]) for r in report.numbers.collect()} == {
        ("one", "a"), ("one", "b"), ("two", "a"),
    }
    assert report.numbers.columns[:9] == [
        "filename", "var_name", "cnt", "cnt_isna", "pct_isna", "sum", "min", "max", "avg",
    ]
    keys = len({r[0] for r in ROWS})
    counts = report.presence.groupBy("filename").agg(F.sum("month_str_count").alias("n")).collect()
    assert {r["filename"]: r["n"] for r in counts} == {"one": keys, "two": keys}
    assert {r["var_value"] for r in report.categories.collect()} == {"A", "B", "C", None}


# --- JSON requests -----------------------------------------------------------


def request(step="201", key="S1", data=None, **more):
    body = {"code": "1", "workflow_step": step, "seqNo": key, "data": data, **more}
    return json.dumps({k: v for k, v in body.items() if v is not None})


STEP = Step(
    "201", "$.data[*]", "seqNo", "$.seqNo",
    (
        Feature("total", STAT, "seqNo", None, "case_id", None, "np.sum"),
        Feature("mid", STAT, "seqNo", None, "case_id", None, "np.median"),
        Feature("missing", STAT, "seqNo", None, "extra.n", None, "cnt_isna"),
        Feature("both", EXPRESSION, "seqNo", expression='df["total"]+df["missing"]'),
    ),
)

GOOD = [
    ("r1", request(data=[{"case_id": "10"}, {"case_id": 5, "extra": {"n": "1"}}])),
    ("r2", request(data=[{"case_id": "7", "other": [1]}])),
]
BAD = {
    "b1": ("{broken", "missing workflow step"),
    "b2": (request(step="9", data=[{"case_id": "1"}]), "unknown workflow step"),
    "b3": (request(data=[]), "no rows"),
    "b4": (request(), "no rows"),
    "b5": (request(key=None, data=[{"case_id": "1"}]), "missing key"),
    "b6": (request(data=[{"case_id": "one"}]), "not a number"),
}


@pytest.fixture(scope="module")
def requests(spark):
    rows = GOOD + [(k, doc) for k, (doc, _) in BAD.items()]
    return spark.createDataFrame(rows, "request_id string, document string")


EXPECTED = {("r1", "S1"): (15.0, 7.5, 1, 16.0), ("r2", "S1"): (7.0, 7.0, 1, 8.0)}


def values(df):
    return {(r["request_id"], r["key"]): (r["total"], r["mid"], r["missing"], r["both"]) for r in df.collect()}


def test_online_batch(requests):
    tables, rejected = online_features(requests, [STEP], 12)
    assert values(tables["201"]) == EXPECTED
    assert {r["request_id"]: r["reason"] for r in rejected.collect()} == {k: why for k, (_, why) in BAD.items()}


def test_online_parts_are_joined_and_keys_may_come_from_rows(spark):
    docs = spark.createDataFrame(
        [("r", request(data=[{"id": "S1", "v": "2"}, {"id": "S2", "v": "3"}], more=[{"w": "4", "m": "12"}]))],
        "request_id string, document string",
    )
    by_row = Step("201", "$.data[*]", "id", None, (Feature("v_sum", STAT, "id", None, "v", None, "np.sum"),))
    by_root = Step("201", "$.more[*]", "seqNo", "$.seqNo",
                   (Feature("w_max", STAT, "seqNo", "m", "w", 3, "np.max"),))
    tables, _ = online_features(docs, [by_row], 12)
    assert {(r["key"], r["v_sum"]) for r in tables["201"].collect()} == {("S1", 2.0), ("S2", 3.0)}
    tables, _ = online_features(docs, [by_row, by_root], 12)
    assert [tuple(r) for r in tables["201"].collect()] == [("r", "S1", 2.0, 4.0)]


def test_online_windows_over_text_periods(spark):
    """Periods are text in JSON; two and ten must not sort as text."""
    data = [{"m": str(p), "v": str(v)} for p, v in ((9, 1), (10, 4), (11, 5), (12, 6), (2, 9))]
    twice = [{"m": "12", "v": "1"}, {"m": "12.0", "v": "2"}]
    docs = spark.createDataFrame(
        [("ok", request(data=data)), ("twice", request(data=twice))], "request_id string, document string"
    )
    features = (
        Feature("r", RATIO, "seqNo", "m", months=2, numerator=("v",), denominator=("v", "v")),
        Feature("run", STREAK, "seqNo", "m", "v", 4, threshold=2.0),
        Feature("total", STAT, "seqNo", "m", "v", 3, "np.sum"),
        Feature("half", STREAK, "seqNo", "m", "r", 4, threshold=0.4),
    )
    step = Step("201", "$.data[*]", "seqNo", "$.seqNo", features)
    tables, rejected = online_features(docs, [step], 12)
    (row,) = tables["201"].collect()
    assert (row["run"], row["total"], row["half"]) == (3, 15.0, 4)
    assert [tuple(r) for r in rejected.collect()] == [("twice", "repeated period")]


def test_stream_equals_batch(spark, requests, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    rows = [r.asDict() for r in requests.collect()]
    (source / "one.json").write_text("\n".join(json.dumps(r) for r in rows[:3]))
    (source / "two.json").write_text("\n".join(json.dumps(r) for r in rows[3:]))
    stream = (
        spark.readStream.schema("request_id string, document string")
        .option("maxFilesPerTrigger", 1)
        .json(str(source))
    )
    query = start_online(
        stream, [STEP], 12, str(tmp_path / "out"), str(tmp_path / "state"), availableNow=True
    )
    assert query.awaitTermination(120)
    assert values(spark.read.parquet(str(tmp_path / "out/step=201"))) == EXPECTED
    rejected = spark.read.parquet(str(tmp_path / "out/rejected"))
    assert rejected.count() == len(BAD)


def test_documents_from_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(json.loads(GOOD[0][1]), indent=2))
    docs = read_documents(spark, str(tmp_path))
    tables, rejected = online_features(docs, [STEP], 12)
    ((_, key, total, *_),) = [tuple(r) for r in tables["201"].collect()]
    assert (key, total) == ("S1", 15.0)
    assert rejected.count() == 0
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "b.txt").write_text("\n".join(doc for _, doc in GOOD))
    assert read_documents(spark, str(tmp_path / "lines"), one_per_line=True).select("request_id").distinct().count() == 2


def test_row_schema_conflicts():
    assert "b" in rows_schema(["a.b", "c"]).simpleString()
    for fields in (["a", "a.b"], ["a.b", "a"]):
        with pytest.raises((ValueError, AttributeError)):
            rows_schema(fields)


def test_requests_are_shuffled_once(spark):
    """Features of a request need no exchange beyond the one that removes repeats."""
    from workload.queries import LAST, STEP, requests

    tables, _ = online_features(requests(spark, "/root/testdata/sf0.001"), [STEP], LAST)
    table = tables["201"]
    table.collect()
    plan = table._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Scan parquet") == 1 or plan.count("FileScan parquet") == 1


def test_a_stored_panel_is_pruned_and_not_shuffled(spark):
    rows = panel_rows(seed=5, keys=40)
    df = spark.createDataFrame(rows + [(None, 3, 1.0, 1.0, 1.0, "A"), ("odd", None, 1.0, 1.0, 1.0, "A")], SCHEMA)
    stored = store_panel(df, "layout_test", "customer", "month", buckets=4)
    assert stored.columns == df.columns
    assert Counter(map(tuple, stored.collect())) == Counter(map(tuple, df.collect()))
    features = [
        Feature("total", STAT, "customer", "month", "a", 3, "np.sum").at(10, 11),
        Feature("run", STREAK, "customer", "month", "a", 3, threshold=2.0).at(10, 11),
    ]
    found = trailing_features(stored, features, unique_periods=True, keyed=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SelectedBucketsCount: 4 out of 4" in plan
    assert "PartitionFilters: [isnotnull(month" in plan and "(month#" in plan.split("PartitionFilters")[1][:200]
    expected = trailing_features(df, features, unique_periods=True).collect()
    assert sorted(map(str, found.collect())) == sorted(map(str, expected)) and expected
    plain = store_panel(df, "layout_plain", "customer", "month", buckets=4, by_period=False)
    again = trailing_features(plain, features, unique_periods=True, keyed=True)
    assert "Exchange" not in again._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, again.collect())) == sorted(map(str, expected))


def test_added_statistics_need_a_code_of_their_own(spark):
    with pytest.raises(ValueError):
        register_statistic("np.sum", lambda v, only: f"sum({v}) {only}")
    df = spark.createDataFrame(panel_rows(seed=6), SCHEMA)
    unknown = Feature("x", STAT, "customer", "month", "a", 3, "no such code").at(12)
    with pytest.raises(ValueError, match="unknown statistic"):
        trailing_features(df, [unknown])
    register_statistic("deviation", lambda v, only: f"stddev_pop({v}) {only}")
    got = trailing_features(df, [Feature("x", STAT, "customer", "month", "a", 3, "deviation").at(10, 12)]).collect()
    for r in got:
        inside = [x[2] for x in panel_rows(seed=6) if x[0] == r["customer"] and 0 <= r["base_period"] - x[1] < 3]
        seen = [v for v in inside if v is not None]
        mean = sum(seen) / len(seen) if seen else 0.0
        expected = (sum((v - mean) ** 2 for v in seen) / len(seen)) ** 0.5 if seen else None
        assert r["x"] == (None if expected is None else pytest.approx(expected, abs=1e-9))
