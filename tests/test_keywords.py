"""Keyword tables against the definition, value by value."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from panelcraft.operators.keywords import METHODS, match_keywords


def plain(value, words, method):
    if value is None:
        return 0
    test = {
        "equal": lambda w: w == value,
        "contain": lambda w: w in value,
        "contained": lambda w: value in w,
    }[method]
    return int(any(w is not None and test(w) for w in words))


@pytest.mark.parametrize("method", METHODS)
@pytest.mark.parametrize("shortest", [0, 1, 3, 6])
def test_random_strings(spark, method, shortest):
    rng = random.Random(shortest)
    text = lambda low, high: "".join(rng.choices("abcé漢", k=rng.randint(low, high)))
    words = [text(shortest, 9) for _ in range(60)] + [None, "abcabc", "abcabc"]
    values = [text(0, 14) for _ in range(300)] + [None, "", "abc", "abcabc"] + ["hot value abcabc"] * 200
    df = spark.createDataFrame(list(enumerate(values)), "n int, v string")
    table = spark.createDataFrame([(w,) for w in words], "w string")
    got = match_keywords(df, "v", table, "w", method, "hit").collect()
    assert len(got) == len(values)
    assert {r["n"]: r["hit"] for r in got} == {n: plain(v, words, method) for n, v in enumerate(values)}


@pytest.mark.parametrize("method", METHODS)
@pytest.mark.parametrize("shortest", [0, 2, 5])
@pytest.mark.parametrize("most", [0, 40, 1_000])
def test_sent_and_joined_words_agree(spark, monkeypatch, method, shortest, most):
    """Below, between and above the numbers of words and values; words of the same head and several lengths."""
    from panelcraft.operators import keywords

    monkeypatch.setattr(keywords, "MOST_SENT", most)
    rng = random.Random(shortest)
    text = lambda low, high: "".join(rng.choices("abé\U0001f600", k=rng.randint(low, high)))
    words = [text(shortest, 8) for _ in range(50)] + ["abéab" * 2, "abéab" * 3, "abéab" * 3 + "b", None]
    values = [text(0, 20) for _ in range(200)] + [None, "", "abéab", "abéab" * 3, "x" + "abéab" * 4] + ["bbb"] * 99
    df = spark.createDataFrame(list(enumerate(values)), "n int, v string").repartition(3)
    table = spark.createDataFrame([(w,) for w in words], "w string")
    got = match_keywords(df, "v", table, "w", method, "hit").collect()
    assert {r["n"]: r["hit"] for r in got} == {n: plain(v, words, method) for n, v in enumerate(values)}
    assert len(got) == len(values)


def test_few_words_move_no_rows(spark, monkeypatch):
    """Words and values below a checked number are sent: no n-gram of a value is shuffled, nor a row."""
    from panelcraft.operators import keywords

    monkeypatch.setattr(keywords, "MOST_SENT", 5_000)
    rows = spark.range(20_000).select("id", F.md5(F.col("id").cast("string")).alias("code"))
    rows = rows.withColumn("short", F.substring("code", 1, 2))
    words = spark.range(3_000).select(F.substring(F.sha1(F.col("id").cast("string")), 1, 6).alias("w"))

    contain = match_keywords(rows, "code", words, "w", "contain")
    assert "Exchange" not in contain._jdf.queryExecution().executedPlan().toString()
    assert contain.agg(F.sum("matched")).first()[0] > 0
    for column, method in (("code", "equal"), ("short", "contained")):
        plan = match_keywords(rows, column, words, "w", method)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin [_text" in plan and "SortMergeJoin [_text" not in plan


@pytest.mark.parametrize("method", METHODS)
def test_empty_tables_and_clashing_names(spark, method):
    df = spark.createDataFrame([(1, "a", "x"), (2, None, "y")], "_gram int, _text string, _hit string")
    none = spark.createDataFrame([], "w string")
    assert [r["matched"] for r in match_keywords(df, "_text", none, "w", method).collect()] == [0, 0]
    assert match_keywords(df.where("_gram > 5"), "_text", none, "w", method).collect() == []
    some = spark.createDataFrame([("a",), (None,)], "_word string")
    got = match_keywords(df, "_text", some, "_word", method).orderBy("_gram")
    assert got.columns == ["_gram", "_text", "_hit", "matched"]
    assert [tuple(r) for r in got.collect()] == [(1, "a", "x", 1), (2, None, "y", 0)]


def test_a_common_gram_makes_no_pairs(spark):
    """Words and values that share a frequent gram meet by a rarer one only."""
    words = spark.range(2_000).select(F.concat(F.lit("common-"), F.md5(F.col("id").cast("string"))).alias("w"))
    values = spark.range(2_000).select(F.concat(F.lit("common-"), F.sha1(F.col("id").cast("string"))).alias("v"))
    from panelcraft.operators import keywords

    joined = keywords.contained_pairs(words, "w", values, "v")
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan and "Cross" not in plan
    assert joined.count() == 0
    assert match_keywords(words, "w", words, "w", "contain").agg(F.min("matched")).first()[0] == 1


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        match_keywords(spark.range(1), "id", spark.range(1), "id", "starts")
