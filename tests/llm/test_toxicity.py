"""FTRL-proximal toxicity scores: the update against a plain version, whole fits, edge rows."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcraft.llm import toxicity
from panelcraft.llm.common import fold, table

SF, LARGER = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


def plain_ftrl(rows, alpha, beta, l1, l2, epochs):
    """The published per-coordinate update, one coordinate at a time."""
    z, n = {}, {}

    def weight(i, first, second):
        if abs(z.get(i, 0.0)) <= first:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return -(z[i] - sign * first) / ((beta + math.sqrt(n[i])) / alpha + second)

    for _ in range(epochs):
        for label, at in rows:
            w = {i: weight(i, l1, l2) for i in at} | {"b": weight("b", 0.0, 0.0)}
            g = 1 / (1 + math.exp(-sum(w.values()))) - label
            for i, wi in w.items():
                s = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / alpha
                z[i] = z.get(i, 0.0) + g - s * wi
                n[i] = n.get(i, 0.0) + g * g
    own = {i: weight(i, l1, l2) for i in z if i != "b"}
    return {i: w for i, w in own.items() if w}, weight("b", 0.0, 0.0)


@pytest.mark.parametrize("l1", [0.0, 0.5, 3.0])
def test_update_is_the_published_one(l1):
    rng = random.Random(3)
    rows = [
        (rng.random() < 0.3, np.array(sorted(rng.sample(range(50), rng.randint(0, 12))), np.uint32))
        for _ in range(300)
    ]
    made = toxicity.ftrl(rows, 0.5, 1.0, l1, 1.0, 2)
    weights, intercept = plain_ftrl(rows, 0.5, 1.0, l1, 1.0, 2)
    assert dict(zip(made.at.tolist(), made.weight.tolist(), strict=True)) == pytest.approx(weights)
    assert made.intercept == pytest.approx(intercept)
    assert l1 < 3 or len(made.at) < 50


def test_margin_counts_a_place_once():
    weights = toxicity.Weights(np.array([3, 9], np.uint32), np.array([1.5, -0.25]), 0.5)
    assert weights.margin(np.array([9, 3, 3, 7, 9], np.uint32)) == 1.75
    assert weights.margin(np.array([], np.uint32)) == 0.5


def test_grams_of_a_text():
    n = len(toxicity.places("a b c d e"))
    assert n == 5 + 4 + 3 + 2 + 3  # words, neighbours, one and two between, triples
    same = toxicity.places("A, b! C d. e")
    assert (np.sort(same) == np.sort(toxicity.places("a b c d e"))).all()
    assert len(toxicity.places(None)) == len(toxicity.places(" .,_ ")) == 0
    assert len(set(toxicity.places("b a").tolist()) - set(toxicity.places("a b").tolist())) == 1


def test_held_out_rows(spark):
    docs, labels = table(spark, LARGER, "documents"), table(spark, LARGER, "labels")
    held = fold("doc_id", 5) == 0
    weights = toxicity.learn_toxicity(docs, labels, ~held)
    assert 0 < len(weights.at) < 5_000  # compact: of 2 ** 20 places
    scored = toxicity.toxicity_scores(docs, weights).filter(held).join(labels, "doc_id")
    words = "trash pathetic idiot worthless disgusting stupid clown scum loser moron".split()
    planted = F.lower("text").rlike(rf"\b({'|'.join(words)})\b")
    rows = scored.join(docs.select("doc_id", planted.alias("planted")), "doc_id").collect()
    bad = [r for r in rows if r["toxic"] and r["planted"]]
    clean = [r for r in rows if not r["toxic"]]
    assert sum(r["predicted"] for r in bad) >= 0.9 * len(bad) > 0
    assert sum(r["predicted"] for r in clean) <= 0.005 * len(clean)


def test_a_small_draw_is_the_same_on_other_partitions(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    one = toxicity.learn_toxicity(docs, labels, F.lit(True), most=150)
    other = toxicity.learn_toxicity(docs.repartition(7), labels.repartition(3), F.lit(True), most=150)
    assert one.at.tolist() == other.at.tolist()
    assert one.weight.tolist() == other.weight.tolist() and one.intercept == other.intercept


def test_edge_rows(spark, edges, none, clashing):
    labels = spark.createDataFrame(
        [(1, 0), (2, 1), (20, 1), (20, 1), (21, 0), (None, 1), (30, None), (31, 7), (999, 1)]
        + [(k, k % 2) for k in range(32, 60)],
        "doc_id long, toxic int",
    )
    weights = toxicity.learn_toxicity(edges, labels, F.lit(True))
    rows = toxicity.toxicity_scores(edges, weights).collect()
    assert len(rows) == edges.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    lone = 1 / (1 + math.exp(-weights.intercept))
    assert {r["score"] for r in rows if r["doc_id"] in (1, 2, 5)} == {lone}
    same = toxicity.toxicity_scores(clashing, toxicity.learn_toxicity(clashing, labels, F.lit(True)))
    assert sorted(map(str, same.collect())) == sorted(map(str, rows))
    assert toxicity.toxicity_scores(none, weights).collect() == []


@pytest.mark.parametrize("given, share", [([], 0.5), ([(30, 0)] * 2 + [(31, 0), (32, 0)], 1 / 8)])
def test_without_both_classes(spark, edges, given, share):
    labels = spark.createDataFrame(given, "doc_id long, toxic int")
    weights = toxicity.learn_toxicity(edges, labels, F.lit(True))
    rows = toxicity.toxicity_scores(edges, weights).collect()
    assert all(r["score"] == pytest.approx(share) for r in rows)
