"""Ranked search against every document scored in turn."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelcraft.llm import ranked_search
from tests.llm.conftest import sentence

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def plain(docs, items, k=50):
    """(item_id, rank, doc_id, score) by the definition, every document in turn."""
    words = [(i, terms(t)) for i, t in docs]
    words = [(i, w) for i, w in words if w]
    count, total = len(words), sum(len(w) for _, w in words)
    df = {}
    for _, w in words:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        scored = []
        for doc, w in words:
            m = 50 + (50 * len(w) * count) // total
            score = 0
            for t in wanted & set(w):
                weight = math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                tf = w.count(t)
                score += weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1):
            out.append((item, rank, doc, -score))
    return sorted(map(str, out))


def rows(found):
    return sorted(str((r["item_id"], r["rank"], r["doc_id"], r["score"])) for r in found.collect())


def given(rng, n):
    docs = [(k, sentence(rng, rng.choice([0, 1, 5, 5, 5, rng.randint(1, 60)]))) for k in range(n)]
    copies = [(n + k, docs[7][1] + " ba de") for k in range(n // 3)]  # a third of all rows, one length
    return docs + copies


@pytest.mark.parametrize("block, k", [(200_000, 50), (40, 3), (1, 1)])
def test_random_documents(spark, block, k):
    rng = random.Random(block)
    docs = given(rng, 400)
    items = [(j, sentence(rng, rng.randint(1, 12))) for j in range(30)] + [(99, docs[7][1]), (100, docs[390][1])]
    found = ranked_search.ranked_search(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
        spark.createDataFrame(items, "item_id long, text string"),
        k,
        block,
    )
    assert rows(found) == plain(docs, items, k)


def test_all_terms_and_several_passes(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "VOCABULARY", 3)  # beyond it all terms are indexed
    monkeypatch.setattr(ranked_search, "ITEMS", 4)
    rng = random.Random(1)
    docs = given(rng, 200)
    items = [(f"item {j}", sentence(rng, 8)) for j in range(13)]
    found = ranked_search.ranked_search(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id string, text string"),
        7,
        100,
    )
    assert rows(found) == plain(docs, items, 7)


def test_bounds_skip_blocks_without_changing_results(spark):
    """A task that has its best documents does not score blocks whose bound is lower."""
    rng = random.Random(2)
    docs = [(k, "rare common") for k in range(60)] + [(k, "common " * rng.randint(5, 40)) for k in range(60, 400)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    index = ranked_search.build_index(frame, None, block=30)
    searcher = ranked_search._Searcher({b"rare": 0, b"common": 1}, np.array([[1900.0], [1.0]]), 50)
    batch = index.blocks.toArrow().combine_chunks().to_batches()[0]
    blocks = [searcher.bounded(batch.slice(j, 1)) for j in range(batch.num_rows)]
    for b in sorted(blocks, key=lambda b: -b["bound"].sum()):
        searcher.visit(b)
    assert searcher.skipped > searcher.visited > 0
    assert sorted(searcher.held[3].tolist()) == list(range(50))


def test_very_large_scores_stay_exact():
    """Products beyond 2**53 are made in 64-bit integers."""
    block = {
        "bound": np.array([2.0**61]),
        "part": {"doc_ids": pa.array([4, 5], pa.int64()), "docs": pa.array([0, 1], pa.int32())},
        "sizes": np.array([1, 1]),
        "known": np.array([True, True]),
        "local": np.array([0, 0]),
        "impact": np.array([2**20, 2**20 + 1]),
        "weights": np.array([[2.0**40 + 1]]),
    }
    searcher = ranked_search._Searcher({b"a": 0}, block["weights"], 2)
    searcher.visit(block)
    assert searcher.held[3].tolist() == [5, 4]
    assert searcher.held[1].tolist() == [(2**20 + 1) * (2**40 + 1), 2**20 * (2**40 + 1)]


def test_edge_rows(spark, edges, none, clashing):
    items = [
        (1, "Ba DE fi"), (2, None), (3, ""), (4, " .,;"), (5, "é漢字 \U0001f600"), (6, "unheard of"),
        (None, "ba"), (None, "go lu"), (7, "1234 one"), (7, "two 1234"), (8, "a" * 30_000),
    ]
    asked = spark.createDataFrame(items, "item_id long, text string")
    docs = [(r["doc_id"], r["text"]) for r in edges.collect()]
    expected = plain(docs, items)
    assert rows(ranked_search.ranked_search(edges, asked)) == expected
    more = asked.withColumn("term", F.lit("x")).withColumn("n", F.lit(1))
    assert rows(ranked_search.ranked_search(clashing.withColumn("m", F.lit(1)), more)) == expected
    empty = spark.createDataFrame([], "item_id long, text string")
    assert ranked_search.ranked_search(edges, empty).collect() == []
    assert ranked_search.ranked_search(none, asked).collect() == []
    assert ranked_search.ranked_search(spark.createDataFrame([(1, None)], "doc_id long, text string"), asked).collect() == []
