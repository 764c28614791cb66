"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are its distinct words, pairs and triples of neighbours, and
pairs with one or two words between them, all hashed to ``DIMENSIONS`` places.
The weights are learnt by follow-the-regularised-leader: every place has its own
learning rate, which falls with the gradients that it has seen, and L1 keeps
places at exactly zero until their evidence exceeds it. What is left is a short
list of (place, weight) that every task holds.

It learns from at most about ``most`` rows, drawn by a hash of (doc_id, text), so
the fit is one short task whatever the number of labels. Both classes are drawn
at one rate, except that a rare label 1 keeps up to a tenth of ``most``; the
intercept is then moved by the classes' shares among all labelled rows.

Defined cases: null, empty and wordless texts have no feature and get the score
of the intercept; labels that are null or neither 0 nor 1, or of documents that
are not there, teach nothing; equal (doc_id, text, label) rows teach once; with
labels of one class only, or none, the score is the share of label 1 (smoothed
by half a row each); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import functools
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcraft.llm.common import Stored, map_rows

BITS = 20
DIMENSIONS = 1 << BITS
#: Rows that the fit draws from all labelled rows, and the share that a rare label 1 may add.
MOST = 16_000
RARE = 0.1
#: Words whose hash a task remembers.
KNOWN = 500_000
_WORD = re.compile(r"[^\W_]+")
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(values: np.ndarray) -> np.ndarray:
    """64 well-mixed bits of every value."""
    values = (values ^ (values >> np.uint64(31))) * _SPREAD
    return (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


@functools.lru_cache(maxsize=1)
def _hashes() -> dict[str, int]:
    return {}


def _word_hashes(words: list[str]) -> np.ndarray:
    known = _hashes()
    if len(known) > KNOWN:
        known.clear()
    for word in set(words).difference(known):
        raw = word.encode("utf-8", "replace")
        known[word] = zlib.crc32(raw) << 32 | zlib.adler32(raw)
    return _mixed(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))


def places(text: str | None) -> np.ndarray:
    """The hashed place of every n-gram and skip-gram of the text, repeats included."""
    h = _word_hashes(_WORD.findall((text or "").lower()))
    three = np.uint64(3)
    grams = [h]
    for kind, gap in enumerate((1, 2, 3), 1):  # neighbours, one between, two between
        grams.append(_mixed(h[:-gap] * three + h[gap:] + np.uint64(kind)))
    grams.append(_mixed((h[:-2] * three + h[1:-1]) * three + h[2:]))
    return (np.concatenate(grams) >> np.uint64(64 - BITS)).astype(np.uint32)


@dataclass(frozen=True)
class Weights:
    """The places with a weight, ascending, their weights, and the intercept."""

    at: np.ndarray
    weight: np.ndarray
    intercept: float

    def margin(self, found: np.ndarray) -> float:
        """Intercept plus the weights of the distinct places in ``found``."""
        if not len(self.at):
            return self.intercept
        spot = np.minimum(np.searchsorted(self.at, found), len(self.at) - 1)
        held = np.unique(spot[self.at[spot] == found])
        return self.intercept + float(self.weight[held].sum())


def ftrl(
    rows: list[tuple[int, np.ndarray]],
    alpha: float,
    beta: float,
    l1: float,
    l2: float,
    epochs: int,
) -> Weights:
    """Weights after ``epochs`` passes over (label, distinct places), in the given order.

    Place ``DIMENSIONS`` is the intercept, which is not held back by L1 or L2.
    """
    z, n = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)

    def solved(zs: np.ndarray, ns: np.ndarray, first: float, second: float) -> np.ndarray:
        held = np.maximum(np.abs(zs) - first, 0.0)
        return -np.sign(zs) * held / ((beta + np.sqrt(ns)) / alpha + second)

    for _ in range(epochs):
        for label, at in rows:
            zs, ns = z[at], n[at]
            w = solved(zs, ns, l1, l2)
            b = float(solved(z[-1:], n[-1:], 0.0, 0.0)[0])
            margin = max(-35.0, min(35.0, b + float(w.sum())))
            g = 1 / (1 + math.exp(-margin)) - label
            after = ns + g * g
            z[at] = zs + g - (np.sqrt(after) - np.sqrt(ns)) / alpha * w
            n[at] = after
            grown = n[-1] + g * g
            z[-1] += g - (math.sqrt(grown) - math.sqrt(n[-1])) / alpha * b
            n[-1] = grown
    weights = solved(z[:-1], n[:-1], l1, l2)
    at = np.flatnonzero(weights)
    return Weights(at.astype(np.uint32), weights[at], float(solved(z[-1:], n[-1:], 0.0, 0.0)[0]))


def learn_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    most: int = MOST,
    alpha: float = 1.0,
    beta: float = 1.0,
    l1: float = 10.0,
    l2: float = 1.0,
    epochs: int = 3,
) -> Weights:
    """Weights from the labelled rows of ``docs`` that ``learn`` picks.

    All labelled rows are counted first; the draw is by a hash that no column decides alone.
    """
    marked = labels.filter(F.col("toxic").isin(0, 1)).select(
        "doc_id", F.col("toxic").cast("int").alias("label")
    )
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    rows = docs.filter(learn).select("doc_id", "text", draw.alias("draw")).join(marked, "doc_id")
    store = Stored(docs.sparkSession)
    keys = store.put("labelled", rows.select("doc_id", "draw", "label").distinct())
    count = {r["label"]: r["count"] for r in keys.groupBy("label").count().collect()}  # two rows
    store.drop("labelled")
    n = [count.get(c, 0) for c in (0, 1)]
    share = (n[1] + 0.5) / (sum(n) + 1)
    if not all(n):
        return Weights(np.zeros(0, np.uint32), np.zeros(0), math.log(share / (1 - share)))
    even = min(1.0, most / sum(n))
    rate = [even, min(1.0, max(even, RARE * most / n[1]))]
    kept = F.when(F.col("label") == 1, rate[1]).otherwise(rate[0]) * float(1 << 30)
    drawn = rows.filter(F.col("draw") < kept).dropDuplicates(["doc_id", "draw", "label"])
    measured = map_rows(
        drawn,
        ["draw", "label"],
        ["text"],
        lambda texts: [(np.unique(places(t)).astype(np.int32),) for t in texts],
        "places array<int>",
    )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[tuple[int, np.ndarray]] = []
        for batch in batches:
            # Sums of lengths cut the flat values, so that no row passes through Python lists.
            values, ends = batch["places"].flatten().to_numpy(), batch["places"].offsets.to_numpy()
            ends = ends - ends[0]
            seen += [
                (label, values[ends[k] : ends[k + 1]])
                for k, label in enumerate(batch["label"].to_pylist())
            ]
        made = ftrl(seen, alpha, beta, l1, l2, epochs)
        at = np.append(made.at.astype(np.int32), np.int32(-1))
        weight = np.append(made.weight, made.intercept)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(weight)], ["at", "weight"])

    # About `most` rows and a tenth at most, in an order that does not depend on their partitions.
    ordered = measured.repartition(1).sortWithinPartitions("draw", "label", "places")
    found = ordered.mapInArrow(fit, "at int, weight double").orderBy("at").collect()
    odds = math.log(n[1] / n[0]) - math.log((n[1] * rate[1]) / (n[0] * rate[0]))
    at = np.array([r["at"] for r in found[1:]], np.uint32)
    return Weights(at, np.array([r["weight"] for r in found[1:]]), found[0]["weight"] + odds)


def toxicity_scores(docs: DataFrame, weights: Weights, threshold: float = 0.5) -> DataFrame:
    """doc_id, score, predicted of every whole text; one pass without a shuffle."""

    def scored(texts: list[str | None]) -> Iterator[tuple]:
        for text in texts:
            margin = max(-35.0, min(35.0, weights.margin(places(text))))
            yield (1 / (1 + math.exp(-margin)),)

    made = map_rows(docs, ["doc_id"], ["text"], scored, "score double")
    return made.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
