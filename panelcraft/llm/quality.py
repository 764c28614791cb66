"""Quality classifier: regularised quadratic discriminant over document statistics.

Every text becomes a vector of transformed statistics. Per class, mean and
covariance come from sums over all learning rows; the covariance is shrunk
towards the pooled one and towards its diagonal. A text's score is the logistic
of the difference of the two Mahalanobis log densities, moved by a bias that is
fitted on the learning rows so that ``threshold`` separates them best.

Cholesky factors are computed once per fit and shipped as small constants.

Defined cases: null and empty texts have the statistics of an empty text and
get a score like any other; labels that are null, or of documents that are not
there, teach nothing; several labels for a document all count; without rows of
both classes every score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcraft.llm.common import Stored, map_rows

SYMBOLS = "#*$%&|<>"
FEATURES = (
    "log_words", "word_length", "word_spread", "symbol_rate", "digit_rate", "upper_rate",
    "punct_rate", "line_length", "dup_line_rate", "repeat_rate", "variety", "stop_entropy",
    "top_word_rate", "short_line_rate", "odd_rate",
)
_DIGIT, _UPPER, _PUNCT = re.compile("[0-9]"), re.compile("[A-ZÀ-Þ]"), re.compile(r"[.,;:!?'\"()-]")
_ODD = re.compile("[^\\w\\s.,;:!?'\"()-]")


def features(text: str | None) -> list[float]:
    """Transformed statistics of one whole text; rates are square roots, sizes logarithms."""
    text = text or ""
    words = text.encode().split()
    n, chars = len(words), max(1, len(text))
    lines = [x for x in text.split("\n") if x.strip()]
    lengths = np.fromiter(map(len, words), np.float64, n)
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    share = np.bincount(ids) / n if n else np.zeros(1)
    share = share[share > 0]
    entropy = float(-(share * np.log(share)).sum()) if n else 0.0
    pairs = ids[:-1] * (len(seen) + 1) + ids[1:]
    repeated = 1 - len(np.unique(pairs)) / len(pairs) if n > 1 else 0.0
    root = math.sqrt
    return [
        math.log1p(n),
        math.log1p(float(lengths.mean()) if n else 0.0),
        math.log1p(float(lengths.std()) if n else 0.0),
        root(sum(map(text.count, SYMBOLS)) / chars),
        root(len(_DIGIT.findall(text)) / chars),
        root(len(_UPPER.findall(text)) / chars),
        root(len(_PUNCT.findall(text)) / chars),
        math.log1p(len(text) / max(1, len(lines))),
        root((len(lines) - len(set(lines))) / max(1, len(lines))),
        root(repeated),
        len(seen) / max(1, n),
        entropy / math.log(n) if n > 1 else 0.0,
        root(float(share.max()) if n else 0.0),
        root(sum(len(x) < 30 for x in lines) / max(1, len(lines))),
        root(len(_ODD.findall(text)) / chars),
    ]


@dataclass(frozen=True)
class Discriminant:
    """Per class: mean, inverse Cholesky factor and log determinant; then prior odds and bias."""

    means: tuple[np.ndarray, ...]
    whiten: tuple[np.ndarray, ...]
    log_det: tuple[float, ...]
    odds: float
    bias: float = 0.0

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0, with the prior odds and the bias."""
        if not self.means:
            return np.full(len(x), self.odds)
        half = [
            -0.5 * (((x - m) @ w.T) ** 2).sum(axis=1) - 0.5 * d
            for m, w, d in zip(self.means, self.whiten, self.log_det, strict=True)
        ]
        return half[1] - half[0] + self.odds + self.bias


def scores(margins: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margins / len(FEATURES), -30, 30)))


def discriminant(sums: dict[int, tuple], pooling: float, ridge: float) -> Discriminant:
    """The classifier from (n, sum of x, sum of x xT) per class."""
    n = {c: sums[c][0] if c in sums else 0 for c in (0, 1)}
    if not n[0] or not n[1]:
        total = n[0] + n[1]
        share = (n[1] + 0.5) / (total + 1)
        return Discriminant((), (), (), len(FEATURES) * math.log(share / (1 - share)))
    means, spreads = [], []
    for c in (0, 1):
        mean = sums[c][1] / n[c]
        means.append(mean)
        spreads.append(sums[c][2] / n[c] - np.outer(mean, mean))
    pooled = (n[0] * spreads[0] + n[1] * spreads[1]) / (n[0] + n[1])
    whiten, log_det = [], []
    for spread in spreads:
        shrunk = (1 - pooling) * spread + pooling * pooled
        shrunk = (1 - ridge) * shrunk + ridge * np.diag(np.diag(pooled)) + 1e-6 * np.eye(len(shrunk))
        factor = np.linalg.cholesky(shrunk)
        whiten.append(np.linalg.inv(factor))
        log_det.append(2 * float(np.log(np.diag(factor)).sum()))
    return Discriminant(tuple(means), tuple(whiten), tuple(log_det), math.log(n[1] / n[0]))


def _class_sums(rows: DataFrame) -> dict[int, tuple]:
    """Sums over all learning rows: per class and pair of statistics one number."""
    d = len(FEATURES)
    ones = [F.count(F.lit(1)).alias("n")]
    first = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(d)]
    second = [
        F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"s{i}_{j}") for i in range(d) for j in range(i, d)
    ]
    found = {}
    for r in rows.groupBy("label").agg(*ones, *first, *second).collect():  # two rows
        square = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                square[i, j] = square[j, i] = r[f"s{i}_{j}"]
        found[r["label"]] = (r["n"], np.array([r[f"s{i}"] for i in range(d)]), square)
    return found


def _bias(rows: DataFrame, model: Discriminant, threshold: float) -> float:
    """The shift of margins with the best balanced accuracy of ``score >= threshold`` on learning rows.

    Margins are counted in bins per class, so the driver gets a fixed number of rows.
    """
    if not model.means:
        return 0.0
    width = 0.25
    binned = map_rows(
        rows,
        ["label"],
        ["x"],
        lambda xs: [
            (int(b),) for b in np.clip(np.floor(model.margins(np.array(xs)) / width), -2000, 2000)
        ],
        "bin int",
    )
    counts = {0: np.zeros(4001), 1: np.zeros(4001)}
    for r in binned.groupBy("label", "bin").count().collect():  # at most 2 x 4001 rows
        counts[r["label"]][r["bin"] + 2000] = r["count"]
    below = np.cumsum(counts[0]) / counts[0].sum()
    above = 1 - np.cumsum(counts[1]) / counts[1].sum()
    cut = (int(np.argmax(below + above)) + 1 - 2000) * width
    return len(FEATURES) * math.log(threshold / (1 - threshold)) - cut


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    threshold: float = 0.3,
    pooling: float = 0.1,
    ridge: float = 0.02,
) -> DataFrame:
    """doc_id, score, predicted for every document; ``learn`` picks the rows that teach.

    The statistics of all texts are stored once and read for the sums, the bias
    and the scores. Labels are joined on doc_id; only small vectors move.
    """
    store = Stored(docs.sparkSession)
    x = store.put(
        "statistics",
        map_rows(docs, ["doc_id"], ["text"], lambda t: [(features(v),) for v in t], "x array<double>"),
    )
    marked = labels.filter(F.col("quality").isin(0, 1)).select(
        "doc_id", F.col("quality").cast("int").alias("label")
    )
    rows = store.put("learning", x.filter(learn).join(marked, "doc_id"))
    model = discriminant(_class_sums(rows), pooling, ridge)
    fitted = Discriminant(
        model.means, model.whiten, model.log_det, model.odds, _bias(rows, model, threshold)
    )
    store.drop("learning")
    return map_rows(
        x,
        ["doc_id"],
        ["x"],
        lambda xs: [(float(s),) for s in scores(fitted.margins(np.array(xs)))],
        "score double",
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
