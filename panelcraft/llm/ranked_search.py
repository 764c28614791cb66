"""Ranked lexical search over a length-stratified index.

A document's normaliser m depends on its number of terms alone. Documents of
equal m form a stratum; in it a posting's impact depends on its tf alone, so
impacts are computed once per (m, tf) and postings are grouped by (term, tf). A
stratum with many postings is cut into blocks by a hash of the row, so no length
that a third of all documents have becomes one task.

A search takes the items in blocks of a bounded size. Every task bounds each of
its index blocks per item by the largest tf of every term there, visits the
blocks from the highest bounds down, skips the items that the bound keeps from
their best ``k``, and scores the rest as one product of (documents x terms) and
(terms x items). What tasks find is ranked once more. All numbers are integers
below 2**53 in doubles, or 64-bit integers, so scores are exact.

Defined cases: null and empty texts, and those without a term, are in no
stratum and count nowhere; rows with equal or null ids are documents of their
own, and null ids come last among equal scores; the rows of one item_id (null
included) are one item with the terms of all of them; an item none of whose
terms occurs, or only with weight 0, has no row; empty tables give an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from panelcraft.llm.common import Stored, map_rows

#: Normaliser: BASE - SHARE + SHARE * n * N div L.
BASE, SHARE = 100, 50
#: (term, document) pairs of an index block.
BLOCK = 50_000
#: Query terms that are held by every task that reads texts; with more, all terms are indexed.
VOCABULARY = 200_000
#: Items, and (item, term) pairs, that are searched in one pass over the index.
ITEMS, PAIRS = 512, 64_000
#: Different normalisers (two numbers each) that are broadcast.
LENGTHS = 200_000
#: Cells of one dense product.
CELLS = 4_000_000
#: Tasks' findings per item are ranked in so many groups first.
SALTS = 32

#: Bytes of terms as they are, A-Z lowered, all others a blank.
_TERM_BYTES = bytes(
    c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else c + 32 if 65 <= c < 91 else 32 for c in range(256)
)


def terms_of(text: bytes | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and all other characters from U+0080; A-Z lowered."""
    return text.translate(_TERM_BYTES).split() if text else []


def _measured(rows: DataFrame, key: str, vocabulary: frozenset[bytes] | None) -> DataFrame:
    """(key, n, terms, tfs) of every row; only terms of the vocabulary, if one is given."""

    def count(texts: list[bytes | None]) -> Iterator[tuple]:
        for text in texts:
            found = terms_of(text)
            tf = Counter(found)
            held = list(tf) if vocabulary is None else [t for t in tf if t in vocabulary]
            yield len(found), held, [tf[t] for t in held]

    texts = rows.select(key, F.col("text").cast("binary").alias("text"))
    return map_rows(texts, [key], ["text"], count, "n long, terms array<binary>, tfs array<int>")


@dataclass(frozen=True)
class Index:
    """Stored blocks of the strata, how often each term occurs, and the documents with a term."""

    blocks: DataFrame
    frequencies: DataFrame
    documents: int


def _block(table: pa.Table) -> pa.Table:
    """One index block: documents, and per (term, tf) descending the documents that hold it."""
    rows = table.combine_chunks()
    lists = rows["terms"].chunk(0)
    size = pc.list_value_length(lists).to_numpy()
    coded = lists.flatten().dictionary_encode()
    term = coded.indices.to_numpy()
    tf = rows["tfs"].chunk(0).flatten().to_numpy()
    doc = np.repeat(np.arange(len(size), dtype=np.int32), size)
    order = np.lexsort((doc, -tf, term))
    term, tf, doc = term[order], tf[order], doc[order]
    new = np.zeros(0, int)
    if len(term):
        new = np.flatnonzero(np.r_[True, (np.diff(term) != 0) | (np.diff(tf) != 0)])

    def listed(values, kind) -> pa.Array:
        values = values if isinstance(values, pa.Array) else pa.array(values, kind)
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    columns = {
        "m": rows["m"].chunk(0)[:1],
        "doc_ids": listed(rows["doc_id"].chunk(0), pa.int64()),
        "terms": listed(coded.dictionary, pa.binary()),
        "term": listed(term[new], pa.int32()),
        "tf": listed(tf[new], pa.int32()),
        "first": listed(new, pa.int32()),
        "docs": listed(doc, pa.int32()),
    }
    return pa.table(columns)


_BLOCK_SCHEMA = (
    "m long, doc_ids array<long>, terms array<binary>, term array<int>, tf array<int>, "
    "first array<int>, docs array<int>"
)


def build_index(docs: DataFrame, vocabulary: frozenset[bytes] | None = None, block: int = BLOCK) -> Index:
    """The index of all documents with a term; postings of the vocabulary's terms, or of all."""
    store = Stored(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    measured = store.put(
        "measured",
        _measured(rows, "doc_id", vocabulary).filter("n > 0").withColumn("row", F.monotonically_increasing_id()),
    )
    count, total = measured.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequencies = store.put("frequencies", measured.select(F.explode("terms").alias("term")).groupBy("term").count())
    strata = measured.withColumn("m", F.expr(f"{BASE - SHARE} + ({SHARE}L * n * {count}L) div {max(total, 1)}L"))
    cuts = store.put(
        "cuts", strata.groupBy("m").agg(F.ceil(F.sum(F.size("terms") + F.lit(1)) / block).alias("cuts"))
    )
    # One row per length: documents meet it without a shuffle unless there are very many lengths.
    cuts = F.broadcast(cuts) if cuts.count() <= LENGTHS else cuts
    placed = strata.join(cuts, "m").withColumn("cut", F.pmod(F.xxhash64("row"), F.col("cuts")))
    blocks = placed.select("m", "cut", "doc_id", "terms", "tfs").groupBy("m", "cut").applyInArrow(_block, _BLOCK_SCHEMA)
    index = Index(store.put("blocks", blocks), frequencies, count)
    store.drop("measured", "cuts")
    return index


def _best(k: int, item: np.ndarray, score: np.ndarray, lost: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Positions of the ``k`` best of every item, best first."""
    order = np.lexsort((doc, lost, -score, item))
    ordered = item[order]
    first = np.flatnonzero(np.r_[True, np.diff(ordered) != 0]) if len(order) else np.zeros(0, int)
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
    return order[rank < k]


class _Searcher:
    """The best ``k`` documents per item of all blocks that one task has visited."""

    def __init__(self, places: dict[bytes, int], weights: np.ndarray, k: int):
        self.places, self.weights, self.k = places, weights, k
        self.least = np.zeros(weights.shape[1], np.int64)
        self.held = [np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)]
        self.visited = self.skipped = 0

    def bounded(self, row: pa.RecordBatch) -> dict:
        """A block with its terms' places, the impacts of its (term, tf) groups, and its bounds."""
        part = {name: row.column(name)[0].values for name in row.schema.names if name != "m"}
        place = np.array([self.places.get(t, -1) for t in part["terms"].to_pylist()], np.int64)
        term, tf = part["term"].to_numpy(), part["tf"].to_numpy().astype(np.int64)
        impact = 1_000_000_000 * tf // (1000 * tf + 20 * row.column("m")[0].as_py())
        known = place >= 0
        local = np.cumsum(known) - 1
        largest = np.zeros(known.sum())
        np.maximum.at(largest, local[term[known[term]]], impact[known[term]])
        weights = self.weights[place[known]]
        ends = np.r_[part["first"].to_numpy()[1:], len(part["docs"])]
        return {
            "part": part,
            "known": known[term],
            "local": local[term],
            "impact": impact,
            "sizes": ends - part["first"].to_numpy(),
            "weights": weights,
            "bound": largest @ weights * (1 + 1e-9),  # whatever the sums are rounded to
        }

    def visit(self, block: dict) -> None:
        """Scores the documents of a block for every item whose bound reaches its best ``k``."""
        bound = block["bound"]
        active = np.flatnonzero((bound > 0) & (bound >= self.least))
        self.visited += len(active)
        self.skipped += len(bound) - len(active)
        if not len(active):
            return
        ids = block["part"]["doc_ids"]
        lost = ids.is_null().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy()
        groups = np.repeat(np.arange(len(block["sizes"])), block["sizes"])
        groups_known = block["known"][groups]
        doc = block["part"]["docs"].to_numpy()[groups_known]
        group = groups[groups_known]
        weights = block["weights"][:, active]
        exact = np.float64 if bound.max() < 2**53 else np.int64
        weights = weights.astype(exact)
        step = max(1, CELLS // max(1, len(weights)))
        for start in range(0, len(ids), step):
            inside = (doc >= start) & (doc < start + step)
            n = min(step, len(ids) - start)
            impacts = np.zeros((n, len(weights)), exact)
            impacts[doc[inside] - start, block["local"][group[inside]]] = block["impact"][group[inside]]
            scores = impacts @ weights
            least = np.maximum(self.least[active], 1)
            if n > self.k:
                least = np.maximum(least, np.partition(scores, n - self.k, axis=0)[n - self.k])
            at, of = np.nonzero(scores >= least)
            self._keep(active[of], scores[at, of].astype(np.int64), lost[start + at], ids[start + at])

    def _keep(self, *found: np.ndarray) -> None:
        if not len(found[0]):
            return
        both = [np.concatenate(pair) for pair in zip(self.held, found, strict=True)]
        best = _best(self.k, *both)
        self.held = [column[best] for column in both]
        item, score = self.held[0], self.held[1]
        last = np.flatnonzero(np.r_[np.diff(item) != 0, True])
        full = np.bincount(item, minlength=len(self.least))[item[last]] >= self.k
        self.least[item[last[full]]] = score[last[full]]


def _searched(index: Index, items: dict, kind: T.StructField, k: int) -> DataFrame:
    """(item_id, doc_id, score): the best ``k`` per item of every task. Items are {id: {term: weight}}."""
    places: dict[bytes, int] = {}
    for terms in items.values():
        for t in terms:
            places.setdefault(t, len(places))
    weights = np.zeros((len(places), len(items)))
    for j, terms in enumerate(items.values()):
        for t, w in terms.items():
            weights[places[t], j] = w
    ids = pa.array(list(items), to_arrow_type(kind.dataType))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = _Searcher(places, weights, k)
        for batch in batches:
            blocks = [searcher.bounded(batch.slice(j, 1)) for j in range(batch.num_rows)]
            for block in sorted(blocks, key=lambda b: -b["bound"].sum()):
                searcher.visit(block)
        item, score, lost, doc = searcher.held
        columns = [
            ids.take(pa.array(item, pa.int64())),
            pa.array(doc, pa.int64(), mask=lost),
            pa.array(score),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["item_id", "doc_id", "score"])

    rest = T.StructType.fromDDL("doc_id long, score long").fields
    return index.blocks.mapInArrow(run, T.StructType([kind, *rest]))


def _item_terms(items: DataFrame) -> DataFrame:
    """Distinct (item_id, term) with a number of the block of items that the item belongs to."""
    counted = _measured(items.select("item_id", "text"), "item_id", None)
    return counted.select("item_id", F.explode("terms").alias("term")).distinct()


def search(index: Index, item_terms: DataFrame, k: int = 50) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of every item, all if fewer."""
    sized = item_terms.join(index.frequencies, "term")
    n_items, n_pairs = sized.agg(F.count_distinct(F.struct("item_id")), F.count(F.lit(1))).first()
    passes = max(1, -(-n_items // ITEMS), -(-n_pairs // PAIRS))
    numbered = sized.withColumn("pass", F.pmod(F.xxhash64("item_id"), F.lit(passes)))
    found = []
    for p in range(passes):
        # About PAIRS rows: the terms of one block of items.
        terms: dict = {}
        for r in numbered.filter(F.col("pass") == p).select("item_id", "term", "count").collect():
            w = math.floor(1000 * math.log((2 * index.documents + 2) / (2 * r["count"] + 1)))
            terms.setdefault(r["item_id"], {})[bytes(r["term"])] = w
        found.append(_searched(index, terms, item_terms.schema["item_id"], k))
    best = functools.reduce(DataFrame.unionByName, found)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = Window.partitionBy("item_id", "salt").orderBy(*order)
    every = Window.partitionBy("item_id").orderBy(*order)
    return (
        best.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
        .withColumn("rank", F.row_number().over(some))
        .filter(F.col("rank") <= k)
        .withColumn("rank", F.row_number().over(every))
        .filter(F.col("rank") <= k)
        .select("item_id", "rank", "doc_id", "score")
    )


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50, block: int = BLOCK) -> DataFrame:
    """The ``k`` best documents of every item, from an index of the terms that the items hold."""
    store = Stored(docs.sparkSession)
    item_terms = store.put("item_terms", _item_terms(items))
    wanted = item_terms.select("term").distinct().limit(VOCABULARY + 1).collect()
    vocabulary = frozenset(bytes(r["term"]) for r in wanted) if len(wanted) <= VOCABULARY else None
    return search(build_index(docs, vocabulary, block), item_terms, k)


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def sql() -> str:
    """DuckDB SQL for the rows of ``ranked_search(documents, benchmark)``."""
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    lowered = f"translate(text, '{_UPPER}', '{_UPPER.lower()}')"
    return f"""
    WITH words AS (
      SELECT row, doc_id, unnest(regexp_extract_all({lowered}, '{pattern}')) AS term
      FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)
    ), lengths AS (SELECT row, doc_id, count(*) AS n FROM words GROUP BY row, doc_id),
    totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
    strata AS (
      SELECT row, doc_id, {BASE - SHARE} + ({SHARE} * n * docs) // terms AS m FROM lengths, totals
    ), tfs AS (SELECT row, term, count(*) AS tf FROM words GROUP BY row, term),
    weights AS (
      SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), totals
    ), asked AS (
      SELECT DISTINCT item_id, unnest(regexp_extract_all({lowered}, '{pattern}')) AS term FROM benchmark
    ), scored AS (
      SELECT item_id, row, doc_id,
             CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
      FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN strata USING (row)
      GROUP BY item_id, row, doc_id
    )
    SELECT * FROM (
      SELECT item_id,
             CAST(row_number() OVER (
               PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS INTEGER) AS rank,
             doc_id, score
      FROM scored WHERE score > 0
    ) WHERE rank <= 50
    """
