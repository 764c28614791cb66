"""A corpus pipeline: each stage applies one operator to all that the stage before it kept.

Language ID, near duplicates, benchmark decontamination, personal data, packing.
All stages but the last return the columns of their input. Those that run Python bound
the session's Arrow batches (``bound_batches``), since their rows are as wide as texts are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcraft.llm import decontamination, language, near_duplicates, packing, pii
from panelcraft.llm.common import Stored, bound_batches, table

#: Stages learn dictionaries and run Python per text: SQL cannot express the result.
ORACLE_SQL: str | None = None

#: Row numbers of kept documents that are broadcast, eight bytes each; more are joined by a shuffle.
MOST_SENT = 4_000_000


def _aside(docs: DataFrame, *used: str) -> DataFrame:
    """``docs`` with the columns ``used`` under their own names, the others under names that no operator uses.

    A text is there once: it is by far the widest column of what tasks hold and move.
    """
    own = [F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(docs.columns) if c not in used]
    return docs.select(*own, *[F.col(f"`{c}`") for c in used])


def _back(found: DataFrame, docs: DataFrame, **new: Column) -> DataFrame:
    """The columns of ``docs`` as they were, except those that are given anew."""
    aside = set(found.columns)
    names = [f"_{i}" if f"_{i}" in aside else c for i, c in enumerate(docs.columns)]
    return found.select(*[new.get(c, F.col(f"`{n}`")).alias(c) for c, n in zip(docs.columns, names, strict=True)])


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language one dictionary names by more than a narrow margin.

    Null texts and texts without a letter have no language and go; rows without
    a label teach nothing, and without any label no document has a language.
    Repeated rows and rows with null or equal ids are judged one by one.
    """
    bound_batches(spark)
    learned = language.learn_dictionaries(docs, F.lit(True))
    found = language.identify(_aside(docs, "text"), learned)
    return _back(found.filter(~F.col("rejected")), docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates: that with the smallest id, null ids last.

    Rows are told apart by a stored number, so null and equal ids do no harm: of
    repeated rows, and of near copies that share an id, one stays. Texts without
    a word, null ones included, are linked with nothing and all stay.
    """
    bound_batches(spark)
    store = Stored(spark)
    rows = store.put("rows", _aside(docs, "doc_id", "text").withColumn("_row", F.monotonically_increasing_id()))
    groups = near_duplicates.near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text"))
    groups = store.put("groups", groups.select(F.col("doc_id").alias("_row"), "component_id"))
    first = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_row"))
    ids = rows.select("_row", "doc_id").join(groups, "_row")
    kept = store.put("kept", ids.groupBy("component_id").agg(F.min(first)["_row"].alias("_row")).select("_row"))
    store.drop("groups")
    # Eight bytes a row: sent to the executors if they are few, so that texts need not be shuffled.
    kept = F.broadcast(kept) if kept.count() <= MOST_SENT else kept
    return _back(rows.join(kept, "_row", "left_semi"), docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items.

    Null and empty texts have no words and stay; repeated rows and rows with
    null or equal ids are judged one by one; an empty benchmark keeps all.
    """
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    found = decontamination.contamination(_aside(docs, "doc_id", "text"), items)
    return _back(found.filter(~F.col("contaminated")), docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars follows the text.

    A null text stays null, with null n_chars; every row is treated on its own.
    """
    found = pii.redact(_aside(docs, "text"))
    return _back(found, docs, text=F.col("text"), n_chars=F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in training sequences.

    A null or empty text is the end mark alone; repeated rows are packed each on their own.
    """
    bound_batches(spark)
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each_group),
    ("decontamination", decontaminated),
    ("personal_data", without_personal_data),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table documents; each stage's result is stored once."""
    store = Stored(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES):
            docs = store.put(name, docs)
            if k > 1:
                store.drop(STAGES[k - 2][0])
    return docs
