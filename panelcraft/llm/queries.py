"""Registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcraft.llm import (
    chat,
    decontamination,
    fertility,
    language,
    license_scan,
    near_duplicates,
    packing,
    pii,
    quality,
    ranked_search,
    suffix_dedup,
    token_alignment,
    toxicity,
)
from panelcraft.llm.common import fold, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.fertility_filter(table(spark, sf_dir, "documents"))


@query
def op2_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def text_of(spans: Column) -> Column:
        return F.array_join(
            F.transform(
                spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
            ),
            ",",
        )

    def count(kind: str) -> Column:
        spans = F.filter("pii", lambda s: s["kind"] == kind)
        return F.size(spans).cast("long").alias(f"n_{kind}")

    base = [k.name for k in pii.KINDS if k.always]
    return found.select(
        "doc_id",
        *[count(k.name) for k in pii.KINDS],
        F.sha2(text_of(F.filter("pii", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        text_of(F.col("pii")).alias("spans"),
        F.array_join(
            F.transform("pii", lambda s: F.round(s["score"] * 100).cast("int").cast("string")), ","
        ).alias("scores"),
    )


ORACLES["op2_pii_spans"] = pii.sql()


@query
def op3_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.license_scan(table(spark, sf_dir, "documents"))
    starts = F.transform("base", lambda b: b["start"])
    labels = F.array_sort(F.array_distinct(F.transform("base", lambda b: b["label"])))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(labels, ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


@query
def op4_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold("doc_id", 5) == 0
    scored = quality.quality_scores(docs, table(spark, sf_dir, "labels"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op5_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    sizes = F.transform("removed", lambda s: (s["end"] - s["first"]).cast("long"))
    return found.select(
        "doc_id",
        "n_bytes",
        F.aggregate(sizes, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        "kept_sha256",
    )


@query
def op6_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLES["op6_circulant_minhash"] = near_duplicates.sql()


@query
def op7_language_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 4) == 2
    learned = language.learn_dictionaries(docs, ~held_out)
    found = language.identify(docs.select("doc_id", "text"), learned)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


@query
def op8_positional_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


ORACLES["op8_positional_decontamination"] = decontamination.sql()


@query
def op9_chat_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)],
        "conv_id long, turn long, role string, text string",
    )
    return chat.digests(chat.format_conversations(rows.unionByName(probe)))


@query
def op10_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op11_pointer_jumping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_tokenizers(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op12_toxicity_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold("doc_id", 5) == 0
    weights = toxicity.learn_toxicity(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = toxicity.toxicity_scores(docs, weights)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op13_stratified_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op13_stratified_search"] = ranked_search.sql()
