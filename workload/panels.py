"""Panels that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The event types of the events table.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def user_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, day) panel of events; a user misses days without events.

    amt1: events; amt2, amt3, amt4: cents of purchase, click and view events,
    null without one; cat: type of the day's latest event (highest event_id).
    All aggregates have fixed-size buffers, so they hash-aggregate on the map side.
    """
    events = table(spark, sf_dir, "events")
    cents = F.round(F.col("value") * 100).cast("long")

    def cents_of(event_type: str):
        return F.sum(F.when(F.col("event_type") == event_type, cents)).cast("double")

    latest = {t: f"_last_{t}" for t in EVENT_TYPES}
    last_of_all = F.greatest(*latest.values())
    cat = F.coalesce(*[F.when(F.col(c) == last_of_all, F.lit(t)) for t, c in latest.items()])
    return (
        events.groupBy(
            "user_id", (F.datediff("ts", F.lit("2024-01-01").cast("date")) + 1).alias("day")
        )
        .agg(
            F.count(F.lit(1)).cast("double").alias("amt1"),
            cents_of("purchase").alias("amt2"),
            cents_of("click").alias("amt3"),
            cents_of("view").alias("amt4"),
            *[
                F.max(F.when(F.col("event_type") == t, F.col("event_id"))).alias(c)
                for t, c in latest.items()
            ],
        )
        .select("user_id", "day", "amt1", "amt2", "amt3", "amt4", cat.alias("cat"))
    )


def customer_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_custkey, month) panel of orders: order count and cents, sparse."""
    month = (F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("month")
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", month)
        .agg(
            F.count(F.lit(1)).cast("double").alias("orders"),
            F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).cast("double").alias("cents"),
        )
    )
