"""Worst account status per month position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: status codes from worst to best.
STATUS_ORDER = "ZDG7654321N*C#/"


def worst_status(
    accounts: DataFrame, key: str, status: str, *, order: str = STATUS_ORDER
) -> DataFrame:
    """Per key: the worst code of all its accounts at each position, in order.

    ``status`` holds one code per month position. Codes outside ``order`` are
    ignored; a position where no account has a known code is skipped. Accounts
    are combined per (key, position) before the shuffle, and the final string
    is as long as the longest status, whatever the number of accounts.
    """
    codes = F.posexplode(F.split(F.col(status), ""))
    rank = F.instr(F.lit(order), F.col("code"))
    worst = (
        accounts.where(F.col(key).isNotNull())
        .select(key, codes.alias("position", "code"))
        .where(F.length("code") == 1)
        .withColumn("rank", F.nullif(rank, F.lit(0)))
        .groupBy(key, "position")
        .agg(F.min("rank").alias("rank"))
    )
    by_position = F.array_sort(
        F.collect_list(F.when(F.col("rank").isNotNull(), F.struct("position", "rank")))
    )
    return worst.groupBy(key).agg(
        F.array_join(F.transform(by_position, lambda e: F.substring(F.lit(order), e["rank"], F.lit(1))), "").alias("summary")
    )
