"""Panels, configuration tables and feature tables as files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A configuration table is read whole by the driver; a larger file is no such table.
MAX_CONFIG_ROWS = 100_000


def read_panel(
    spark: SparkSession, path: str, *, schema: T.StructType | str | None = None, sep: str = "\t"
) -> DataFrame:
    """A panel from parquet or from delimited text with a header.

    Text without a ``schema`` is inferred. Columns without a name in the header
    are dropped, and so is a byte order mark.
    """
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    reader = spark.read.option("header", True).option("sep", sep).option("nanValue", "NaN")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    for name in df.columns:
        clean = name.lstrip("﻿")
        if clean != name:
            df = df.withColumnRenamed(name, clean)
    return df.select(*[f"`{c}`" for c in df.columns if not re.fullmatch(r"_c\d+", c)])


def store_panel(
    panel: DataFrame, name: str, key: str, period: str, *, buckets: int = 200, by_period: bool = True
) -> DataFrame:
    """The panel as a stored table, laid out for trailing features, read back.

    Rows are bucketed by key and sorted in each bucket: every job that groups by
    the key, or opens windows over it, does so without a shuffle (``keyed=True``). With ``by_period`` the table is partitioned by the
    period as well, so a range of periods reads only its own files; that suits
    some hundreds of periods with rows enough for files of some size in each of
    the ``buckets``. Rows are brought together before writing, so that a task
    writes few files. Rows without a key or period stay in the table.
    """
    placed = panel.repartition(buckets, key)
    writer = placed.write.format("parquet").mode("overwrite").bucketBy(buckets, key)
    if by_period:
        writer.sortBy(key).partitionBy(period).saveAsTable(name)
    else:
        writer.sortBy(key, period).saveAsTable(name)
    return panel.sparkSession.table(name).select(*[f"`{c}`" for c in panel.columns])


def read_config(spark: SparkSession, path: str, *, sep: str = "\t") -> list[dict]:
    """A configuration table as a list of rows; blank cells are None."""
    df = spark.read.csv(path, header=True, sep=sep, multiLine=True, escape='"')
    rows = df.limit(MAX_CONFIG_ROWS + 1).collect()
    if len(rows) > MAX_CONFIG_ROWS:
        raise ValueError(f"{path} has over {MAX_CONFIG_ROWS} rows, not a configuration table")
    return [{k.lstrip("﻿"): v for k, v in row.asDict().items()} for row in rows]


def columns_of_type(
    meta: list[dict], source: str, var_type: str, *, without: tuple[str, ...] = ()
) -> list[str]:
    """Column names of one type in a metadata table, in table order."""
    return [
        row["var_name"]
        for row in meta
        if row["filename"] == source
        and row["var_type"] == var_type
        and row["var_name"] not in without
    ]


def write_features(features: DataFrame, path: str, *, file_format: str = "parquet") -> None:
    """Store a feature table as parquet or as CSV with a header, where maps are JSON text."""
    if file_format == "csv":
        flat = [
            F.to_json(f"`{f.name}`").alias(f.name) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`")
            for f in features.schema
        ]
        features.select(*flat).write.mode("overwrite").option("header", True).csv(path)
    elif file_format == "parquet":
        features.write.mode("overwrite").parquet(path)
    else:
        raise ValueError(f"unknown feature table format {file_format!r}")
