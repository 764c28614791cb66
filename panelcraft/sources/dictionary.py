"""The feature dictionary: every generated variable with its parameters."""

from __future__ import annotations

import ast
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from panelcraft.plans.config import optional, optional_int, optional_text
from panelcraft.sources.tables import read_config
from panelcraft.spec import KIND_OF_MODULE, Feature

# The columns of a dictionary file.
DICTIONARY_SCHEMA = (
    "var_name string, module string, key_column string, month_column string, "
    "base_month int, N_Months int, value_column string, func_name string, "
    "number_of_bins int, bin_value double, threshold_value double, "
    "category_value string, numerator array<string>, denominator array<string>, "
    "numerator_months int, denominator_months int, expression string, dataset string"
)
# What else decides a variable's value. Files without these columns can be read.
EXTRA_SCHEMA = "where string, denominator_span string, rows_from int, rows_to int, null_is_above boolean"


def to_rows(features: Sequence[Feature]) -> list[tuple]:
    return [
        (
            f.name, f.module, f.key, f.period, f.last_base, f.months, f.value, f.func, f.bins,
            None if f.bin_value is None else float(f.bin_value),
            None if f.threshold is None else float(f.threshold),
            f.category,
            list(f.numerator) if f.numerator else None,
            list(f.denominator) if f.denominator else None,
            f.numerator_months, f.denominator_months, f.expression, f.dataset,
            f.where, f.denominator_span, f.rows_from, f.rows_to, f.null_is_above,
        )
        for f in features
    ]


def dictionary_frame(spark: SparkSession, features: Sequence[Feature]) -> DataFrame:
    return spark.createDataFrame(to_rows(features), f"{DICTIONARY_SCHEMA}, {EXTRA_SCHEMA}")


def write_dictionary(spark: SparkSession, features: Sequence[Feature], path: str) -> None:
    """Write the dictionary as one CSV file; lists are JSON arrays."""
    frame = dictionary_frame(spark, features)
    flat = frame.selectExpr(
        *[
            f"to_json({c}) as {c}" if c in ("numerator", "denominator") else c
            for c in frame.columns
        ]
    )
    flat.coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def name_list(cell: object) -> tuple[str, ...] | None:
    """A list cell: a JSON array or a quoted list literal such as ``['a', 'b']``."""
    if cell is None:
        return None
    if isinstance(cell, (list, tuple)):
        return tuple(cell)
    text = str(cell).strip()
    if not text:
        return None
    try:
        names = json.loads(text)
    except json.JSONDecodeError:
        names = ast.literal_eval(text)
    if isinstance(names, str) or not all(isinstance(n, str) for n in names):
        raise ValueError(f"not a list of column names: {text!r}")
    return tuple(names)


def _number(row: Mapping, name: str) -> float | None:
    cell = optional(row, name)
    return None if cell is None else float(str(cell))


def from_row(row: Mapping[str, object]) -> Feature:
    """One dictionary row as a feature.

    A bin variable without a threshold uses its recorded edge; one of a rolling
    run has the edge of its last period. Without a recorded null rule, null is
    above an edge and not above a given threshold.
    """
    module = str(row["module"])
    if module not in KIND_OF_MODULE:
        raise ValueError(f"unknown module {module!r} in the feature dictionary")
    earliest = optional_int(row, "denominator_months")
    if earliest is None:
        earliest = optional_int(row, "denomerator_months")
    threshold = _number(row, "threshold_value")
    edge = _number(row, "bin_value")
    above = optional_text(row, "null_is_above")
    return Feature(
        name=str(row["var_name"]),
        kind=KIND_OF_MODULE[module],
        key=optional_text(row, "key_column") or "",
        period=optional_text(row, "month_column"),
        value=optional_text(row, "value_column"),
        months=optional_int(row, "N_Months"),
        func=optional_text(row, "func_name"),
        bins=optional_int(row, "number_of_bins"),
        bin_value=edge,
        threshold=threshold,
        category=optional_text(row, "category_value"),
        numerator=name_list(optional(row, "numerator")),
        denominator=name_list(optional(row, "denominator")),
        numerator_months=optional_int(row, "numerator_months"),
        denominator_months=earliest,
        expression=optional_text(row, "expression"),
        dataset=optional_text(row, "dataset"),
        null_is_above=(
            threshold is None and edge is not None if above is None else above.lower() == "true"
        ),
        where=optional_text(row, "where"),
        denominator_span=optional_text(row, "denominator_span") or "denominator",
        rows_from=optional_int(row, "rows_from"),
        rows_to=optional_int(row, "rows_to"),
    )


def read_dictionary(spark: SparkSession, path: str, *, sep: str = ",") -> list[Feature]:
    """Features of a dictionary file, in file order.

    Rows without a known module, such as a leading placeholder, are skipped.
    An unnamed first column holds the variable names.
    """
    features = []
    for row in read_config(spark, path, sep=sep):
        if "var_name" not in row:
            row = {**row, "var_name": row[next(iter(row))]}
        if row.get("module") in (None, "placeholder"):
            continue
        features.append(from_row(row))
    return features
