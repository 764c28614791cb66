"""JSON request documents: scalars, and the rows inside their arrays."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ARRAY_PATH = re.compile(r"(\$(?:\.\w+)*)\[\*\]((?:(?:\.\w+)+\[\*\])*)")


def read_documents(
    spark: SparkSession,
    path: str,
    *,
    one_per_line: bool = False,
    id_path: str | None = None,
    stream: bool = False,
    **options,
) -> DataFrame:
    """Documents as (request_id, document): one per file, or one per line.

    With ``id_path``, such as ``$.requestNo``, the id is the document's own, and
    the same request in two files has one id. Otherwise, and for documents that
    lack it, the id is the file name; with one per line the document's own
    digest is added, so that a re-read gives the same ids. Equal documents under
    one id are one request, which the online job answers once. ``stream`` reads
    a stream of files; ``options`` go to the reader.
    """
    reader = (spark.readStream if stream else spark.read).options(**options)
    text = reader.text(path, wholetext=not one_per_line)
    name = F.input_file_name()
    if one_per_line:
        name = F.concat_ws("#", name, F.sha2("value", 256))
    if id_path:
        name = F.coalesce(scalar(F.col("value"), id_path), name)
    return text.select(name.alias("request_id"), F.col("value").alias("document"))


def scalar(document: Column, path: str) -> Column:
    """The scalar at a path such as ``$.seqNo``; null if absent."""
    return F.get_json_object(document, path)


def rows_schema(fields: Iterable[str]) -> T.ArrayType:
    """Schema of row objects with text leaves; ``a.b`` is field b of object a."""
    tree: dict = {}
    for field in fields:
        node = tree
        *parents, leaf = field.split(".")
        for parent in parents:
            node = node.setdefault(parent, {})
            if not isinstance(node, dict):
                raise ValueError(f"{field!r}: {parent!r} is both a value and an object")
        if isinstance(node.get(leaf), dict):
            raise ValueError(f"{field!r} is both a value and an object")
        node[leaf] = None

    def struct(node: dict) -> T.StructType:
        return T.StructType(
            [
                T.StructField(name, T.StringType() if child is None else struct(child))
                for name, child in node.items()
            ]
        )

    return T.ArrayType(struct(tree))


def _field_of(names: Iterable[str]) -> Callable[[Column], Column]:
    return lambda row: reduce(lambda column, name: column[name], names, row)


def row_array(document: Column, path: str, fields: Iterable[str]) -> Column:
    """The rows at a path such as ``$.data[*]``, parsed once, values as text.

    Arrays may lie in one another, as in ``$.data[*].info.items[*]``: the rows
    are those of the innermost arrays, in order. An element without the next
    array has no rows. A field that a row lacks is null, whichever rows have it.
    """
    match = _ARRAY_PATH.fullmatch(path)
    if match is None:
        raise ValueError(f"unsupported row path {path!r}, expected the form $.name[*] or $.name[*].name[*]")
    inner = [part.strip(".").split(".") for part in match[2].split("[*]")[:-1]]
    schema = rows_schema(fields)
    for names in reversed(inner):
        for name in reversed(names):
            schema = T.StructType([T.StructField(name, schema)])
        schema = T.ArrayType(schema)
    array = document if match[1] == "$" else F.get_json_object(document, match[1])
    rows = F.from_json(array, schema)
    for names in inner:
        within = F.transform(rows, _field_of(names))
        rows = F.flatten(F.filter(within, lambda x: x.isNotNull()))
    return rows


def explode_rows(
    documents: DataFrame, rows: Column, fields: Iterable[str], *, keep: Iterable[str]
) -> DataFrame:
    """One row per array element with the ``keep`` columns and the flat fields."""
    return documents.select(*keep, F.explode(rows).alias("_row")).select(
        *keep,
        *[
            F.col("_row." + ".".join(f"`{part}`" for part in field.split("."))).alias(field)
            for field in fields
        ],
    )
