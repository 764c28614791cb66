"""Helpers shared by the operators: reading, storing, and bounded work in Python tasks."""

from __future__ import annotations

import contextlib
import functools
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from panelcraft.session import shared_folder

#: Deletes a query's shuffle files when the query ends instead of when the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextlib.contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


class Stored:
    """Tables in the shared checkpoint folder, which survive lost executors.

    ``put`` writes a frame and reads it back, so that later steps start from
    the stored rows; ``drop`` deletes those that the final plan does not read.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"

    def put(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{name}"
        with _setting(self.spark, _CLEANUP, "true"):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        for name in names:
            path = hadoop.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fold(doc_id: str, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % of


#: Rows that a Python task turns into objects at once.
SLICE = 128
#: Most rows, and most bytes, of a batch that Spark hands to a Python task.
BATCH_ROWS, BATCH_BYTES = 8 * SLICE, 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches, from now on; a session with smaller ones is left as it is.

    A batch stands outside the JVM's heap and once more in the Python worker:
    with Spark's defaults each task holds up to 10,000 texts, or 64 MB, twice.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")


_HELD: list = []


def let_go(but: Callable | None = None) -> None:
    """Frees what functions under ``held_alone`` keep in this worker."""
    for kept in _HELD:
        if kept is not but and kept.cache_info().currsize:
            kept.cache_clear()


def held_alone(make: Callable) -> Callable:
    """``make`` with its last result kept, and nothing of other such functions beside it.

    Workers live on from one step to the next; what an earlier step loaded would stay with them.
    """
    kept = functools.lru_cache(maxsize=1)(make)
    _HELD.append(kept)

    @functools.wraps(make)
    def get(*args):
        let_go(but=kept)
        return kept(*args)

    return get


def map_rows(
    df: DataFrame,
    keep: list[str],
    inputs: list[str],
    function: Callable[..., Iterable[tuple]],
    schema: str,
) -> DataFrame:
    """``keep`` columns as they are, beside the fields that ``function`` makes of ``inputs``.

    ``function`` gets one list per input and returns one tuple per row. Kept
    columns stay in Arrow, so that ids never pass through floating point.
    """
    made = T.StructType.fromDDL(schema)
    names = keep + made.fieldNames()
    types = [to_arrow_type(f.dataType) for f in made]
    columns = list(dict.fromkeys(keep + inputs))
    places, given = [columns.index(c) for c in keep], [columns.index(c) for c in inputs]
    kept = T.StructType([df.schema[c] for c in keep])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                part = whole.slice(at, SLICE)
                rows = list(function(*[part.column(i).to_pylist() for i in given]))
                new = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in places], *new], names)

    return df.select(*columns).mapInArrow(run, T.StructType([*kept.fields, *made.fields]))


def explode_rows(
    df: DataFrame, inputs: list[str], function: Callable[..., Iterable[tuple]], schema: str
) -> DataFrame:
    """Rows that ``function`` makes of each slice of ``inputs``, any number of them."""
    made = T.StructType.fromDDL(schema)
    types = [to_arrow_type(f.dataType) for f in made]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                part = whole.slice(at, SLICE)
                columns = list(function(*[c.to_pylist() for c in part.columns]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], made.fieldNames()
                )

    return df.select(*inputs).mapInArrow(run, made)
