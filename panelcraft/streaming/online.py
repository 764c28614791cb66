"""Online production: dictionary features of JSON requests.

Every request is complete in itself, so the same transformation serves a batch
of requests and a stateless stream. Requests that cannot be computed come out
as rejected rows with a reason; they never fail the job.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from panelcraft.functions.columns import as_number
from panelcraft.plans.config import optional_text
from panelcraft.plans.replay import replay
from panelcraft.sources.documents import explode_rows, row_array, scalar
from panelcraft.spec import CATEGORY, EXPRESSION, RATIO, RISING_STREAK, STAT, STREAK, Feature

STEP_PATH = "$.workflow_step"


@dataclass(frozen=True)
class Step:
    """One row of the request configuration with its feature dictionary."""

    workflow_step: str
    rows_path: str
    key_column: str
    key_path: str | None
    features: tuple[Feature, ...]

    @staticmethod
    def from_row(row: Mapping, dictionaries: Mapping[str, Sequence[Feature]]) -> Step:
        return Step(
            str(row["workflow_step"]),
            str(row["dataframe_json_path"]),
            str(row["key_column_name"]),
            optional_text(row, "key_json_path"),
            tuple(dictionaries[str(row["data_dic_name"])]),
        )

    @property
    def number_fields(self) -> list[str]:
        """Row fields that must hold numbers."""
        found = set()
        for f in self.features:
            if f.kind == RATIO:
                found |= {*f.numerator, *f.denominator}
            elif f.kind not in (EXPRESSION, CATEGORY) and f.value and f.func != "np.size":
                found.add(f.value)
            if f.period:
                found.add(f.period)
        made = {f.name for f in self.features if f.kind == RATIO}
        return sorted(found - made)

    @property
    def fields(self) -> list[str]:
        """Row fields that the features read."""
        text = {f.value for f in self.features if f.value and f.kind in (CATEGORY, STAT)}
        own_key = set() if self.key_path else {self.key_column}
        made = {f.name for f in self.features if f.kind == RATIO}
        return sorted((text | own_key | set(self.number_fields)) - made)


def _problem(step: Step, document: Column, rows: Column) -> Column:
    """Why a request of this step cannot be computed; null if it can."""
    key = (
        scalar(document, step.key_path).isNull()
        if step.key_path
        else F.forall(rows, lambda r: _field(r, step.key_column).isNull())
    )
    bad_number = F.lit(False)
    for field in step.number_fields:
        bad_number = bad_number | F.exists(rows, _not_a_number(field))
    repeated = F.lit(False)
    for period in {f.period for f in step.features if f.kind in (RATIO, STREAK, RISING_STREAK)}:
        places = F.filter(F.transform(rows, _place(step, period)), lambda p: p["period"].isNotNull())
        repeated = repeated | (F.size(F.array_distinct(places)) < F.size(places))
    return (
        F.when(rows.isNull() | (F.size(rows) == 0), "no rows")
        .when(key, "missing key")
        .when(bad_number, "not a number")
        .when(repeated, "repeated period")
    )


def _place(step: Step, period: str) -> Callable[[Column], Column]:
    """Key and period of a row: ratios and streaks need them to be unique."""
    key = F.lit(None) if step.key_path else None
    return lambda row: F.struct(
        (_field(row, step.key_column) if key is None else key).alias("key"),
        _period_number(_field(row, period)).alias("period"),
    )


def _period_number(column: Column) -> Column:
    return as_number(column).try_cast("int")


def _not_a_number(name: str) -> Callable[[Column], Column]:
    return lambda row: _field(row, name).isNotNull() & as_number(_field(row, name)).isNull()


def _field(row: Column, name: str) -> Column:
    return reduce(lambda column, part: column[part], name.split("."), row)


def split_requests(
    requests: DataFrame, steps: Sequence[Step]
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Usable requests per workflow step, and rejected (request_id, reason) rows.

    ``requests`` has the columns request_id and document. A document that comes
    twice under one id is one request, answered once; different documents under
    one id are told apart by their digest and never merge. Each usable table
    carries one parsed ``_rows_i`` column per configuration row of the step.
    """
    document = F.col("document")
    requests = requests.select(
        "request_id", "document", F.sha2("document", 256).alias("_digest")
    ).dropDuplicates(["request_id", "_digest"])
    by_step: dict[str, list[Step]] = {}
    for step in steps:
        by_step.setdefault(step.workflow_step, []).append(step)
    tagged = requests.withColumn("_step", scalar(document, STEP_PATH))
    usable, rejected = {}, []
    for name, parts in by_step.items():
        parsed = F.struct(
            *[
                row_array(document, p.rows_path, p.fields).alias(f"_rows_{i}")
                for i, p in enumerate(parts)
            ]
        )
        # The one-element explode keeps the conditions below from being moved
        # before the parse, where each of them would parse the document again.
        mine = (
            tagged.where(F.col("_step") == name)
            .select("request_id", "_digest", "document", F.explode(F.array(parsed)).alias("_parsed"))
            .select("request_id", "_digest", "document", "_parsed.*")
        )
        mine = mine.withColumn(
            "_problem",
            F.coalesce(*[_problem(p, document, F.col(f"_rows_{i}")) for i, p in enumerate(parts)]),
        )
        usable[name] = mine.where(F.col("_problem").isNull())
        rejected.append(
            mine.where(F.col("_problem").isNotNull()).select("request_id", F.col("_problem").alias("reason"))
        )
    other = tagged.where(F.col("_step").isNull() | ~F.col("_step").isin(*by_step))
    rejected.append(
        other.select(
            "request_id",
            F.when(F.col("_step").isNull(), "missing workflow step")
            .otherwise("unknown workflow step")
            .alias("reason"),
        )
    )
    return usable, reduce(lambda a, b: a.unionByName(b), rejected)


def step_features(usable: DataFrame, parts: Sequence[Step], base_period: int) -> DataFrame:
    """Features of one workflow step: one row per (request_id, key).

    ``parts`` are the step's configuration rows in order; their features are
    joined on request and key. Requests sharing a key stay apart.
    """
    names = [f.name for p in parts for f in p.features]
    if len(set(names)) < len(names):
        raise ValueError("two dictionaries of a step define the same variable")
    tables = [_part_features(usable, i, p, base_period) for i, p in enumerate(parts)]
    joined = reduce(lambda a, b: a.join(b, ["request_id", "_digest", "key"]), tables)
    return joined.drop("_digest")


def _part_features(usable: DataFrame, i: int, part: Step, base_period: int) -> DataFrame:
    key = scalar(F.col("document"), part.key_path) if part.key_path else F.lit(None).cast("string")
    request = ("request_id", "_digest")
    documents = usable.select(*request, key.alias("_key"), F.col(f"_rows_{i}").alias("_rows"))
    rows = explode_rows(documents, F.col("_rows"), part.fields, keep=(*request, "_key"))
    if part.key_path is None:
        rows = rows.withColumn("_key", F.col(f"`{part.key_column}`"))
    rows = rows.where(F.col("_key").isNotNull())
    periods = {f.period for f in part.features if f.period}
    rows = rows.withColumns({p: _period_number(F.col(f"`{p}`")) for p in periods})
    features = [replace(f, key="_key") for f in part.features]
    # A group is part of one document, so its rows are bounded by the document. Requests are
    # already partitioned by id and digest, so grouping inside them needs no shuffle.
    table = replay(
        rows,
        features,
        base_period,
        key="_key",
        unique_periods=True,
        period_span=(0, 0),
        within=request,
        hot_rows=None,
    )
    kept = [f.name for f in part.features if f.kind != RATIO]
    return table.select(*request, F.col("_key").alias("key"), *[f"`{n}`" for n in kept])


def online_features(
    requests: DataFrame, steps: Sequence[Step], base_period: int
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Feature table per workflow step, and the rejected requests."""
    usable, rejected = split_requests(requests, steps)
    tables = {
        name: step_features(
            rows, [s for s in steps if s.workflow_step == name], base_period
        )
        for name, rows in usable.items()
    }
    return tables, rejected


def start_online(
    requests: DataFrame,
    steps: Sequence[Step],
    base_period: int,
    output: str,
    checkpoint: str,
    horizon: str = "1 day",
    **trigger,
) -> StreamingQuery:
    """Write features and rejects of a stream of requests under ``output``.

    A document that comes again under the same id, in the same micro-batch or
    in a later one within ``horizon`` of its arrival, is answered once, as in a
    batch. What is remembered of a request is its id and digest, in the state
    store, until the horizon has passed. Each micro-batch overwrites its own folder, so a batch that is retried after
    a failure leaves the same files. ``trigger`` is passed to the stream, for
    example ``availableNow=True`` or ``processingTime="10 seconds"``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            tables, rejected = online_features(batch, steps, base_period)
            for name, table in tables.items():
                table.write.mode("overwrite").parquet(f"{output}/step={name}/batch={batch_id}")
            rejected.write.mode("overwrite").parquet(f"{output}/rejected/batch={batch_id}")
        finally:
            batch.unpersist()

    arrived = F.current_timestamp().alias("_arrived")
    first = (
        requests.select("request_id", "document", F.sha2("document", 256).alias("_digest"), arrived)
        .withWatermark("_arrived", horizon)
        .dropDuplicatesWithinWatermark(["request_id", "_digest"])
        .select("request_id", "document")
    )
    return (
        first.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
