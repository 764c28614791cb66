"""Job configuration: small delimited tables that say what to compute."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

# A configuration row is a plain mapping of column name to text or number.
Row = Mapping[str, object]


def as_list(cell: object) -> list[str]:
    """A comma-separated cell as trimmed items."""
    return [item.strip() for item in str(cell).split(",") if item.strip()]


def as_ints(cell: object) -> list[int]:
    return [int(item) for item in as_list(cell)]


def optional(row: Row, name: str) -> object | None:
    """A cell, with blank and missing as None."""
    cell = row.get(name)
    if cell is None or cell != cell or str(cell).strip() == "":
        return None
    return cell


def optional_text(row: Row, name: str) -> str | None:
    cell = optional(row, name)
    return None if cell is None else str(cell)


def optional_int(row: Row, name: str) -> int | None:
    cell = optional(row, name)
    return None if cell is None else int(float(str(cell)))


@dataclass(frozen=True)
class Source:
    """One panel of a job: its columns, period range and row filter."""

    name: str
    key: str
    period: str
    first_period: int
    last_period: int
    where: str | None = None
    exclude: tuple[str, ...] = ()

    @staticmethod
    def from_row(row: Row) -> Source:
        """From a filter table (month_start...) or a check table (start_month...)."""
        first = optional_int(row, "month_start")
        last = optional_int(row, "month_end")
        return Source(
            str(row["datasource"]),
            str(row["key_col"]),
            str(row["month_col"]),
            optional_int(row, "start_month") if first is None else first,
            optional_int(row, "end_month") if last is None else last,
            optional_text(row, "where"),
            tuple(as_list(optional(row, "exclude_col") or "")),
        )


@dataclass(frozen=True)
class Blocks:
    """The five generation tables, each a list of rows for all sources."""

    ratios: Sequence[Row] = field(default_factory=list)
    stats: Sequence[Row] = field(default_factory=list)
    streaks: Sequence[Row] = field(default_factory=list)
    bins: Sequence[Row] = field(default_factory=list)
    categories: Sequence[Row] = field(default_factory=list)

    def of(self, source: Source) -> Blocks:
        """The rows that belong to one source."""

        def mine(rows: Sequence[Row]) -> list[Row]:
            return [r for r in rows if r["datasource"] == source.name]

        return Blocks(*(mine(getattr(self, name)) for name in self.__dataclass_fields__))
