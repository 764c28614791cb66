"""Feature specifications: what one named variable computes."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, replace

RATIO = "ratio"
STAT = "stat"
PERIOD_RATIO = "period_ratio"
STREAK = "streak"
RISING_STREAK = "rising_streak"
LOC_BIN = "loc_bin"
VAL_BIN = "val_bin"
CATEGORY = "category"
EXPRESSION = "expression"

# Codes that feature dictionaries use in their `module` column.
MODULE_CODES = {
    RATIO: "ff_combination_pct",
    STAT: "ff_common_stat",
    PERIOD_RATIO: "ff_period_compare_stat",
    STREAK: "ff_continue_gt_N",
    RISING_STREAK: "ff_continue_inc_gt_N",
    LOC_BIN: "ff_bin_distribution_by_loc",
    VAL_BIN: "ff_bin_distribution_by_val",
    CATEGORY: "ff_category_cnt_pct",
    EXPRESSION: "ff_customized_var",
}
KIND_OF_MODULE = {code: kind for kind, code in MODULE_CODES.items()}

# Statistic codes of the dictionary, in their emission order.
STAT_FUNCS = (
    "np.size",
    "cnt_gt_0",
    "pct_gt_0",
    "np.sum",
    "np.min",
    "np.max",
    "np.average",
    "np.median",
    "cnt_isna",
    "pct_isna",
)
PERIOD_FUNCS = ("np.sum", "np.max", "np.mean")

#: Category variables that hold all categories of a row in one map, for columns with very many.
MAP_FUNCS = ("cnt_map", "pct_map")

#: Statistics that a user has added: code of the dictionary to builder.
ADDED_FUNCS: dict[str, Callable[[str, str], str]] = {}


def register_statistic(code: str, builder: Callable[[str, str], str]) -> None:
    """Add a statistic under ``code``, which dictionaries then may use as ``func_name``.

    ``builder`` gets the SQL name of the value column (a double, or null) and
    the ``FILTER (WHERE ...)`` clause of the window, and returns the SQL text of
    an aggregate, as ``lambda v, only: f"stddev_pop({v}) {only}"``. The result
    is null for windows without a row, like every other statistic. Dictionaries
    name the code only, so the process that replays one registers it first.
    """
    if code in STAT_FUNCS or code in PERIOD_FUNCS or code in MAP_FUNCS:
        raise ValueError(f"{code!r} is a statistic of its own already")
    ADDED_FUNCS[code] = builder


# Extra (latest, earliest) spans for quarter-based windows.
EXTRA_SPANS = {3: (1, 2), 9: (3, 6), 12: (3, 9)}


@dataclass(frozen=True)
class Feature:
    """One variable. ``first_base == last_base`` means a single base period.

    ``rows_from`` / ``rows_to`` restrict the input rows further (the row layer
    of a discovery run); ``edge`` names (edge set, ordinal) when the threshold
    differs by base period and is looked up in an edge table. A period ratio
    with ``denominator_span="numerator"`` takes its denominator over as many
    periods as its numerator, whatever ``denominator_months`` says.
    """

    name: str
    kind: str
    key: str
    period: str | None = None
    value: str | None = None
    months: int | None = None
    func: str | None = None
    bins: int | None = None
    bin_value: float | None = None
    threshold: float | None = None
    category: str | None = None
    numerator: tuple[str, ...] | None = None
    denominator: tuple[str, ...] | None = None
    numerator_months: int | None = None
    denominator_months: int | None = None
    expression: str | None = None
    dataset: str | None = None
    first_base: int | None = None
    last_base: int | None = None
    rows_from: int | None = None
    rows_to: int | None = None
    null_is_above: bool = False
    where: str | None = None
    edge: tuple[str, int] | None = None
    denominator_span: str = "denominator"

    @property
    def module(self) -> str:
        return MODULE_CODES[self.kind]

    def at(self, first_base: int, last_base: int | None = None) -> Feature:
        """The same variable for the given base period or range of them."""
        last = first_base if last_base is None else last_base
        return replace(self, first_base=first_base, last_base=last)


def numbered(start: int = 1) -> Iterator[str]:
    """Variable names var_1, var_2, ..."""
    return (f"var_{i}" for i in itertools.count(start))


def ratio_pairs(columns: Sequence[str]) -> list[tuple[tuple[str, ...], tuple[str, ...]]]:
    """(numerator, denominator) column sets of a combination-ratio block.

    Every proper subset S is a numerator; its denominators add a non-empty
    proper subset of the remaining columns, so the full set never appears.
    """
    pairs = []
    for size in range(1, len(columns)):
        for numerator in itertools.combinations(columns, size):
            rest = [c for c in columns if c not in numerator]
            for extra in range(1, len(rest)):
                for added in itertools.combinations(rest, extra):
                    pairs.append((numerator, numerator + added))
    return pairs


def period_spans(months: int) -> list[tuple[int, int]]:
    """(latest, earliest) period counts compared inside a window of N periods."""
    if months <= 0:
        raise ValueError("the number of periods must be positive")
    if months == 1:
        return [(1, 1)]
    half = math.ceil(months / 2)
    spans = sorted({(1, months), (half, months), (half, half)})
    extra = EXTRA_SPANS.get(months)
    if extra and extra not in spans:
        spans.append(extra)
    return spans


def ratio_features(
    key: str, period: str, columns: Sequence[str], months: int, names: Iterator[str]
) -> list[Feature]:
    return [
        Feature(next(names), RATIO, key, period, months=months, numerator=top, denominator=bottom)
        for top, bottom in ratio_pairs(columns)
    ]


def stat_features(
    key: str,
    period: str | None,
    value: str,
    months: int | None,
    names: Iterator[str],
    funcs: Iterable[str] = STAT_FUNCS,
) -> list[Feature]:
    return [
        Feature(next(names), STAT, key, period, value, months, func) for func in funcs
    ]


def period_ratio_features(
    key: str, period: str, value: str, months: int, names: Iterator[str]
) -> list[Feature]:
    return [
        Feature(
            next(names), PERIOD_RATIO, key, period, value, months, func,
            numerator_months=latest, denominator_months=earliest,
        )
        for latest, earliest in period_spans(months)
        for func in PERIOD_FUNCS
    ]


def category_features(
    key: str,
    period: str,
    value: str,
    months: int,
    categories: Sequence[str] | None,
    names: Iterator[str],
) -> list[Feature]:
    """Count and share of every category; of all of them as two maps if ``categories`` is None."""
    if categories is None:
        return [Feature(next(names), CATEGORY, key, period, value, months, func) for func in MAP_FUNCS]
    return [
        Feature(next(names), CATEGORY, key, period, value, months, func, category=category)
        for category in categories
        for func in ("cnt", "pct")
    ]
