"""A synthetic panel and plain-Python versions of the definitions."""

from __future__ import annotations

import random
import statistics

SCHEMA = "customer string, month int, a double, b double, c double, kind string"


def panel_rows(seed: int = 7, keys: int = 9, periods: int = 12) -> list[tuple]:
    """Rows with missing months, nulls, a key of nulls only and a one-row key."""
    rng = random.Random(seed)
    rows = []
    for k in range(keys):
        for p in range(1, periods + 1):
            if rng.random() < 0.2:
                continue
            values = [
                None if rng.random() < 0.15 else float(rng.randint(-3, 12)) for _ in range(3)
            ]
            rows.append((f"k{k}", p, *values, rng.choice(["A", "B", "C", None])))
    rows += [("nulls", p, None, None, None, None) for p in (9, 10, 12)]
    rows += [("once", 11, 5.0, 0.0, 2.0, "A"), ("early", 1, 1.0, 1.0, 1.0, "B")]
    return rows


def by_key(rows: list[tuple]) -> dict[str, dict[int, tuple]]:
    found: dict[str, dict[int, tuple]] = {}
    for row in rows:
        found.setdefault(row[0], {})[row[1]] = row
    return found


def window(periods: dict[int, tuple], base: int, months: int) -> list[tuple]:
    return [periods[p] for p in sorted(periods) if base - months + 1 <= p <= base]


def stats(values: list) -> dict[str, object]:
    seen = [v for v in values if v is not None]
    n = len(values)
    return {
        "np.size": n,
        "cnt_gt_0": sum(v > 0 for v in seen),
        "pct_gt_0": sum(v > 0 for v in seen) / n,
        "np.sum": float(sum(seen)),
        "np.min": min(seen, default=None),
        "np.max": max(seen, default=None),
        "np.average": sum(seen) / n if len(seen) == n else None,
        "np.median": statistics.median(seen) if seen else None,
        "cnt_isna": n - len(seen),
        "pct_isna": (n - len(seen)) / n,
    }


def longest_run(rows: list[tuple], threshold: float, rising: bool) -> int | None:
    """Runs by break flags against the previous period's value, -1 if missing."""
    values = {r[1]: r[2] for r in rows}
    run, lengths = 0, {}
    for p in sorted(values):
        v = values[p]
        previous = values.get(p - 1)
        previous = -1.0 if previous is None else previous
        above = v is not None and v > threshold
        if rising:
            breaks = not (above and v > previous and previous > threshold)
        else:
            breaks = above != (previous > threshold)
        run += breaks
        if above:
            lengths[run] = lengths.get(run, 0) + 1
    return max(lengths.values(), default=None)
