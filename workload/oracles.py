"""DuckDB SQL for every query, one block per operator joined on its keys.

Written block by block, with joins and window functions over expanded rows, so
that it shares no plan shape with the Spark side.
"""

from __future__ import annotations

import itertools

FIRST, LAST = 7, 12

USER_DAY = """user_day AS (
  SELECT user_id,
    CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS INTEGER) AS day,
    CAST(count(*) AS DOUBLE) AS amt1,
    CAST(sum(CASE WHEN event_type = 'purchase' THEN CAST(round(value * 100) AS BIGINT) END) AS DOUBLE) AS amt2,
    CAST(sum(CASE WHEN event_type = 'click' THEN CAST(round(value * 100) AS BIGINT) END) AS DOUBLE) AS amt3,
    CAST(sum(CASE WHEN event_type = 'view' THEN CAST(round(value * 100) AS BIGINT) END) AS DOUBLE) AS amt4,
    arg_max(event_type, event_id) AS cat
  FROM events GROUP BY 1, 2)"""

CUSTOMER_MONTH = """customer_month AS (
  SELECT o_custkey, CAST(year(o_orderdate) * 12 + month(o_orderdate) AS INTEGER) AS month,
    CAST(count(*) AS DOUBLE) AS orders,
    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) AS cents
  FROM orders GROUP BY 1, 2)"""

EVENT_DAY = """event_day AS (
  SELECT user_id,
    CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS INTEGER) AS day,
    round(value * 100) AS cents
  FROM events)"""


def trail(source: str, months: int, first: int, last: int, key: str = "user_id", day: str = "day") -> str:
    """Rows of ``source`` repeated for every base period whose window holds them."""
    return (
        f"(SELECT s.*, b.base_period FROM {source} s "
        f"JOIN (SELECT CAST(unnest(range({first}, {last} + 1)) AS INTEGER) AS base_period) b "
        f"ON s.{day} BETWEEN b.base_period - {months - 1} AND b.base_period)"
    )


STATS = {
    "size": "count(*)",
    "cnt_gt_0": "count(*) FILTER (WHERE {v} > 0)",
    "pct_gt_0": "count(*) FILTER (WHERE {v} > 0) / count(*)",
    "sum": "coalesce(sum({v}), 0)",
    "min": "min({v})",
    "max": "max({v})",
    "average": "CASE WHEN count({v}) = count(*) THEN avg({v}) END",
    "median": "median({v})",
    "cnt_isna": "count(*) - count({v})",
    "pct_isna": "(count(*) - count({v})) / count(*)",
}


def stats(value: str, names=None) -> str:
    names = names or STATS
    return ", ".join(
        f"{text.format(v=value)} AS {name}" for text, name in zip(STATS.values(), names, strict=True)
    )


def spans(months: int) -> list[tuple[int, int]]:
    extra = {3: [(1, 2)], 9: [(3, 6)], 12: [(3, 9)]}.get(months, [])
    half = -(-months // 2)
    return sorted({(1, months), (half, months), (half, half)}) + extra


def half(func: str, value: str, condition: str) -> str:
    if func == "sum":
        return (
            f"CASE WHEN count(*) FILTER (WHERE {condition}) > 0 "
            f"THEN coalesce(sum({value}) FILTER (WHERE {condition}), 0) END"
        )
    return f"{func}({value}) FILTER (WHERE {condition})"


def period_ratios(value: str, months: int, names) -> str:
    parts = []
    for a, b in spans(months):
        for func in ("sum", "max", "avg"):
            latest = half(func, value, f"base_period - day < {a}")
            earliest = half(func, value, f"base_period - day >= {months - b}")
            parts.append(f"({latest}) / nullif({earliest}, 0) AS {next(names)}")
    return ", ".join(parts)


def var_names(start: int = 1):
    return (f"var_{i}" for i in itertools.count(start))


def run_above(source: str, value: str, months: int, threshold: float, first: int, last: int, name: str) -> str:
    """Gaps and islands over the window's qualifying rows."""
    return f"""(SELECT user_id, base_period, max(n) AS {name} FROM (
      SELECT user_id, base_period, grp, count(*) AS n FROM (
        SELECT user_id, base_period,
          day - row_number() OVER (PARTITION BY user_id, base_period ORDER BY day) AS grp
        FROM {trail(source, months, first, last)} WHERE {value} > {threshold})
      GROUP BY ALL) GROUP BY ALL)"""


def run_rising(source: str, value: str, months: int, threshold: float, first: int, last: int,
               name: str, key: str = "user_id", day: str = "day", keys: str | None = None) -> str:
    """Break flags from lagged values, runs numbered by their running sum, zero-filled."""
    keys = keys or f"SELECT DISTINCT {key} FROM {source}"
    return f"""(SELECT k.{key}, k.base_period, coalesce(r.n, 0) AS {name}
      FROM (SELECT {key}, CAST(unnest(range({first}, {last} + 1)) AS INTEGER) AS base_period FROM ({keys})) k
      LEFT JOIN (
        SELECT {key}, base_period, max(n) AS n FROM (
          SELECT {key}, base_period, run, count(*) AS n FROM (
            SELECT *, sum(brk) OVER (PARTITION BY {key}, base_period ORDER BY {day}) AS run FROM (
              SELECT {key}, base_period, {day}, v,
                CASE WHEN v > prev AND v > {threshold} AND prev > {threshold} THEN 0 ELSE 1 END AS brk
              FROM (
                SELECT {key}, base_period, {day}, {value} AS v,
                  coalesce(CASE WHEN lag({day}) OVER w = {day} - 1 THEN lag({value}) OVER w END, -1) AS prev
                FROM {trail(source, months, first, last, key, day)}
                WINDOW w AS (PARTITION BY {key}, base_period ORDER BY {day}))))
          WHERE v > {threshold} GROUP BY ALL)
        GROUP BY ALL) r
      ON k.{key} = r.{key} AND k.base_period = r.base_period)"""


def edges(source: str, value: str, months: int, bins: int, first: int, last: int, by_rank: bool) -> str:
    rows = trail(source, months, first, last)
    ordinals = f"(SELECT CAST(unnest(range(0, {bins})) AS INTEGER) AS ordinal)"
    if by_rank:
        edge = f"v[1 + CAST(floor(ordinal * (CAST(n - 1 AS DOUBLE) / {bins})) AS BIGINT)]"
        return f"""(SELECT base_period, ordinal, {edge} AS edge
          FROM (SELECT base_period, list_sort(list({value})) AS v, count({value}) AS n
                FROM {rows} WHERE {value} IS NOT NULL GROUP BY 1), {ordinals})"""
    return f"""(SELECT base_period, ordinal, ordinal * ((high - low) / {bins}) + low AS edge
      FROM (SELECT base_period, min({value}) AS low, max({value}) AS high FROM {rows} GROUP BY 1), {ordinals})"""


def shares(source: str, value: str, months: int, bins: int, first: int, last: int, by_rank: bool) -> str:
    return f"""SELECT r.user_id, e.base_period, e.ordinal, e.edge,
        count(*) FILTER (WHERE {value} IS NULL OR {value} >= edge) / count(*) AS share
      FROM {trail(source, months, first, last)} r
      JOIN {edges(source, value, months, bins, first, last, by_rank)} e ON r.base_period = e.base_period
      GROUP BY ALL"""


def moving(column: str, months: int) -> str:
    frame = f"(PARTITION BY user_id ORDER BY day ROWS BETWEEN {months - 1} PRECEDING AND CURRENT ROW)"
    return f"coalesce(CASE WHEN count({column}) OVER {frame} = {months} THEN sum({column}) OVER {frame} END, 0)"


def ratio(top: tuple, bottom: tuple, months: int) -> str:
    return (
        f"({' + '.join(moving(c, months) for c in top)}) / "
        f"nullif({' + '.join(moving(c, months) for c in bottom)}, 0)"
    )


TRIPLE = [
    (("amt2",), ("amt2", "amt3")),
    (("amt2",), ("amt2", "amt4")),
    (("amt3",), ("amt3", "amt2")),
    (("amt3",), ("amt3", "amt4")),
    (("amt4",), ("amt4", "amt2")),
    (("amt4",), ("amt4", "amt3")),
]


def triple_ratios(months: int, names) -> str:
    return ", ".join(f"{ratio(top, bottom, months)} AS {next(names)}" for top, bottom in TRIPLE)


def single(columns: str, months: int) -> str:
    return f"SELECT user_id, {columns} FROM {trail('user_day', months, LAST, LAST)} GROUP BY user_id"


def many(columns: str, months: int) -> str:
    return (
        f"SELECT user_id, base_period, {columns} "
        f"FROM {trail('user_day', months, FIRST, LAST)} GROUP BY user_id, base_period"
    )


EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def category_counts(names) -> str:
    return ", ".join(
        f"count(*) FILTER (WHERE cat = '{t}'){part} AS {next(names)}"
        for t in EVENT_TYPES
        for part in ("", " / count(*)")
    )


def pattern(source: str, key: str, period: str, start: int, end: int) -> str:
    return f"""SELECT month_str, count(*) AS month_str_count FROM (
      SELECT k, string_agg(CASE WHEN s.{period} IS NULL THEN '1' ELSE '0' END, '' ORDER BY m) AS month_str
      FROM (SELECT DISTINCT {key} AS k FROM {source}), (SELECT unnest(range({start}, {end} + 1)) AS m)
      LEFT JOIN {source} s ON s.{key} = k AND s.{period} = m
      GROUP BY k) GROUP BY 1"""


POINTS = (25, 50, 75, 90, 95)


def range_point(q: int, value: str) -> str:
    return f"CAST({q / 100} AS DOUBLE) * (max({value}) - min({value})) + min({value})"


def range_sql(source: str, value: str) -> str:
    edges_ = ", ".join(f"{range_point(q, value)} AS P{q}_num" for q in POINTS)
    pcts = ", ".join(
        f"count(*) FILTER (WHERE {value} IS NULL OR {value} >= P{q}_num) / count(*) AS P{q}_pct"
        for q in POINTS
    )
    nums = ", ".join(f"any_value(P{q}_num) AS P{q}_num" for q in POINTS)
    return f"SELECT '{value}' AS var_name, {nums}, {pcts} FROM {source}, (SELECT {edges_} FROM {source})"


def number_sql(source: str, value: str, rounded: bool) -> str:
    total, mean = f"coalesce(sum({value}), 0)", f"avg({value})"
    if rounded:
        total, mean = f"round({total}, 1)", f"round({mean}, 4)"
    v = f"CAST({value} AS DOUBLE)"
    return f"""SELECT '{value}' AS var_name, count(*) AS cnt, count(*) - count({value}) AS cnt_isna,
      (count(*) - count({value})) / count(*) AS pct_isna, CAST({total} AS DOUBLE) AS sum,
      CAST(min({value}) AS DOUBLE) AS min, CAST(max({value}) AS DOUBLE) AS max, {mean} AS avg,
      median({v}) AS med FROM {source}"""


def category_sql(source: str, value: str) -> str:
    return f"""SELECT '{value}' AS var_name, var_value, CAST(sum(n) AS BIGINT) AS cnt,
      CAST(sum(n) AS BIGINT) / (SELECT count(*) FROM {source}) AS pct
    FROM (SELECT {value} AS var_value, 1 AS n FROM {source} UNION ALL SELECT NULL, 0)
    GROUP BY var_value"""


def check_numbers(source: str, value: str) -> str:
    """One (item, amount) row per measure of a numeric column."""
    measures = {
        "cnt": "cnt", "cnt_isna": "cnt_isna", "pct_isna": "pct_isna", "sum": "sum", "min": "min",
        "max": "max", "avg": "avg", "med": "med",
        **{f"P{q}_num": f"P{q}_num" for q in POINTS}, **{f"P{q}_pct": f"P{q}_pct" for q in POINTS},
    }
    return " UNION ALL ".join(
        f"SELECT '{source}' AS filename, 'number' AS section, '{value}' AS var_name, "
        f"'{item}' AS item, round(CAST({column} AS DOUBLE), 6) AS amount "
        f"FROM ({number_sql(source, value, False)}) JOIN ({range_sql(source, value)}) USING (var_name)"
        for item, column in measures.items()
    )


# --- discovery: the blocks of the configuration, joined on their keys ---------


def layer_sql() -> str:
    names = var_names()
    ratios = ", ".join(triple_ratios(months, names) for months in (1, 3))
    return (
        "filtered AS (SELECT user_id, day, amt2, amt3, amt4, cat FROM user_day "
        "WHERE day BETWEEN 3 AND 14 AND day > 3), "
        f"layer AS (SELECT *, {ratios} FROM filtered), "
        f"near AS (SELECT * FROM layer WHERE day BETWEEN {FIRST} AND {LAST})"
    )


def grouped(source: str, columns: str, months: int, first: int, last: int) -> str:
    return (
        f"(SELECT user_id, base_period, {columns} "
        f"FROM {trail(source, months, first, last)} GROUP BY user_id, base_period)"
    )


def bin_block(source: str, value: str, months: int, bins: int, first: int, by_rank: bool, names) -> str:
    cols = ", ".join(f"max(share) FILTER (WHERE ordinal = {i}) AS {next(names)}" for i in range(bins))
    return (
        f"(SELECT user_id, base_period, {cols} FROM "
        f"({shares(source, value, months, bins, first, LAST, by_rank)}) GROUP BY ALL)"
    )


def discovery_blocks(first: int, layered: str) -> list[str]:
    names = var_names(13)
    blocks = []
    for value, months in (("amt2", 1), ("amt2", 3), ("amt3", 4)):
        block_stats = stats(value, [next(names) for _ in STATS])
        blocks.append(grouped("filtered", block_stats, months, first, LAST))
        blocks.append(grouped("filtered", period_ratios(value, months, names) if months > 1 else
                              one_period_ratios(value, names), months, first, LAST))
    for months in (3, 6):
        blocks.append(run_above(layered, "amt2", months, 3000, first, LAST, next(names)))
    blocks.append(run_rising(layered, "amt3", 6, 1000, first, LAST, next(names)))
    blocks.append(run_above(layered, "var_7", 3, 0.2, first, LAST, next(names)))
    blocks.append(bin_block(layered, "amt2", 3, 4, first, True, names))
    for months in (3, 6):
        blocks.append(bin_block(layered, "amt4", months, 3, first, False, names))
    for months in (5, 6):
        blocks.append(grouped(layered, category_counts(names), months, first, LAST))
    return blocks


def one_period_ratios(value: str, names) -> str:
    parts = []
    for func in ("sum", "max", "avg"):
        whole = half(func, value, "true")
        parts.append(f"({whole}) / nullif({whole}, 0) AS {next(names)}")
    return ", ".join(parts)


def discovery(rolling: bool) -> str:
    if rolling:
        blocks = discovery_blocks(FIRST, "layer")
        base = "(SELECT * EXCLUDE (day), day AS base_period FROM near)"
        joined = " FULL JOIN ".join(
            [base] + [f"{b} b{i} USING (user_id, base_period)" for i, b in enumerate(blocks)]
        )
        columns = "*"
    else:
        blocks = discovery_blocks(LAST, "near")
        base = f"(SELECT DISTINCT user_id, {LAST} AS base_period FROM near)"
        joined = " FULL JOIN ".join(
            [base] + [f"{b} b{i} USING (user_id, base_period)" for i, b in enumerate(blocks)]
        )
        columns = "* EXCLUDE (base_period)"
    return f"WITH {USER_DAY}, {layer_sql()} SELECT {columns} FROM {joined}"


def replayed_discovery_sql() -> str:
    """The variables of a filtered block and of a bin block, for every key of the source."""
    names = var_names()
    columns = f"{stats('amt2', [next(names) for _ in STATS])}, {period_ratios('amt2', 3, names)}"
    block = grouped("chosen", columns, 3, LAST, LAST)
    bins = bin_block("filtered", "amt2", 6, 3, LAST, False, names)
    return (
        f"WITH {USER_DAY}, filtered AS (SELECT * FROM user_day WHERE day BETWEEN 3 AND 14 AND day > 3), "
        "chosen AS (SELECT * FROM filtered WHERE amt3 > 1000 OR cat = 'view') "
        f"SELECT * FROM (SELECT DISTINCT user_id, {LAST} AS base_period FROM filtered) "
        f"LEFT JOIN {block} b USING (user_id, base_period) LEFT JOIN {bins} c USING (user_id, base_period)"
    )


def dictionary_sql() -> str:
    """One row per variable of the discovery run; edges come from the data."""
    names = var_names()
    rows = []

    def add(module, months, value="NULL", func="NULL", category="NULL"):
        quoted = [x if x == "NULL" else f"'{x}'" for x in (value, func, category)]
        rows.append(
            f"SELECT '{next(names)}' AS var_name, '{module}' AS module, CAST({months} AS INTEGER) AS N_Months, "
            f"{quoted[0]} AS value_column, {quoted[1]} AS func_name, CAST(NULL AS DOUBLE) AS bin_value, "
            f"{quoted[2]} AS category_value"
        )

    for months in (1, 3):
        for _ in TRIPLE:
            add("ff_combination_pct", months)
    codes = {"size": "np.size", "sum": "np.sum", "min": "np.min", "max": "np.max",
             "average": "np.average", "median": "np.median"}
    for value, months in (("amt2", 1), ("amt2", 3), ("amt3", 4)):
        for stat in STATS:
            add("ff_common_stat", months, value, codes.get(stat, stat))
        for _ in spans(months) if months > 1 else [(1, 1)]:
            for func in ("np.sum", "np.max", "np.mean"):
                add("ff_period_compare_stat", months, value, func)
    for module, value, months in (
        ("ff_continue_gt_N", "amt2", 3),
        ("ff_continue_gt_N", "amt2", 6),
        ("ff_continue_inc_gt_N", "amt3", 6),
        ("ff_continue_gt_N", "var_7", 3),
    ):
        add(module, months, value)
    for module, value, months, bins, by_rank in (
        ("ff_bin_distribution_by_loc", "amt2", 3, 4, True),
        ("ff_bin_distribution_by_val", "amt4", 3, 3, False),
        ("ff_bin_distribution_by_val", "amt4", 6, 3, False),
    ):
        first = int(next(names).removeprefix("var_"))
        for _ in range(bins - 1):
            next(names)
        rows.append(
            f"SELECT 'var_' || ({first} + ordinal), '{module}', {months}, '{value}', NULL, edge, NULL "
            f"FROM {edges('near', value, months, bins, LAST, LAST, by_rank)}"
        )
    for months in (5, 6):
        for category in EVENT_TYPES:
            for func in ("cnt", "pct"):
                add("ff_category_cnt_pct", months, "cat", func, category)
    return f"WITH {USER_DAY}, {layer_sql()} " + " UNION ALL ".join(rows)


def replay_sql() -> str:
    names = iter(["total", "best", "mid"])
    window = trail("with_pct", 6, LAST, LAST)
    blocks = [
        f"""(SELECT user_id, coalesce(sum(amt2), 0) AS {next(names)}, max(amt2) AS {next(names)},
          median(amt3) AS {next(names)},
          avg(amt2) FILTER (WHERE base_period - day < 2)
            / nullif(avg(amt2) FILTER (WHERE base_period - day >= 3), 0) AS trend,
          count(*) FILTER (WHERE amt2 IS NULL OR amt2 >= 5000) / count(*) AS high,
          count(*) FILTER (WHERE amt2 >= 5000) / count(*) AS over,
          count(*) FILTER (WHERE cat = 'click') / count(*) AS clicks
        FROM {window} GROUP BY user_id)""",
        f"(SELECT user_id, pct_run FROM {run_above('with_pct', 'pct', 6, 0.3, LAST, LAST, 'pct_run')})",
        f"(SELECT user_id, rise FROM {run_rising('with_pct', 'amt2', 6, 1000, LAST, LAST, 'rise')})",
    ]
    joined = " ".join(f"LEFT JOIN {b} b{i} USING (user_id)" for i, b in enumerate(blocks))
    return f"""WITH {USER_DAY}, with_pct AS (
        SELECT *, {ratio(("amt2",), ("amt2", "amt3"), 3)} AS pct FROM user_day)
      SELECT user_id, {LAST} AS base_period, total, best, mid, pct_run, rise, trend, high, over, clicks,
        best / nullif(total + 1, 0) - 0.5 AS spread
      FROM (SELECT DISTINCT user_id FROM user_day) {joined}"""


REQUESTS = """requests AS (
  SELECT CAST(event_id AS VARCHAR) AS request_id, CAST(user_id AS VARCHAR) AS key,
    event_id, event_type, json_extract_string(props, '$.k') AS k,
    CASE WHEN value < 200 THEN CAST(round(value * 100) AS BIGINT) END AS cents,
    event_type <> 'error' AS has_step, value < 200 AS is_number
  FROM events)"""

WORST_TO_BEST = "ZDG7654321N*C#/"


def with_panel(sql: str) -> str:
    return f"WITH {USER_DAY} {sql}"


def _long_windows() -> str:
    parts = []
    for value in ("amt2", "amt3", "amt4"):
        for months in (1, 3, 6):
            inside = f"base_period - day < {months}"
            rows = f"count(*) FILTER (WHERE {inside})"
            only = f"FILTER (WHERE {inside})"
            parts += [
                f"CASE WHEN {rows} > 0 THEN coalesce(sum({value}) {only}, 0) END AS sum_{value}_{months}",
                f"max({value}) {only} AS max_{value}_{months}",
                f"CASE WHEN {rows} > 0 THEN {rows} END AS rows_{value}_{months}",
            ]
    return ", ".join(parts)


def _ratio_over(months: int) -> str:
    """Orders over orders and cents, each summed over the last rows with a full window."""
    window = f"OVER (PARTITION BY o_custkey ORDER BY month ROWS {months - 1} PRECEDING)"

    def total(c: str) -> str:
        return f"coalesce(CASE WHEN count({c}) {window} = {months} THEN sum({c}) {window} END, 0)"

    return f"{total('orders')} / nullif({total('orders')} + {total('cents')}, 0)"


ORACLES = {
    "panel_user_day": with_panel("SELECT * FROM user_day"),
    "panel_filter": with_panel(
        "SELECT * FROM user_day WHERE day BETWEEN 5 AND 20 AND day > 6 AND amt1 >= 2"
    ),
    "combo_ratio": with_panel(
        f"SELECT user_id, day, amt1, amt2, amt3, amt4, {triple_ratios(3, var_names())} FROM user_day"
    ),
    "combo_ratio_named": with_panel(
        f"SELECT user_id, day, {ratio(('amt2', 'amt3'), ('amt2', 'amt3', 'amt4'), 2)} AS share_of_three "
        "FROM user_day"
    ),
    "trailing_stats": with_panel(single(stats("amt2"), 3)),
    "trailing_stats_rolling": with_panel(many(stats("amt2"), 3)),
    "trailing_stats_events": (
        f"WITH {EVENT_DAY} SELECT user_id, base_period, {stats('cents')} "
        f"FROM {trail('event_day', 3, FIRST, LAST)} GROUP BY user_id, base_period"
    ),
    "trailing_stats_no_period": (
        f"WITH {EVENT_DAY} SELECT user_id, {stats('cents')} FROM event_day GROUP BY user_id"
    ),
    "trailing_many_windows": with_panel(many(_long_windows(), 6)),
    "period_ratio": with_panel(single(period_ratios("amt2", 12, var_names()), 12)),
    "period_ratio_rolling": with_panel(many(period_ratios("amt2", 6, var_names()), 6)),
    "streak_above": with_panel(
        f"SELECT k.user_id, run FROM (SELECT DISTINCT user_id FROM {trail('user_day', 6, LAST, LAST)}) k "
        f"LEFT JOIN {run_above('user_day', 'amt2', 6, 3000, LAST, LAST, 'run')} r USING (user_id)"
    ),
    "streak_above_rolling": with_panel(
        f"SELECT k.user_id, k.base_period, run "
        f"FROM (SELECT DISTINCT user_id, base_period FROM {trail('user_day', 6, FIRST, LAST)}) k "
        f"LEFT JOIN {run_above('user_day', 'amt2', 6, 3000, FIRST, LAST, 'run')} r USING (user_id, base_period)"
    ),
    "streak_increasing": with_panel(
        f"SELECT user_id, run FROM {run_rising('user_day', 'amt2', 6, 3000, LAST, LAST, 'run')}"
    ),
    "streak_increasing_rolling": with_panel(
        f"SELECT * FROM {run_rising('user_day', 'amt2', 6, 3000, FIRST, LAST, 'run')}"
    ),
    "streak_increasing_months": (
        f"WITH {CUSTOMER_MONTH} SELECT * FROM "
        f"{run_rising('customer_month', 'cents', 24, 0, 23952, 23999, 'run', 'o_custkey', 'month')}"
    ),
    "loc_bins": with_panel(shares("user_day", "amt2", 6, 8, LAST, LAST, True)),
    "loc_bins_rolling": with_panel(shares("user_day", "amt2", 6, 8, FIRST, LAST, True)),
    "val_bins": with_panel(shares("user_day", "amt2", 6, 8, LAST, LAST, False)),
    "val_bins_rolling": with_panel(shares("user_day", "amt2", 6, 8, FIRST, LAST, False)),
    "bin_named": with_panel(many("count(*) FILTER (WHERE amt2 >= 3000) / count(*) AS share", 6)),
    "category_share": with_panel(single(category_counts(var_names()), 6)),
    "category_share_rolling": with_panel(many(category_counts(var_names()), 6)),
    "category_named": with_panel(
        single(
            "count(*) FILTER (WHERE cat = 'purchase') AS purchase_cnt, "
            "count(*) FILTER (WHERE cat = 'purchase') / count(*) AS purchase_pct",
            6,
        )
    ),
    "presence_pattern_days": with_panel(pattern("user_day", "user_id", "day", 1, 30)),
    "presence_pattern_months": (
        f"WITH {CUSTOMER_MONTH} {pattern('customer_month', 'o_custkey', 'month', 23941, 24024)}"
    ),
    "presence_flags": with_panel(
        f"""SELECT k.user_id, CAST(m AS INTEGER) AS day, CASE WHEN s.day IS NULL THEN '1' ELSE '0' END AS missing
        FROM (SELECT DISTINCT user_id FROM user_day) k, (SELECT unnest(range({FIRST}, {LAST} + 1)) AS m)
        LEFT JOIN user_day s ON s.user_id = k.user_id AND s.day = m"""
    ),
    "numeric_profile_lineitem": " UNION ALL ".join(
        number_sql("lineitem", v, True) for v in ("l_quantity", "l_extendedprice", "l_linenumber")
    ),
    "range_profile_lineitem": " UNION ALL ".join(
        range_sql("lineitem", v) for v in ("l_quantity", "l_extendedprice")
    ),
    "range_profile_nulls": with_panel(
        " UNION ALL ".join(range_sql("user_day", v) for v in ("amt2", "amt3"))
    ),
    "category_profile_lineitem": " UNION ALL ".join(
        category_sql("lineitem", v) for v in ("l_returnflag", "l_linestatus")
    ),
    "value_frequency": "SELECT source, count(*) AS cnt FROM documents WHERE source IS NOT NULL GROUP BY 1",
    "assert_unique": (
        "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"
    ),
    "data_check": f"WITH {USER_DAY}, {CUSTOMER_MONTH} "
    + " UNION ALL ".join(
        [
            "SELECT 'user_day' AS filename, 'presence' AS section, CAST(NULL AS VARCHAR) AS var_name, "
            "month_str AS item, CAST(month_str_count AS DOUBLE) AS amount "
            f"FROM ({pattern('user_day', 'user_id', 'day', 1, 10)})",
            "SELECT 'customer_month', 'presence', NULL, month_str, CAST(month_str_count AS DOUBLE) "
            f"FROM ({pattern('customer_month', 'o_custkey', 'month', 23953, 23964)})",
            check_numbers("user_day", "amt1"),
            check_numbers("user_day", "amt2"),
            check_numbers("customer_month", "orders"),
            "SELECT 'user_day', 'category', var_name, var_value, round(pct, 6) "
            f"FROM ({category_sql('user_day', 'cat')})",
        ]
    ),
    "pick_extreme_rows": """SELECT o_custkey,
        arg_min(o_orderkey, (o_totalprice, o_orderkey)) AS min_o_totalprice_o_orderkey,
        arg_min(o_orderpriority, (o_totalprice, o_orderkey)) AS min_o_totalprice_o_orderpriority,
        arg_min(o_orderkey, (-o_totalprice, o_orderkey)) AS max_o_totalprice_o_orderkey,
        arg_min(o_orderpriority, (-o_totalprice, o_orderkey)) AS max_o_totalprice_o_orderpriority
      FROM orders GROUP BY o_custkey""",
    "pick_latest_event": """SELECT user_id, event_type, event_id AS max_ts_event_id, value AS max_ts_value
      FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS rn
            FROM events WHERE ts IS NOT NULL) WHERE rn = 1""",
    "keyword_match": """SELECT p_partkey,
        CAST(p_name IN ('red widget', 'blue bolt') AS INTEGER) AS is_word,
        CAST(contains(p_name, 'ring') OR contains(p_name, 'bolt') AS INTEGER) AS has_word,
        CAST(contains('a small ring box', p_name) OR contains('red widgets', p_name) AS INTEGER) AS in_word
      FROM part""",
    "keyword_match_text": """SELECT doc_id, CAST(contains(text, 'the') OR contains(text, 'entre')
        OR contains(text, 'license') OR contains(text, 'password') AS INTEGER) AS has_word
      FROM documents""",
    "worst_status_summary": f"""WITH codes AS (
        SELECT o_custkey, translate(CAST(o_orderkey * 7919 + 104729 AS VARCHAR), '0123456789', 'N1234567*?') AS status
        FROM orders),
      places AS (SELECT o_custkey, status, unnest(range(1, length(status) + 1)) AS pos FROM codes),
      worst AS (SELECT o_custkey, pos, min(nullif(instr('{WORST_TO_BEST}', substr(status, pos, 1)), 0)) AS rank
        FROM places GROUP BY 1, 2)
      SELECT o_custkey, coalesce(string_agg(substr('{WORST_TO_BEST}', rank, 1), '' ORDER BY pos)
        FILTER (WHERE rank IS NOT NULL), '') AS summary
      FROM worst GROUP BY 1""",
    "discover_features": discovery(False),
    "discover_rolling": discovery(True),
    "discover_dictionary": dictionary_sql(),
    "replay_features": replay_sql(),
    "custom_expr": with_panel(
        f"""SELECT user_id, {LAST} AS base_period, total, size, total / size AS mean_all,
          2 * (total / size) + size AS twice
        FROM (SELECT DISTINCT user_id FROM user_day) LEFT JOIN (
          {single("coalesce(sum(amt2), 0) AS total, count(*) AS size", 6)}) USING (user_id)"""
    ),
    "json_explode_features": """SELECT CAST(event_id AS VARCHAR) AS request_id,
        CAST(event_id AS VARCHAR) AS case_id, json_extract_string(props, '$.k') AS some_number, event_type
      FROM events
      UNION ALL
      SELECT CAST(event_id AS VARCHAR),
        CASE WHEN value >= 200 THEN 'n/a' ELSE CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) END,
        NULL, NULL
      FROM events""",
    "online_requests": f"""WITH {REQUESTS}
      SELECT request_id, key, CAST(event_id + cents AS DOUBLE) AS var_22,
        CAST(greatest(event_id, cents) AS DOUBLE) AS var_23,
        CAST(CASE WHEN k IS NULL THEN 2 ELSE 1 END AS BIGINT) AS var_24, CAST(2 AS BIGINT) AS var_25,
        CASE WHEN event_type = 'click' THEN 0.5 ELSE 0 END::DOUBLE AS var_26,
        CAST(event_id + cents + 2 AS DOUBLE) AS var_31
      FROM requests WHERE has_step AND is_number""",
    "online_rejects": f"""WITH {REQUESTS}
      SELECT request_id, CASE WHEN NOT has_step THEN 'missing workflow step' ELSE 'not a number' END AS reason
      FROM requests WHERE NOT has_step OR NOT is_number""",
    "panel_filter_nulls": with_panel(
        "SELECT * FROM user_day WHERE (amt2 IS NULL OR amt2 <> 0) AND (amt2 IS NULL OR amt2 <= 5000) "
        "AND day > 3 AND day <= 20 AND cat IN ('click', 'view', 'purchase')"
    ),
    "combo_ratio_long_history": f"""WITH {CUSTOMER_MONTH} SELECT o_custkey, month, orders, cents,
        {_ratio_over(3)} AS order_share, {_ratio_over(1)} AS own FROM customer_month""",
    "trailing_medians_only_hot": with_panel(many("median(amt4) AS mid", 6)),
    "category_share_long": """WITH o AS (
        SELECT o_orderpriority, CAST(month(o_orderdate) AS INTEGER) AS month, CAST(o_custkey AS VARCHAR) AS category
        FROM orders),
      inside AS (SELECT o.*, CAST(b AS INTEGER) AS base_period FROM o JOIN (SELECT unnest(range(6, 10)) AS b)
        ON month BETWEEN b - 2 AND b)
      SELECT o_orderpriority, base_period, category, count(*) AS cnt,
        count(*) / sum(count(*)) OVER (PARTITION BY o_orderpriority, base_period) AS pct
      FROM inside GROUP BY o_orderpriority, base_period, category""",
    "worst_status_codes": f"""WITH codes AS (
        SELECT o_custkey, k, substr('{WORST_TO_BEST}',
          CAST(((o_orderkey * 7 + o_custkey) % 15 + k * k) % 15 + 1 AS INTEGER), 1) AS code
        FROM orders, (SELECT unnest(range(6)) AS k)),
      worst AS (SELECT o_custkey, k, min(instr('{WORST_TO_BEST}', code)) AS rank FROM codes GROUP BY 1, 2)
      SELECT o_custkey, string_agg(substr('{WORST_TO_BEST}', rank, 1), '' ORDER BY k) AS summary
      FROM worst GROUP BY 1""",
    "custom_expr_more": with_panel(
        f"""SELECT user_id, {LAST} AS base_period, total, best, size,
          (7 - total) - 360 * floor((7 - total) / 360) AS rest,
          total - (-360) * floor(total / -360) AS back,
          floor((7 - total) / size) AS whole,
          CAST(coalesce(best > 5000, false) AS DOUBLE) + CAST(coalesce(best <> 0, true) AS DOUBLE) AS large,
          coalesce(best, -1) * 2 AS filled
        FROM (SELECT DISTINCT user_id FROM user_day) LEFT JOIN (
          {single("coalesce(sum(amt2), 0) AS total, max(amt2) AS best, count(*) AS size", 6)}) USING (user_id)"""
    ),
    "discover_many_categories": """WITH counted AS (
        SELECT o_orderpriority, CAST(o_custkey AS VARCHAR) AS customer, count(*) AS n FROM orders
        WHERE year(o_orderdate) * 12 + month(o_orderdate) - 23940 BETWEEN 13 AND 36 GROUP BY 1, 2),
      listed AS (SELECT o_orderpriority, string_agg(customer || ':' || n, ',' ORDER BY customer) AS counts,
        max(n) / sum(n) AS largest FROM counted GROUP BY 1)
      SELECT o_orderpriority, counts, CAST(1 AS DOUBLE) AS whole, largest, counts AS replayed FROM listed""",
    "json_nested_rows": """SELECT CAST(event_id AS VARCHAR) AS request_id, CAST(case_id AS VARCHAR) AS case_id, event_type
      FROM (SELECT event_id, event_type, event_id AS case_id FROM events
        UNION ALL SELECT event_id, event_type, event_id * 10 FROM events
        UNION ALL SELECT event_id, event_type, event_id + 1 FROM events WHERE event_id % 3 <> 0)""",
    "custom_statistic": with_panel(
        f"""SELECT user_id, {LAST} AS base_period, spread_amt2, squares_amt1, size, spread_amt2 / size AS mixed
        FROM (SELECT DISTINCT user_id FROM user_day)
        LEFT JOIN ({single("max(amt2) - min(amt2) AS spread_amt2, count(*) AS size", 6)}) USING (user_id)
        LEFT JOIN ({single("sum(amt1 * amt1) AS squares_amt1", 3)}) USING (user_id)"""
    ),
    "stored_panel_features": with_panel(
        f"""SELECT user_id, base_period, total, n_rows, run FROM ({many("count(*) AS n_rows", 6)})
        LEFT JOIN ({many("coalesce(sum(amt2), 0) AS total", 3)}) USING (user_id, base_period)
        LEFT JOIN {run_above('user_day', 'amt2', 6, 3000, FIRST, LAST, 'run')} USING (user_id, base_period)"""
    ),
    "custom_expr_large": with_panel(
        f"""SELECT user_id, {LAST} AS base_period, best, size,
          floor(best * 1e20) AS huge, floor(size * -9e22 / 0.5) AS low, floor((best - 5000) / 7) AS parts
        FROM (SELECT DISTINCT user_id FROM user_day) LEFT JOIN (
          {single("max(amt2) AS best, count(*) AS size", 6)}) USING (user_id)"""
    ),
    "panel_filter_types": """SELECT * FROM (
        SELECT event_id, coalesce(CASE WHEN event_id % 3 = 0 THEN json_extract_string(props, '$.k') END, event_type) AS tag
        FROM events)
      WHERE coalesce(TRY_CAST(tag AS DOUBLE) <> 50, true) AND NOT coalesce(TRY_CAST(tag AS DOUBLE) > 80, false)
        AND NOT coalesce(TRY_CAST(tag AS DOUBLE) = 7, false) AND coalesce(tag <> 'click', true)""",
    "keyword_match_large": """WITH
      words AS (SELECT DISTINCT substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 5) AS word FROM orders),
      lines AS (SELECT l_orderkey, l_linenumber, md5(concat(l_orderkey, '-', l_linenumber)) AS code FROM lineitem),
      grams AS (SELECT code, substr(code, i, 5) AS gram
        FROM (SELECT code, unnest(range(1, 29)) AS i FROM (SELECT DISTINCT code FROM lines))),
      parts AS (SELECT substr(word, i, 3) AS part FROM (SELECT word, unnest(range(1, 4)) AS i FROM words))
      SELECT l_orderkey, l_linenumber,
        CAST(substr(code, 1, 5) IN (SELECT word FROM words) AS INTEGER) AS is_word,
        CAST(code IN (SELECT code FROM grams JOIN words ON gram = word) AS INTEGER) AS has_word,
        CAST(substr(code, 1, 3) IN (SELECT part FROM parts) AS INTEGER) AS in_word
      FROM lines""",
    "online_stream_repeats": f"""WITH {REQUESTS}
      SELECT request_id, key, CAST(event_id + cents AS DOUBLE) AS var_22,
        CAST(greatest(event_id, cents) AS DOUBLE) AS var_23,
        CAST(CASE WHEN k IS NULL THEN 2 ELSE 1 END AS BIGINT) AS var_24, CAST(2 AS BIGINT) AS var_25,
        CASE WHEN event_type = 'click' THEN 0.5 ELSE 0 END::DOUBLE AS var_26,
        CAST(event_id + cents + 2 AS DOUBLE) AS var_31
      FROM requests WHERE has_step AND is_number""",
    "online_repeated_requests": f"""WITH {REQUESTS}
      SELECT CAST(event_id % 10 AS VARCHAR) AS request_id, key, CAST(event_id + cents AS DOUBLE) AS var_22,
        CAST(greatest(event_id, cents) AS DOUBLE) AS var_23,
        CAST(CASE WHEN k IS NULL THEN 2 ELSE 1 END AS BIGINT) AS var_24, CAST(2 AS BIGINT) AS var_25,
        CASE WHEN event_type = 'click' THEN 0.5 ELSE 0 END::DOUBLE AS var_26,
        CAST(event_id + cents + 2 AS DOUBLE) AS var_31
      FROM requests WHERE has_step AND is_number""",
    "online_stream": f"""WITH {REQUESTS}
      SELECT key, CAST(event_id + cents AS DOUBLE) AS var_22,
        CAST(greatest(event_id, cents) AS DOUBLE) AS var_23,
        CAST(CASE WHEN k IS NULL THEN 2 ELSE 1 END AS BIGINT) AS var_24, CAST(2 AS BIGINT) AS var_25,
        CASE WHEN event_type = 'click' THEN 0.5 ELSE 0 END::DOUBLE AS var_26,
        CAST(event_id + cents + 2 AS DOUBLE) AS var_31
      FROM requests WHERE has_step AND is_number""",
    "online_two_parts": f"""WITH {REQUESTS}
      SELECT request_id, key, CAST(event_id + cents AS DOUBLE) AS var_22,
        CAST(greatest(event_id, cents) AS DOUBLE) AS var_23,
        CAST(CASE WHEN k IS NULL THEN 2 ELSE 1 END AS BIGINT) AS var_24, CAST(2 AS BIGINT) AS var_25,
        CASE WHEN event_type = 'click' THEN 0.5 ELSE 0 END::DOUBLE AS var_26,
        CAST(event_id + cents + 2 AS DOUBLE) AS var_31,
        CAST(least(event_id, cents) AS DOUBLE) AS var_41
      FROM requests WHERE has_step AND is_number""",
    "replay_of_discovered": replayed_discovery_sql(),
    "csv_round_trip": with_panel("SELECT * FROM user_day"),
}
