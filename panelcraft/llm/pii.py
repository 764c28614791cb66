"""Personal data by proposal, validation and context, in built-in functions only.

Per kind a regular expression proposes spans (leftmost, not overlapping). A
validator confirms or drops each: number ranges of addresses, Luhn for cards,
digit counts of phones, mod-97 of bank account numbers. A score starts at the
kind's own value and is moved by words near the span, up to ``NEAR`` code
points of text to either side. The four base kinds stay whatever their score,
and their words end at the next proposal of that kind; the kinds added by the
method need a score of ``THRESHOLD``, and their words are those of the whole
text, so one word "ssn" serves a list of numbers.

An account number is tried from every word that can begin one: at its
country's length (``IBAN_LENGTHS``) first, so that upper-case words or digits
after it do no harm, then as the longest run of groups. For a country without a
known length every word edge is tried, the longest first.

Patterns use possessive repeats and look-behinds where these cannot change the
matches: Java's engine then neither recurses per repeat nor rescans long runs.

Defined cases: a null text is empty and has no spans; repeated rows are judged
one by one; spans count code points, their end is exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEAR = 32
THRESHOLD = 0.6


@dataclass(frozen=True)
class Kind:
    """``pattern`` is for Java's engine, ``plain`` the same matches without its extensions."""

    name: str
    pattern: str
    plain: str
    score: float
    context: str
    always: bool = False
    hint: str | None = None


KINDS = (
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        0.9, "mail|contact|write to", True, "@",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        0.7, "ip|address|host|server", True, ".",
    ),
    Kind(
        "card",
        r"[0-9](?:[ -]?[0-9])++",
        r"[0-9]([ -]?[0-9])+",
        0.8, "card|visa|credit|payment", True,
    ),
    Kind(
        "phone",
        r"\+[0-9][ ().0-9-]+[0-9]",
        r"\+[0-9][ ().0-9-]+[0-9]",
        0.7, "phone|tel|call|mobile|fax", True, "+",
    ),
    Kind(
        "iban",
        r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}",
        r"[A-Z]{2}[0-9]{2}( ?[A-Z0-9]){11,30}",
        0.7, "iban|account|bank|transfer",
    ),
    Kind(
        "ssn",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        0.4, "ssn|social security|tax id", False, "-",
    ),
    Kind("secret", r"[0-9a-f]{32,}+", r"[0-9a-f]{32,}", 0.4, "token|secret|key|passw"),
)
CONTEXT_GAIN = 0.3
#: Characters of a bank account number by its country, and those countries.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD AL CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
#: A word that can begin an account number; the longest run of groups and the character after it.
_IBAN_START = r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11})"
_IBAN_RUN = r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?s:.)))"
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True for digit strings whose Luhn sum is a multiple of ten."""
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.cast("int") + 1)
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(number: Column) -> Column:
    """True for account numbers (letters and digits) whose rearranged value is 1 modulo 97."""
    turned = F.concat(F.substring(number, 5, 64), F.substring(number, 1, 4))
    rest = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + c.cast("int")) % 97).otherwise(
            (a * 100 + F.ascii(c) - 55) % 97
        ),
    )
    return rest == 1


def _small_parts(hit: Column) -> Column:
    parts = F.transform(F.split(hit, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    return F.forall(
        parts, lambda p: (F.length(p) <= 3) & (F.coalesce(F.substring(p, 1, 4).try_cast("int"), F.lit(0)) <= 255)
    )


def _apart(before: Column, after: Column, charset: str) -> Column:
    """True if no character of ``charset`` touches the span."""
    return ~F.right(before, F.lit(1)).rlike(charset) & ~F.left(after, F.lit(1)).rlike(charset)


def _confirmed(kind: str, hit: Column, before: Column, after: Column) -> Column:
    if kind == "ip":
        return _small_parts(hit)
    if kind == "card":
        digits = _digits(hit)
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(hit)).between(9, 15)
    if kind == "ssn":
        return _apart(before, after, "[0-9-]") & ~hit.rlike("^(000|666|9)|-00-|0000$")
    if kind == "secret":
        return _apart(before, after, "[A-Za-z0-9]") & (F.length(hit) <= 128)
    return F.lit(True)


def _score(kind: Kind, before: Column, after: Column) -> Column:
    near = F.concat(F.right(before, F.lit(NEAR)), F.lit(" "), F.left(after, F.lit(NEAR)))
    seen = F.translate(near, ASCII_UPPER, ASCII_LOWER).rlike(kind.context)
    return F.round(
        F.least(F.lit(1.0), F.lit(kind.score) + F.when(seen, CONTEXT_GAIN).otherwise(0.0)), 2
    )


_SPAN = "array<struct<kind:string,start:bigint,`end`:bigint,score:double>>"


def _iban_length(run: Column) -> Column:
    """Characters of the account number that a run of groups begins with, or null."""
    known = F.create_map(
        *[F.lit(x) for n, names in IBAN_LENGTHS.items() for c in names.split() for x in (c, n)]
    )[F.substring(run, 1, 2)]

    def number(n: Column) -> Column:
        return F.replace(F.substr(run, F.lit(1), n), F.lit(" "), F.lit(""))

    def fits(n: Column) -> Column:
        edge = F.substr(run, n, F.lit(2)).rlike("^[A-Z0-9][^A-Za-z0-9]")
        length = F.length(number(n))
        usual = known.isNull() | (length == known) | (n == F.length(run) - 1)
        return edge & (length >= 15) & usual & mod97(number(n))

    ends = F.filter(F.sequence(F.length(run) - 1, F.lit(15), F.lit(-1)), fits)
    own = F.get(F.filter(ends, lambda n: F.length(number(n)) == known), F.lit(0))
    return F.coalesce(own, F.get(ends, F.lit(0)))


def _iban_spans(kind: Kind, text: Column) -> Column:
    """Account numbers, none inside another. ``text`` has one more character at either end."""
    lengths, gaps = F.col("__hits_iban"), F.col("__gaps_iban")
    start = F.struct(
        F.length(gaps[0]).cast("long").alias("at"),
        F.lit(0).cast("long").alias("free"),
        F.array().cast(_SPAN).alias("spans"),
    )

    def step(state: Column, i: Column) -> Column:
        at = state["at"]  # characters before the run, with the added one
        end = at + lengths[i]
        before = F.substr(text, F.greatest(at - NEAR, F.lit(0)) + 1, F.least(at, F.lit(NEAR)))
        after = F.substr(text, end + 1, F.lit(NEAR))
        span = F.struct(
            F.lit(kind.name).alias("kind"),
            (at - 1).alias("start"),
            (end - 1).alias("end"),
            _score(kind, before, after).alias("score"),
        )
        keep = lengths[i].isNotNull() & (at >= state["free"])
        return F.struct(
            (at + F.length(gaps[i + 1])).alias("at"),
            F.when(keep, end).otherwise(state["free"]).cast("long").alias("free"),
            F.when(keep, F.concat(state["spans"], F.array(span)))
            .otherwise(state["spans"])
            .cast(_SPAN)
            .alias("spans"),
        )

    found = F.aggregate(F.sequence(F.lit(0), F.size(lengths) - 1), start, step, lambda s: s["spans"])
    return F.when(F.size(lengths) > 0, found).otherwise(F.array().cast(_SPAN))


def _spans(kind: Kind) -> Column:
    """Confirmed spans of a kind from its proposals and the gaps between them.

    The words near a span of an added kind may lie beyond the next proposals:
    three of them, as the shortest has 11 characters, fill ``NEAR``.
    """
    hits, gaps = F.col(f"__hits_{kind.name}"), F.col(f"__gaps_{kind.name}")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_SPAN).alias("spans"))

    def step(state: Column, i: Column) -> Column:
        hit, before, after = hits[i], gaps[i], gaps[i + 1]
        begin = state["at"] + F.length(before)
        end = begin + F.length(hit)
        near = (before, after)
        if not kind.always:
            near = tuple(
                F.concat_ws("", *[F.coalesce(F.get(x, i + k), F.lit("")) for x, k in order])
                for order in (
                    [p for k in (-3, -2, -1) for p in ((gaps, k), (hits, k))] + [(gaps, 0)],
                    [(gaps, 1)] + [p for k in (1, 2, 3) for p in ((hits, k), (gaps, k + 1))],
                )
            )
        score = _score(kind, *near)
        keep = _confirmed(kind.name, hit, before, after)
        if not kind.always:
            keep = keep & (score >= THRESHOLD)
        span = F.struct(
            F.lit(kind.name).alias("kind"), begin.alias("start"), end.alias("end"), score.alias("score")
        )
        spans = F.when(keep, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.cast(_SPAN).alias("spans"))

    found = F.aggregate(F.sequence(F.lit(0), F.size(hits) - 1), start, step, lambda s: s["spans"])
    return F.when(F.size(hits) > 0, found).otherwise(F.array().cast(_SPAN))


def find_pii(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` and ``pii``: (kind, start, end, score) by kind, then start.

    A column named ``pii`` in the input is replaced.
    """
    kept = [c for c in docs.columns if c.lower() != "pii"]
    text = F.col("__text")
    rows = docs.select(*kept, F.coalesce("text", F.lit("")).alias("__text"))
    none = F.array().cast("array<string>")

    padded = F.concat(F.lit(" "), text, F.lit(" "))  # a split at the very start would be lost

    def hits(kind: Kind) -> Column:
        if kind.name == "iban":
            return F.transform(F.regexp_extract_all(padded, F.lit(_IBAN_RUN), F.lit(1)), _iban_length)
        found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
        return F.when(F.contains(text, F.lit(kind.hint)), found).otherwise(none) if kind.hint else found

    rows = rows.select("*", *[hits(k).alias(f"__hits_{k.name}") for k in KINDS])
    rows = rows.select(
        "*",
        *[
            F.when(
                F.size(f"__hits_{k.name}") > 0,
                F.split(padded, _IBAN_START, -1) if k.name == "iban" else F.split(text, k.pattern, -1),
            ).alias(f"__gaps_{k.name}")
            for k in KINDS
        ],
    )
    spans = [_iban_spans(k, padded) if k.name == "iban" else _spans(k) for k in KINDS]
    return rows.select(*kept, F.concat(*spans).alias("pii"))


def redact(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with every found span replaced by its kind in brackets.

    Of overlapping spans the first decides the mark, and all their text goes.
    A null text stays null.
    """
    found = find_pii(docs)
    ordered = F.array_sort(
        F.transform("pii", lambda s: F.struct(s["start"], s["end"], s["kind"]))
    )
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        gap = F.substr("text", state["at"] + 1, F.greatest(F.lit(0), s["start"] - state["at"]))
        mark = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(s["start"] < state["at"], state["out"])
            .otherwise(F.concat(state["out"], gap, mark))
            .alias("out"),
        )

    clean = F.aggregate(
        ordered, start, step, lambda s: F.concat(s["out"], F.substr("text", s["at"] + 1))
    )
    text = F.when(F.size("pii") > 0, clean).otherwise(F.col("text")).alias("text")
    return found.select(*[text if c == "text" else F.col(c) for c in docs.columns])


def _sql_spans(kind: Kind) -> str:
    """DuckDB: confirmed spans of a kind, by the plain pattern."""
    digits = "regexp_replace(hit, '[^0-9]', '', 'g')"
    luhn_sql = (
        f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: CASE WHEN i % 2 = 1 "
        f"THEN CAST(reverse({digits})[i] AS INT) ELSE [0,2,4,6,8,1,3,5,7,9][CAST(reverse({digits})[i] "
        "AS INT) + 1] END)) % 10 = 0"
    )
    number = "replace(hit, ' ', '')"
    mod_sql = (
        f"list_reduce(list_prepend(CAST(0 AS HUGEINT), list_transform(string_split(substr({number}, 5) || "
        f"substr({number}, 1, 4), ''), lambda c: CAST(CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 "
        "ELSE ascii(c) - 55 END AS HUGEINT))), lambda a, v: (CASE WHEN v < 10 THEN a * 10 + v "
        "ELSE a * 100 + v END) % 97) = 1"
    )

    def apart(charset: str) -> str:
        return (
            f"NOT regexp_matches(right(before, 1), '{charset}') "
            f"AND NOT regexp_matches(left(after, 1), '{charset}')"
        )

    checks = {
        "ip": "list_bool_and(list_transform(string_split(hit, '.'), lambda p: length(ltrim(p, '0')) <= 3 "
        "AND coalesce(TRY_CAST(left(ltrim(p, '0'), 4) AS INT), 0) <= 255))",
        "card": f"CASE WHEN length({digits}) BETWEEN 13 AND 19 THEN {luhn_sql} ELSE false END",
        "phone": f"length({digits}) BETWEEN 9 AND 15",
        "iban": f"{apart('[A-Za-z0-9]')} AND {mod_sql}",
        "ssn": f"{apart('[0-9-]')} AND NOT regexp_matches(hit, '^(000|666|9)|-00-|0000$')",
        "secret": f"{apart('[A-Za-z0-9]')} AND length(hit) <= 128",
    }
    keep = f"({checks.get(kind.name, 'true')})"
    near = f"right(before, {NEAR}) || ' ' || left(after, {NEAR})"
    if not kind.always:
        near = (
            f"substr(text, greatest(start - {NEAR}, 0) + 1, least(start, {NEAR})) || ' ' || "
            f"substr(text, start + length(hit) + 1, {NEAR})"
        )
    seen = f"regexp_matches(translate({near}, '{ASCII_UPPER}', '{ASCII_LOWER}'), '{kind.context}')"
    own, more = round(100 * kind.score), round(100 * min(1.0, kind.score + CONTEXT_GAIN))
    score = f"CASE WHEN {seen} THEN {more} ELSE {own} END"
    if not kind.always:
        keep += f" AND {score} >= {round(100 * THRESHOLD)}"
    order = [k.name for k in KINDS].index(kind.name)
    return f"""
SELECT doc_id, {order} AS o, '{kind.name}' AS kind, start, start + length(hit) AS stop, {score} AS score
FROM (SELECT doc_id, text, hits[i] AS hit, gaps[i] AS before, gaps[i + 1] AS after,
      CAST(coalesce(list_sum(list_transform(gaps[1:i], lambda g: length(g))), 0)
         + coalesce(list_sum(list_transform(hits[1:i - 1], lambda g: length(g))), 0) AS BIGINT) AS start
   FROM (SELECT doc_id, text, hits, gaps, unnest(range(1, len(hits) + 1)) AS i
      FROM (SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '{kind.plain}') AS hits,
         string_split_regex(coalesce(text, ''), '{kind.plain}') AS gaps FROM documents)))
WHERE {keep}"""


def sql() -> str:
    """DuckDB SQL of the registered query, with unique document ids."""
    base = [k for k in KINDS if k.always]
    parts = " UNION ALL ".join(_sql_spans(k) for k in KINDS)
    text = "kind || ':' || start || ':' || stop"
    counts = ",\n".join(
        f"count(*) FILTER (kind = '{k.name}') AS n_{k.name}" for k in KINDS
    )
    return f"""
WITH spans AS ({parts})
SELECT d.doc_id, {counts},
   sha256(coalesce(string_agg({text}, ',' ORDER BY o, start) FILTER (o < {len(base)}), '')) AS base_sha256,
   coalesce(string_agg({text}, ',' ORDER BY o, start), '') AS spans,
   coalesce(string_agg(CAST(score AS VARCHAR), ',' ORDER BY o, start), '') AS scores
FROM documents d LEFT JOIN spans s ON d.doc_id = s.doc_id GROUP BY d.doc_id"""
