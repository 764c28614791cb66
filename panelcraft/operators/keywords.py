"""Keyword matching against a table of words of any size.

``functions.keyword_flag`` tests a short list word by word inside an expression.
Here the words are a table: equal values are a hash join. Words that values may
contain are sent to the executors while they are few by a checked count: the
scan then looks at every place of a value, and neither n-grams nor rows move.
Other containment goes through an index of character n-grams. A string that lies
inside another one shares all its n-grams with it, so the rarest of them, counted
over the strings that may hold it, leads to few candidates, which are then compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Length of the n-grams; a shorter string is one gram.
GRAM = 4

#: Distinct texts that are sent to every executor, and their bytes; more are joined by a shuffle.
MOST_SENT, MOST_BYTES = 1_500_000, 32_000_000

METHODS = ("equal", "contain", "contained")


def match_keywords(
    df: DataFrame, value: str, words: DataFrame, word: str, method: str = "equal", name: str = "matched"
) -> DataFrame:
    """``df`` with a column ``name``: 1 where the value matches one of the words, else 0.

    ``equal``: the value is one of the words; ``contain``: the value contains
    one; ``contained``: one of the words contains the value. Nulls on either
    side match nothing; the empty text lies inside every other text. Repeated
    words count once. Words that are sent are looked up row by row; in an index
    every different value is compared once, however many rows have it, so a value
    of a third of all rows is no more work than another.
    """
    if method not in METHODS:
        raise ValueError(f"unknown match method {method!r}")
    every = words.select(F.col(f"`{word}`").cast("string").alias("_word")).where("_word is not null")
    known, own = every.distinct(), F.col(f"`{value}`").cast("string")
    sent = method != "contained" and _few(every)
    if method == "contain" and sent:
        return df.select("*", _contains_any(known)(own.cast("binary")).alias(name))
    given = df.select(own.alias("_text")).where("_text is not null")
    texts = given.distinct()
    if method == "equal":
        found = known.withColumnRenamed("_word", "_text")
    else:
        sent = _few(given)
        if method == "contain":
            pairs = contained_pairs(known, "_word", texts, "_text")
        else:
            pairs = contained_pairs(texts, "_text", known, "_word", sent)
        found = pairs.select("_text").distinct()
    # Columns of ``df`` travel as one struct, so that their names meet no others.
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), own.alias("_text"))
    hits = found.select("_text", F.lit(1).alias("_hit"))
    flagged = rows.join(F.broadcast(hits) if sent else hits, "_text", "left")
    return flagged.select("_row.*", F.coalesce("_hit", F.lit(0)).alias(name))


def _few(texts: DataFrame) -> bool:
    """Whether the different texts of one column can be sent: estimated first, then counted if not many."""
    column = texts.columns[0]
    if texts.agg(F.approx_count_distinct(column)).first()[0] > 2 * MOST_SENT:
        return False
    n, size = texts.distinct().agg(F.count(F.lit(1)), F.sum(F.octet_length(column))).first()
    return n <= MOST_SENT and (size or 0) <= MOST_BYTES


def _contains_any(known: DataFrame) -> Callable[[Column], Column]:
    """A function of binary columns: 1 where the bytes hold one of the ``known`` words, else 0.

    Words are found by their first bytes, ``GRAM`` at most: ``heads`` has the
    lengths of the words that begin so.
    """
    column = known.columns[0]
    # Partition by partition, so that the driver holds few rows beside the set.
    words = frozenset(bytes(r[0]) for r in known.select(F.col(column).cast("binary")).toLocalIterator())
    lengths: dict[bytes, set[int]] = {}
    for w in words:
        lengths.setdefault(w[:GRAM], set()).add(len(w))
    heads = {head: tuple(sorted(own)) for head, own in lengths.items()}
    sent = known.sparkSession.sparkContext.broadcast((words, heads, sorted({len(head) for head in heads})))

    def holds(text: bytes | None) -> int:
        if text is None:
            return 0
        words, heads, sizes = sent.value
        for size in sizes:
            for at in range(len(text) - size + 1):
                for n in heads.get(text[at : at + size], ()):
                    if text[at : at + n] in words:
                        return 1
        return 0

    return F.udf(holds, "int", useArrow=True)


def _grams(text: Column, length: int) -> Column:
    """The different n-grams of a text; the empty text for length 0."""
    if length == 0:
        return F.array(F.lit(""))
    last = F.char_length(text) - length + 1
    places = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda at: F.substring(text, at, F.lit(length))))


def contained_pairs(
    inner: DataFrame, part: str, outer: DataFrame, whole: str, sent: bool = False
) -> DataFrame:
    """(part, whole): each distinct text of ``inner`` with those of ``outer`` that contain it.

    ``sent``: the texts of ``inner`` are few and go to every executor, so that the index stays where it is made.
    """
    part_column, whole_column = F.col(part), F.col(whole)
    length = F.least(F.char_length(part_column), F.lit(GRAM))
    lengths = [r[0] for r in inner.select(length).distinct().collect()]  # at most GRAM + 1 rows
    if not lengths:
        return inner.select(part).join(outer.select(whole), F.lit(False))
    grams = F.array_distinct(F.flatten(F.array(*[_grams(whole_column, n) for n in sorted(lengths)])))
    index = outer.select(whole, F.explode(grams).alias("_gram"))
    of_part = F.lit(None).cast("array<string>")
    for n in sorted(lengths):
        of_part = F.when(length == n, _grams(part_column, n)).otherwise(of_part)
    counts = index.groupBy("_gram").agg(F.count(F.lit(1)).alias("_in"))
    rarest = (
        inner.select(part, F.explode(of_part).alias("_gram"))
        .join(counts, "_gram", "left")
        .groupBy(part)
        .agg(
            F.min(F.coalesce("_in", F.lit(0))).alias("_in"),
            F.min_by("_gram", F.struct(F.coalesce("_in", F.lit(0)), "_gram")).alias("_gram"),
        )
        .where(F.col("_in") > 0)
        .select(part, "_gram")
    )
    rarest = F.broadcast(rarest) if sent else rarest
    return index.join(rarest, "_gram").where(F.contains(whole_column, part_column)).select(part, whole)
