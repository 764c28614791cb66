"""Benchmark decontamination by a positional inverted index, in built-in functions only.

``build_index`` stores the postings of the corpus: one row (term_id, key, pos)
per occurrence of a test term, where ``key`` names the text, and one row with
term_id -1 at the end of every text, whose position is the text's word count.
They are written by the scan itself, without a shuffle.

``phrase_matches`` finds test windows in the corpus. The two rarest terms of
each window give lists of offset-adjusted starts, which are intersected per
text; what is left is compared word by word with the text. ``proximity_matches``
finds texts that hold all terms of a window within a given span of words.

Copies of a text share its key, so a group of copies is intersected once.

Defined cases: a null text has no words; a test item without words has no
windows; one with fewer words than a window is one window; repeated rows of
the corpus each get their result; items with the same id are one item.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcraft.llm.common import Stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same for texts whose A-Z are not lowered yet.
CASED_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Rarest terms of a window whose lists are intersected before words are compared.
RAREST = 2
#: Tables of test terms up to this many rows are sent to every executor; larger ones are shuffled.
MOST_SENT = 200_000
END = -1


def words(text: Column) -> Column:
    """Words of a text as an array; a null text has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, SEPARATORS, -1), "")


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def windows(items: DataFrame, length: int = 13) -> DataFrame:
    """(window, length, item_id): every window's words, joined by spaces, with its items."""
    listed = items.select(F.col("item_id").cast("string"), words(F.col("text")).alias("w"))
    listed = listed.filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (length - 1)))
    cut = listed.select("item_id", "w", F.explode(starts).alias("at"))
    part = F.slice("w", F.col("at"), length)
    return cut.select(
        F.array_join(part, " ").alias("window"), F.size(part).alias("length"), "item_id"
    ).distinct()


@dataclass
class Index:
    """Stored postings of a corpus, for the terms of one test set."""

    postings: DataFrame
    terms: DataFrame
    counts: DataFrame


def build_index(corpus: DataFrame, tests: DataFrame, store: Stored) -> Index:
    """Postings of all occurrences of the windows' terms in ``corpus`` (column text)."""
    terms = tests.select(F.explode(F.array_distinct(F.split("window", " "))).alias("term")).distinct()
    terms = store.put("terms", terms.select("term", F.monotonically_increasing_id().alias("term_id")))
    many = terms.count() > MOST_SENT
    ended = terms.unionByName(
        terms.sparkSession.range(1).select(F.lit("").alias("term"), F.lit(END).cast("long").alias("term_id"))
    )
    # A closing space makes the last part empty: it stands for the end of the text.
    text = F.coalesce("text", F.lit(""))
    parts = F.split(F.concat(text, F.lit(" ")), CASED_SEPARATORS, -1)
    ahead = (F.left(text, F.lit(1)).rlike(CASED_SEPARATORS) | (text == "")).cast("int")
    tokens = (
        corpus.select(text_key(F.col("text")).alias("key"), (-ahead).alias("from"), parts.alias("parts"))
        # The array is never empty; an inner generator would split every text again to test that.
        .select("key", "from", F.posexplode_outer("parts").alias("at", "word"))
        .select("key", (F.col("at") + F.col("from")).alias("pos"), "word")
        .filter("pos >= 0")
    )
    sought = ended.select("term_id", "term", F.lower("term").alias("lowered"))
    # Beyond A-Z, lower() changes more than the operator's words do; few words need the second look.
    same = (F.col("word") == F.col("term")) | (F.translate("word", UPPER, LOWER) == F.col("term"))
    postings = store.put(
        "postings",
        tokens.join(
            sought if many else F.broadcast(sought), (F.lower("word") == F.col("lowered")) & same
        ).select("term_id", "key", "pos"),
    )
    counts = store.put("counts", postings.groupBy("term_id").count())
    return Index(postings, terms, counts)


def _ranked(index: Index, tests: DataFrame) -> DataFrame:
    """(window, length, offset, term_id, rank): terms from rarest to most common.

    A window with a term that the corpus lacks is left out: it cannot match.
    """
    own = tests.select("window", "length").distinct()
    placed = own.select("window", "length", F.posexplode(F.split("window", " ")).alias("offset", "term"))
    counted = placed.join(index.terms, "term").join(index.counts, "term_id")
    by_window = Window.partitionBy("window")
    rarest = by_window.orderBy("count", "offset")
    return counted.select(
        "window",
        "length",
        "offset",
        "term_id",
        F.row_number().over(rarest).alias("rank"),
        F.count(F.lit(1)).over(by_window).alias("known"),
    ).filter(F.col("known") == F.col("length"))


def phrase_matches(index: Index, tests: DataFrame, corpus: DataFrame, store: Stored) -> DataFrame:
    """(key, matches): the places (start, length, window) of every window in each text."""
    rare = store.put("rare", _ranked(index, tests).filter(F.col("rank") <= RAREST))
    sent = rare.count() <= MOST_SENT
    starts = (
        index.postings.join(F.broadcast(rare) if sent else rare.hint("merge"), "term_id")
        .select("key", "window", "length", (F.col("pos") - F.col("offset")).alias("start"), "rank")
        .filter(F.col("start") >= 0)
    )
    both = (
        starts.groupBy("key", "window", "length", "start")
        .agg(F.bit_or(F.expr("shiftleft(1, rank - 1)")).alias("lists"))
        .filter(F.col("lists") == F.when(F.col("length") < RAREST, 1).otherwise(2**RAREST - 1))
    )
    candidates = store.put(
        "candidates",
        both.groupBy("key").agg(F.collect_list(F.struct("start", "length", "window")).alias("found")),
    )
    texts = corpus.select(text_key(F.col("text")).alias("key"), "text")
    # The one-element explode keeps the words from being made again for every candidate.
    read = texts.join(candidates.hint("merge"), "key").select(
        "key", "found", F.explode(F.array(words(F.col("text")))).alias("w")
    )

    def stands(m: Column) -> Column:
        there = F.slice("w", m["start"] + 1, m["length"])
        return F.array_join(there, " ") == m["window"]

    exact = read.select("key", F.filter("found", stands).alias("matches"))
    return exact.filter(F.size("matches") > 0).groupBy("key").agg(F.first("matches").alias("matches"))


def proximity_matches(index: Index, tests: DataFrame, span: int) -> DataFrame:
    """(key, window, at): texts with all of a window's terms within ``span`` words of ``at``.

    ``at`` is a place of the window's rarest term. Positions are cut into blocks
    of ``span`` words, so that each list meets only the blocks beside its own.
    """
    ranked = _ranked(index, tests)
    first = ranked.filter(F.col("rank") == 1).select("window", "term_id")
    rest = ranked.select("window", "term_id").distinct()
    needed = rest.groupBy("window").agg(F.count(F.lit(1)).alias("needed"))
    block = F.floor(F.col("pos") / span)
    seeds = index.postings.join(first, "term_id").select(
        "key",
        "window",
        F.col("pos").alias("at"),
        F.explode(F.array(block - 1, block, block + 1)).alias("block"),
    )
    others = index.postings.join(rest, "term_id").select(
        "key", "window", "term_id", "pos", block.alias("block")
    )
    near = seeds.join(others, ["key", "window", "block"]).filter(
        F.abs(F.col("pos") - F.col("at")) < span
    )
    met = near.groupBy("key", "window", "at").agg(F.count_distinct("term_id").alias("met"))
    return met.join(needed, "window").filter(F.col("met") == F.col("needed")).select("key", "window", "at")


def contamination(corpus: DataFrame, items: DataFrame, length: int = 13, share: int = 20) -> DataFrame:
    """All columns of ``corpus`` with n_words, n_hit, items (sorted) and contaminated.

    A text is contaminated if ``share`` times its hit words reach its words.
    Columns of these names that the input already has are replaced.
    """
    store = Stored(corpus.sparkSession)
    tests = store.put("windows", windows(items, length))
    index = build_index(corpus, tests, store)
    matches = store.put("matches", phrase_matches(index, tests, corpus, store))
    store.drop("candidates", "rare")
    covered = F.flatten(
        F.transform("matches", lambda m: F.sequence(m["start"], m["start"] + m["length"] - 1))
    )
    hits = matches.select("key", F.size(F.array_distinct(covered)).cast("long").alias("n_hit"))
    found = matches.select(
        "key", F.explode(F.array_distinct(F.col("matches.window"))).alias("window")
    ).join(tests, "window")
    listed = found.groupBy("key").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    totals = (
        index.postings.filter(F.col("term_id") == END)
        .groupBy("key")
        .agg(F.min("pos").cast("long").alias("n_words"))
    )
    facts = totals.join(hits, "key", "left").join(listed, "key", "left")
    made = ("n_words", "n_hit", "items", "contaminated")
    kept = [c for c in corpus.columns if c.lower() not in made]
    rows = corpus.select(*kept, text_key(F.col("text")).alias("__key"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    joined = rows.join(facts.withColumnRenamed("key", "__key"), "__key", "left")
    return joined.select(
        *kept,
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def sql(length: int = 13) -> str:
    """DuckDB SQL of the registered query, with unique document ids."""
    lowered = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    listed = f"list_filter(string_split_regex({lowered}, '{SEPARATORS}'), lambda w: w <> '')"
    return f"""
WITH d AS (SELECT doc_id, {listed} AS w FROM documents),
b AS (SELECT item_id, {listed} AS w FROM benchmark),
wins AS (SELECT DISTINCT item_id, array_to_string(w[k:k + {length - 1}], ' ') AS win,
      least(len(w), {length}) AS n
   FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - {length - 1}) + 1)) AS k FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM wins),
grams AS (SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS win
   FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, k, wins.n AS n, item_id FROM grams JOIN wins ON grams.win = wins.win),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM
   (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM
   (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
   coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
   coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN places ON d.doc_id = places.doc_id LEFT JOIN found ON d.doc_id = found.doc_id"""
