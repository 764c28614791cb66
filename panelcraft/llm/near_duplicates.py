"""Near duplicates by circulant MinHash, banding and exact verification.

A text's set holds 64-bit hashes of its five-word shingles. Signatures need two
permutations of a space of 2**32 values: the first scatters the set once, the
second is used for every coordinate, shifted circularly by the coordinate's
number. Coordinates are banded, and texts that share a band are candidates.

How links are found without comparing all pairs of a group:

1. Texts with equal sets become one node.
2. In every bucket each node is compared with the bucket's first node only.
   Confirmed links give components; a group of copies collapses here.
3. Buckets that still hold several components compare their nodes with a few
   drawn by hash, which joins most of what belongs together.
4. In buckets that are still open, the nodes outside the bucket's largest
   component are compared with all nodes of other components. Where these would
   be more than ``DIRECT`` pairs, as when thousands of texts share a passage, a
   pair must also share one of its rarest shingles, and from the first shared
   one on enough shingles must be left to reach the threshold. Sets over the
   threshold always pass (prefix and position filter); texts that only share a
   passage, or have too many words of their own, do not.

Every link is confirmed on the full sets. A pair at a similarity of exactly
0.75 shares no band with probability 1e-6, so results are those of an
exhaustive search but for that chance.

Defined cases: a null or wordless text has an empty set and is its own
component; a text with fewer words than a shingle has one shingle. Repeated
rows have equal sets. A null id never names a component unless all ids of the
component are null; ``kept`` compares ids null-safely.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcraft.llm.common import Stored, let_go, map_rows

WORDS = 5
SIMILAR = 75  # of 100
BANDS, ROWS = 36, 4
#: Nodes per open bucket that all its nodes are compared with before cross pairs are taken.
DRAWN = 4
#: Pairs of a bucket that are compared without a look at their rarest shingles.
DIRECT = 1_024
#: Shingles whose coordinates are computed at once.
CHUNK = 4_096


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a whole text, A-Z lowered."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    line = b" ".join(found)
    if len(found) < words:
        return np.array([xxhash.xxh3_64_intdigest(line)], np.uint64)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(found) - words + 1].tolist()
    digest = xxhash.xxh3_64_intdigest
    hashes = [digest(line[s:e]) for s, e in zip(starts, ends[words - 1 :].tolist(), strict=True)]
    return np.unique(np.array(hashes, np.uint64))


def _scatter(x: np.ndarray, first: int, second: int) -> np.ndarray:
    """A permutation of the 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(first)
    x ^= x >> np.uint32(13)
    x *= np.uint32(second)
    x ^= x >> np.uint32(16)
    return x


def signature(hashes: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    """``size`` coordinates: minima of one permutation under circular shifts."""
    scattered = _scatter(hashes.astype(np.uint32), 0x7FEB352D, 0x846CA68B)
    shifts = np.arange(1, size + 1, dtype=np.uint32)[:, None]
    least = np.full(size, np.uint32(0xFFFFFFFF))
    for at in range(0, len(scattered), CHUNK):
        shifted = scattered[None, at : at + CHUNK] - shifts
        np.minimum(least, _scatter(shifted, 0x85EBCA6B, 0xC2B2AE35).min(axis=1), out=least)
    return least


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, different for different bands."""
    rows = coordinates.reshape(BANDS, ROWS).astype(np.uint64)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(ROWS):
        keys = (keys ^ rows[:, k]) * np.uint64(0xFF51AFD7ED558CCD)
        keys ^= keys >> np.uint64(29)
    return keys.astype(np.int64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= SIMILAR * (len(a) + len(b) - common) > 0


def _signed(texts: list[str | None]) -> Iterator[tuple]:
    let_go()
    for text in texts:
        hashes = shingle_set(text)
        if len(hashes):
            node = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
            yield len(hashes), node, band_keys(signature(hashes)).tolist()
        else:
            yield 0, None, []


def _confirm(lefts: list[str], rights: list[str]) -> Iterator[tuple]:
    """Whether the texts of each pair are similar; rows come in runs of equal right texts."""
    let_go()
    last, own = None, None
    for left, right in zip(lefts, rights, strict=True):
        if right is not last and right != last:
            last, own = right, shingle_set(right)
        yield (similar(shingle_set(left), own),)


def _may_be_similar(a: Column, b: Column) -> Column:
    """Sets of such sizes can reach the threshold."""
    return 100 * F.least(a, b) >= SIMILAR * F.greatest(a, b)


class _Search:
    """The stored tables of one search and the steps over them."""

    def __init__(self, docs: DataFrame):
        self.store = Stored(docs.sparkSession)
        key = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("text_key")
        rows = docs.select("doc_id", "text", key)
        self.rows = self.store.put(
            "signed",
            map_rows(
                rows, ["doc_id", "text_key"], ["text"], _signed,
                "n_shingles long, node binary, bands array<long>",
            ),
        )
        nodes = (
            self.rows.filter(F.col("node").isNotNull())
            .groupBy("node")
            .agg(
                F.min("doc_id").alias("least_id"),
                F.min(F.struct("doc_id", "text_key")).alias("at"),
                F.first("n_shingles").alias("n"),
                F.first("bands").alias("bands"),
            )
        )
        # Stored once, so the numbers given here hold for all later reads.
        self.nodes = self.store.put(
            "nodes", nodes.withColumn("nid", F.monotonically_increasing_id())
        )
        members = self.nodes.select("nid", "n", F.posexplode("bands").alias("band", "key"))
        buckets = self.store.put("buckets", _buckets(members))
        self.shared = self.store.put("shared", members.join(buckets.hint("merge"), "key"))
        self.store.drop("buckets")
        wanted = self.shared.select("nid").distinct().join(self.nodes.hint("merge"), "nid")
        wanted = wanted.select("nid", "at.*")
        self.texts = self.store.put(
            "texts",
            rows.withColumn("id", F.hash("doc_id"))
            .join(
                wanted.withColumn("id", F.hash("doc_id")).drop("doc_id").hint("merge"), ["text_key", "id"]
            )
            .select("nid", "text"),
        )

    def confirmed(self, name: str, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose texts are similar, by their whole texts."""
        a = self.texts.select(F.col("nid").alias("a"), F.col("text").alias("left"))
        b = self.texts.select(F.col("nid").alias("b"), F.col("text").alias("right"))
        found = map_rows(
            pairs.join(a.hint("merge"), "a").join(b.hint("merge"), "b"), ["a", "b"], ["left", "right"], _confirm, "ok boolean"
        )
        return self.store.put(name, found.filter("ok").select("a", "b").distinct())

    def leader_pairs(self) -> DataFrame:
        """Each node with the first node of each of its buckets."""
        leaders = self.nodes.select(F.col("nid").alias("leader"), F.col("n").alias("m"))
        pairs = self.shared.filter("nid <> leader").select("nid", "n", "leader").distinct()
        return (
            pairs.join(leaders.hint("merge"), "leader")
            .filter(_may_be_similar(F.col("n"), F.col("m")))
            .select(F.col("nid").alias("a"), F.col("leader").alias("b"))
        )

    def drawn_pairs(self, roots: DataFrame) -> DataFrame:
        """Nodes of open buckets with ``DRAWN`` nodes of other components, drawn by hash."""
        own = self._rooted(self.shared, roots)
        order = [F.xxhash64("key", "nid", F.lit(k)) for k in range(DRAWN)]
        drawn = (
            own.groupBy("key")
            .agg(
                F.min("root").alias("low"),
                F.max("root").alias("high"),
                *[F.min_by("nid", o).alias(f"d{k}") for k, o in enumerate(order)],
            )
            .filter("low <> high")
            .select("key", F.array(*[f"d{k}" for k in range(DRAWN)]).alias("drawn"))
        )
        pairs = (
            own.join(drawn.hint("merge"), "key")
            .select("nid", "n", "root", F.explode("drawn").alias("other"))
            .filter("nid <> other")
            .distinct()
        )
        others = self._rooted(self.nodes, roots).select(
            F.col("nid").alias("other"), F.col("n").alias("m"), F.col("root").alias("far")
        )
        return (
            pairs.join(others.hint("merge"), "other")
            .filter((F.col("root") != F.col("far")) & _may_be_similar(F.col("n"), F.col("m")))
            .select(F.least("nid", "other").alias("a"), F.greatest("nid", "other").alias("b"))
            .distinct()
        )

    def _rooted(self, members: DataFrame, roots: DataFrame) -> DataFrame:
        joined = members.join(roots.hint("merge"), "nid", "left")
        return joined.withColumn("root", F.coalesce("root", "nid"))

    def cross_pairs(self, roots: DataFrame) -> DataFrame:
        """Pairs of a bucket that lie in different components."""
        shared = self.shared.select("key", "nid", "n", F.lit(0).alias("pos"))
        open_ = self.store.put("open", _with_main(self._rooted(shared, roots)))
        direct = _across(open_.filter(f"others * size <= {DIRECT}"))
        crowded = self.store.put(
            "crowded", open_.filter(f"others * size > {DIRECT}").select("nid").distinct()
        )
        if crowded.isEmpty():
            return direct.distinct()
        sets = map_rows(
            self.texts.join(crowded.hint("merge"), "nid", "left_semi"),
            ["nid"],
            ["text"],
            lambda texts: [(shingle_set(t).view(np.int64).tolist(),) for t in texts],
            "hashes array<long>",
        )
        every = self.store.put(
            "shingles", sets.select("nid", F.explode("hashes").alias("key"))
        ).distinct()
        often = self.store.put("often", every.groupBy("key").count().filter("count > 1"))
        # Shingles of one set only come first in the order; they need no join to be counted.
        ranked = every.join(often.hint("merge"), "key").groupBy("nid").agg(
            F.sort_array(F.collect_list(F.struct("count", "key"))).alias("s")
        )
        alone = F.col("n") - F.size("s")
        most = F.col("n") - F.ceil(F.col("n") * SIMILAR / 100.0).cast("int") + 1
        sizes = self.nodes.select("nid", "n").hint("merge")
        rare = ranked.join(sizes, "nid").select(
            "nid",
            "n",
            alone.alias("alone"),
            F.posexplode(F.slice("s", F.lit(1), F.greatest(F.lit(0), most - alone))).alias("at", "x"),
        )
        rare = rare.select("nid", "n", F.col("x.key").alias("key"), (F.col("alone") + F.col("at")).alias("pos"))
        placed = self.store.put("rare", self._rooted(rare, roots))
        return direct.unionByName(_across(_with_main(placed))).distinct()


def _buckets(members: DataFrame) -> DataFrame:
    """Keys that two or more nodes share, with the first node."""
    found = members.groupBy("key").agg(F.min("nid").alias("leader"), F.max("nid").alias("last"))
    return found.filter("leader <> last").select("key", "leader")


def _with_main(members: DataFrame) -> DataFrame:
    """Members of keys with several components, with the largest of them and the key's counts."""
    state = (
        members.groupBy("key", "root")
        .agg(F.count("nid").alias("c"))
        .groupBy("key")
        .agg(
            F.max_by("root", "c").alias("main"),
            F.sum("c").alias("size"),
            (F.sum("c") - F.max("c")).alias("others"),
        )
        .filter("others > 0")
    )
    return members.join(state.hint("merge"), "key")


def _across(members: DataFrame) -> DataFrame:
    """Pairs (smaller, larger) of nodes outside a key's main component with all others.

    ``pos`` is the number of a set's shingles that come before the key; if the
    key is the first shared one, only what follows it can be shared.
    """
    columns = ("nid", "n", "root", "pos")
    left = members.filter("root <> main").select("key", *[F.col(c).alias(f"{c}_a") for c in columns])
    right = members.select("key", *[F.col(c).alias(f"{c}_b") for c in columns])
    rest = F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b"))
    reachable = (100 + SIMILAR) * rest >= SIMILAR * (F.col("n_a") + F.col("n_b"))
    return (
        left.join(right.hint("merge"), "key")
        .filter((F.col("root_a") != F.col("root_b")) & reachable)
        .select(F.least("nid_a", "nid_b").alias("a"), F.greatest("nid_a", "nid_b").alias("b"))
    )


def components(store: Stored, links: DataFrame, name: str) -> DataFrame:
    """(nid, root) of every linked node: its component's smallest node.

    Alternates two star steps: neighbours above a node move to its smallest
    neighbour, then neighbours below it do. Both are joins and minima per node;
    each round is stored, and rounds grow with the logarithm of the longest path.
    """
    edges = store.put(
        f"{name}0", links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    mark, k = None, 0
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least.hint("merge"), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low.hint("merge"), "u").select(
            F.explode(
                F.array(
                    F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                )
            ).alias("e")
        )
        k += 1
        edges = store.put(f"{name}{k}", small.select("e.*").filter("u <> v").distinct())
        store.drop(f"{name}{k - 1}")
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == mark:
            return edges.select(F.col("u").alias("nid"), F.col("v").alias("root"))
        mark = now


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``."""
    search = _Search(docs)
    store = search.store
    links = search.confirmed("links", search.leader_pairs())
    roots = components(store, links, "first")
    for name, pairs in (("drawn", search.drawn_pairs), ("crossed", search.cross_pairs)):
        more = search.confirmed(name, pairs(roots))
        if not more.isEmpty():
            known = roots.select(F.col("nid").alias("a"), F.col("root").alias("b"))
            roots = components(store, known.unionByName(more), f"{name}_roots")
    store.drop(*"shared texts links drawn crossed open crowded shingles often rare".split())
    rooted = search.nodes.select("node", "nid", "least_id").join(roots.hint("merge"), "nid", "left")
    rooted = rooted.select("node", "least_id", F.coalesce("root", "nid").alias("root"))
    names = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    placed = rooted.join(names.hint("merge"), "root").select("node", "component_id")
    own = search.rows.select("doc_id", "n_shingles", "node").join(placed.hint("merge"), "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return own.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def sql() -> str:
    """DuckDB SQL of the registered query, with unique document ids."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    listed = (
        f"list_filter(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), "
        r"'[\x20\x09-\x0D]+'), lambda w: w <> '')"
    )
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, {listed} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, hash(array_to_string(w[k:k + {WORDS - 1}], ' ')) AS h
   FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - {WORDS - 1}) + 1)) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
      FROM s x JOIN s y ON x.h = y.h AND x.doc_id <> y.doc_id GROUP BY ALL) p
   JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b
   WHERE 100 * c >= {SIMILAR} * (na.n + nb.n - c)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM d
   UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(other) AS component_id,
   d.doc_id = min(other) AS kept
FROM d JOIN reach ON reach.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id"""
