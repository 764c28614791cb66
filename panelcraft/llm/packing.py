"""Best-fit packing by length patterns.

Documents become token pieces of at most ``size`` tokens. Their lengths form a
histogram with at most ``size`` entries, whatever the number of documents. On
it the driver

1. enumerates patterns of up to three length bins that fill a sequence,
2. fits repeat counts to the histogram by non-negative least squares,
3. rounds them down and turns each into patterns of exact lengths,
4. packs the residual lengths, longest first, into the gap that they fit best.

Pieces then find their place by their rank among the pieces of their length,
which is counted in salted groups, so a length that a third of all pieces have
is no single task.

Defined cases: a null or empty text is the end mark alone (one token); repeated
rows are packed each on their own; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import itertools
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcraft.llm.common import Stored, held_alone, map_rows

SIZE = 2048
END_ID = 0
#: Width of the bins in which patterns are fitted.
BIN = 8
#: Tokens that a fitted pattern may leave empty; sequences with more are packed as residuals.
WASTE = 0
#: Pieces per salt group when ranks within a length are counted.
PER_SALT = 100_000
LEAST_SALTS = 64


# Tokens.


class CachedTokenizer:
    """Ids of a word-level BPE, remembering the ids of up to ``most`` different words.

    Texts whose characters all lie below U+0250 are lowered and cut into words
    here; such characters are unchanged by the vocabulary's Unicode
    normalisation. Any other text, and any that names one of the vocabulary's
    added tokens (as ``<|endoftext|>``), goes through the tokenizer as a whole.
    """

    #: End of the plain characters, which are unchanged by the vocabulary's normalisation.
    PLAIN = 0x250

    def __init__(self, path: str, most: int = 400_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        kinds = [unicodedata.category(chr(c))[0] for c in range(self.PLAIN)]
        letter, digit = ("".join(chr(c) for c, k in enumerate(kinds) if k == kind) for kind in "LN")
        self.plain = re.compile(f"[\t-\r -~\xa1-{chr(self.PLAIN - 1)}]*")
        # The vocabulary's own pattern of words, with its classes spelt out over the plain characters.
        self.word = re.compile(rf"'(?:[stmd]|re|ve|ll)|[{letter}]+|[{digit}]|[^\s{letter}{digit}]+")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.most, self.known = most, {}

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in made]

    def _learn(self, words: set[str]) -> None:
        """Ids of new words, encoded as one line; each word ends at its first word-end token."""
        listed = sorted(words)
        ids = self._whole([" ".join(listed)])[0]
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) == len(listed):
            raw, starts = ids.tobytes(), np.concatenate([[0], cuts[:-1]])
            places = zip(listed, (starts * 4).tolist(), (cuts * 4).tolist(), strict=True)
            self.known.update((w, raw[s:e]) for w, s, e in places)
        else:
            made = self._whole(listed)
            self.known.update((w, ids.tobytes()) for w, ids in zip(listed, made, strict=True))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        cut, odd = {}, []
        for k, text in enumerate(texts):
            lower = text.lower()
            named = any(token in lower for token in self.added)
            if not named and "İ" not in text and self.plain.fullmatch(text):
                cut[k] = self.word.findall(lower)
            else:
                odd.append(k)
        for k, ids in zip(odd, self._whole([texts[k] for k in odd]), strict=True):
            out[k] = ids
        wanted = set(itertools.chain.from_iterable(cut.values()))
        new = wanted.difference(self.known)
        if len(self.known) + len(new) > self.most:
            self.known.clear()
            new = wanted
        if new:
            self._learn(new)
        for k, words in cut.items():
            out[k] = np.frombuffer(b"".join(map(self.known.__getitem__, words)), np.uint32)
        return out


@held_alone
def tokenizer(path: str) -> CachedTokenizer:
    return CachedTokenizer(path)


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def pieces(docs: DataFrame, path: str | None = None, size: int = SIZE) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document, ending in the end mark."""
    path = path or vocabulary()

    def cut(texts: list[str | None]) -> Iterator[tuple]:
        for ids in tokenizer(path).encode([t or "" for t in texts]):
            ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
            starts = range(0, len(ids), size)
            yield ([
                {
                    "piece": k,
                    "start": s,
                    "length": min(size, len(ids) - s),
                    "ids_crc32": zlib.crc32(ids[s : s + size].tobytes()),
                }
                for k, s in enumerate(starts)
            ],)

    schema = "parts array<struct<piece:int,start:long,length:long,ids_crc32:long>>"
    made = map_rows(docs, ["doc_id"], ["text"], cut, schema)
    return made.select("doc_id", F.explode("parts").alias("p")).select("doc_id", "p.*")


# Patterns on the histogram.


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 1_000) -> np.ndarray:
    """x >= 0 that makes |a x - b| least: columns enter by gradient and leave at zero."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    for _ in range(rounds):
        slope = a.T @ (b - a @ x)
        slope[active] = -np.inf
        k = int(np.argmax(slope))
        if slope[k] <= 1e-7 * max(1.0, float(np.abs(b).max())):
            break
        active[k] = True
        while True:
            chosen = np.flatnonzero(active)
            own = a[:, chosen]
            gram = own.T @ own
            gram[np.diag_indices_from(gram)] += 1e-9
            fitted = np.linalg.solve(gram, own.T @ b)
            low = fitted <= 1e-9
            if not low.any():
                x[chosen] = fitted
                break
            now = x[chosen]
            step = float(np.min(now[low] / np.maximum(now[low] - fitted[low], 1e-12)))
            now = now + step * (fitted - now)
            gone = low & (now <= 1e-9)
            gone = gone if gone.any() else low
            x[chosen] = np.where(gone, 0.0, now)
            active[chosen[gone]] = False
    return x

def bin_patterns(present: list[int], full: int) -> list[tuple[int, ...]]:
    """Multisets of one to three present bins that add up to ``full``."""
    there = set(present)
    found = [(full,)] if full in there else []
    found += [(a, full - a) for a in present if a >= full - a and full - a in there]
    for a in present:
        for b in present:
            c = full - a - b
            if a >= b >= c > 0 and c in there:
                found.append((a, b, c))
    return found


Group = tuple[tuple[int, ...], int]


def pattern_groups(histogram: dict[int, int], size: int = SIZE, width: int = BIN) -> list[Group]:
    """(lengths of a sequence, number of such sequences) that hold the whole histogram."""
    left = {length: n for length, n in histogram.items() if n and length < size}
    by_bin: dict[int, list[int]] = {}
    for length in sorted(left):
        by_bin.setdefault(-(-length // width), []).append(length)
    groups: list[Group] = [((size,), histogram[size])] if histogram.get(size) else []
    bins = sorted(by_bin)
    patterns = bin_patterns(bins, size // width)
    if patterns:
        place = {b: i for i, b in enumerate(bins)}
        a = np.zeros((len(bins), len(patterns)))
        for j, p in enumerate(patterns):
            for b in p:
                a[place[b], j] += 1
        h = np.array([sum(left[length] for length in by_bin[b]) for b in bins], float)
        repeats = np.floor(nnls(a, h) + 1e-9).astype(int)
        for j in np.argsort(-repeats, kind="stable"):
            groups += _exact(patterns[j], int(repeats[j]), by_bin, left, size, width)
    return _fill(groups, {length: n for length, n in left.items() if n}, size)


def _exact(
    pattern: tuple[int, ...],
    repeats: int,
    by_bin: dict[int, list[int]],
    left: dict[int, int],
    size: int,
    width: int,
) -> list[Group]:
    """Patterns of exact lengths for ``repeats`` sequences, as long as lengths are left.

    All members but the last come from their bins, longest first; the last is
    the longest one left that fits beside them, from its bin or the one above.
    """
    groups: list[Group] = []
    last = sorted({*by_bin[pattern[-1]], *by_bin.get(pattern[-1] + 1, ())}, reverse=True)
    while repeats > 0:
        members: list[int] = []
        for b in pattern[:-1]:
            free = (x for x in reversed(by_bin[b]) if left[x] > members.count(x))
            members.append(next(free, 0))
        gap = size - sum(members)
        members.append(next((x for x in last if x <= gap and left[x] > members.count(x)), 0))
        if not all(members) or size - sum(members) > WASTE:
            break
        k = min(repeats, *(left[x] // members.count(x) for x in set(members)))
        for x in members:
            left[x] -= k
        groups.append((tuple(members), k))
        repeats -= k
    return groups

def _fill(groups: list[Group], rest: dict[int, int], size: int) -> list[Group]:
    """Best fit, longest first: residual lengths go to the smallest gap that holds them."""
    by_gap: dict[int, list[Group]] = {}
    for group in groups:
        by_gap.setdefault(size - sum(group[0]), []).append(group)
    gaps = sorted(by_gap)

    def put(group: Group) -> None:
        gap = size - sum(group[0])
        if gap not in by_gap:
            by_gap[gap] = []
            bisect.insort(gaps, gap)
        by_gap[gap].append(group)

    for length in sorted(rest, reverse=True):
        n = rest[length]
        while n:
            at = bisect.bisect_left(gaps, length)
            if at == len(gaps):
                held = size // length
                if n >= held:
                    put(((length,) * held, n // held))
                if n % held:
                    put(((length,) * (n % held), 1))
                break
            gap = gaps[at]
            members, count = by_gap[gap].pop()
            if not by_gap[gap]:
                del by_gap[gap], gaps[at]
            k = min(n, count)
            put((members + (length,), k))
            if count > k:
                put((members, count - k))
            n -= k
    return [g for gap in sorted(by_gap) for g in by_gap[gap]]


def slots(groups: list[Group]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset): where ranks of a length go."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for members, count in groups:
        offset = 0
        for length in members:
            first = used.get(length, 0)
            used[length] = first + count
            out.append((length, first, first + count, sequence, offset))
            offset += length
        sequence += count
    return out


# Places of the pieces.


def pack(docs: DataFrame, path: str | None = None, size: int = SIZE) -> DataFrame:
    """Every piece with its sequence_id and its offset there."""
    spark = docs.sparkSession
    store = Stored(spark)
    cut = store.put("pieces", pieces(docs, path, size))
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    made = slots(pattern_groups(histogram, size))
    total = sum(histogram.values())
    salts = max(LEAST_SALTS, total // PER_SALT)
    key = F.xxhash64("doc_id", "piece", "start", "ids_crc32")
    salted = cut.withColumn("salt", F.pmod(key, F.lit(salts)))
    by_salt = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        salted.groupBy("length", "salt")
        .count()
        .select("length", "salt", F.coalesce(F.sum("count").over(by_salt), F.lit(0)).alias("before"))
    )
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (
        salted.withColumn("own", F.row_number().over(own) - 1)
        .join(before, ["length", "salt"])
        .withColumn("rank", F.col("before") + F.col("own"))
    )
    places = _slot_frame(spark, made)
    return ranked.join(
        F.broadcast(places),
        (ranked["length"] == places["of"])
        & (ranked["rank"] >= places["first"])
        & (ranked["rank"] < places["end"]),
    ).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"),
        F.col("offset"),
    )


def _slot_frame(spark, made: list[tuple]) -> DataFrame:
    """The slot table; its rows are bounded by the patterns of one histogram, not by documents."""
    names = ["of", "first", "end", "sequence", "offset"]
    columns = [pa.array([m[k] for m in made], pa.int64()) for k in range(5)]
    return spark.createDataFrame(pa.table(columns, names))
