"""Repeated byte strings by sharded suffix arrays.

Every byte is removed that lies in a ``length``-byte string which starts at two
or more places of the corpus. Places are judged on the input; strings never
cross documents.

1. Anchors: of the ``KGRAM``-byte strings inside a ``length``-byte string, the least
   by hash is its anchor (the leftmost of equals). Equal strings have the same
   anchor at the same place, so only anchors that occur twice matter.
2. Contexts: a run of strings with the same anchor is one stretch of bytes; each
   string lies in exactly one. Equal contexts become one with a count before
   bytes are moved.
3. Shards: all contexts of an anchor meet in one shard of a few megabytes. Its
   suffix array is built by induced sorting: suffixes are classified, the
   leftmost-smaller substrings are sorted and named, the string of names is
   sorted recursively, and all suffixes are induced bucket by bucket. Permuted
   common prefixes tell which neighbours agree in ``length`` bytes.
4. What a shard found repeated is joined back to all places of its contexts.

An anchor with more than ``most`` different contexts (frequent words in ever
new surroundings) does not go into one shard: its strings are counted one by
one by a group-by, which splits it over all tasks and gives the same answer.

Defined cases: a null text is empty; texts shorter than ``length`` bytes keep
everything; repeated rows are places of their own, so equal texts of ``length``
bytes or more lose all bytes.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcraft.llm.common import Stored, map_rows

LENGTH = 200
KGRAM = 32
#: Different contexts of one anchor that may share a shard.
MOST_CONTEXTS = 8_192
#: Bytes after which a shard is closed at the next anchor.
SHARD_BYTES = 2_000_000
#: Bytes of a document whose anchors are found at once.
CHUNK = 4_000_000
#: Alphabets up to this size are induced bucket by bucket; larger ones are sorted by doubling.
FEW_BUCKETS = 4_096


# Suffix arrays by induced sorting.


def _is_small(t: np.ndarray) -> np.ndarray:
    """True where a suffix is less than the next one (type S); the last is."""
    n = len(t)
    change = np.where(t[1:] != t[:-1], np.arange(n - 1), n)
    at = np.minimum.accumulate(change[::-1])[::-1]
    small = np.ones(n, bool)
    small[:-1] = t[np.minimum(at + 1, n - 1)] > t[:-1]
    return small


def _scatter_forward(sa: np.ndarray, pointer: np.ndarray, t: np.ndarray, new: np.ndarray) -> None:
    """Append suffixes to the fronts of their buckets, in order."""
    chars = t[new]
    order = np.argsort(chars, kind="stable")
    chars = chars[order]
    counts = np.bincount(chars, minlength=len(pointer))
    first = np.cumsum(counts) - counts
    sa[pointer[chars] + np.arange(len(new)) - first[chars]] = new[order]
    pointer += counts


def _scatter_backward(sa: np.ndarray, pointer: np.ndarray, t: np.ndarray, new: np.ndarray) -> None:
    """Append suffixes to the backs of their buckets, from the end inwards."""
    chars = t[new]
    order = np.argsort(chars, kind="stable")
    chars = chars[order]
    counts = np.bincount(chars, minlength=len(pointer))
    first = np.cumsum(counts) - counts
    sa[pointer[chars] - 1 - np.arange(len(new)) + first[chars]] = new[order]
    pointer -= counts


def _induce(t: np.ndarray, small: np.ndarray, lms: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The suffix array from leftmost-smaller suffixes that are in order within their buckets.

    A bucket is worked off in waves: what it adds to itself is the next wave, what
    it adds to other buckets is handed over once, in the order of the scan.
    """
    sa = np.full(len(t), -1, np.int64)
    ends = np.cumsum(counts)
    heads = ends - counts
    own = t[lms]
    lms = lms[np.argsort(own, kind="stable")]
    lms_counts = np.bincount(own, minlength=len(counts))
    lms_ends = np.cumsum(lms_counts)
    present = np.flatnonzero(counts)
    front = heads.copy()
    for c in present:
        done, out = heads[c], []
        while done < front[c]:
            before = sa[done : front[c]] - 1
            done = front[c]
            before = before[before >= 0]
            before = before[~small[before]]
            same = t[before] == c
            if same.any():
                again = before[same]
                sa[front[c] : front[c] + len(again)] = again
                front[c] += len(again)
                before = before[~same]
            out.append(before)
        before = lms[lms_ends[c] - lms_counts[c] : lms_ends[c]] - 1
        out.append(before[before >= 0])
        new = np.concatenate(out)
        if len(new):
            _scatter_forward(sa, front, t, new)
    back = ends.copy()
    sa[0] = len(t) - 1
    back[0] = 0
    for c in present[::-1]:
        done, out = ends[c], []
        while back[c] < done:
            before = sa[back[c] : done][::-1] - 1
            done = back[c]
            before = before[before >= 0]
            before = before[small[before]]
            same = t[before] == c
            if same.any():
                again = before[same]
                sa[back[c] - len(again) : back[c]] = again[::-1]
                back[c] -= len(again)
                before = before[~same]
            out.append(before)
        before = sa[heads[c] : front[c]][::-1] - 1
        before = before[before >= 0]
        out.append(before[small[before]])
        new = np.concatenate(out)
        if len(new):
            _scatter_backward(sa, back, t, new)
    return sa


def _names(t: np.ndarray, ordered: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Names, in text order, of leftmost-smaller substrings given in sorted order."""
    sizes = np.zeros(len(t), np.int64)
    sizes[lms[:-1]] = np.diff(lms) + 1
    sizes[lms[-1]] = 1
    a, b = ordered[:-1], ordered[1:]
    differ = sizes[a] != sizes[b]
    left = np.flatnonzero(~differ)
    k = 0
    while len(left):
        left = left[sizes[a[left]] > k]
        other = t[a[left] + k] != t[b[left] + k]
        differ[left[other]] = True
        left = left[~other]
        k += 1
    named = np.zeros(len(t), np.int64)
    named[ordered] = np.concatenate([[0], np.cumsum(differ)])
    return named[lms]


def _by_doubling(s: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Order of the suffixes of a string with a large alphabet: ranks of ever longer prefixes.

    With ``depth`` suffixes that agree in so many letters may stay in any order.
    """
    rank, step = s.astype(np.int64), 1
    while True:
        order = np.argsort(rank)
        ranked = rank[order]
        fresh = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
        rank = np.empty_like(fresh)
        rank[order] = fresh
        if fresh[-1] == len(s) - 1 or (depth is not None and step >= depth):
            return order
        after = np.zeros(len(s), np.int64)
        after[:-step] = rank[step:] + 1
        rank = rank * (fresh[-1] + 2) + after
        step *= 2


def suffix_array(t: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Sorted suffixes of ``t``, whose last value must be 0 and the only 0.

    With ``depth`` suffixes that agree in so many values may stay in any order:
    names stand for two values at least, so half as many of them decide.
    """
    if len(t) == 1:
        return np.zeros(1, np.int64)
    small = _is_small(t)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    counts = np.bincount(t)
    if len(lms) > 1:
        first = _induce(t, small, lms, counts)
        is_lms = np.zeros(len(t), bool)
        is_lms[lms] = True
        ordered = first[is_lms[first]]
        names = _names(t, ordered, lms)
        if names.max() + 1 < len(lms):
            deep = suffix_array if names.max() < FEW_BUCKETS else _by_doubling
            ordered = lms[deep(names, None if depth is None else depth // 2 + 1)]
        lms = ordered
    return _induce(t, small, lms, counts)


def plcp(raw: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """Permuted common prefixes: for each place, in text order, that with its predecessor.

    ``places`` are text positions in suffix order; values stop at ``length``
    and are compared eight bytes at a time. The first place has 0.
    """
    padded = np.concatenate([raw, np.zeros(length + 16, np.uint8)])
    size = len(raw) + length + 8
    eights = np.lib.stride_tricks.as_strided(padded, (size, 8), (1, 1))
    words = np.ascontiguousarray(eights).view("<u8").ravel()
    common = np.zeros(len(raw), np.int64)
    a, b = places[:-1], places[1:]
    left, k = np.arange(len(b)), 0
    while len(left) and k < length:
        same = words[a[left] + k] == words[b[left] + k]
        common[b[left[same]]] = min(k + 8, length)
        gone = left[~same]
        tail = words[a[gone] + k] ^ words[b[gone] + k]
        lowest = tail & (~tail + np.uint64(1))
        common[b[gone]] = np.minimum(k + (np.log2(lowest.astype(np.float64)) // 8).astype(np.int64), length)
        left = left[same]
        k += 8
    return np.minimum(common, len(raw) - np.arange(len(raw)))


# Anchors and contexts.


def _kgram_hashes(raw: np.ndarray) -> np.ndarray:
    """64-bit hashes of all KGRAM-byte strings, by joining halves."""
    h = (raw.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    step = 1
    while step < KGRAM:
        low = h[: len(h) - step]
        h = (low ^ (low >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + h[step:] * np.uint64(
            0x94D049BB133111EB
        )
        step *= 2
    return h ^ (h >> np.uint64(31))


def anchors(raw: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, start, size in bytes) of the contexts of one text, in order."""
    hashes, starts, sizes = [], [], []
    width, mask = length - KGRAM + 1, np.uint64(0xFFFFFF)
    for at in range(0, max(0, len(raw) - length + 1), CHUNK):
        part = np.frombuffer(raw, np.uint8, min(CHUNK + length - 1, len(raw) - at), at)
        h = _kgram_hashes(part)
        least = (h * np.uint64(0xD6E8FEB86659FD93)) & ~mask | np.arange(len(h), dtype=np.uint64)
        span = 1
        while 2 * span <= width:
            least = np.minimum(least[: len(least) - span], least[span:])
            span *= 2
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
        places = (least & mask).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(places)) + 1])
        starts.append(first + at)
        sizes.append(np.diff(np.append(first, len(places))) + length - 1)
        hashes.append(h[places[first]])
    if not starts:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts), np.concatenate(sizes)


def _signed(h: np.ndarray) -> list[int]:
    return h.astype(np.uint64).view(np.int64).tolist()


def _anchor_rows(texts: list[str | None], length: int) -> Iterator[tuple]:
    for text in texts:
        raw = (text or "").encode()
        hashes, starts, sizes = anchors(raw, length)
        rows = []
        for h, at, size in zip(_signed(hashes), starts.tolist(), sizes.tolist(), strict=True):
            seen = xxhash.xxh3_64_intdigest(raw[at : at + size])
            rows.append({"h": h, "ctx": seen - (1 << 64) if seen >> 63 else seen, "a": at, "size": size})
        yield (rows,)


def _context_rows(wanted: list, texts: list[str]) -> Iterator[tuple]:
    for rows, text in zip(wanted, texts, strict=True):
        raw = text.encode()
        yield ([
            {"h": r["h"], "ctx": r["ctx"], "n": r["n"], "raw": raw[r["a"] : r["a"] + r["size"]]}
            for r in rows
        ],)


def shard_spans(n: np.ndarray, raws: list[bytes], length: int) -> list[list[dict]]:
    """Per context the spans of strings that occur at two or more places.

    ``n`` is the number of places of each context.
    """
    sizes = np.fromiter(map(len, raws), np.int64, len(raws))
    joined = np.frombuffer(b"\0".join(raws) + b"\0", np.uint8)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    owner = np.repeat(np.arange(len(raws)), sizes + 1)
    t = joined.astype(np.int64) + 2
    t[starts + sizes] = 1
    sa = suffix_array(np.append(t, 0), length)[1:]
    offset = np.arange(len(t)) - starts[owner]
    whole = offset <= sizes[owner] - length
    places = sa[whole[sa]]
    common = plcp(joined, places, length)
    first = np.flatnonzero(common[places] < length)
    total = np.add.reduceat(n[owner[places]], first)
    again = np.repeat(total >= 2, np.diff(np.append(first, len(places))))
    hit = np.sort(places[again])
    out: list[list[dict]] = [[] for _ in raws]
    if not len(hit):
        return out
    new = np.concatenate([[True], (owner[hit[1:]] != owner[hit[:-1]]) | (np.diff(hit) > length)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(hit)) - 1
    for s, e in zip(hit[first].tolist(), hit[last].tolist(), strict=True):
        k = int(owner[s])
        origin = int(starts[k])
        out[k].append({"first": s - origin, "end": e + length - origin})
    return out


_SPANS = "array<struct<first:int,`end`:int>>"


def _sharded(contexts: DataFrame, length: int) -> DataFrame:
    """(h, ctx, spans): suffix arrays over the contexts, whole anchors in each shard."""
    spans_type = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))

    def close(rows: list[tuple]) -> pa.RecordBatch:
        # A context alone with its anchor has nothing to be sorted against: its count decides.
        many = Counter(r[0] for r in rows)
        sorted_ = [r for r in rows if many[r[0]] > 1]
        found = iter(
            shard_spans(np.array([r[2] for r in sorted_]), [r[3] for r in sorted_], length) if sorted_ else ()
        )
        spans = [
            next(found) if many[r[0]] > 1 else [{"first": 0, "end": len(r[3])}] * (r[2] > 1) for r in rows
        ]
        columns = [pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1)]
        columns.append(pa.array(spans, spans_type))
        return pa.RecordBatch.from_arrays(columns, ["h", "ctx", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if rows and row[:2] == rows[-1][:2]:
                    continue  # the same context once more, from a repeated row
                if held > SHARD_BYTES and row[0] != rows[-1][0]:
                    yield close(rows)
                    rows, held = [], 0
                rows.append(row)
                held += len(row[3])
        if rows:
            yield close(rows)

    placed = contexts.select("h", "ctx", "n", "raw").repartition("h")
    return placed.sortWithinPartitions("h", "ctx").mapInArrow(run, f"h long, ctx long, spans {_SPANS}")


def _counted(contexts: DataFrame, length: int) -> DataFrame:
    """(h, ctx, spans) of anchors with very many contexts: a group-by over their strings."""

    def strings(raws: list[bytes]) -> Iterator[tuple]:
        for raw in raws:
            view = memoryview(raw)
            yield ([
                {"r": s, "w": xxhash.xxh3_128_digest(view[s : s + length])}
                for s in range(len(raw) - length + 1)
            ],)

    once = contexts.dropDuplicates(["h", "ctx"])
    made = map_rows(once, ["h", "ctx", "n"], ["raw"], strings, "s array<struct<r:int,w:binary>>")
    rows = made.select("h", "ctx", "n", F.explode("s").alias("s")).select("h", "ctx", "n", "s.*")
    total = rows.groupBy("h", "w").agg(F.sum("n").alias("total")).filter("total >= 2")
    again = rows.join(total, ["h", "w"])
    span = F.struct(F.col("r").alias("first"), (F.col("r") + length).alias("end"))
    return again.groupBy("h", "ctx").agg(F.collect_list(span).cast(_SPANS).alias("spans"))


def repeated_spans(
    docs: DataFrame, store: Stored, length: int = LENGTH, most: int = MOST_CONTEXTS
) -> DataFrame:
    """(text_key, spans): per text its repeated spans, which may touch or overlap."""
    key = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    rows = docs.select(F.hash("doc_id").alias("id"), key.alias("text_key"), "text")
    listed = map_rows(
        rows,
        ["id", "text_key"],
        ["text"],
        lambda texts: _anchor_rows(texts, length),
        "anchors array<struct<h:long,ctx:long,a:int,size:int>>",
    )
    # Stored once, so the numbers given to texts hold for all later reads.
    texts = store.put(
        "anchors", listed.filter(F.size("anchors") > 0).withColumn("tid", F.monotonically_increasing_id())
    )
    every = texts.select("tid", F.explode("anchors").alias("x")).select("tid", "x.*")
    often = store.put("often", every.groupBy("h").count().filter("count > 1").select("h"))
    places = store.put("places", every.join(often, "h"))
    distinct = store.put(
        "contexts",
        places.groupBy("h", "ctx").agg(
            F.count(F.lit(1)).alias("n"),
            F.min("tid").alias("tid"),
            F.min_by("a", "tid").alias("a"),
            F.min("size").alias("size"),
        ),
    )
    wanted = (
        distinct.groupBy("tid")
        .agg(F.collect_list(F.struct("h", "ctx", "n", "a", "size")).alias("wanted"))
        .join(texts.select("tid", "id", "text_key"), "tid")
    )
    around = "c array<struct<h:long,ctx:long,n:long,raw:binary>>"
    contexts = (
        map_rows(
            rows.join(wanted, ["text_key", "id"]),
            [],
            ["wanted", "text"],
            _context_rows,
            around,
        )
        .select(F.explode("c").alias("c"))
        .select("c.*")
    )
    hot = distinct.groupBy("h").count().filter(F.col("count") > most).select("h")
    if hot.isEmpty():
        spans = store.put("spans", _sharded(contexts, length))
    else:
        contexts = store.put("bytes", contexts)
        cool = _sharded(contexts.join(hot, "h", "left_anti"), length)
        spans = store.put("spans", cool.unionByName(_counted(contexts.join(hot, "h", "left_semi"), length)))
    found = places.join(spans.filter(F.size("spans") > 0), ["h", "ctx"]).select(
        "tid",
        F.transform(
            "spans",
            lambda s: F.struct((F.col("a") + s["first"]).alias("first"), (F.col("a") + s["end"]).alias("end")),
        ).alias("spans"),
    )
    by_text = found.groupBy("tid").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    keyed = by_text.join(texts.select("tid", "text_key"), "tid")
    result = store.put("removed", keyed.groupBy("text_key").agg(F.first("spans").alias("spans")))
    store.drop("anchors", "often", "places", "contexts", "bytes", "spans")
    return result


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for first, end in sorted((s["first"], s["end"]) for s in spans or ()):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return [(s, e) for s, e in out]


def _kept(texts: list[str | None], spans: list) -> Iterator[tuple]:
    for text, own in zip(texts, spans, strict=True):
        raw, runs, parts, at = (text or "").encode(), merged(own), [], 0
        for s, e in runs:
            parts.append(raw[at:s])
            at = e
        kept = b"".join([*parts, raw[at:]])
        removed = [{"first": s, "end": e} for s, e in runs]
        yield len(raw), removed, kept, hashlib.sha256(kept).hexdigest()


def remove_repeats(docs: DataFrame, length: int = LENGTH, most: int = MOST_CONTEXTS) -> DataFrame:
    """doc_id, n_bytes, removed (spans in bytes), kept (bytes) and kept_sha256 of every row."""
    store = Stored(docs.sparkSession)
    spans = repeated_spans(docs, store, length, most)
    key = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    rows = docs.select("doc_id", "text", key.alias("text_key")).join(spans, "text_key", "left")
    return map_rows(
        rows,
        ["doc_id"],
        ["text", "spans"],
        _kept,
        f"n_bytes long, removed {_SPANS}, kept binary, kept_sha256 string",
    )
