"""Tokeniser fertility: how well public vocabularies fit a text.

Per text: characters per token and token entropy under a byte-level BPE, and
the share of byte-fallback tokens under a piece vocabulary. A text is rejected
when a figure leaves the band of its language (or, without one, of the script
of its letters). Bands are the quartiles of all texts of that language widened
by ``width`` times their distance, plus an absolute slack, so that ordinary
texts stay whatever the language's usual figures are.

Defined cases: a null text has no words and no tokens; a text without tokens
has null figures and fails by its word count; a null language falls to the
script band ``script:<name>`` of such texts. Where a band comes from fewer than
``least`` texts, a text is rejected only if its figure also leaves the band over
all texts of its script; if that script has fewer than ``least`` texts too, the
bands reject nothing. Repeated rows are judged one by one.
"""

from __future__ import annotations

import base64
import functools
import re
import unicodedata

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcraft.llm.common import Stored, map_rows

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
FIGURES = ("chars_per_token", "token_entropy", "byte_fallback_share")
#: What a figure may lie outside the widened quartiles.
SLACK = {"chars_per_token": 0.08, "token_entropy": 0.03, "byte_fallback_share": 0.02}
#: Band tables of up to this many rows are sent to every executor; larger ones are joined by key.
MOST_SENT = 10_000
#: Texts with longer stretches without a break are encoded by the library that suits these.
LONG_STRETCH = 2_000
_STRETCH = re.compile(r"\s{%d,}|\S{%d,}" % (LONG_STRETCH, LONG_STRETCH))
STAT_SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_tokens long, chars_per_token double, token_entropy double, byte_fallback_share double, "
    "script string"
)


@functools.lru_cache(maxsize=1)
def byte_bpe(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@functools.lru_cache(maxsize=1)
def piece_model(path: str):
    """The piece vocabulary and a pattern of the characters it has no piece for."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    single = {p for p in map(model.id_to_piece, range(model.get_piece_size())) if len(p) == 1}
    known = "".join(map(re.escape, sorted(single)))
    return model, re.compile(f"[^{known}{SPACE}]")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@functools.lru_cache(maxsize=1)
def long_bpe(name: str = "byte_bpe_50k.json"):
    """The same byte-level vocabulary in a library whose merges do not slow down with a word's length."""
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(vocabulary(name))
    made.encode_special_tokens = True
    return made


def byte_ids(text: str, bpe_path: str) -> np.ndarray:
    """Ids of the whole text; its longest stretch without a break decides which library makes them."""
    if _STRETCH.search(text):
        return np.array(long_bpe().encode(text, add_special_tokens=False).ids)
    return byte_bpe(bpe_path).encode_to_numpy(text, disallowed_special=())


def repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that the text has twice or more."""
    if len(words) < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    pairs = ids[:-1] * len(seen) + ids[1:]
    if len(seen) > 1_000_000:  # keeps the product below 2**63
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, place, count = np.unique(
        pairs[:-1] * len(seen) + ids[2:], return_inverse=True, return_counts=True
    )
    again = count[place] >= 2
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(again)] |= again
    return int(covered.sum())


def dup_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return len(lines) - len(set(lines))


def script_of(text: str) -> str:
    """The script of most of the first letters' kinds: by the letters' Unicode names."""
    if text.isascii():
        return "latin" if re.search("[A-Za-z]", text) else "none"
    kinds: dict[str, int] = {}
    letters = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    for code, n in zip(*np.unique(letters, return_counts=True), strict=True):
        if chr(code).isalpha():
            kind = unicodedata.name(chr(code), "other").split(" ")[0].lower()
            kinds[kind] = kinds.get(kind, 0) + int(n)
    return min(kinds, key=lambda k: (-kinds[k], k)) if kinds else "none"


def fertility(text: str, bpe_path: str, piece_path: str) -> tuple:
    """(tokens, characters per token, normalised token entropy, byte-fallback share)."""
    if not text:
        return 0, None, None, None
    ids = byte_ids(text, bpe_path)
    n = len(ids)
    count = np.unique(ids, return_counts=True)[1] / n
    entropy = float((count * -np.log2(count)).sum() / np.log2(n)) if n > 1 else 1.0
    model, unknown = piece_model(piece_path)
    share = 0.0
    if unknown.search(text):  # else every character has a piece, and no byte token can arise
        pieces = model.encode(text)
        is_byte = np.fromiter(map(model.is_byte, pieces), bool, len(pieces))
        share = float(is_byte.mean()) if len(pieces) else 0.0
    return n, len(text) / n, entropy, share


def text_stats(text: str | None, bpe_path: str, piece_path: str) -> tuple:
    text = text or ""
    words = text.encode().split()
    return (
        len(words),
        len(text) - sum(map(text.count, SPACE)),
        sum(map(text.count, SYMBOLS)),
        dup_lines(text),
        repeat_words(words),
        *fertility(text, bpe_path, piece_path),
        script_of(text),
    )


def measured(
    docs: DataFrame, bpe_path: str | None = None, piece_path: str | None = None
) -> DataFrame:
    """doc_id and lang with the figures of every text, made in Arrow batches."""
    bpe_path = bpe_path or vocabulary("byte_bpe_50k.tiktoken")
    piece_path = piece_path or vocabulary("piece_bpe_32k.model")
    return map_rows(
        docs,
        ["doc_id", "lang"],
        ["text"],
        lambda texts: [text_stats(t, bpe_path, piece_path) for t in texts],
        STAT_SCHEMA,
    )


def bands(stats: DataFrame, by: str, width: float) -> DataFrame:
    """(``by``, n, <figure>_low, <figure>_high) over all texts; n counts texts with tokens."""
    quartiles = [
        F.percentile_approx(f, [0.25, 0.75], 1000).alias(f) for f in FIGURES
    ]
    found = stats.groupBy(by).agg(F.count("chars_per_token").alias("n"), *quartiles)
    return found.select(by, "n", *_limits(width))


def _limits(width: float) -> list:
    columns = []
    for f in FIGURES:
        low, high = F.col(f)[0], F.col(f)[1]
        reach = width * (high - low) + SLACK[f]
        columns += [(low - reach).alias(f"{f}_low"), (high + reach).alias(f"{f}_high")]
    return columns


def _outside(least: int) -> Column:
    """True if a figure leaves the band ``own``, where that has few texts also the band ``wide``."""
    outside = F.lit(False)
    for f in FIGURES:
        past = {
            side: F.coalesce(
                (F.col(f) < F.col(f"{side}.{f}_low")) | (F.col(f) > F.col(f"{side}.{f}_high")),
                F.lit(False),
            )
            for side in ("own", "wide")
        }
        outside = outside | (past["own"] & ((F.col("own.n") >= least) | past["wide"]))
    return outside


def fertility_filter(
    docs: DataFrame,
    width: float = 2.5,
    least: int = 30,
    bpe_path: str | None = None,
    piece_path: str | None = None,
) -> DataFrame:
    """Every document's counts and figures, ``base_failed`` and ``kept``.

    The measured rows are stored once: the bands come from all of them. The two
    band tables have one row per language and one per script.
    """
    store = Stored(docs.sparkSession)
    band = F.coalesce("lang", F.concat(F.lit("script:"), F.col("script")))
    stats = store.put("fertility", measured(docs, bpe_path, piece_path)).withColumn("band", band)
    joined = stats
    for by, side in (("band", "own"), ("script", "wide")):
        found = bands(stats, by, width)
        if side == "wide":
            found = found.filter(F.col("n") >= least)
        limits = [c for c in found.columns if c != by]
        found = store.put(side, found.select(by, F.struct(*limits).alias(side)))
        if found.count() <= MOST_SENT:
            found = F.broadcast(found)
        joined = joined.join(found, by, "left")
    outside = _outside(least)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return joined.select(
        "doc_id",
        *counts,
        failed.alias("base_failed"),
        (~failed & ~outside).alias("kept"),
        "n_tokens",
        *FIGURES,
        "band",
    )

