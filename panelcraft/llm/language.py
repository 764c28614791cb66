"""Language by compression: the dictionary that makes a text smallest names it.

Per language a raw-content dictionary for zstandard is cut from labelled texts.
Texts are lowered and everything but letters becomes one space, so that case,
symbols and numbers do not count. A text is cut into pieces of ``PIECE`` bytes, every piece is compressed alone
with each dictionary, and the language with the fewest bytes over the whole
text wins. The score is the share of bytes saved against the runner-up, scaled
to 0..1; below ``margin`` the row is marked as rejected.

The dictionaries are a bounded sample by design: about ``sample`` texts, of
``excerpt`` characters each, per language, drawn by a hash of id and text. Equal
rows are drawn once, and every language that has a labelled text has a
dictionary, whatever its ids are.

Defined cases: a null text or one without a letter gives ``und`` with score 0
and is rejected; ties go to the language with more labelled texts; without any labelled
text every document is ``und``. Empty tables give empty results.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcraft.llm.common import held_alone, map_rows

UNKNOWN = "und"
PIECE = 2_048
LEVEL = 5
_NO_LETTERS = re.compile(r"[\W\d_]+")
#: A saving of this share over the runner-up counts as certain.
CERTAIN = 0.05


def letters(text: str) -> str:
    return _NO_LETTERS.sub(" ", text.lower())


def learn_dictionaries(
    docs: DataFrame, learn: Column, sample: int = 256, excerpt: int = 512
) -> tuple[tuple[str, bytes], ...]:
    """(language, raw dictionary content) from a bounded sample of labelled texts.

    Languages with more labelled texts come first. In a first aggregate every
    text falls into one of ``sample`` slots of its language, by its hash, and a
    slot keeps the text with the smallest one: a task holds at most so many rows
    per language, however many copies a text or an id has.
    """
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text")
    rows = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "lang", key.alias("key"), F.substring("text", 1, excerpt).alias("part")
    )
    slots = rows.groupBy("lang", F.pmod("key", F.lit(sample)).alias("slot")).agg(
        F.count(F.lit(1)).alias("n"), F.min_by("part", F.struct("key", "part")).alias("part")
    )
    picked = slots.groupBy("lang").agg(
        F.sum("n").alias("n"),
        F.transform(F.array_sort(F.collect_list(F.struct("slot", "part"))), lambda s: s["part"]).alias("parts"),
    )
    # One row of at most sample x excerpt characters per language of the labels.
    found = picked.orderBy(F.desc("n"), "lang").collect()
    return tuple((r["lang"], letters(" ".join(r["parts"])).encode()) for r in found)


@held_alone
def _compressors(dictionaries: tuple[tuple[str, bytes], ...]) -> list:
    import zstandard

    made = []
    for _, content in dictionaries:
        data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(level=LEVEL)
        made.append(
            zstandard.ZstdCompressor(
                dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False
            )
        )
    return made


def classify(text: str | None, dictionaries: tuple[tuple[str, bytes], ...]) -> tuple[str, float]:
    """(language, score) of one whole text."""
    if not text or not dictionaries or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0
    raw = letters(text).encode()
    pieces = [raw[i : i + PIECE] for i in range(0, len(raw), PIECE)]
    sizes = [
        sum(len(c.compress(p)) for p in pieces) for c in _compressors(dictionaries)
    ]
    best = min(range(len(sizes)), key=sizes.__getitem__)
    rest = min((s for k, s in enumerate(sizes) if k != best), default=None)
    saved = 1.0 if rest is None else (rest - sizes[best]) / rest
    return dictionaries[best][0], min(1.0, saved / CERTAIN)


def identify(
    docs: DataFrame, dictionaries: tuple[tuple[str, bytes], ...], margin: float = 0.02
) -> DataFrame:
    """All columns of ``docs`` with lang_pred, score and rejected.

    Columns of these names that the input already has are replaced.
    """

    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score", "rejected")]
    found = map_rows(
        docs, kept, ["text"], lambda texts: [classify(t, dictionaries) for t in texts],
        "lang_pred string, score double",
    )
    return found.withColumn("rejected", F.col("score") < margin)
