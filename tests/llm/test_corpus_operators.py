"""Operators over the whole corpus, against brute force on small tables."""

from __future__ import annotations

import gc
import hashlib
import random
import re
import weakref
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelcraft.llm import common, decontamination, language, near_duplicates, packing, suffix_dedup
from panelcraft.llm.common import Stored
from tests.llm.conftest import DOCS, by_row, edge_rows, sentence


def rows_of(texts):
    return [(k, t, "en", "s", 1) for k, t in enumerate(texts)]


# Repeated byte strings.


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=80) | st.lists(st.integers(1, 200), max_size=80))
def test_suffix_array(values):
    t = np.array([*values, 0])
    assert suffix_dedup.suffix_array(t).tolist() == sorted(range(len(t)), key=lambda i: t.tolist()[i:])


def test_suffix_arrays_with_deep_recursion():
    rng = np.random.default_rng(1)
    for n, k in ((4_000, 2), (4_000, 1), (3_000, 150)):
        t = np.append(rng.integers(1, k + 1, n), 0)
        raw = t.tolist()
        assert suffix_dedup.suffix_array(t).tolist() == sorted(range(n + 1), key=lambda i: raw[i:])
        assert suffix_dedup._by_doubling(t).tolist() == sorted(range(n + 1), key=lambda i: raw[i:])


def repeats(texts, length=200):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(r, np.uint8)[~gone])
        runs = int(np.diff(np.concatenate([[0], gone.astype(int)])).clip(0).sum())
        out.append((len(r), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus_with_passages():
    rng = random.Random(2)
    passages = [sentence(rng, 60) for _ in range(5)]
    texts = []
    for _ in range(60):
        parts = [sentence(rng, rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            at = rng.randint(0, len(p) // 2)
            parts += [p[at : at + rng.randint(150, 400)], sentence(rng, rng.randint(0, 20))]
        texts.append(rng.choice([" ", "é", ""]).join(parts))
    return [*texts, texts[3], "a" * 450, "ab" * 300, "a" * 199, "", None, "xyz" * 90]


@pytest.mark.parametrize("most", [suffix_dedup.MOST_CONTEXTS, 1])
def test_repeated_strings(spark, most):
    texts = corpus_with_passages()
    frame = spark.createDataFrame(rows_of(texts), DOCS)
    got = {}
    for r in suffix_dedup.remove_repeats(frame, most=most).collect():
        got[r.doc_id] = (r.n_bytes, sum(s.end - s.first for s in r.removed), len(r.removed), r.kept_sha256)
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
    assert [got[k] for k in range(len(texts))] == repeats(texts)


def test_repeated_strings_on_edges(edges, none, clashing):
    expected = sorted(
        str([i, b, k]) for (i, *_), (b, _, _, k) in zip(edge_rows(), repeats([r[1] for r in edge_rows()]), strict=True)
    )
    assert by_row(suffix_dedup.remove_repeats(edges), "doc_id", "n_bytes", "kept_sha256") == expected
    assert by_row(suffix_dedup.remove_repeats(clashing), "doc_id", "n_bytes", "kept_sha256") == expected
    assert suffix_dedup.remove_repeats(none).count() == 0


# Near duplicates.


def plain_components(rows):
    sets = []
    for _, text, *_ in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                group[max(a, b)] = min(a, b)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    out = []
    for i, (doc_id, *_) in enumerate(rows):
        ids = [x for x in members[find(i)] if x is not None] if sets[i] else [doc_id]
        root = min(ids) if ids else None
        out.append(str([doc_id, len(sets[i]), root, doc_id == root]))
    return sorted(out)


def near_copies():
    """Chains of edits, copies, a shared passage in many texts, texts at the threshold."""
    rng = random.Random(4)
    texts, passage = [], sentence(rng, 60)
    for _ in range(12):
        words = sentence(rng, rng.randint(8, 120)).split()
        for _ in range(rng.randint(1, 12)):
            texts.append(" ".join(words))
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = sentence(rng, 1)
    texts += [passage + " " + sentence(rng, rng.randint(15, 40)) for _ in range(120)]
    texts += ["A b C d", "a B c D", "", None, "x", "x", "x y z w v", "x y z w V"]
    rng.shuffle(texts)
    return rows_of(texts)


COLUMNS = ("doc_id", "n_shingles", "component_id", "kept")


@pytest.mark.parametrize("direct", [near_duplicates.DIRECT, 3])
def test_components(spark, monkeypatch, direct):
    monkeypatch.setattr(near_duplicates, "DIRECT", direct)
    rows = near_copies()
    got = by_row(near_duplicates.near_duplicates(spark.createDataFrame(rows, DOCS)), *COLUMNS)
    assert got == plain_components(rows)


def test_components_on_edges(edges, none, clashing):
    expected = plain_components(edge_rows())
    assert by_row(near_duplicates.near_duplicates(edges), *COLUMNS) == expected
    assert by_row(near_duplicates.near_duplicates(clashing), *COLUMNS) == expected
    assert near_duplicates.near_duplicates(none).count() == 0


def test_star_steps(spark):
    rng = random.Random(9)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(90), rng.randrange(90)) for _ in range(60)]
    pairs = [(a, b) for a, b in pairs if a != b]
    root = {x: x for p in pairs for x in p}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    links = spark.createDataFrame(pairs, "a long, b long")
    got = {r.nid: r.root for r in near_duplicates.components(Stored(spark), links, "t").collect()}
    assert got == {k: v for k, v in root.items() if k != v}


# Decontamination.

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain_contamination(rows, items, length=13):
    windows = defaultdict(set)
    for item_id, text in items:
        w = WORD.findall(lowered(text))
        for i in range(max(1, len(w) - length + 1) if w else 0):
            windows[tuple(w[i : i + length])].add(str(item_id))
    out = []
    for doc_id, text, *_ in rows:
        w, hit, found = WORD.findall(lowered(text)), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[tuple(w[i : i + size])]
        out.append(str([doc_id, len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w)]))
    return sorted(out)


FOUND = ("doc_id", "n_words", "n_hit", "items", "contaminated")


def contaminated_corpus():
    rng = random.Random(6)
    items = [(k, sentence(rng, rng.randint(10, 40))) for k in range(15)]
    items += [(50, "ba ba ba"), (51, "de"), (52, ""), (53, None), (50, "fi fi go lu"), (None, sentence(rng, 20))]
    items += [(60, items[0][1])]
    rows = edge_rows()
    for k in range(60):
        text = sentence(rng, rng.randint(0, 60))
        item = rng.choice(items)[1] or ""
        words = item.split()
        at = rng.randint(0, max(0, len(words) - 12))
        text += ", " + " - ".join(words[at : at + rng.randint(5, 30)]).upper() + " " + sentence(rng, 9)
        rows.append((100 + k, text, "en", "s", 1))
    return rows, items


def test_contamination(spark, none, clashing):
    rows, items = contaminated_corpus()
    tests = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(rows, DOCS)
    known = [i for i in items if i[0] is not None]
    assert by_row(
        decontamination.contamination(docs, spark.createDataFrame(known, tests.schema)), *FOUND
    ) == plain_contamination(rows, known)
    assert decontamination.contamination(docs, tests).count() == len(rows)
    assert decontamination.contamination(none, tests).count() == 0
    empty = spark.createDataFrame([], tests.schema)
    assert not any(r.contaminated for r in decontamination.contamination(docs, empty).collect())
    got = decontamination.contamination(clashing, tests)
    assert set(clashing.columns) <= set(got.columns)
    assert got.count() == clashing.count()


def test_proximity(spark):
    docs = spark.createDataFrame(
        [(1, "x red y green z blue"), (2, "red a a a a a a a a green blue"), (3, "blue green red"), (4, "red green")],
        "doc_id long, text string",
    )
    tests = decontamination.windows(spark.createDataFrame([(1, "red green blue")], "item_id long, text string"))
    index = decontamination.build_index(docs, tests, Stored(spark))
    near = decontamination.proximity_matches(index, tests, 6).select("key").distinct()
    keyed = docs.select("doc_id", decontamination.text_key(docs["text"]).alias("key"))
    assert {r.doc_id for r in keyed.join(near, "key").collect()} == {1, 3}


# Packing.


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 2048), st.integers(1, 400), max_size=60))
def test_patterns_hold_the_histogram(histogram):
    groups = packing.pattern_groups(histogram)
    held = Counter()
    for members, count in groups:
        assert sum(members) <= 2048
        for m in members:
            held[m] += count
    assert held == Counter(histogram)


def test_nnls():
    rng = np.random.default_rng(3)
    for _ in range(5):
        a, x = rng.random((20, 8)), np.maximum(rng.normal(size=8), 0)
        found = packing.nnls(a, a @ x)
        assert np.allclose(found, x, atol=1e-4)
        assert (found >= 0).all()


def check_packing(rows, got):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.vocabulary())
    expected = Counter()
    for doc_id, text, *_ in rows:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            part = np.array(ids[k : k + 2048], "<u4")
            expected[(doc_id, k // 2048, k, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    return len(places), sum(r.length for r in got)


def test_packing(spark, edges, none, clashing):
    rows = edge_rows()
    check_packing(rows, packing.pack(edges).collect())
    check_packing(rows, packing.pack(clashing).collect())
    assert packing.pack(none).count() == 0
    rng = random.Random(8)
    many = rows_of([sentence(rng, rng.choice([5, 40, 200, 200, 500])) for _ in range(400)])
    sequences, tokens = check_packing(many, packing.pack(spark.createDataFrame(many, DOCS)).collect())
    assert sequences <= 1.02 * tokens / 2048 + 1


def test_cached_ids_are_those_of_a_default_tokenizer():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.vocabulary())
    rng = random.Random(6)
    parts = [
        "the", "don't", "I'LL", "'s", "'re'd", "Été", "x²½", "ß", "1234", "a_b", "...", "İstanbul", "µm", "ª", "×",
        "\xad", "\xa0", "\x1c", "\x85", "漢字", "e\u0301", "<|endoftext|>", "<|StartOfText|>", "ǅ", "ʼn", "\t", "\r\n",
    ]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(0, 20))) for _ in range(2_000)]
    cached = packing.CachedTokenizer(packing.vocabulary(), most=60)
    for k in range(0, len(texts), 50):
        found = cached.encode(texts[k : k + 50])
        expected = [plain.encode(t, add_special_tokens=False).ids for t in texts[k : k + 50]]
        assert [ids.tolist() for ids in found] == expected


# The pipeline.


def test_pipeline_stages(spark):
    import corpus_pipeline as cp

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    counts = [docs.count()]
    for _, stage in cp.STAGES[:-1]:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        docs = Stored(spark).put("stage", stage(spark, docs, sf))
        assert docs.columns == columns
        after = {r.doc_id for r in docs.collect()}
        assert after <= {i for i, _ in before}
        counts.append(len(after))
        if stage is cp.one_of_each_group:
            kept = [r for r in plain_components(before) if r.endswith("True]")]
            assert len(after) == len(kept)
        if stage is cp.decontaminated:
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            clean = [r for r in plain_contamination(before, items) if r.endswith("False]")]
            assert len(after) == len(clean)
    assert counts == sorted(counts, reverse=True)
    last = cp.STAGES[-1][1](spark, docs, sf).collect()
    check_packing([(r.doc_id, r.text) for r in docs.collect()], last)
    assert {r.doc_id for r in cp.run(spark, sf).collect()} == {r.doc_id for r in last}


def stage_rows(df):
    return Counter(tuple(r) for r in df.collect())


CLASHING = "n_words n_hit items contaminated pii lang_pred score rejected kept component_id node key _row _0 row".split()


@pytest.mark.parametrize("name", ["language", "near_duplicates", "decontamination", "personal_data"])
def test_stages_on_edge_rows(spark, edges, none, name):
    """Each stage on nulls, repeated rows and ids, empty tables, and columns named like results."""
    import corpus_pipeline as cp

    sf, stage = "/root/testdata/sf0.001", dict(cp.STAGES)[name]
    plain = stage(spark, edges, sf)
    assert plain.columns == edges.columns and plain.dtypes == edges.dtypes
    assert stage(spark, none, sf).collect() == []
    typed = edges
    for k, c in enumerate(CLASHING):
        typed = typed.withColumn(c, F.lit(123) if k % 2 else F.array(F.lit(c)))
    got = stage(spark, typed, sf)
    assert got.dtypes == typed.dtypes
    assert stage_rows(got.select(*edges.columns)) == stage_rows(plain)
    assert got.where("n_hit != 123").count() == 0
    before, after = stage_rows(edges), stage_rows(plain)
    if name == "near_duplicates":
        # Wordless rows stay, null and equal ids too; of the three repeated rows and their near copies one does.
        assert all(after[r] == before[r] for r in before if not (r[1] or "").split())
        assert sum(n for r, n in after.items() if r[0] is not None and 20 <= r[0] <= 26) == 1
        assert sum(n for r, n in after.items() if r[0] is None) == sum(n for r, n in before.items() if r[0] is None)
    if name == "personal_data":
        assert sum(after.values()) == sum(before.values())
    if name == "language":
        assert all(any(map(str.isalpha, r[1] or "")) for r in after)


@pytest.mark.parametrize("name", ["language", "near_duplicates", "decontamination", "personal_data"])
def test_stages_hold_each_column_once(spark, edges, monkeypatch, name):
    """What a stage hands to its operator, or stores, has no second copy of the texts."""
    import corpus_pipeline as cp

    held, stored = [], Stored.put
    for module, function in ((cp.language, "identify"), (cp.decontamination, "contamination"), (cp.pii, "redact")):
        kept = getattr(module, function)
        monkeypatch.setattr(module, function, lambda df, *more, kept=kept: held.append(df) or kept(df, *more))
    monkeypatch.setattr(
        Stored, "put", lambda own, at, df: (at == "rows" and held.append(df)) or stored(own, at, df)
    )
    rows = edges.withColumn("Score", F.lit(1))
    got = dict(cp.STAGES)[name](spark, rows, "/root/testdata/sf0.001")
    assert got.dtypes == rows.dtypes
    for df in held:
        assert len(df.drop("_row").columns) == len(rows.columns) and "text" in df.columns
    assert held


@pytest.mark.parametrize("name", ["language", "near_duplicates", "packing"])
def test_stages_bound_the_batches_of_python_tasks(spark, name):
    """a task held up to 10,000 texts, or 64 MB, outside the heap and once more in its worker."""
    import corpus_pipeline

    docs = spark.createDataFrame(rows_of(["ba de fi"] * 3), DOCS)
    wide = spark.range(0, 1_500, 1, 1).select(F.repeat(F.lit("ba de fi go "), 1_000).alias("text"))
    narrow = spark.range(0, 3_000, 1, 1)
    keys = [f"spark.sql.execution.arrow.max{k}PerBatch" for k in ("Records", "Bytes")]

    def largest(df):
        def sizes(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

        found = df.mapInArrow(sizes, "n long, size long").agg(F.sum("n"), F.max("n"), F.max("size")).first()
        return tuple(found)

    try:
        dict(corpus_pipeline.STAGES)[name](spark, docs, "/root/testdata/sf0.001")
        rows, most, _ = largest(narrow)
        assert (rows, most) == (3_000, common.BATCH_ROWS)
        rows, _, size = largest(wide)
        assert rows == 1_500 and size < common.BATCH_BYTES + 20_000
        spark.conf.set(keys[0], "100")  # a smaller bound of the session's own stays
        dict(corpus_pipeline.STAGES)[name](spark, docs, "/root/testdata/sf0.001")
        assert largest(narrow)[1] == 100
    finally:
        for key in keys:
            spark.conf.unset(key)


def test_a_worker_holds_what_one_step_needs():
    """dictionaries and tokenizers of earlier steps stayed beside what the step at work needs."""
    texts = ["ba de fi go lu ma", None]
    packing.tokenizer(packing.vocabulary()).encode(texts[:1])
    held = weakref.ref(packing.tokenizer(packing.vocabulary()))
    assert packing.tokenizer(packing.vocabulary()) is held()
    language.classify(texts[0], (("en", b"ba de fi"), ("de", b"xo zu ka")))
    gc.collect()
    assert held() is None
    held = weakref.ref(packing.tokenizer(packing.vocabulary()))
    assert [n for n, *_ in near_duplicates._signed(texts)] == [2, 0]
    gc.collect()
    assert held() is None


def test_near_copies_with_null_and_shared_ids(spark):
    import corpus_pipeline as cp

    rng = random.Random(12)
    one, two, three = (sentence(rng, 90) for _ in range(3))
    rows = [
        (None, one, "a"), (None, one + " ba", "a"),  # near copies, both without an id
        (7, two, "a"), (8, two + " ba", "b"), (8, three, "a"),  # a near copy shares its id with another text
        (9, "", "a"), (9, "", "b"), (None, None, "a"), (None, None, "b"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = cp.one_of_each_group(spark, docs, "/root/testdata/sf0.001").collect()
    kept = Counter((r.doc_id, (r.text or "")[:40], r.source) for r in got)
    expected = [(None, one[:40], "a"), (7, two[:40], "a"), (8, three[:40], "a")]
    assert kept == Counter([*expected, (9, "", "a"), (9, "", "b"), (None, "", "a"), (None, "", "b")])


def test_every_labelled_language_has_a_dictionary(spark):
    from panelcraft.llm import language

    rng = random.Random(3)
    german = [(None, sentence(rng, 40), "de") for _ in range(600)] + [(5, "der die das " * 9, "rare")]
    english = [(k, sentence(rng, 40), "en") for k in range(500)]
    copies = [(6, "ein Text", "copy")] * 900  # equal rows fill one slot
    docs = spark.createDataFrame(german + english + copies, "doc_id long, text string, lang string")
    learned = language.learn_dictionaries(docs.repartition(6), F.lit(True), sample=32)
    assert [lang for lang, _ in learned] == ["copy", "de", "en", "rare"]
    sizes = {lang: content.count(b" ") for lang, content in learned}
    assert sizes["copy"] == 1 and sizes["de"] > 32 * 30 and sizes["en"] > 32 * 30
    assert learned == language.learn_dictionaries(docs.repartition(3), F.lit(True), sample=32)


def test_long_stretches_have_the_tokens_of_the_whole_text():
    import sentencepiece
    from tokenizers import Tokenizer

    from panelcraft.llm import fertility

    paths = fertility.vocabulary("byte_bpe_50k.tiktoken"), fertility.vocabulary("piece_bpe_32k.model")
    plain = Tokenizer.from_file(fertility.vocabulary("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=paths[1])
    rng = random.Random(2)
    texts = ["".join(rng.choices("abcdefgh", k=17_269)), "漢字テスト" * 900 + " <|endoftext|>", " " * 5_000 + "x"]
    for text in texts:
        n, chars, entropy, share = fertility.fertility(text, *paths)
        ids = plain.encode(text, add_special_tokens=False).ids
        assert (n, chars) == (len(ids), len(text) / len(ids))
        pieces = model.encode(text)
        assert share == pytest.approx(sum(map(model.is_byte, pieces)) / len(pieces)) or share == 0.0
    short = "word " * 300 + "naïve <|endoftext|>"
    assert fertility.byte_ids(short, paths[0]).tolist() == plain.encode(short, add_special_tokens=False).ids
