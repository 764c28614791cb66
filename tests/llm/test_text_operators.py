"""Operators that judge one text at a time, against plain definitions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelcraft.llm import chat, fertility, language, license_scan, packing, pii, quality
from tests.llm.conftest import DOCS, by_row, edge_rows

BPE, PIECE = fertility.vocabulary("byte_bpe_50k.tiktoken"), fertility.vocabulary("piece_bpe_32k.model")


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    threes = Counter(zip(words, words[1:], words[2:], strict=False))
    again = {
        i + k
        for i in range(len(words) - 2)
        if threes[tuple(words[i : i + 3])] > 1
        for k in range(3)
    }
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(again),
    )


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab #\n\t\x0b|é ", max_size=60))
def test_base_counts(text):
    assert fertility.text_stats(text, BPE, PIECE)[:5] == plain_counts(text)


def test_byte_fallback_is_that_of_the_piece_vocabulary():
    model, _ = fertility.piece_model(PIECE)
    for text in ("plain words", "漢字 and ꙮ", "\U0001f9ff x", "żółć"):
        ids = model.encode(text)
        share = sum(map(model.is_byte, ids)) / len(ids)
        assert fertility.fertility(text, BPE, PIECE)[3] == pytest.approx(share)


def test_fertility_on_edges(spark, edges, none, clashing):
    rows = fertility.fertility_filter(edges).collect()
    texts = edge_rows()
    assert len(rows) == len(texts)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = sorted(str((r.doc_id, *[r[c] for c in counts], r.base_failed)) for r in rows)
    want = []
    for doc_id, text, *_ in texts:
        c = plain_counts(text)
        want.append(str((doc_id, *c, c[0] < 50 or 100 * c[4] > 50 * c[0])))
    assert got == sorted(want)
    assert all(not r.kept for r in rows if r.base_failed)
    assert fertility.fertility_filter(none).count() == 0
    assert by_row(fertility.fertility_filter(clashing), "doc_id", "n_words", "kept") == by_row(
        fertility.fertility_filter(edges), "doc_id", "n_words", "kept"
    )


def test_bands_reject_what_differs_from_its_language(spark):
    import random

    from tests.llm.conftest import sentence

    rng = random.Random(3)
    rows = [(k, sentence(rng, 120), "xx", "s", 1) for k in range(60)]
    noise = " ".join("".join(rng.choices("#$%&~^@!;:", k=7)) for _ in range(120))
    rows.append((99, noise, "xx", "s", 1))
    kept = {r.doc_id: r.kept for r in fertility.fertility_filter(spark.createDataFrame(rows, DOCS)).collect()}
    assert not kept[99]
    assert sum(kept.values()) == 60


@pytest.mark.parametrize("n", [1, 20])
def test_rare_languages_are_not_judged_by_others(spark, n):
    import random

    from tests.llm.conftest import sentence

    rng = random.Random(4)
    thai = [chr(c) for c in (0x0E01, 0x0E02, 0x0E04, 0x0E07, 0x0E08, 0x0E19, 0x0E1A, 0x0E1E)]
    rows = [(k, sentence(rng, 120), "en", "s", 1) for k in range(300)]
    for k in range(n):
        words = " ".join("".join(rng.choices(thai, k=5)) for _ in range(120))
        rows.append((1000 + k, words, "th", "s", 1))  # few texts of its script
        rows.append((2000 + k, words, None, "s", 1))
        words = " ".join("".join(rng.choices("qxzj", k=7)) for _ in range(120))
        rows.append((3000 + k, words, "yy", "s", 1))  # few texts of its language
    noise = " ".join("".join(rng.choices("#$%&~^@!;:", k=7)) + "a" for _ in range(120))
    rows += [(4000, noise, "en", "s", 1)]
    rows += [(4001, noise, "yy", "s", 1)] * (n > 1)
    kept = {r.doc_id: r.kept for r in fertility.fertility_filter(spark.createDataFrame(rows, DOCS)).collect()}
    assert [k for k, v in kept.items() if not v] == [k for k in kept if k >= 4000]


# Personal data.

JAVA_FREE = {k.name: k.plain for k in pii.KINDS if k.always}


def plain_spans(text):
    def luhn(d):
        return sum(
            int(c) if i % 2 == 0 else (int(c) * 2 - 9 if int(c) > 4 else int(c) * 2)
            for i, c in enumerate(reversed(d))
        ) % 10 == 0

    out = []
    for kind, pattern in JAVA_FREE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


HARD = [
    "a@b.c_d@e.f x@y@z.w.q .a@b a@b..c a.@-.- 1.2.3.4.5.6.7.8 256.1.1.1 01.002.0003.4 1.2.3",
    "4111 1111 1111 1111-2 4111111111111111 4111-1111 1111-1111, 0000000000000 12 3",
    "+1 (017) 555-7713 +4 +49(0)30.123456-7- +1234567890123456 ++12 345 678 90",
    "IBAN GB82 WEST 1234 5698 7654 32 and GB82WEST12345698765433 xGB82WEST12345698765432",
    'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" 24be64439e3e49cf46b2d7c90f3602a3d0b907ff',
    "ssn 123-45-6789, 123-45-6789 " + "x" * 40 + " 123-45-6789",
    "é漢\U0001f600 a@b.cd \U0001f600 1.1.1.1",
    "1" * 20_000 + "@" + "a" * 20_000,
    "1 " * 10_000,
    "a.b@c." * 3_000,
    "+" + "(" * 20_000,
    None,
]


def test_base_spans_match_the_plain_patterns(spark, edges):
    texts = HARD + [r[1] for r in edge_rows()]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in pii.find_pii(frame).collect():
        base = [(s.kind, s.start, s.end) for s in row.pii if s.kind in JAVA_FREE]
        assert base == plain_spans(texts[row.doc_id]), texts[row.doc_id][:80]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="a1@.+ -(4_%é", max_size=40), min_size=20, max_size=40))
def test_random_spans(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in pii.find_pii(frame).collect():
        assert [(s.kind, s.start, s.end) for s in row.pii if s.kind in JAVA_FREE] == plain_spans(
            texts[row.doc_id]
        )


def test_added_kinds_need_validators_or_context(spark):
    frame = spark.createDataFrame(list(enumerate(HARD)), "doc_id long, text string")
    found = {r.doc_id: [s.kind for s in r.pii if s.kind not in JAVA_FREE] for r in pii.find_pii(frame).collect()}
    assert found[3] == ["iban"]
    assert found[4] == ["secret"]
    assert found[5] == ["ssn", "ssn"]  # one word for both numbers; the third is too far from it


def test_account_numbers_end_at_their_length(spark):
    de, gb, spaced = "DE89370400440532013000", "GB82WEST12345698765432", "GB82 WEST 1234 5698 7654 32"
    texts = {
        f"IBAN {de} Thanks": [de],
        f"IBAN: {spaced} BIC: WESTGB2L": [spaced],
        f"{de} {gb}": [de, gb],
        f"{spaced} {de} AND MORE 12": [spaced, de],
        f"😀 AB12 CDEF {de}\n{gb}.": [de, gb],
        f"x{gb} {de}": [de],
        f"{de}a {de}1 {gb}É": [gb],
        "ZZ33 1234 5678 9012 345 OK THEN": ["ZZ33 1234 5678 9012 345"],  # no known length
        "AB12 " * 3_000: [],
    }
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    listed = list(texts)
    for row in pii.find_pii(frame).collect():
        text = listed[row.doc_id]
        assert [text[s.start : s.end] for s in row.pii if s.kind == "iban"] == texts[text], text[:80]


def test_redaction_takes_context_past_other_numbers(spark):
    texts = ["ssn 123-45-6789, 123-45-6780", "123-45-6789 123-45-6780 ssn", "ssn " + "x" * 40 + " 123-45-6789"]
    texts += ["IBAN DE89370400440532013000 Thanks"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.redact(frame).collect()}
    assert got == {0: "ssn [SSN], [SSN]", 1: "[SSN] [SSN] ssn", 2: texts[2], 3: "IBAN [IBAN] Thanks"}


def test_redaction(spark, edges, none, clashing):
    text = "mail a@b.cd, +1 (017) 555-7713 and 4111111111111111."
    frame = spark.createDataFrame([(1, text), (2, None), (3, "clean")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.redact(frame).collect()}
    assert got == {1: "mail [EMAIL], [PHONE] and [CARD].", 2: None, 3: "clean"}
    assert pii.redact(none).count() == 0
    assert pii.redact(clashing).columns == clashing.columns


# Licenses.


def test_base_places(spark):
    text = "Under the MIT-license. under the mit license cc by nc; cc by nc apache license, version 2.0"
    n, base, _, labels, score = license_scan.scan(text)
    assert n == len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower()))
    assert [b["label"] for b in base] == ["mit", "mit", "cc-by-nc", "cc-by-nc", "apache-2"]
    assert base[0]["start"] == 0
    assert {"mit", "apache-2", "cc-by-nc"} <= set(labels)
    assert 0 < score <= 1
    assert license_scan.scan(None) == (0, [], [], [], 0.0)


def test_templates_take_optional_and_replaced_words():
    made = license_scan.compile_template("t", 0.5, "start <<optional>>maybe so<</optional>> <<var:x:1-2>> fixed end")
    for text, end in (
        ("start maybe so a fixed end", 6),
        ("start a b fixed end", 5),
        ("start fixed end", -1),
        ("start a b c fixed end", -1),
        ("start maybe a fixed end", 5),  # "maybe a" are the replaced words
        ("start a fixed the end", -1),
    ):
        assert made.accepts_at(text.encode().split(), 0) == end, text


def test_mandatory_wording_must_match():
    label, weight, template = license_scan.TEMPLATES[0]
    full = re.sub(r"<<[^>]*>>", " ", template.replace("<<var:work:1-8>>", "this software"))
    assert "mit-text" in license_scan.scan(full)[3]
    assert "mit-text" not in license_scan.scan(full.replace("free of charge", "for a fee"))[3]
    for bad in ("<<optional>>a", "<<var:x:0-3>>"):
        with pytest.raises((ValueError, IndexError)):
            license_scan.compile_template("bad", 0.5, bad)


def test_whole_wordings_need_their_disclaimers():
    """With any mandatory word changed or gone, a text is no longer accepted as that license."""
    rng = random.Random(4)
    for label, _, template in license_scan.TEMPLATES[:4]:
        text = re.sub(r"<<var:[^>]*>>", " somebody ", re.sub(r"<<optional>>\w+<</optional>>", " ", template))
        words = re.sub(r"<<[^>]*>>", " ", text).split()
        assert label in license_scan.scan(" ".join(["Preamble.", *words, "and more"]))[3], label
        fixed = [k for k, w in enumerate(words) if w != "somebody" and k > 30]
        for k in rng.sample(fixed, 25):
            changed = [*words[:k], "otherwise", "stated", "here", *words[k + 1 :]]
            assert label not in license_scan.scan(" ".join(changed))[3], (label, words[k])
            if words[k - 1] != "somebody" and words[k + 1 : k + 2] != ["somebody"]:
                gone = [*words[:k], *words[k + 1 :]]
                assert label not in license_scan.scan(" ".join(gone))[3] or words[k] in words[k + 1 : k + 2], label


def test_phrases_against_a_plain_matcher():
    """Places, first and last word of random texts, from the definition."""
    rng = random.Random(8)
    parts = "under the mit license apache version 2 cc by nc The MIT. x é".split()
    for _ in range(400):
        text = " ".join(rng.choice(parts) + rng.choice(["", "", "-", ".,", "\n"]) for _ in range(rng.randint(0, 60)))
        if rng.random() < 0.5:
            text += rng.choice([" under the mit license ", " cc by nc cc by nc", " Apache License, Version 2"])
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        expected = sorted(
            (k, k + len(p.split()), label)
            for p, label in (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
            for k in range(len(words))
            if words[k : k + len(p.split())] == p.split()
        )
        n, base, *_ = license_scan.scan(text)
        assert n == len(words)
        assert [(b["start"], b["end"], b["label"]) for b in base] == expected


def test_many_phrases_take_linear_time():
    import time

    def spent(n):
        started = time.process_time()
        assert len(license_scan.scan("cc by nc " * n)[1]) == n
        return time.process_time() - started

    spent(1_000)
    assert spent(80_000) < 40 * max(spent(8_000), 0.01)


def test_license_scan_on_edges(edges, none, clashing):
    assert license_scan.license_scan(edges).count() == len(edge_rows())
    assert license_scan.license_scan(none).count() == 0
    assert license_scan.license_scan(clashing).columns[0] == "doc_id"


# Languages.


def test_language_on_edges(edges, none, clashing):
    from pyspark.sql import functions as F

    learned = language.learn_dictionaries(edges, F.lit(True))
    rows = language.identify(edges.select("doc_id", "text"), learned).collect()
    assert len(rows) == len(edge_rows())
    for r in rows:
        lettered = r.text is not None and any(map(str.isalpha, r.text))
        assert (r.lang_pred == "und") == (not lettered)
        assert 0 <= r.score <= 1
    assert language.learn_dictionaries(none, F.lit(True)) == ()
    assert language.identify(none, ()).count() == 0
    again = language.identify(clashing, learned)
    assert again.columns[-3:] == ["lang_pred", "score", "rejected"]
    assert len(set(again.columns)) == len(again.columns)


def test_held_out_languages_and_quality(spark):
    from panelcraft.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = [r for r in QUERIES["op7_language_compression"](spark, sf).collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in rows) > 0.97 * len(rows)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op4_quality_discriminant"](spark, sf).collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    rows = [r for r in rows if r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in rows) > 0.9 * len(rows)


def test_quality_on_edges(spark, edges, none, clashing):
    from pyspark.sql import functions as F

    labels = spark.createDataFrame(
        [(k, k % 2, 0) for k in range(20, 60)] + [(None, 1, 0), (1, None, 0), (999, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    rows = quality.quality_scores(edges, labels, F.lit(True)).collect()
    assert len(rows) == len(edge_rows())
    assert all(0 <= r.score <= 1 for r in rows)
    assert quality.quality_scores(none, labels, F.lit(True)).count() == 0
    empty = spark.createDataFrame([], labels.schema)
    assert {r.score for r in quality.quality_scores(edges, empty, F.lit(True)).collect()} == {0.5}
    assert quality.quality_scores(clashing, labels, F.lit(True)).count() == len(rows)


# Chat.


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/s[]INSTROLE\\ ab", max_size=40))
def test_escape_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not any(c in chat.escape(text) for c in chat.CONTROLS)


@settings(max_examples=100, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["user", "assistant", "system", "", "</s>[ROLE]x"]),
            st.text(alphabet="<>/s[]INST\\ \n", max_size=30),
        ),
        max_size=5,
    )
)
def test_round_trip_and_loss_spans(turns):
    text, spans = chat.compile_template(chat.TEMPLATE)([{"role": r, "text": t} for r, t in turns])
    assert chat.read_back(text) == turns
    assert [chat.unescape(text[s:e]) for s, e in spans] == [t for r, t in turns if r == "assistant"]


@pytest.mark.parametrize(
    ("template", "expected"),
    [
        ("{{ 'a' + 'b' ~ 3 }}", "ab3"),
        ("{% if 1 == 1 and not false %}yes{% else %}no{% endif %}", "yes"),
        ("{% for m in messages %}{{ loop.index }}{{ m['role'] | upper }}{% if not loop.last %},{% endif %}{% endfor %}", "1U,2A"),
        ("{% set x = messages | length %}{{ x }}", "2"),
        ("a {{- ' b ' -}} c", "a b c"),
        ("{{ ('x' in 'xyz') and 'in' or 'out' }}", "in"),
        ("{% if messages[0].role == 'a' %}1{% elif messages[1].role == 'a' %}2{% endif %}", "2"),
        ("{{ messages[0].missing }}|{{ 'It\\'s' }}", "|It's"),
    ],
)
def test_template_language(template, expected):
    text, _ = chat.compile_template(template)([{"role": "u", "text": "x"}, {"role": "a", "text": "y"}])
    assert text == expected


def test_folding_leaves_no_constant_work():
    tree = chat.fold(chat.parse("{{ 'a' ~ 'b' }}c{% if true %}d{% else %}e{% endif %}"))
    assert tree == ("block", [("out", ("const", "abcd"))])


@pytest.mark.parametrize(
    "template",
    ["{{ x.__class__ }}", "{{ f() }}", "{% import os %}", "{{ 'a' | nope }}", "{% for x in y %}", "{{ }}", "{% endif %}"],
)
def test_sandbox_refuses(template):
    with pytest.raises(chat.TemplateError):
        chat.compile_template(template)([])


def test_conversations_on_edges(spark):
    schema = "conv_id long, turn long, role string, text string, score string"
    rows = [
        (1, 1, "assistant", "hi", "x"),
        (1, 0, "user", None, None),
        (None, 0, None, "x", None),
        (2, None, "user", "a", None),
        (2, 0, "assistant", "b" * 50_000, None),
        (3, 0, "user", "t", None),
        (3, 0, "user", "t", None),
    ]
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(spark.createDataFrame(rows, schema))).collect()}
    assert {k: v.n_turns for k, v in got.items()} == {1: 2, None: 1, 2: 2, 3: 2}
    assert got[1].turns_sha256 == hashlib.sha256(b"user\n\nassistant\nhi\n").hexdigest()
    assert got[1].loss_sha256 == hashlib.sha256(b"hi").hexdigest()
    assert got[2].loss_chars == 50_000
    empty = spark.createDataFrame([], schema)
    assert chat.digests(chat.format_conversations(empty)).count() == 0


# Tokens of the packing operator.


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="abé'stll 19²½ǅİΣ\xa0\x85\x1c.,<|>", max_size=60))
def test_cached_tokens_are_those_of_the_tokenizer(text):
    t = packing.tokenizer(packing.vocabulary())
    expected = t.tokenizer.encode(text, add_special_tokens=False).ids
    assert t.encode([text, text + " end"])[0].tolist() == expected


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", " ", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "漢", "9"]), max_size=12))
def test_added_tokens_are_those_of_a_default_tokenizer(parts):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.vocabulary())
    t = packing.tokenizer(packing.vocabulary())
    for text in ("".join(parts), "a <|endoftext|> b"):
        expected = plain.encode(text, add_special_tokens=False).ids
        assert t.encode([text, "a b"])[0].tolist() == expected
    assert t.encode(["a <|endoftext|> b"])[0].tolist() == [320, 49407, 321]
