"""Encoding, mixing and visual forms against whole-text encoders and plain Python."""

import collections
import os
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing, tokens, visual
from tidemark.sources.workspace import Workspace

HAVE = pytest.mark.skipif(not os.path.isdir(tokens.TOKENIZERS), reason="no tokenizers")
DOCS = "doc_id bigint, text string, source string, word string, ids string, id int"
TEXTS = [
    "The camera's lens isn't clean; they'll re-check at 09:30.", "  leading and   inner \n\n\t blanks  \n", "trailing space ", "\n", " ", "日本語のテキスト、全角。 ﾊﾝｶｸ", "Ёлка и ёж 12³ ½ ②", "emoji 👩‍🔬🏽 and ❤️​﻿",
    "a" * 3000, "=" * 700 + " " * 300 + "x", "<|endoftext|> is text here", "x y z　w q r\x85s\x1ct", "ʼn ß ŉ İ ı ǅ", "don't DON'T 'S 's 'll", "\U0001e030 \U00011f51 ࡰࡱx new letters", "é ́alone", "\u0000nul\u0000",
    None, "", "12345678901234567890", "tab\tand\rreturn\r\nend",
]


def docs(spark, texts, more=()):
    rows = [(i, t, f"s{i % 3}" if i % 5 else None, "w", "x", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, *more], DOCS)


def encoder():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{tokens.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda x: t.encode(x, add_special_tokens=False).ids if x else []


@HAVE
def test_ids_are_those_of_the_whole_text(spark):
    rng = random.Random(1)
    alphabet = [chr(c) for c in (*range(32, 127), 0x09, 0x0A, 0xA0, 0xE9, 0x301, 0x3B1, 0x416, 0x5D0, 0x4E2D, 0x200B, 0x2003, 0x1F600, 0x870, 0x1E030)]
    texts = [*TEXTS, *("".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(300))]
    one = encoder()
    got = tokens.encode(docs(spark, texts)).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(len(texts)))
    assert {r["doc_id"]: list(r["ids"]) for r in got} == {i: one(t) for i, t in enumerate(texts)}


@HAVE
def test_ids_without_broadcast_words(spark, monkeypatch):
    """All words through the ordinary join, as if none were frequent."""
    monkeypatch.setattr(tokens, "HOT_WORDS", 0)
    one = encoder()
    assert {r["doc_id"]: list(r["ids"]) for r in tokens.encode(docs(spark, TEXTS)).collect()} == {i: one(t) for i, t in enumerate(TEXTS)}


@HAVE
def test_every_character_is_cut_as_the_tokenizer_cuts_it(spark):
    pre = tokens._tokenizer(tokens.TOKENIZERS).pre_tokenizer
    points = [c for c in range(1, 0x1FFFF, 7) if not 0xD800 <= c < 0xE000] + list(range(1, 0x3100))
    texts = [f"a{chr(c)}a 1{chr(c)}1 !{chr(c)}! {chr(c)} {chr(c)}{chr(c)}" for c in points]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = tokens.words(df).groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]).alias("w")).collect()
    bad = [hex(points[r["doc_id"]]) for r in got if list(r["w"]) != [texts[r["doc_id"]][a:b] for _, (a, b) in pre.pre_tokenize_str(texts[r["doc_id"]])]]
    assert not bad and len(got) == len(texts)


@HAVE
def test_repeated_ids_nulls_and_nothing(spark):
    one = encoder()
    df = docs(spark, [], [(1, "b", None, "", "", 0), (1, "a", None, "", "", 0), (2, None, None, "", "", 0), (2, "z", None, "", "", 0), (None, "q", None, "", "", 0), (3, "", None, "", "", 0), (3, None, None, "", "", 0)])
    assert {r["doc_id"]: list(r["ids"]) for r in tokens.encode(df).collect()} == {1: one("a"), 2: one("z"), None: one("q"), 3: []}
    assert tokens.encode(df.where("false")).count() == 0 and tokens.encode(df.where("doc_id = 3")).count() == 1


@HAVE
def test_round_trip_and_counts(spark):
    df, one = docs(spark, TEXTS), encoder()
    got = tokens.round_trip(df).collect()
    assert len(got) == len(TEXTS) and all(r["same"] for r in got)
    assert {r["doc_id"]: r["n_tokens"] for r in tokens.token_counts(df).collect()} == {i: len(one(t)) for i, t in enumerate(TEXTS) if t}
    odd = spark.createDataFrame([(1, [65, 999_999]), (2, [])], "doc_id bigint, ids array<int>")
    assert {r["doc_id"]: r["text"] for r in tokens.decode(odd).collect()} == {1: "b", 2: ""}


TARGETS = "mix_id string, source string, target_share double, max_repeats int, budget_share double"


@HAVE
def test_mix_reaches_its_shares(spark):
    rng = random.Random(2)
    words = "the camera lens shows a light film of algae on its lower rim today".split()
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(5, 60))), rng.choice(["big"] * 8 + ["mid", "small"]), "", "", 0) for i in range(3000)]
    df = spark.createDataFrame([*rows, (9000, "no source at all", None, "", "", 0), (9001, None, "big", "", "", 0)], DOCS)
    one = encoder()
    size = collections.Counter()
    for r in rows:
        size[r[2]] += len(one(r[1]))
    total = sum(size.values()) + len(one("no source at all"))
    targets = [("m", "big", 0.5, 2, 0.6), ("m", "small", 0.2, 4, 0.6), ("m", "mid", 0.3, 1, 0.6), ("m2", "gone", 0.5, 3, 0.1), ("m2", None, 0.5, 3, 0.1), ("m3", "big", None, 1, 1.0), ("m3", "mid", 0.001, None, 1.0)]
    sizes = mixing.sized(df, Workspace(spark))
    rated = mixing.rates(sizes, spark.createDataFrame(targets, TARGETS))
    assert {tuple(r) for r in mixing.short_sources(rated).collect()} == {(m, s) for m, s, t, k, b in targets if (k or 0) * size.get(s, 0) < (t or 0) * b * total}
    most = collections.Counter((r["mix_id"], r["id"]) for r in mixing.mixed(sizes, rated).collect())
    allowed = {(m, s): k or 0 for m, s, _, k, _ in targets}
    source = {r[0]: r[2] for r in rows}
    assert all(n <= allowed[(m, source.get(i))] for (m, i), n in most.items() if i in source)
    report = {(r["mix_id"], r["source"]): r for r in mixing.mix_report(sizes, rated).collect()}
    assert len(report) == len(targets)
    r = report[("m", "big")]
    assert abs(r["actual_tokens"] - r["wanted_tokens"]) < 0.05 * r["wanted_tokens"] and not r["short"]
    assert report[("m", "mid")]["actual_tokens"] == min(1, 1) * size["mid"] and report[("m", "mid")]["short"] == (size["mid"] < 0.3 * 0.6 * total)
    assert report[("m2", "gone")]["actual_tokens"] == 0 and report[("m2", "gone")]["short"] and not report[("m3", "big")]["short"]
    assert mixing.mixed(sizes, rated).count() == sum(most.values())


@HAVE
def test_mix_of_nothing(spark):
    sizes = mixing.sized(docs(spark, []), Workspace(spark))
    rated = mixing.rates(sizes, spark.createDataFrame([("m", "s", 1.0, 1, 1.0)], TARGETS))
    assert mixing.short_sources(rated).count() == 0 and mixing.mixed(sizes, rated).count() == 0 and mixing.mix_report(sizes, rated).count() == 1


SAME = [
    ("Film on lens", "Ｆｉｌｍ　ｏｎ　ｌｅｎｓ"), ("office flow", "oﬃce ﬂow"), ("café über", "café über"), ("soft ware", "soft­ ​ware﻿"), ("a b", " a \n b\t"), ("scope", "ѕсоре"), ("HOT", "НОТ"),
    ("ёж", "ёж"), ("ëж", "ёж"), ("10 µm", "10 μm"), ("5 Ω", "5 Ω"), ("273 K", "273 K"), ("Å", "A͏̊"), ("well-known", "well‑known"), ("well-known", "well‐known"), ("ガラス", "ｶﾞﾗｽ"), ("o", "օ"), ("ΑΒΕ", "ABE"), ("ό", "ó"), ("Ή", "H́"), ("ĳ", "ij"),
    ("right", "ri‮ght"), ("go", "ɡo"),
    ("pau", "ραυ"), ("ABC", "ꓮꓐꓚ"), ("AC", "ᎪᏟ"), ("DATE", "ᎠᎪᎢᎬ"), ("OK", "ⲞⲔ"), ("VIII", "Ⅷ"), ("li", "ⅼⅰ"), ("ice", "ісҽ"), ("hou", "հօս"),
]
OTHER = [("cafe", "café"), ("Film", "film"), ("a,b", "a.b"), ("O", "0"), ("l", "1"), ("ab", "a b"), ("x²", "x2"), ("①", "1"), ("’", "'"), ("–", "-"), ("ß", "ss"), ("ø", "o"), ("и", "u"), ("a", "а́"), ("½", "1/2"), ("𝐀", "A"), ("й", "и"), ("ﬁ", "fl")]


def forms(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["form"] for r in visual.with_form(df).collect()}
    return [got[i] for i in range(len(texts))]


def test_forms_of_texts_that_look_the_same(spark):
    got = forms(spark, [t for p in SAME for t in p])
    assert [p for p, a, b in zip(SAME, got[::2], got[1::2]) if a != b] == []


def test_forms_of_texts_that_look_different(spark):
    got = forms(spark, [t for p in OTHER for t in p])
    assert [p for p, a, b in zip(OTHER, got[::2], got[1::2]) if a == b] == []


def test_form_is_a_fixed_point_and_keeps_whole_texts(spark):
    texts = [*TEXTS, "x" * 200_000 + "é", *(t for p in SAME + OTHER for t in p)]
    once = forms(spark, texts)
    assert forms(spark, once) == once
    assert once[texts.index(None)] is None and once[texts.index("")] == "" and once[len(TEXTS)] == "x" * 200_000 + "é"


def test_slices_are_bounded_by_bytes(monkeypatch):
    import pyarrow as pa

    texts = ["a" * 10, None, "b" * 500, "c", "", "é" * 40, "d" * 3]
    monkeypatch.setattr(visual, "SLICE_BYTES", 90)
    parts = [p.column("text").to_pylist() for p in visual._slices(pa.RecordBatch.from_pydict({"text": texts}))]
    assert sum(parts, []) == texts and all(len(p) == 1 or sum(len((t or "").encode()) for t in p) <= 90 for p in parts) and len(parts) == 3
    monkeypatch.setattr(visual, "SLICE_ROWS", 2)
    assert max(p.num_rows for p in visual._slices(pa.RecordBatch.from_pydict({"text": texts}))) == 2


def by_hand(t):
    """The same form without DuckDB, for texts of letters, accents and blanks."""
    out = []
    for ch in unicodedata.normalize("NFD", "".join(c for c in t if not any(a <= ord(c) <= b for a, b in visual.INVISIBLE))):
        parts = unicodedata.decomposition(ch).split()
        if parts and (parts[0] in ("<wide>", "<narrow>") or any(a <= ord(ch) <= b for a, b in visual.LIGATURES)):
            ch = "".join(chr(int(x, 16)) for x in parts[1:])
        out += [visual.LOOK_ALIKES.get(c, visual.TWINS.get(c, c)) for c in ch]
    return " ".join(unicodedata.normalize("NFC", "".join(out)).split())


def test_pairs_and_classes_against_all_pairs(spark):
    rng = random.Random(4)
    swap = {v: k for k, v in visual.LOOK_ALIKES.items()}
    base = ["Clean lens today", "Schöne Grüße", "Ёлка", "office", "x"]
    changes = [
        lambda t: "".join(swap.get(c, c) if rng.random() < 0.4 else c for c in t), lambda t: unicodedata.normalize("NFD", t), lambda t: t.replace(" ", rng.choice([" ", "  ", "\n"])), lambda t: t + rng.choice(["", " ", "​"]),
        lambda t: "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" and rng.random() < 0.3 else c for c in t), lambda t: t, lambda t: t.replace("ffi", "ﬃ"), lambda t: t.upper(),
    ]
    texts = [rng.choice(changes)(rng.choice(changes)(rng.choice(base))) for _ in range(150)] + [None, "", " ", "​", " ", "x"]
    df = docs(spark, texts)
    got = {tuple(r) for r in visual.same_look_pairs(df).collect()}
    f = [by_hand(t) if t else None for t in texts]
    want = {(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts)) if f[a] and f[a] == f[b] and texts[a] != texts[b]}
    assert got == want
    classes = {r["doc_id"]: (r["class_id"], r["n_docs"], r["n_texts"]) for r in visual.same_look_classes(df).collect()}
    assert classes == {i: (f.index(x), f.count(x), len({t for t, y in zip(texts, f) if y == x})) for i, x in enumerate(f) if x}
    assert visual.same_look_pairs(df.where("false")).count() == 0
