"""One form for texts that look the same but differ in their characters.

The form is made by DuckDB inside Arrow partitions: each Python worker hands its batches to an embedded DuckDB and runs one SQL expression
over them (``nfc_normalize``, ``translate``, ``regexp_replace``, ``replace``). Nothing is compared there; equal forms meet by hash in Spark.

What doesn't count: width, ligatures, composition, compatibility twins of letters and hyphens, invisible characters, the script a look-alike
letter is taken from, kind and number of blanks. What counts: accents, case, digits, punctuation, superscripts, circled and styled letters.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.sources.workspace import Workspace, ship

#: Letters of other scripts, and the Latin letters they can't be told from.
LOOK_ALIKES = {
    # Greek
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y",
    "Χ": "X", "ν": "v", "ο": "o", "ϳ": "j", "Ϳ": "J", "α": "a", "ρ": "p", "υ": "u", "ι": "i", "ϲ": "c", "Ϲ": "C",
    # Cyrillic
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "Ѕ": "S", "І": "I",
    "Ј": "J", "Ԛ": "Q", "Ԝ": "W", "Ү": "Y", "Ԍ": "G", "Ӏ": "I", "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i",
    "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѵ": "v", "ҽ": "e", "ү": "y", "ӏ": "l",
    # Armenian and Latin
    "օ": "o", "ո": "n", "ս": "u", "ց": "g", "հ": "h", "զ": "q", "Օ": "O", "Ս": "U", "ɡ": "g", "ɑ": "a", "ı": "i", "ꞵ": "ß",
    # Coptic
    "Ⲃ": "B", "Ⲏ": "H", "Ⲓ": "I", "Ⲕ": "K", "Ⲙ": "M", "Ⲛ": "N", "Ⲟ": "O", "Ⲣ": "P", "Ⲥ": "C", "Ⲧ": "T", "Ⲩ": "Y", "Ⲭ": "X", "ⲟ": "o", "ⲣ": "p", "ⲥ": "c",
    # Cherokee
    "Ꭰ": "D", "Ꭱ": "R", "Ꭲ": "T", "Ꭺ": "A", "Ꭻ": "J", "Ꭼ": "E", "Ꮃ": "W", "Ꮇ": "M", "Ꮋ": "H", "Ꮐ": "G", "Ꮓ": "Z", "Ꮢ": "R", "Ꮤ": "W", "Ꮥ": "S", "Ꮩ": "V", "Ꮪ": "S",
    "Ꮮ": "L", "Ꮯ": "C", "Ꮲ": "P", "Ꮶ": "K", "Ᏼ": "B",
    # Lisu
    "ꓐ": "B", "ꓑ": "P", "ꓓ": "D", "ꓔ": "T", "ꓖ": "G", "ꓗ": "K", "ꓙ": "J", "ꓚ": "C", "ꓜ": "Z", "ꓝ": "F", "ꓟ": "M", "ꓠ": "N", "ꓡ": "L", "ꓢ": "S", "ꓣ": "R", "ꓦ": "V",
    "ꓧ": "H", "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y", "ꓮ": "A", "ꓰ": "E", "ꓲ": "I", "ꓳ": "O", "ꓴ": "U",
}
#: Twins by compatibility that are neither wide nor ligatures.
TWINS = {"μ": "µ", "‐": "-", "‑": "-", "ʼ": "’"}
#: First and last of the runs of code points without a visible mark (Default_Ignorable_Code_Point, controls that aren't blanks).
INVISIBLE = [
    (0x00, 0x08), (0x0E, 0x1B), (0x7F, 0x84), (0x86, 0x9F), (0xAD, 0xAD), (0x34F, 0x34F), (0x61C, 0x61C), (0x115F, 0x1160), (0x17B4, 0x17B5),
    (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0),
    (0xFFF0, 0xFFFB), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A), (0xE0000, 0xE0FFF),
]
#: First and last of the runs of blanks (White_Space, and the four information separators).
BLANKS = [(0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]
#: First and last of the runs of letters that are two or more letters joined, and of the Roman numerals, which are drawn as letters.
LIGATURES = [(0x132, 0x133), (0x1C4, 0x1CC), (0x1F1, 0x1F3), (0x2160, 0x217F), (0xFB00, 0xFB06), (0xFB13, 0xFB17)]
#: A slice that is handed to DuckDB ends at so many bytes of text or so many rows, a longer text being a slice of its own.
SLICE_BYTES, SLICE_ROWS = 8 << 20, 2048
SALTS = 16


def _class(runs: list[tuple[int, int]]) -> str:
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in runs) + "]+"


@cache
def mappings() -> tuple[dict[str, str], dict[str, str]]:
    """(one character to one, one character to several), built by rule from the Unicode database and the fixed values above.

    Wide, narrow and joined letters take one step of their compatibility decomposition; a letter with accents over a look-alike takes the
    Latin letter with the same accents.
    """
    one, several = LOOK_ALIKES | TWINS, {}
    joined = {c for a, b in LIGATURES for c in range(a, b + 1)}
    for c in range(0x80, 0x10000):
        ch, parts = chr(c), unicodedata.decomposition(chr(c)).split()
        if not parts or 0xD800 <= c < 0xE000:
            continue
        if parts[0] in ("<wide>", "<narrow>") or c in joined and parts[0] == "<compat>":
            to = "".join(chr(int(x, 16)) for x in parts[1:])
            to = "".join(LOOK_ALIKES.get(x, TWINS.get(x, x)) for x in unicodedata.normalize("NFC", to))
        elif parts[0][0] != "<":
            base, *marks = unicodedata.normalize("NFD", ch)
            if base not in LOOK_ALIKES or not marks:
                continue
            to = unicodedata.normalize("NFC", LOOK_ALIKES[base] + "".join(marks))
        else:
            continue
        if len(to) == 1:
            one[ch] = to
        else:
            several[ch] = to
    return one, several


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@cache
def _unstable() -> list[tuple[int, int]]:
    """Runs of the code points that NFC may change, alone or beside others: marks, what composes with a letter before it, what has another form, and what this database doesn't know.

    A text without any of them is in NFC.
    """
    second = {int(parts[1], 16) for c in range(0x110000) if len(parts := unicodedata.decomposition(chr(c)).split()) == 2 and parts[0][0] != "<"}
    jamo = {*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)}
    runs: list[tuple[int, int]] = []
    for c in range(0x80, 0x110000):
        ch = chr(c)
        if 0xD800 <= c < 0xE000 or not (c in second or c in jamo or unicodedata.combining(ch) or unicodedata.category(ch) == "Cn" or unicodedata.normalize("NFC", ch) != ch):
            continue
        if runs and runs[-1][1] == c - 1:
            runs[-1] = (runs[-1][0], c)
        else:
            runs.append((c, c))
    return runs


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` for the value, which is computed once."""
    return f"list_transform([{value}], lambda {name}: {body})[1]"


def _one_of(runs: list[tuple[int, int]]) -> str:
    return _class(runs)[:-1]


@cache
def form_sql(column: str = "text") -> str:
    """The DuckDB expression of the one form; null for null.

    Each step is taken only by texts that hold a character it could change: one look each, instead of a rewrite of every text.
    """
    one, several = mappings()
    chain = f"translate(y, {_literal(''.join(one))}, {_literal(''.join(one.values()))})"
    for a, b in several.items():
        chain = f"replace({chain}, {_literal(a)}, {_literal(b)})"
    mapped = _one_of([(ord(c), ord(c)) for c in sorted({*one, *several})])
    # single plain blanks are as they should be
    other = [r for a, b in BLANKS for r in ([(a, b)] if not a <= 0x20 <= b else [(a, 0x1F)])]
    runs = f" {_class(BLANKS)}|{_one_of(other)}{_one_of(BLANKS)}*"
    x = f"regexp_replace({column}, '{_class(INVISIBLE)}', '', 'g')"
    y = _let("x", x, f"case when regexp_matches(x, '{_one_of(_unstable())}') then nfc_normalize(x) else x end")
    z = _let("y", y, f"case when regexp_matches(y, '{mapped}') then nfc_normalize({chain}) else y end")
    return f"trim({_let('z', z, f"case when regexp_matches(z, '{runs}') then regexp_replace(z, '{runs}', ' ', 'g') else z end")})"


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    upto = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0), dtype=np.int64))
    at = 0
    while at < batch.num_rows:
        done = int(upto[at - 1]) if at else 0
        end = min(at + SLICE_ROWS, max(at + 1, int(np.searchsorted(upto, done + SLICE_BYTES, "right"))))
        yield batch.slice(at, end - at)
        at = end


def _in_duckdb(batches: Iterator[pa.RecordBatch], select: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    import duckdb

    # nothing of a slice needs more memory than its bytes allow, and no worker's disk is used
    base = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})
    for batch in batches:
        for part in _slices(batch):
            base.register("part", pa.Table.from_batches([part]))
            made = base.sql(f"select {select}").to_arrow_table()
            base.unregister("part")
            yield from made.cast(schema).to_batches()


def _mapped(docs: DataFrame, id: str, text: str, columns: dict[str, tuple[str, T.DataType]], source: str = "part") -> DataFrame:
    """(id, *columns): DuckDB's expressions over the rows of ``source``, made of ``part(id, text)``."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    schema = T.StructType([rows.schema["id"], *[T.StructField(n, kind, True) for n, (_, kind) in columns.items()]])
    arrow = to_arrow_schema(schema)
    select = ", ".join(["id", *[f"{x} as {n}" for n, (x, _) in columns.items()]])
    return rows.mapInArrow(lambda it: _in_duckdb(it, f"{select} from {source}", arrow), schema).withColumnRenamed("id", id)


def with_form(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, form) of every row; the whole text is mapped. The form of a null text is null, of an empty, blank or invisible text empty."""
    return _mapped(docs, id, text, {"form": (form_sql("text"), T.StringType())})


def _digest(text: str) -> dict[str, tuple[str, T.DataType]]:
    """A 128-bit digest as two bigints: fixed width, so that Spark compares and combines them without objects."""
    half = "({f}({x})::hugeint - 9223372036854775808)::bigint"
    return {"1": (half.format(f="md5_number_upper", x=text), T.LongType()), "2": (half.format(f="md5_number_lower", x=text), T.LongType())}


def _keys(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, r1, r2, f1, f2): text and form as 128-bit digests, of rows whose text has a visible character. Only digests leave the Arrow partitions."""
    raw, form = _digest("text"), _digest("form")
    columns = {**{f"r{k}": v for k, v in raw.items()}, **{f"f{k}": v for k, v in form.items()}}
    made = _mapped(docs, id, text, columns, f"(select id, text, nullif({form_sql('text')}, '') as form from part)")
    # read more than once below: mapped only once
    return Workspace(docs.sparkSession).cut(made.where("f1 is not null"), "forms")


def same_look_classes(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, class_id, n_docs, n_texts) of every row with a visible character: the class is the smallest id with its form.

    n_docs: documents of the class, n_texts: different texts among them. Counting combines on the map side, a class of any size is
    two numbers. Rows with null, empty, blank or invisible text have no class and don't come out. Repeated rows count as often as they come.
    """
    keys = _keys(docs, id, text)
    texts = keys.groupBy("f1", "f2", "r1", "r2").agg(F.min(id).alias("class_id"), F.count(F.lit(1)).alias("n_docs"))
    classes = texts.groupBy("f1", "f2").agg(F.min("class_id").alias("class_id"), F.sum("n_docs").alias("n_docs"), F.count(F.lit(1)).alias("n_texts"))
    return keys.join(classes, ["f1", "f2"]).select(id, "class_id", "n_docs", "n_texts")


def same_look_pairs(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_a, doc_b), doc_a < doc_b: documents whose texts differ but look the same. Distinct; plain copies are no pair.

    Only forms with at least two different texts are joined, by form, with salt: the rows of a form on one side are spread over SALTS parts, so
    that a form with very many copies isn't one task. Null, empty, blank and invisible texts are in no pair.
    """
    keys = _keys(docs, id, text)
    several = keys.groupBy("f1", "f2").agg(*[g(c).alias(f"{n}{c}") for c in ("r1", "r2") for n, g in (("lo", F.min), ("hi", F.max))]).where("lor1 <> hir1 or lor2 <> hir2").select("f1", "f2")
    rows = keys.join(several, ["f1", "f2"])
    left = rows.select("f1", "f2", "r1", "r2", F.col(id).alias("doc_a"), F.pmod(F.xxhash64(id), F.lit(SALTS)).cast("int").alias("salt"))
    right = rows.select("f1", "f2", F.col("r1").alias("s1"), F.col("r2").alias("s2"), F.col(id).alias("doc_b"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return left.join(right, ["f1", "f2", "salt"]).where("doc_a < doc_b and (r1 <> s1 or r2 <> s2)").select("doc_a", "doc_b").distinct()
