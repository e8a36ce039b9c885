"""Encoding a corpus with a public byte-level BPE through a table of its distinct words.

The tokenizer never merges across the words its pattern cuts a text into, so a word has the same ids wherever it stands. Words are cut in Spark
(``regexp_extract_all``), counted with map-side combining, and each distinct word is encoded once, in Arrow batches. The ids go back by position:

* the most frequent words (at most ``HOT_WORDS``, of at most ``HOT_BYTES`` bytes each: a bounded table, broadcast) are looked up for whole Arrow batches of word
  lists at once; a document stays one row, so nothing is exploded, gathered or shuffled for them;
* the others, a few per cent of the places and each of low frequency, are left as gaps with their words, filled by an equi-join on the word and put back into the gaps.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.sources.workspace import Workspace, ship

TOKENIZERS = "/opt/tokenizers"
HOT_WORDS = 65_536
HOT_BYTES = 256
#: Fixed value: the pattern by which byte_bpe_50k cuts texts into words; (?U) makes Java's \s mean Unicode white space. No two of the alternatives up to the
#: contractions can match at one place, so the commonest stand first; possessive runs save Java the way back, which none of them needs.
PATTERN = r"(?U) ?\p{L}++| ?\p{N}++|'(?:s|t|re|ve|m|ll|d)| ?[^\s\p{L}\p{N}]++|\s+(?!\S)|\s+"
#: Texts with characters that this Java doesn't know yet are cut by the tokenizer itself.
UNKNOWN = r"\p{Cn}"


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{path}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return t


def _cutter(path: str):
    @pandas_udf(T.ArrayType(T.StringType()))
    def cut(texts: pd.Series) -> pd.Series:
        pre = _tokenizer(path).pre_tokenizer
        return texts.map(lambda t: None if t is None else [t[a:b] for _, (a, b) in pre.pre_tokenize_str(t)])

    return cut


def _one_each(docs: DataFrame, id: str, text: str, also: str | None = None) -> DataFrame:
    """(id, text, also): one row per id, of repeated ids the smallest non-empty text and the smallest ``also``.

    Only the ids are shuffled to see whether any repeats; only the rows of those that do are gathered.
    """
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), (F.col(also) if also else F.lit(None).cast("string")).alias("also"))
    repeated = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("id").alias("again"))
    if repeated.isEmpty():
        return rows
    same = F.col("id").eqNullSafe(F.col("again"))
    least = rows.join(repeated, same, "left_semi").groupBy("id").agg(F.min(F.when(F.col("text") != "", F.col("text"))).alias("text"), F.min("also").alias("also"))
    return rows.join(repeated, same, "left_anti").unionByName(least)


def _split(rows: DataFrame) -> DataFrame:
    """``rows`` with words (null for a null or empty text) and odd: the text, where the tokenizer must cut it."""
    odd = F.rlike("text", F.lit(UNKNOWN))
    there = F.col("text") != ""
    return rows.withColumn("words", F.when(there & ~odd, F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)))).withColumn("odd", F.when(there & odd, F.col("text"))).drop("text")


def words(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str = TOKENIZERS) -> DataFrame:
    """(id, pos, word) of every non-empty text, the whole text: joined in order of pos the words give it back.

    Of several rows with one id the smallest text counts. Null and empty texts give no rows.
    """
    ship(docs.sparkSession)
    cut = _split(_one_each(docs, id, text))
    plain = cut.where("words is not null").select("id", F.posexplode("words").alias("pos", "word"))
    rest = cut.where("odd is not null").select("id", F.posexplode(_cutter(path)("odd")).alias("pos", "word"))
    return plain.unionAll(rest).withColumnRenamed("id", id)


def _slices(batches: Iterator[pa.RecordBatch], most: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of about ``most`` words."""
    for batch in batches:
        sizes = np.cumsum(np.asarray(batch.column("words").value_lengths().fill_null(0)))
        at = 0
        while at < batch.num_rows:
            done = int(sizes[at - 1]) if at else 0
            upto = max(at + 1, int(np.searchsorted(sizes, done + most, "right")))
            yield batch.slice(at, upto - at)
            at = upto


def _lists(batch: pa.RecordBatch, path: str) -> pa.ListArray:
    """The words of each row, those of odd texts cut by the tokenizer."""
    cut, odd = batch.column("words"), batch.column("odd")
    if odd.null_count == batch.num_rows:
        return cut
    pre = _tokenizer(path).pre_tokenizer
    by_hand = [w if t is None else [t[a:b] for _, (a, b) in pre.pre_tokenize_str(t)] for w, t in zip(cut.to_pylist(), odd.to_pylist())]
    return pa.array(by_hand, pa.list_(pa.string()))


def _count(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """(word, n) of each slice: counted before anything is shuffled."""
    for batch in _slices(batches):
        counted = _lists(batch, path).flatten().value_counts()
        yield pa.RecordBatch.from_arrays([counted.field("values"), counted.field("counts")], names=["word", "n"])


def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    t = _tokenizer(path)
    for batch in batches:
        made = t.encode_batch(batch.column("word").to_pylist(), add_special_tokens=False)
        ids = pa.array([x.ids for x in made], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), ids], names=["word", "n", "ids"])


class WordTable:
    """The distinct words of a corpus with their frequency and ids, written to the shared folder; ``hot``: the bounded part that is broadcast.

    ``rows``: one row per document, from :func:`_one_each`. The driver sees 64 numbers and the hot words: HOT_WORDS rows of HOT_BYTES at most.
    """

    def __init__(self, rows: DataFrame, work: Workspace, path: str = TOKENIZERS):
        ship(rows.sparkSession)
        cut = _split(rows).select("words", "odd")
        counts = cut.mapInArrow(lambda it: _count(it, path), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
        self.all = work.cut(counts.mapInArrow(lambda it: _encode(it, path), "word string, n bigint, ids array<int>"), "words")
        # the least power of two that no more than HOT_WORDS words reach
        short = self.all.where(F.octet_length("word") <= HOT_BYTES)
        powers = short.groupBy(F.floor(F.log2("n")).cast("int").alias("k")).count().collect()
        reach, least = 0, 62
        for k, n in sorted(((r["k"], r["count"]) for r in powers), reverse=True):
            if reach + n > HOT_WORDS:
                break
            reach, least = reach + n, k
        sink = pa.BufferOutputStream()
        hot = short.where(F.col("n") >= F.lit(2**least)).select("word", "ids").toArrow()
        with pa.ipc.new_stream(sink, hot.schema) as out:
            out.write_table(hot)
        self.hot = rows.sparkSession.sparkContext.broadcast(sink.getvalue().to_pybytes())


def _look_up(batches: Iterator[pa.RecordBatch], hot, path: str, gather: bool, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """(id, also, n, ids, gaps) of (id, also, words, odd): the ids of the hot words in order, and at which of their places which other words stand."""
    table = pa.ipc.open_stream(hot.value).read_all().combine_chunks()
    known = table["word"].combine_chunks() if table.num_rows else pa.array([], pa.string())
    lists = table["ids"].combine_chunks() if table.num_rows else pa.array([], pa.list_(pa.int32()))
    flat_ids, starts = np.asarray(lists.values), np.asarray(lists.offsets)
    lengths = np.append(np.diff(starts), 0)
    for batch in _slices(batches):
        cut = _lists(batch, path)
        per_row = np.asarray(cut.value_lengths().fill_null(0))
        found = cut.flatten()
        place = np.asarray(pc.fill_null(pc.index_in(found, value_set=known), len(known)))
        size = lengths[place]
        # tokens before each word of the batch, and before each row
        upto = np.concatenate([[0], np.cumsum(size)])
        rows = np.concatenate([[0], np.cumsum(per_row)])
        before = upto[rows]
        missing = np.nonzero(place == len(known))[0]
        owner = np.searchsorted(rows, missing, "right") - 1
        gap = pa.StructArray.from_arrays([pa.array((upto[missing] - before[owner]).astype(np.int32)), found.take(pa.array(missing))], names=["at", "word"])
        gaps = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(per_row) + 1)).astype(np.int32)), gap)
        if gather:
            hit = np.nonzero(place < len(known))[0]
            source = np.arange(upto[-1]) + np.repeat(starts[place[hit]] - upto[hit], size[hit])
            ids = pa.ListArray.from_arrays(pa.array(before.astype(np.int32)), pa.array(flat_ids[source], pa.int32()))
        else:
            ids = pa.nulls(batch.num_rows, pa.list_(pa.int32()))
        made = [batch.column("id"), batch.column("also"), pa.array(np.diff(before).astype(np.int64)), ids, gaps]
        yield from pa.Table.from_arrays(made, names=schema.names).cast(schema).to_batches()


def _with_gaps(rows: DataFrame, table: WordTable, work: Workspace, path: str, gather: bool) -> DataFrame:
    """(id, also, n, ids, gaps), written to the shared folder: texts are cut and looked up once."""
    cut = _split(rows).select("id", "also", "words", "odd")
    gap = T.StructType([T.StructField("at", T.IntegerType()), T.StructField("word", T.StringType())])
    made = [T.StructField("n", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("gaps", T.ArrayType(gap))]
    schema = T.StructType([cut.schema["id"], cut.schema["also"], *made])
    arrow, hot = to_arrow_schema(schema), table.hot
    return work.cut(cut.mapInArrow(lambda it: _look_up(it, hot, path, gather, arrow), schema), "gaps")


def _in_gaps(half: DataFrame, table: WordTable, found: Column) -> DataFrame:
    """(k, i, at, found) of every gap: k is the document's id in a struct, so that a null id is a key like any other."""
    missing = half.where("size(gaps) > 0").select(F.struct("id").alias("k"), F.posexplode("gaps").alias("i", "gap")).select("k", "i", "gap.at", "gap.word")
    return missing.join(table.all.select("word", found.alias("found")), "word").select("k", "i", "at", "found")


def encode(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str = TOKENIZERS) -> DataFrame:
    """(id, ids array<int>): each id once, without special tokens; an empty list for an empty and for a null text.

    Rows with a null id come out as one row with the smallest text of them, like any repeated id. Strings of special tokens are ordinary text.
    """
    work, rows = Workspace(docs.sparkSession), _one_each(docs, id, text)
    table = WordTable(rows, work, path)
    half = _with_gaps(rows, table, work, path, True)
    fill = _in_gaps(half, table, F.col("ids")).groupBy("k").agg(F.array_sort(F.collect_list(F.struct("i", "at", F.col("found").alias("ids")))).alias("fill"))
    both = half.where("size(gaps) > 0").select(F.struct("id").alias("k"), "ids").join(fill, "k")
    # the ids up to a gap, the gap's own, and so on; then what follows the last gap
    before = lambda i: F.when(i == 0, 0).otherwise(F.get("fill", i - 1)["at"])
    pieces_ = F.transform("fill", lambda x, i: F.concat(F.slice("ids", before(i) + 1, x["at"] - before(i)), x["ids"]))
    last = F.element_at("fill", -1)["at"]
    whole = F.concat(F.flatten(pieces_), F.slice("ids", last + 1, F.size("ids") - last))
    return half.where("size(gaps) = 0").select(F.col("id").alias(id), "ids").unionAll(both.select(F.col("k.id").alias(id), whole.alias("ids")))


def sized(docs: DataFrame, also: str | None = None, id: str = "doc_id", text: str = "text", path: str = TOKENIZERS) -> DataFrame:
    """(id, also, n_tokens bigint): each id once, 0 for a null or empty text; the ids themselves aren't gathered. ``also``: a column that comes along (the least of a repeated id)."""
    work, rows = Workspace(docs.sparkSession), _one_each(docs, id, text, also)
    table = WordTable(rows, work, path)
    half = _with_gaps(rows, table, work, path, False)
    more = _in_gaps(half, table, F.size("ids").cast("bigint")).groupBy("k").agg(F.sum("found").alias("more"))
    both = half.where("size(gaps) > 0").select(F.struct("id").alias("k"), "also", "n").join(more, "k").select("k.id", "also", (F.col("n") + F.col("more")).alias("n_tokens"))
    return half.where("size(gaps) = 0").select("id", "also", F.col("n").alias("n_tokens")).unionAll(both).select(F.col("id").alias(id), *([F.col("also").alias(also)] if also else []), "n_tokens")


def token_counts(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str = TOKENIZERS) -> DataFrame:
    """(id, n_tokens bigint) of every non-empty text."""
    return sized(docs.where(F.col(text) != ""), None, id, text, path)


def pieces(spark: SparkSession, path: str = TOKENIZERS) -> DataFrame:
    """(token, piece binary) of the whole vocabulary: 50,257 rows at most, read from the tokenizer's rank file."""
    import base64

    ranks = [line.split() for line in Path(path, "byte_bpe_50k.tiktoken").read_bytes().splitlines() if line]
    return spark.createDataFrame(pd.DataFrame({"token": [int(b) for _, b in ranks], "piece": [base64.b64decode(a) for a, _ in ranks]}), "token int, piece binary")


def decode(encoded: DataFrame, id: str = "doc_id", path: str = TOKENIZERS) -> DataFrame:
    """(id, text) from (id, ids) by a join of ids with pieces; an empty list gives an empty text, an id outside the vocabulary no piece."""
    spark = encoded.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    placed = encoded.repartition(parts, id).select(id, F.posexplode_outer("ids").alias("pos", "token"))
    named = placed.join(F.broadcast(pieces(spark, path)), "token", "left")
    bytes_of = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", F.hex("piece").alias("h"))))), lambda x: x["h"]), "")
    return named.groupBy(id).agg(F.unhex(bytes_of).cast("string").alias("text"))


def decoded(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str = TOKENIZERS) -> DataFrame:
    """(id, text) of every document after encoding and decoding: the text itself, empty for a null text."""
    return decode(Workspace(docs.sparkSession).cut(encode(docs, id, text, path), "encoded"), id, path)


def round_trip(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str = TOKENIZERS) -> DataFrame:
    """(id, n_tokens, same): whether decoding gives the text back; null and empty texts decode to an empty text."""
    encoded = Workspace(docs.sparkSession).cut(encode(docs, id, text, path), "encoded")
    before = docs.groupBy(F.col(id).alias("id")).agg(F.coalesce(F.min(F.when(F.col(text) != "", F.col(text))), F.lit("")).alias("before"))
    joined = encoded.select(F.col(id).alias("eid"), F.size("ids").cast("bigint").alias("n_tokens")).join(decode(encoded, id, path), F.col("eid").eqNullSafe(F.col(id)))
    return joined.join(before, F.col("eid").eqNullSafe(F.col("id"))).select(F.col("eid").alias(id), "n_tokens", (F.col("text") == F.col("before")).alias("same"))
