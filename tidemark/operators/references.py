"""References to records that don't exist: dictionary, bitmaps per key range and period, AND-NOT, decoded bits.

A *reference* is a child record that names the key of a parent at a time t. It holds if the parent table has a row of that key
that arrived at or before t and wasn't withdrawn by t.

1. References are gathered into cells (space, key, period) with map-side combining: however many children name one
   parent, a cell is one bit.
2. The distinct referenced keys are sorted and numbered (dictionary encoding); consecutive numbers are 64-bit words, the key ranges. The dictionary is
   written to the shared folder, since its numbers must not change when a lost executor's work is done again.
3. Per (word, period) two bitmaps are built as integers with ``bit_or``: referenced keys, and keys whose parent is present through the whole
   period. Words without a set bit aren't stored, which is the compression. A parent that never leaves again is stored once, in the period it
   arrives in, and a running OR over the periods of its word carries it on; a stay that ends is stored twice, as switches that a running XOR
   carries on.
4. ``referenced & ~present`` leaves the bits that need a look: keys without a parent, and keys whose parent arrives or leaves in that period.
   They are decoded through the dictionary and only their references are compared with the exact times.

That a key has no parent at all is known from the join that makes the dictionary; the bitmaps settle all keys that are there through a period, nearly all references, without
looking at one of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.keys import key
from tidemark.sources.workspace import Workspace

SALTS = 16


@dataclass(frozen=True)
class Child:
    """A referring field. ``own``: the child's key; ``ref``: the named key; ``at``: the row's time; ``space``: of the parents it names."""

    table: str
    field: str
    rows: DataFrame
    own: str
    ref: str
    at: str
    space: str


@dataclass(frozen=True)
class Parent:
    """The parents of a key space, with the times from which a row is there and (or null) no longer there."""

    space: str
    rows: DataFrame
    key: str
    since: str
    until: str


def _references(children: list[Child]) -> DataFrame:
    """Distinct (child_table, ref_field, space, child, ref, t, salt); t is the smallest time of all rows of the child's key."""
    parts = []
    by_source: dict[tuple, list[Child]] = {}
    for c in children:
        by_source.setdefault((c.table, id(c.rows), c.own, c.at), []).append(c)
    for (name, _, own, at), same in by_source.items():
        refs = [key(c.ref).alias(f"__r{i}") for i, c in enumerate(same)]
        rows = same[0].rows.select(key(own).alias("child"), F.col(at).alias("t"), *refs).where(F.col("child").isNotNull())
        cols = [f"__r{i}" for i in range(len(same))]
        # the least time combines before the shuffle, so a child of any number of rows is no task of its own
        first = rows.select("child", *cols).distinct().join(rows.groupBy("child").agg(F.min("t").alias("t")), "child")
        named = F.array(*[
            F.struct(F.lit(c.field).alias("ref_field"), F.lit(c.space).alias("space"), F.col(f"__r{i}").alias("ref")) for i, c in enumerate(same)
        ])
        parts.append(first.select(F.lit(name).alias("child_table"), "child", "t", F.inline(named)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where(F.col("ref").isNotNull()).withColumn("salt", F.pmod(F.xxhash64("child"), F.lit(SALTS)).cast("int"))


def _islands(stays: DataFrame, *by: str) -> DataFrame:
    """(by..., since, until): stays that touch or overlap joined, without gathering them: a new one begins where all before have ended."""
    inside = Window.partitionBy(*by).orderBy("since", "until")
    ended = F.max("until").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    begun = stays.withColumn("__new", F.when(ended >= F.col("since"), 0).otherwise(1))
    return begun.withColumn("__island", F.sum("__new").over(inside)).groupBy(*by, "__island").agg(F.min("since").alias("since"), F.max("until").alias("until")).drop("__island")


def _lifetimes(parents: list[Parent]) -> tuple[DataFrame, DataFrame]:
    """((space, key, always_since), (space, key, since, until)): from always_since the key is there for good; the withdrawn stays, disjoint.

    Stays are joined by key and day first and then by key, so that what meets in a task is the days' islands, not the rows of a key.
    """
    forever = F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")
    rows = None
    for p in parents:
        one = p.rows.select(F.lit(p.space).alias("space"), key(p.key).alias("key"), F.col(p.since).cast("timestamp_ntz").alias("since"), F.coalesce(F.col(p.until).cast("timestamp_ntz"), forever).alias("until"))
        rows = one if rows is None else rows.unionByName(one)
    rows = rows.where(F.col("key").isNotNull() & F.col("since").isNotNull() & (F.col("until") > F.col("since")))
    always = rows.where(F.col("until") == forever).groupBy("space", "key").agg(F.min("since").alias("always_since"))
    closed = rows.where(F.col("until") < forever).distinct().withColumn("day", F.col("since").cast("date"))
    return always, _islands(_islands(closed, "space", "key", "day").drop("day"), "space", "key")


def orphan_references(children: list[Child], parents: list[Parent], period: str = "day") -> DataFrame:
    """The references that fail: distinct (child_table, ref_field, image_id, ref, t, why), image_id being the child's key.

    ``period``: the width of a bitmap's period, ``day`` or ``month``; it changes the work, not the result. ``why``: ``missing`` (the key was never
    there), ``later`` (it arrives after t) or ``withdrawn`` (it was there before t, but not at t). Null or blank keys are no references,
    children without a key have no time and don't come out, a child whose times are all null fails, as nothing is there at no time. Parents
    without arrival time, or withdrawn before they arrive, are never there. Repeated rows count once. Empty tables: no parents make every
    reference fail, no children give no rows. Columns beyond those named are not read, so their names can't clash.
    """
    spark = children[0].rows.sparkSession
    work = Workspace(spark)
    number = (lambda c: F.date_diff(c.cast("date"), F.lit("1970-01-01").cast("date"))) if period == "day" else (lambda c: F.year(c) * 12 + F.month(c))
    refs = work.cut(_references(children).withColumn("t", F.col("t").cast("timestamp_ntz")).withColumn("period", number(F.col("t"))), "references")
    cells = refs.groupBy("space", F.col("ref").alias("key"), "period").agg(F.count(F.lit(1)).alias("n"))
    named = cells.select("space", "key").distinct()
    always, stays = _lifetimes(parents)
    dictionary = work.cut(named.join(always, ["space", "key"], "left").sort("space", "key").select(F.monotonically_increasing_id().alias("id"), "*"), "dictionary")
    named_stays = stays.join(dictionary.select("space", "key", "id", "always_since"), ["space", "key"]).where("always_since is null or since < always_since")
    stays = work.cut(named_stays.select("id", "since", "until"), "stays")

    word, bit = F.shiftright("id", 6).alias("word"), F.expr("shiftleft(1L, cast(id % 64 as int))")
    first = number(F.col("always_since"))
    referenced = (
        cells.join(dictionary.select("space", "key", "id"), ["space", "key"])
        .groupBy(word, "period").agg(F.bit_or(bit).alias("referenced"))
    )
    for_good = dictionary.where(F.col("always_since").isNotNull()).select(word, bit.alias("bit"), (first + 1).alias("period"))
    whole = stays.select(word, bit.alias("bit"), (number(F.col("since")) + 1).alias("p"), number(F.col("until")).alias("q")).where("p < q")
    # a stay is two switches, on and off, however long it is: the stays of a key don't overlap
    whole = whole.select("word", F.explode(F.array("p", "q")).alias("period"), "bit")
    none = F.lit(0).cast("bigint")
    words = (
        referenced.select("word", "period", "referenced", none.alias("settled"), none.alias("stay"))
        .unionAll(for_good.groupBy("word", "period").agg(F.bit_or("bit").alias("settled")).select("word", "period", none.alias("referenced"), "settled", none.alias("stay")))
        .unionAll(whole.groupBy("word", "period").agg(F.bit_xor("bit").alias("stay")).select("word", "period", none.alias("referenced"), none.alias("settled"), "stay"))
        .groupBy("word", "period").agg(*[F.bit_or(c).alias(c) for c in ("referenced", "settled", "stay")])
    )
    running = Window.partitionBy("word").orderBy("period").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = words.withColumn("present", F.bit_or("settled").over(running).bitwiseOR(F.bit_xor("stay").over(running))).select(
        "word", "period", F.col("referenced").bitwiseAND(F.bitwise_not("present")).alias("left")
    ).where("left <> 0")
    bits = left.select("word", "period", F.explode(F.expr("filter(sequence(0, 63), i -> (shiftright(left, i) & 1) = 1)")).alias("i"))
    suspects = bits.select((F.shiftleft("word", 6) + F.col("i")).alias("id"), "period").join(dictionary, "id")
    # a stay matters in the periods in which it begins and ends: between the two the key is settled, outside it isn't there
    touching = stays.select("id", "since", "until", F.explode(F.array_distinct(F.array(number(F.col("since")), number(F.col("until"))))).alias("period"))
    spans = touching.groupBy("id", "period").agg(F.collect_list(F.struct("since", "until")).alias("spans"))
    bounds = stays.groupBy("id").agg(F.min("until").alias("first_until"), F.max("since").alias("last_since"))
    suspects = suspects.join(spans, ["id", "period"], "left").join(bounds, "id", "left")

    salted = suspects.select(
        "space", F.col("key").alias("ref"), "period", "always_since", "first_until", "last_since", "spans", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    t, since = F.col("t"), F.col("always_since")
    holds = F.coalesce(since <= t, F.lit(False)) | F.coalesce(F.exists("spans", lambda x: (x["since"] <= t) & (t < x["until"])), F.lit(False))
    before = F.coalesce(F.col("first_until") <= t, F.lit(False))
    after = since.isNotNull() | F.coalesce(F.col("last_since") > t, F.lit(False))
    timed = refs.where(t.isNotNull()).join(salted, ["space", "ref", "period", "salt"]).where(~holds).select(
        "child_table", "ref_field", F.col("child").alias("image_id"), "ref", "t",
        F.when(before, "withdrawn").when(after, "later").otherwise("missing").alias("why"),
    )
    untimed = refs.where(t.isNull()).select("child_table", "ref_field", F.col("child").alias("image_id"), "ref", "t", F.lit("missing").alias("why"))
    return timed.unionAll(untimed)


def orphans_found(failed: DataFrame) -> DataFrame:
    """Distinct (child_table, ref_field, image_id)."""
    return failed.select("child_table", "ref_field", "image_id").distinct()


def orphans_by_month(failed: DataFrame) -> DataFrame:
    """Counts per referring table, field, month of t and reason: failing references, and distinct children."""
    return failed.groupBy("child_table", "ref_field", F.date_format("t", "yyyy-MM").alias("month"), "why").agg(
        F.count(F.lit(1)).alias("n_references"), F.countDistinct("image_id").alias("n_images")
    )
