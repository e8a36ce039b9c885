"""Exact ranks, running sums and percentiles within groups of any size: by ranges of a hash or of the values, never a group in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_BITS = 10
#: Relative width of a range of values.
RANGE_WIDTH = 0.0005
_ENDS = 4_000_000


def value_range(value: Column) -> Column:
    """The number of the signed logarithmic range that a double lies in: larger values have no smaller number. Zero is a range of its own, infinities are the outermost."""
    size = F.ceil(F.ln(F.abs(value)) / RANGE_WIDTH) + _ENDS // 2
    size = F.when(F.abs(value) == F.lit(float("inf")), F.lit(_ENDS)).otherwise(size)
    return F.when(value == 0, 0).when(value > 0, size).otherwise(-size).cast("int")


def equal_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join on equal keys, null being a key like any other; the right side's keys are dropped."""
    other = right.select(*[F.col(k).alias(f"__{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{i}")) for i, k in enumerate(keys)]) if keys else F.lit(True)
    return left.join(other, on, how).drop(*[f"__{i}" for i in range(len(keys))])


def running(counted: DataFrame, by: list[str], value: str, sums: list[str], descending: bool = False) -> DataFrame:
    """``counted`` (one row per group and value) with <s>_before and <s>_total for each of ``sums``, and __next: the next value of the group.

    <s>_before: the sum over the group's values before this one, in ascending or descending order. The values are cut into ranges: sums per range, offsets by a window over the ranges of a
    group (some thousands), and a window over the values of one range. ``value`` must be a number that isn't NaN; null group keys are a group. Names that begin with ``__`` are reserved.
    """
    order = F.desc if descending else F.asc
    rows = counted.withColumn("__r", value_range(F.col(value).cast("double")))
    first = F.max(value) if descending else F.min(value)
    parts = rows.groupBy(*by, "__r").agg(*[F.sum(s).alias(s) for s in sums], first.alias("__first"))
    whole = Window.partitionBy(*by)
    along = whole.orderBy(order("__r"))
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *by, "__r", *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"__{s}") for s in sums], *[F.sum(s).over(whole).alias(f"{s}_total") for s in sums],
        F.lead("__first").over(along).alias("__then"),
    )
    inside = Window.partitionBy(*by, "__r").orderBy(order(value))
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    return equal_join(rows, offsets, [*by, "__r"]).select(
        *counted.columns, *[(F.col(f"__{s}") + F.coalesce(F.sum(s).over(upto), F.lit(0))).alias(f"{s}_before") for s in sums], *[f"{s}_total" for s in sums],
        F.coalesce(F.lead(value).over(inside), F.col("__then")).alias("__next"),
    )


def percentiles(values: DataFrame, by: list[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """(by..., n, <name>...): exact percentiles, interpolated between the two values next to the place q (n - 1).

    Counts per range of values tell in which ranges the wanted places lie; only the values of those few ranges are looked at, counted per value and added up within the range. So neither a
    buffer of all values nor a sort of a group is needed. Null and NaN aren't values; a group without values has no row.
    """
    known = values.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(*by, F.col(value).cast("double").alias("__v"))
    known = known.withColumn("__r", value_range(F.col("__v")))
    whole = Window.partitionBy(*by)
    before = whole.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    parts = known.groupBy(*by, "__r").agg(F.count(F.lit(1)).alias("__c"))
    parts = parts.withColumn("__before", F.coalesce(F.sum("__c").over(before), F.lit(0))).withColumn("n", F.sum("__c").over(whole))
    place = {k: F.lit(float(q)) * (F.col("n") - 1) for k, q in quantiles.items()}
    ends = {k: (F.floor(p), F.ceil(p)) for k, p in place.items()}
    holds = lambda at: (F.col("__before") <= at) & (at < F.col("__before") + F.col("__c"))
    wanted = parts.where(reduce(lambda a, b: a | b, [holds(at) for pair in ends.values() for at in pair])).select(*by, "__r", "__before", "n")
    counted = equal_join(known, wanted, [*by, "__r"]).groupBy(*by, "__r", "__before", "n", "__v").agg(F.count(F.lit(1)).alias("__c"))
    inside = Window.partitionBy(*by, "__r").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("__before", F.col("__before") + F.coalesce(F.sum("__c").over(inside), F.lit(0)))
    found = counted.groupBy(*by, "n").agg(*[F.max(F.when(holds(at), F.col("__v"))).alias(f"__{e}_{k}") for k, pair in ends.items() for e, at in zip(("lo", "hi"), pair)])
    return found.select(*by, "n", *[(F.col(f"__lo_{k}") + F.when(F.col(f"__lo_{k}") == F.col(f"__hi_{k}"), 0.0).otherwise((F.col(f"__hi_{k}") - F.col(f"__lo_{k}")) * (p - F.floor(p)))).alias(k) for k, p in place.items()])


def range_rank(df: DataFrame, group: list[str], order: str, tie: list[str], out: str = "rank") -> DataFrame:
    """Rank 1, 2, ... of each row within ``group`` by a number that isn't null or NaN, then by ``tie``: a task sorts a range of the numbers, not a group."""
    rows = df.withColumn("__r", value_range(F.col(order).cast("double")))
    before = Window.partitionBy(*group).orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(*group, "__r").agg(F.count(F.lit(1)).alias("__n")).withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    inside = Window.partitionBy(*group, "__r").orderBy(order, *tie)
    return equal_join(rows, offsets, [*group, "__r"]).withColumn(out, (F.row_number().over(inside) + F.col("__before")).cast("bigint")).select(*df.columns, out)


def bucketed_rank(df: DataFrame, group: list[str], order: Column, tie: list[str], out: str = "rank") -> DataFrame:
    """Rank 1, 2, ... of each row within ``group`` by a 64-bit hash, without one task per group.

    ``order``: a bigint hash. The rows of a group are cut by the top bits of the hash into 2**BUCKET_BITS parts; a part's
    rank offset is the number of rows in the parts before it, and only a part is sorted in a task. A group that holds a third of
    all rows is spread evenly, as hashes are. ``tie``: columns that order equal hashes. Null group keys form a group of
    their own. An empty input gives an empty output. The names ``__h``, ``__b`` and ``__before`` are reserved.
    """
    rows = df.withColumn("__h", order).withColumn("__b", F.shiftrightunsigned(F.col("__h"), 64 - BUCKET_BITS).cast("int"))
    sizes = rows.groupBy(*group, "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], F.col("__b").alias("__b2"),
                           F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    on = F.col("__b") == F.col("__b2")
    for i, g in enumerate(group):
        on = on & rows[g].eqNullSafe(F.col(f"__g{i}"))
    inner = Window.partitionBy(*group, "__b").orderBy("__h", *tie)
    return (
        rows.join(offsets, on)
        .withColumn(out, (F.row_number().over(inner) + F.col("__before")).cast("bigint"))
        .select(*df.columns, out)
    )
