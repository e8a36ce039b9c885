"""Percentiles of very large columns within a stated relative error, from bucket counts that add up.

A finite value x falls into bucket (sign, ceil(log_gamma |x|)) with gamma = (1 + a) / (1 - a); both zeros share one bucket. The value
2 gamma^i / (gamma + 1) is within a * |x| of every x of bucket i, so a quantile read from the counts is within the relative error a of the value
that has that rank. Counts of partitions, days or files are added; their number depends on the range of the values and a, not on how many values there are
(at a = 0.01 at most 72,000 per sign over all doubles, about 1,000 in practice).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.keys import finite

ERROR = 0.01
QUANTILES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)


def _log_gamma(error: float) -> float:
    if not 0 < error < 1:
        raise ValueError("the relative error must lie between 0 and 1")
    return math.log((1 + error) / (1 - error))


def _signed_bucket(x: Column, error: float) -> tuple[Column, Column]:
    sign = F.when(x > 0, 1).when(x < 0, -1).otherwise(0)
    return sign, F.when(x == 0, 0).otherwise(F.ceil(F.ln(F.abs(x)) / _log_gamma(error))).cast("int")


def sketch(df: DataFrame, by: list[str], metrics: list[str], error: float = ERROR) -> DataFrame:
    """(by..., metric, sign, bucket, n): bucket counts of the finite values of ``metrics`` per group.

    Nulls, NaN and infinities aren't values. Null group keys form groups of their own; a group without values has no rows; an
    empty table gives an empty sketch. The rows are counted with map-side combining, so a group of any size is no more than its buckets. Names
    of other columns don't matter. Repeated rows count as often as they come.
    """
    values = df.select(*by, F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])))
    sign, bucket = _signed_bucket(F.col("value"), error)
    return values.where(finite(F.col("value"))).select(*by, "metric", sign.alias("sign"), bucket.alias("bucket")).groupBy(*by, "metric", "sign", "bucket").agg(F.count(F.lit(1)).alias("n"))


def combine(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Add sketches of the same error over fewer group columns: the sketch that all their rows together would have given."""
    return sketches.groupBy(*by, "metric", "sign", "bucket").agg(F.sum("n").alias("n"))


def percentiles(sketches: DataFrame, by: list[str], quantiles: tuple[float, ...] = QUANTILES, error: float = ERROR) -> DataFrame:
    """(by..., metric, q, n, estimate): the value of rank floor(q * (n - 1)) from below, within ``error`` of it relatively.

    n: values of the group. Buckets are ordered by sign, then outwards or inwards by their number, which may be of either sign. The window runs over the buckets of a group, whose number is bounded; not over its values. Zero is exact.
    """
    group = Window.partitionBy(*by, "metric")
    upto = group.orderBy("sign", F.col("sign") * F.col("bucket")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = sketches.withColumn("upto", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(group))
    ranks = F.array(*[F.struct(F.lit(float(q)).alias("q"), F.floor(F.lit(float(q)) * (F.col("total") - 1)).alias("rank")) for q in quantiles])
    hit = counted.select(*by, "metric", "sign", "bucket", "n", "upto", "total", F.inline(ranks)).where("rank < upto and rank >= upto - n")
    lg = _log_gamma(error)
    size = F.exp(F.col("bucket") * F.lit(lg)) * F.lit(2 / (math.exp(lg) + 1))
    size = F.when(size == float("inf"), F.lit(1.7976931348623157e308)).otherwise(size)
    return hit.select(*by, "metric", "q", F.col("total").alias("n"), F.when(F.col("sign") == 0, F.lit(0.0)).otherwise(F.col("sign") * size).alias("estimate"))


def by_day(df: DataFrame, by: list[str], metrics: list[str], time: str, error: float = ERROR) -> DataFrame:
    """The sketch per group and day of ``time``; a null time is a day of its own."""
    return sketch(df.withColumn("day", F.to_date(time)), [*by, "day"], metrics, error)
