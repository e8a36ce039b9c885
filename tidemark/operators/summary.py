"""Descriptive statistics: always population deviations, exact quantiles, nulls and NaN left out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.derive import as_number
from tidemark.functions.keys import finite
from tidemark.operators.ranking import equal_join, bucketed_rank, percentiles, running


def long(df: DataFrame, columns: list[str], *keep: str) -> DataFrame:
    """(keep..., field, value) of the finite numbers in ``columns``; what isn't a number is left out, a missing column has no rows."""
    named = [F.struct(F.lit(c).alias("field"), as_number(F.col(c)).alias("value")) for c in columns if c in df.columns]
    return df.select(*keep, F.inline(F.array(*named))).where(finite(F.col("value")))


def described(values: DataFrame, *by: str) -> DataFrame:
    """Per group: n, mean, population std, min, exact median, max. A field without values has no row."""
    v = F.col("value")
    one = values.groupBy(*by).agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"))
    middle = percentiles(values, list(by), "value", {"median": 0.5}).drop("n")
    return equal_join(one, middle, list(by), "left").select(*by, "n", "mean", "std", "min", "median", "max")


def side_by_side(values: DataFrame, group: str, left: str, right: str) -> DataFrame:
    """Per field: mean and population std of two groups next to each other."""
    one = [f(F.when(F.col(group) == g, F.col("value"))).alias(f"{g}_{n}") for g in (left, right) for n, f in (("mean", F.avg), ("std", F.stddev_pop))]
    return values.where(F.col(group).isin(left, right)).groupBy("field").agg(*one)


def standardized(df: DataFrame, columns: list[str], floor: float = 1e-12) -> DataFrame:
    """``df`` with z_<column>: (x - mean) / max(population std, floor). The constants are a scalar subquery."""
    one = df.agg(F.struct(*[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]).alias("c"))
    z = [((F.col(c) - F.col(f"__c.m_{c}")) / F.greatest(F.col(f"__c.s_{c}"), F.lit(floor))).alias(f"z_{c}") for c in columns]
    return df.withColumn("__c", one.scalar()).select(*df.columns, *z)


def sampling_weights(df: DataFrame, label: str) -> DataFrame:
    """Per label: n and 1 / n, the weight of each of its rows in a draw with replacement."""
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n")).withColumn("weight", 1.0 / F.col("n"))


def class_weights(df: DataFrame, label: str, classes: int = 5) -> DataFrame:
    """Per label: n_total / (classes * n), the balanced class weight."""
    counts = df.where(F.col(label).between(1, classes)).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.select(label, "n", (total.scalar() / (classes * F.col("n"))).alias("weight"))


def _number(*parts: Column) -> Column:
    """60 bits of a digest that any engine can make."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 15), 16, 10).cast("bigint")


def weighted_draw(df: DataFrame, id: str, label: str, draws: int, seed: int = 42) -> DataFrame:
    """(draw, id): ``draws`` rows drawn with replacement, each label equally likely, each row of a label equally likely; null labels are never drawn.

    A draw picks a label and a place in it by hash, and the places are joined: no row is gathered on the driver.
    """
    ranked = bucketed_rank(df.where(F.col(label).isNotNull()).select(id, label), [label], F.shiftleft(_number(F.lit(seed), F.col(id)), 4), [id], "place")
    sizes = ranked.groupBy(label).agg(F.max("place").alias("n"))
    names = sizes.select(label, "n", (F.row_number().over(Window.orderBy(label)) - 1).alias("k"))
    count = names.agg(F.count(F.lit(1)).alias("labels"))
    drawn = df.sparkSession.range(draws).select(F.col("id").alias("draw")).withColumn("labels", count.scalar()).withColumn("k", _number(F.lit(seed), F.lit("l"), F.col("draw")) % F.col("labels"))
    places = drawn.join(names, "k").select("draw", label, (_number(F.lit(seed), F.lit("p"), F.col("draw")) % F.col("n") + 1).alias("place"))
    return places.join(ranked, [label, "place"]).select("draw", id)


def ecdf(values: DataFrame, *by: str, value: str = "value") -> DataFrame:
    """(by..., value, y): each value with its rank over n, equal values on steps of their own.

    Counted per distinct value, and ranked by ranges of values; ties are expanded afterwards.
    """
    counted = values.groupBy(*by, value).agg(F.count(F.lit(1)).alias("c"))
    stepped = running(counted, list(by), value, ["c"])
    return stepped.select(*by, value, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("c"))).alias("__i"), "c_before", "c_total").select(*by, value, ((F.col("c_before") + F.col("__i")) / F.col("c_total")).alias("y"))


def histogram(values: DataFrame, *by: str, bins: int = 40, value: str = "value") -> DataFrame:
    """(by..., bin, n, density) over equal bins from the group's smallest to largest value, the last bin closed; empty bins have no row.

    A group with one distinct value spans value - 0.5 to value + 0.5.
    """
    span = values.groupBy(*by).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"), F.count(value).alias("__n"))
    lo = F.when(F.col("__lo") == F.col("__hi"), F.col("__lo") - 0.5).otherwise(F.col("__lo"))
    hi = F.when(F.col("__lo") == F.col("__hi"), F.col("__hi") + 0.5).otherwise(F.col("__hi"))
    span = span.select(*by, lo.alias("__lo"), hi.alias("__hi"), "__n")
    rows = values.join(span, list(by)) if by else values.join(F.broadcast(span), F.lit(True))
    place = F.least(F.floor((F.col(value) - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * bins), F.lit(bins - 1)).cast("int")
    counted = rows.withColumn("bin", place).groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"), F.max("__n").alias("__n"), F.max(F.col("__hi") - F.col("__lo")).alias("__w"))
    return counted.select(*by, "bin", "n", (F.col("n") / (F.col("__n") * F.col("__w") / bins)).alias("density"))


def seeded_sample(df: DataFrame, by: str, id: str, per_group: int = 3, seed: str = "42") -> DataFrame:
    """Up to ``per_group`` rows of each group by the digest of seed and id: the same draw on any cluster. The limit is applied before the shuffle."""
    place = F.row_number().over(Window.partitionBy(by).orderBy(F.md5(F.concat(F.lit(seed), F.col(id))), id))
    return df.where(F.col(by).isNotNull() & F.col(id).isNotNull()).select(by, id).distinct().withColumn("place", place).where(F.col("place") <= per_group)


def head(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first n rows by ``order``: a file's order must be named, Spark's scans have none."""
    return df.orderBy(*order).limit(n)


def covariance(df: DataFrame, columns: list[str]) -> DataFrame:
    """(row, col, cov): the sample covariance of standardized columns in one aggregation."""
    z = standardized(df, columns).select(*[F.col(f"z_{c}").alias(c) for c in columns])
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    one = z.agg(*[F.covar_samp(a, b).alias(f"{a}|{b}") for a, b in pairs])
    return one.select(F.inline(F.array(*[F.struct(F.lit(a).alias("row"), F.lit(b).alias("col"), F.col(f"`{a}|{b}`").alias("cov")) for a, b in pairs])))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, both zeros as one: sums of doubles depend on the order of their parts in the last bits."""
    def one(c: str) -> Column:
        return (F.round(c, digits) + F.lit(0.0)).alias(c)

    return reduce(lambda d, c: d.withColumn(c, one(c)), [c for c, t in df.dtypes if t == "double"], df)
