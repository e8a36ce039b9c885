"""What a training loop minimises, over tables of logits: cross-entropy, and the two ordinal losses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def log_sigmoid(x: Column) -> Column:
    """ln(1 / (1 + exp(-x))), without overflow on either side."""
    return F.least(x, F.lit(0.0)) - F.log1p(F.exp(-F.abs(x)))


def _binary(logit: Column, positive: Column) -> Column:
    """The log-loss of one yes-or-no question."""
    return -(log_sigmoid(logit) - F.when(positive, 0.0).otherwise(logit))


def _usable(df: DataFrame, logits: str, index: str, classes: Column) -> DataFrame:
    return df.where(F.col(logits).isNotNull() & F.col(index).isNotNull() & (F.col(index) >= 0) & (F.col(index) < classes) & ~F.exists(logits, lambda z: z.isNull()))


def coral_loss(df: DataFrame, *by: str, logits: str = "logits", index: str = "index") -> DataFrame:
    """(by..., n, loss): the mean over rows of the summed log-losses of "is the class above k", for every k.

    ``index``: the class, 0 to the number of logits. Rows without logits or class, or with a class outside, don't count; a group without rows has none.
    """
    rows = _usable(df, logits, index, F.size(logits) + 1)
    each = F.transform(logits, lambda z, k: _binary(z.cast("double"), F.col(index) > k))
    return rows.select(*by, F.aggregate(each, F.lit(0.0), lambda s, x: s + x).alias("__l")).groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg("__l").alias("loss"))


def corn_loss(df: DataFrame, *by: str, logits: str = "logits", index: str = "index") -> DataFrame:
    """(by..., n, loss): the log-losses of "is the class above k, given that it isn't below k", over all questions that were asked.

    Question k is asked of the rows whose class is k at least. n: questions asked.
    """
    rows = _usable(df, logits, index, F.size(logits) + 1)
    asked = F.transform(logits, lambda z, k: F.when(F.col(index) >= k, _binary(z.cast("double"), F.col(index) > k)))
    kept = rows.select(*by, F.filter(asked, lambda x: x.isNotNull()).alias("__l"))
    sums = kept.select(*by, F.size("__l").cast("bigint").alias("__n"), F.aggregate("__l", F.lit(0.0), lambda s, x: s + x).alias("__s")).groupBy(*by).agg(F.sum("__n").alias("n"), F.sum("__s").alias("s"))
    return sums.where("n > 0").select(*by, "n", (F.col("s") / F.col("n")).alias("loss"))


def cross_entropy(df: DataFrame, *by: str, logits: str = "logits", index: str = "index", weight: str | None = None) -> DataFrame:
    """(by..., n, loss): the weighted mean of -ln softmax(logits)[class]; without ``weight`` all rows weigh the same. Rows of a class outside the logits, or of no weight at all, don't count."""
    rows = _usable(df, logits, index, F.size(logits))
    top = F.array_max(logits).cast("double")
    total = F.aggregate(F.transform(logits, lambda z: F.exp(z.cast("double") - top)), F.lit(0.0), lambda s, x: s + x)
    nll = F.ln(total) + top - F.get(logits, F.col(index)).cast("double")
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    sums = rows.select(*by, w.alias("__w"), nll.alias("__l")).where("__w is not null").groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("__w") * F.col("__l")).alias("s"), F.sum("__w").alias("w"))
    return sums.where("w > 0").select(*by, "n", (F.col("s") / F.col("w")).alias("loss"))
