"""Scoring ordinal classifiers exactly: confusion, P/R/F1, AUROC, average precision, ordinal decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.derive import LABELS
from tidemark.operators.agreement import kappas
from tidemark.operators.ranking import running

SEVERE = (4, 5)


def cells(predictions: DataFrame, *by: str, truth: str = "target_label", pred: str = "pred_label") -> DataFrame:
    """(by..., x, y, n): counts of truth x and prediction y; rows lacking either don't count. At most 25 rows a group, combined on the map side."""
    rows = predictions.where(F.col(truth).isNotNull() & F.col(pred).isNotNull())
    return rows.groupBy(*by, F.col(truth).alias("x"), F.col(pred).alias("y")).agg(F.count(F.lit(1)).alias("n"))


def scalars(table: DataFrame, *by: str) -> DataFrame:
    """accuracy, mae and within1 of a confusion table."""
    n = F.col("n")
    share = lambda c: F.sum(F.when(c, n).otherwise(0)) / F.sum(n)
    return table.groupBy(*by).agg(
        F.sum(n).alias("n"), share(F.col("x") == F.col("y")).alias("accuracy"), (F.sum(F.abs(F.col("x") - F.col("y")) * n) / F.sum(n)).alias("mae"),
        share(F.abs(F.col("x") - F.col("y")) <= 1).alias("within1"),
    )


def per_class(table: DataFrame, *by: str, labels: tuple[int, ...] = LABELS) -> DataFrame:
    """(by..., label, precision, recall, f1, support) for every label of the domain; 0 where a ratio has no denominator."""
    one = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    sums = table.groupBy(*by).agg(*[f.alias(f"{n}{k}") for k in labels for n, f in (("tp", one((F.col("x") == k) & (F.col("y") == k))), ("t", one(F.col("x") == k)), ("p", one(F.col("y") == k)))])
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    rows = [
        F.struct(
            F.lit(k).alias("label"), ratio(F.col(f"tp{k}"), F.col(f"p{k}")).alias("precision"), ratio(F.col(f"tp{k}"), F.col(f"t{k}")).alias("recall"),
            ratio(2 * F.col(f"tp{k}"), F.col(f"p{k}") + F.col(f"t{k}")).alias("f1"), F.col(f"t{k}").alias("support"),
        )
        for k in labels
    ]
    return sums.select(*by, F.inline(F.array(*rows)))


def macro_f1(table: DataFrame, *by: str) -> DataFrame:
    """The mean F1 over the labels that occur in truth or prediction; not over the whole domain."""
    marginal = table.select(*by, F.col("x").alias("label"), F.col("n").alias("t"), F.lit(0).cast("bigint").alias("p"), F.when(F.col("x") == F.col("y"), F.col("n")).otherwise(0).alias("tp")).unionAll(
        table.select(*by, F.col("y").alias("label"), F.lit(0).cast("bigint").alias("t"), F.col("n").alias("p"), F.lit(0).cast("bigint").alias("tp"))
    )
    each = marginal.groupBy(*by, "label").agg((2 * F.sum("tp") / (F.sum("t") + F.sum("p"))).alias("f1"))
    return each.groupBy(*by).agg(F.avg("f1").alias("macro_f1"))


def confusion(table: DataFrame, *by: str, labels: tuple[int, ...] = LABELS) -> DataFrame:
    """(by..., x, y, n, share) over the whole domain; share of the row, 0 for a row without truth."""
    domain = F.array(*[F.lit(k) for k in labels])
    groups = table.select(*by).distinct() if by else table.sparkSession.range(1).select()
    grid = groups.withColumn("x", F.explode(domain)).withColumn("y", F.explode(domain))
    full = grid.join(table, [*by, "x", "y"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    whole = F.sum("n").over(Window.partitionBy(*by, "x"))
    return full.select(*by, "x", "y", "n", F.coalesce(F.try_divide(F.col("n").cast("double"), whole.cast("double")), F.lit(0.0)).alias("share"))


def binary(table: DataFrame, *by: str, positive: tuple[int, ...] = SEVERE) -> DataFrame:
    """precision, recall, f1 of severe (4, 5) against the rest."""
    x, y, n = F.col("x").isin(*positive), F.col("y").isin(*positive), F.col("n")
    one = lambda c: F.sum(F.when(c, n).otherwise(0)).cast("double")
    sums = table.groupBy(*by).agg(one(x & y).alias("tp"), one(x).alias("t"), one(y).alias("p"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return sums.select(*by, ratio(F.col("tp"), F.col("p")).alias("precision"), ratio(F.col("tp"), F.col("t")).alias("recall"), ratio(2 * F.col("tp"), F.col("p") + F.col("t")).alias("f1"))


def _steps(scored: DataFrame, by: list[str], truth: str, score: str) -> DataFrame:
    """Per distinct score: positives and all, with the running sums from the highest score down."""
    known = scored.where(F.col(truth).isNotNull() & F.col(score).isNotNull() & ~F.isnan(score))
    counted = known.groupBy(*by, F.col(score).alias("s")).agg(F.sum(F.col(truth).cast("bigint")).alias("pos"), F.count(F.lit(1)).alias("all"))
    steps = running(counted, by, "s", ["pos", "all"], descending=True)
    return steps.withColumn("tp", F.col("pos_before") + F.col("pos")).withColumn("seen", F.col("all_before") + F.col("all"))


def auroc(scored: DataFrame, *by: str, truth: str, score: str) -> DataFrame:
    """(by..., auroc): the share of (positive, negative) pairs in which the positive scores higher, ties half; NaN with one class only.

    Exact, from counts per distinct score, added up by ranges of scores.
    """
    steps = _steps(scored, list(by), truth, score)
    neg, neg_seen = F.col("all") - F.col("pos"), F.col("seen") - F.col("tp")
    # positives of this score beat all negatives below it and half of those beside it
    parts = steps.groupBy(*by).agg(F.sum("pos").alias("p"), F.sum(neg).alias("n"), F.sum(F.col("pos") * (neg_seen - neg / 2.0)).alias("above"))
    area = 1.0 - F.try_divide(F.col("above"), (F.col("p") * F.col("n")).cast("double"))
    return parts.select(*by, F.coalesce(area, F.lit(float("nan"))).alias("auroc"))


def average_precision(scored: DataFrame, *by: str, truth: str, score: str) -> DataFrame:
    """(by..., average_precision): sum of recall gained times precision over the distinct thresholds; NaN without positives."""
    steps = _steps(scored, list(by), truth, score)
    one = steps.groupBy(*by).agg(F.sum(F.col("pos") * F.col("tp") / F.col("seen")).alias("a"), F.sum("pos").alias("p"))
    return one.select(*by, F.coalesce(F.try_divide(F.col("a"), F.col("p").cast("double")), F.lit(float("nan"))).alias("average_precision"))


def evaluation(predictions: DataFrame, *by: str, truth: str = "target_label", pred: str = "pred_label") -> DataFrame:
    """accuracy, mae, within1, macro_f1 and weighted_kappa of each group."""
    table = cells(predictions, *by, truth=truth, pred=pred)
    kappa = kappas(table, *by).select(*by, F.col("quadratic_weighted_kappa").alias("weighted_kappa"))
    on = list(by) or F.lit(True)
    return scalars(table, *by).join(macro_f1(table, *by), on).join(kappa, on)


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def coral_label(logits: Column) -> Column:
    """Index of the class: how many of the survival probabilities exceed one half."""
    return F.size(F.filter(logits, lambda z: sigmoid(z) > 0.5))


def _adjacent(survival: Column) -> Column:
    """Class probabilities as differences of the survival probabilities 1, s1, ..., sk, 0."""
    upper, lower = F.concat(F.array(F.lit(1.0)), survival), F.concat(survival, F.array(F.lit(0.0)))
    return F.zip_with(upper, lower, lambda a, b: a - b)


def coral_probabilities(logits: Column) -> Column:
    """Differences of the survival probabilities, negative ones set to 0, scaled to add up to 1 (the sum is at least 1e-12)."""
    clamped = F.transform(_adjacent(F.transform(logits, sigmoid)), lambda p: F.greatest(p, F.lit(0.0)))
    total = F.greatest(F.aggregate(clamped, F.lit(0.0), lambda s, p: s + p), F.lit(1e-12))
    return F.transform(clamped, lambda p: p / total)


def _running(logits: Column) -> Column:
    start = F.array().cast("array<double>")
    return F.aggregate(logits, start, lambda done, z: F.concat(done, F.array(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(1.0)) * sigmoid(z))))


def corn_label(logits: Column) -> Column:
    """Index of the class: how many of the running products of conditional probabilities exceed one half."""
    return F.size(F.filter(_running(logits), lambda p: p > 0.5))


def corn_probabilities(logits: Column) -> Column:
    """Differences of the running products, neither cut nor scaled."""
    return _adjacent(_running(logits))


def softmax(logits: Column) -> Column:
    top = F.array_max(logits)
    powers = F.transform(logits, lambda z: F.exp(z - top))
    total = F.aggregate(powers, F.lit(0.0), lambda s, p: s + p)
    return F.transform(powers, lambda p: p / total)


def argmax(values: Column) -> Column:
    """0-based place of the largest value, the first of equal ones."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")
