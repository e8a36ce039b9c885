"""Agreement of annotators: first votes, pairwise kappa, confusion, adjudication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.derive import LABELS


def first_votes(votes: DataFrame, pos: str) -> DataFrame:
    """(image_id, annotator, label int): the first vote that isn't null per image and annotator, in order of ``pos``; labels are cut to integers (2.9 is 2)."""
    rows = votes.where(F.col("label").isNotNull() & F.col("image_id").isNotNull() & F.col("annotator").isNotNull())
    return rows.groupBy("image_id", "annotator").agg(F.min_by("label", pos).cast("int").alias("label"))


def pair_counts(first: DataFrame) -> DataFrame:
    """(annotator_a, annotator_b, x, y, n): how often the two gave x and y to one image; a < b. The counts are all that the measures below need."""
    a = first.select("image_id", F.col("annotator").alias("annotator_a"), F.col("label").alias("x"))
    b = first.select("image_id", F.col("annotator").alias("annotator_b"), F.col("label").alias("y"))
    return a.join(b, "image_id").where("annotator_a < annotator_b").groupBy("annotator_a", "annotator_b", "x", "y").agg(F.count(F.lit(1)).alias("n"))


def kappas(cells: DataFrame, *by: str) -> DataFrame:
    """Per group of a confusion table (x, y, n): n_images, cohen_kappa, quadratic_weighted_kappa, raw_agreement.

    The classes are the labels that occur in x or y, and the quadratic weight is taken between their places in that sorted list. A constant table has
    kappa NaN (0 / 0). The table is the classes squared, however many images there are.
    """
    by = list(by)
    classes = cells.select(*by, F.explode(F.array("x", "y")).alias("c")).distinct()
    placed = classes.withColumn("p", F.dense_rank().over(Window.partitionBy(*by).orderBy("c")) if by else F.dense_rank().over(Window.orderBy("c")))
    rows, cols = cells.groupBy(*by, "x").agg(F.sum("n").alias("nx")), cells.groupBy(*by, "y").agg(F.sum("n").alias("ny"))
    total = cells.groupBy(*by).agg(F.sum("n").alias("t"))
    grid = placed.select(*by, F.col("c").alias("x"), F.col("p").alias("i")).join(placed.select(*by, F.col("c").alias("y"), F.col("p").alias("j")), by) if by else placed.select(F.col("c").alias("x"), F.col("p").alias("i")).join(placed.select(F.col("c").alias("y"), F.col("p").alias("j")), F.lit(True))
    full = grid.join(cells, [*by, "x", "y"], "left").join(rows, [*by, "x"], "left").join(cols, [*by, "y"], "left")
    full = full.join(total, by) if by else full.join(total, F.lit(True))
    n = F.coalesce("n", F.lit(0)).cast("double")
    expected = F.coalesce("nx", F.lit(0)) * F.coalesce("ny", F.lit(0)) / F.col("t")
    w1, w2 = F.when(F.col("i") == F.col("j"), 0.0).otherwise(1.0), ((F.col("i") - F.col("j")) ** 2).cast("double")

    def kappa(w: Column) -> Column:
        return F.coalesce(F.lit(1.0) - F.try_divide(F.sum(w * n), F.sum(w * expected)), F.lit(float("nan")))

    return full.groupBy(*by).agg(
        F.max("t").alias("n_images"), kappa(w1).alias("cohen_kappa"), kappa(w2).alias("quadratic_weighted_kappa"), F.try_divide(F.sum(F.when(F.col("i") == F.col("j"), n).otherwise(0.0)), F.max("t").cast("double")).alias("raw_agreement")
    )


def pairwise_agreement(votes: DataFrame, pos: str) -> DataFrame:
    """Per pair of annotators that share an image: n_images, both kappas and the raw agreement."""
    return kappas(pair_counts(first_votes(votes, pos)), "annotator_a", "annotator_b")


def first_pair_confusion(votes: DataFrame, pos: str) -> DataFrame:
    """5 x 5 counts of the two first annotators by name; no rows if they share no image."""
    first = first_votes(votes, pos)
    two = first.select("annotator").distinct().orderBy("annotator").limit(2)
    cells = pair_counts(first.join(F.broadcast(two), "annotator", "left_semi"))
    pair = cells.select("annotator_a", "annotator_b").distinct()
    domain = F.array(*[F.lit(k) for k in LABELS])
    grid = pair.withColumn("x", F.explode(domain)).withColumn("y", F.explode(domain))
    return grid.join(cells, ["annotator_a", "annotator_b", "x", "y"], "left").select("annotator_a", "annotator_b", "x", "y", F.coalesce("n", F.lit(0)).alias("n"))


def vote_rollup(votes: DataFrame) -> DataFrame:
    """Per image: n_votes, n_unique_labels, min, max, span and needs_adjudication over all votes that aren't null; an image with null votes only has 0 votes and nulls."""
    label = F.col("label").try_cast("double").cast("int")
    one = votes.where(F.col("image_id").isNotNull()).groupBy("image_id").agg(
        F.count(label).alias("n_votes"), F.countDistinct(label).alias("n_unique_labels"), F.min(label).alias("min_label"), F.max(label).alias("max_label")
    )
    return one.withColumn("disagreement_span", F.col("max_label") - F.col("min_label")).withColumn("needs_adjudication", (F.col("n_unique_labels") > 1).cast("int"))


def agreement_summary(votes: DataFrame, pos: str) -> DataFrame:
    """One row: annotators, images, means of the pairwise measures, adjudication rate, images with a span above 1."""
    who = votes.agg(F.countDistinct("annotator").alias("n_annotators"), F.countDistinct("image_id").alias("n_images"))
    pairs = pairwise_agreement(votes, pos).agg(F.struct(*[F.avg(c).alias(f"mean_{c}") for c in ("cohen_kappa", "quadratic_weighted_kappa", "raw_agreement")]).alias("p"))
    images = vote_rollup(votes).agg(F.struct(F.avg("needs_adjudication").alias("adjudication_rate"), F.count_if(F.col("disagreement_span") > 1).alias("images_with_span_gt_1")).alias("i"))
    return who.withColumns({"p": pairs.scalar(), "i": images.scalar()}).select("n_annotators", "n_images", "p.*", "i.*")
