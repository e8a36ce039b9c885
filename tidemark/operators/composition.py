"""Counts by label, origin, split and field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.derive import LABELS


def label_counts(label: str = "label") -> list[Column]:
    """Aggregates label_1..label_5: zero-filled, labels outside 1..5 and null in none of them."""
    return [F.count_if(F.col(label) == k).alias(f"label_{k}") for k in LABELS]


def release_composition(images: DataFrame) -> DataFrame:
    """Rows real, synthetic and combined: n_images and label counts, in one pass (grouping sets)."""
    counted = images.where(F.col("origin").isin("real", "synthetic")).rollup("origin").agg(F.count(F.lit(1)).alias("n_images"), *label_counts())
    return counted.withColumn("subset", F.coalesce("origin", F.lit("combined"))).drop("origin")


def split_composition(images: DataFrame, split: str = "split") -> DataFrame:
    """Per split: images, real and synthetic ones, distinct captures and groups (nulls are none), label counts."""
    return images.groupBy(split).agg(
        F.count(F.lit(1)).alias("n_images"), F.count_if(F.col("origin") == "real").alias("n_real"), F.count_if(F.col("origin") == "synthetic").alias("n_synthetic"),
        F.countDistinct("capture_id").alias("n_captures"), F.countDistinct("group_id").alias("n_groups"), *label_counts(),
    )


def cross_tab(images: DataFrame, field: str) -> DataFrame:
    """Field by label: label_1..label_5 and n_images, the sum of the five. Rows without field or label don't count; a field with other labels only keeps a row of zeros."""
    known = images.where(F.col(field).isNotNull() & F.col("label").isNotNull()).groupBy(F.col(field)).agg(*label_counts())
    return known.withColumn("n_images", sum((F.col(f"label_{k}") for k in LABELS), F.lit(0).cast("bigint")))


def sparse_counts(images: DataFrame, *fields: str) -> DataFrame:
    """Counts of the combinations that occur; nulls don't."""
    rows = images
    for f in fields:
        rows = rows.where(F.col(f).isNotNull())
    return rows.groupBy(*fields).agg(F.count(F.lit(1)).alias("n_images"))


def day_sessions(images: DataFrame, sessions: list[str]) -> DataFrame:
    """Day by camera session, zero-filled for the named sessions: one conditional count each, so no extra pass finds the columns."""
    rows = images.where(F.col("day").isNotNull() & F.col("cam_state").isNotNull())
    return rows.groupBy("day").agg(*[F.count_if(F.col("cam_state") == s).alias(s) for s in sessions])


def setting_manifest(images: DataFrame, settings: DataFrame) -> DataFrame:
    """Per setting(setting, part, split, with_synthetic): images, real and synthetic ones of each part."""
    rows = images.groupBy("split", "origin").agg(F.count(F.lit(1)).alias("n"))
    used = settings.join(rows, "split").where((F.col("origin") == "real") | F.col("with_synthetic"))
    return used.groupBy("setting", "part").agg(
        F.sum("n").alias("n_images"), F.sum(F.when(F.col("origin") == "real", F.col("n")).otherwise(0)).alias("n_real"), F.sum(F.when(F.col("origin") == "synthetic", F.col("n")).otherwise(0)).alias("n_synthetic")
    )


def label_text(images: DataFrame, by: str) -> DataFrame:
    """``L1:n | ... | L5:n`` per group."""
    counts = images.groupBy(by).agg(*label_counts())
    return counts.select(by, F.concat_ws(" | ", *[F.concat(F.lit(f"L{k}:"), F.col(f"label_{k}").cast("string")) for k in LABELS]).alias("labels"))


def domains(images: DataFrame, *fields: str) -> DataFrame:
    """One row of the sorted distinct values of each field and the row count: the scalars of a build summary."""
    sets = [F.sort_array(F.collect_set(f)).alias(f"{f}_values") for f in fields]
    return images.agg(F.count(F.lit(1)).alias("n_images"), *sets)
