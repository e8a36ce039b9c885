"""From accepted tasks to a release: image files and their metadata rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import derive
from tidemark.sources import sinks
from tidemark.sources.release import aligned
from tidemark.sources.workspace import Workspace


def synthetic_rows(results: DataFrame, tasks: DataFrame, parents: DataFrame, root: str, version: str, kind: str = "jpeg") -> DataFrame:
    """Write the image of every accepted result below ``root`` and return its metadata row in the public schema.

    ``results``: from :func:`tidemark.operators.compositing.synthesized`; ``tasks(uid, split, asset_id, asset_filename, seed, width, height)``; ``parents``: metadata of the real images, one
    row an id. A child takes camera, time, capture, block and source file name from its parent, the split from its task. Results that weren't accepted have no file and no row.
    """
    work = Workspace(results.sparkSession)
    kept = work.cut(results.where("accepted"), "accepted")
    path = F.concat(F.lit("images/synthetic/"), F.col("split"), F.lit("/label_"), F.col("label").cast("string"), F.lit("/"), F.col("image_id"), F.lit(".jpg" if kind == "jpeg" else f".{kind}"))
    told = tasks.select("uid", "split", "asset_id", "asset_filename", "seed", "width", "height")
    made = kept.withColumnRenamed("image_id", "parent_image_id").join(told, "uid").withColumn("image_id", derive.synthetic_image_id(F.col("uid"))).withColumn("relative_path", path)
    sinks.write_images(made.select(F.col("relative_path").alias("path"), "pixels", "width", "height"), root, kind).agg(F.sum("size")).collect()
    own = parents.select(F.col("image_id").alias("parent_image_id"), F.col("label").alias("parent_label"), "cam", "state", "cam_state", "day", "sec", "capture_id", "block_index", "group_id", "source_filename")
    rows = made.drop("pixels").join(own, "parent_image_id")
    return aligned(rows.select(
        "image_id", F.lit("synthetic").alias("origin"), F.lit(True).alias("synthetic"), "label", F.col("parent_label").alias("source_label"), F.col("label").alias("target_label"), "cam", "state",
        "cam_state", "day", "sec", "capture_id", "block_index", "group_id", F.col("split").alias("synthetic_split"), F.col("split").alias("asset_split"), "parent_image_id", "parent_label", "width",
        "height", "relative_path", "source_filename", "asset_id", "asset_filename", "rotation_deg", "coverage_scale", "blur_scale_factor", "opacity", "avg_blockage",
        derive.label_boost(F.col("avg_blockage")).alias("label_boost"), F.col("seed").alias("synthetic_seed"), F.lit(version).alias("generator_version"),
    ))
