"""Files as tables: inventories, digests, decoded images, asset numbering, cached statistics."""

from __future__ import annotations

import json
from collections.abc import Callable
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.derive import asset_key
from tidemark.operators.kernels import to_gray
from tidemark.sources import pictures
from tidemark.sources.release import exists
from tidemark.sources.workspace import ship

#: The endings of image files.
IMAGES = ("jpg", "jpeg", "png", "bmp", "tif", "tiff")
ANNOTATIONS = "image_id string, annotator string, label double, resolved_label double"


def _plain(path) -> F.Column:
    """A path without its scheme."""
    return F.regexp_replace(path, r"^[a-z0-9]+:(//)?(?=/)", "")


def _below(path: F.Column, top: str) -> F.Column:
    """What follows the folder ``top`` in a path, whatever its length."""
    return F.substring(_plain(path), F.lit(len(top) + 2), F.length(path))


def below(path: F.Column, root: str) -> F.Column:
    """The path relative to the folder ``root``, which may have a scheme."""
    return _below(path, "/" + (root.split(":", 1)[-1] if ":" in root else root).strip("/"))


def _scanned(spark: SparkSession, root: str, content: bool) -> DataFrame:
    """(relative_path, size_bytes, sha256 or null) of all files below ``root``.

    Spark's scans leave out files of no bytes. Their paths come from the file index, which the driver holds for any scan; no other list of files is made there.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    digest = F.sha2("content", 256) if content else F.lit(None).cast("string")
    read = files.select(below(F.col("path"), root).alias("relative_path"), F.col("length").alias("size_bytes"), digest.alias("sha256"))
    # the index has paths as they are written in URIs
    paths = [(unquote(p),) for p in files.inputFiles()]
    listed = spark.createDataFrame(paths, "path string").select(below(F.col("path"), root).alias("relative_path"))
    there = files.select(below(F.col("path"), root).alias("relative_path"))
    empty = listed.join(there, "relative_path", "left_anti")
    return read.unionAll(empty.select("relative_path", F.lit(0).cast("bigint"), F.sha2(F.lit(b""), 256) if content else F.lit(None).cast("string")))


def inventory(spark: SparkSession, root: str, leave_out: tuple[str, ...] = ()) -> DataFrame:
    """(relative_path, size_bytes) of all files below ``root``, empty ones too; contents aren't read (only path and length are selected). ``leave_out``: relative paths."""
    return _scanned(spark, root, False).select("relative_path", "size_bytes").where(~F.col("relative_path").isin(*leave_out) if leave_out else F.lit(True))


def digests(spark: SparkSession, root: str, leave_out: tuple[str, ...] = ()) -> DataFrame:
    """(relative_path, size_bytes, sha256) of all files below ``root``, empty ones too, each read once, in its own task's memory."""
    out = _scanned(spark, root, True)
    return out.where(~F.col("relative_path").isin(*leave_out)) if leave_out else out


def labelled_inventory(spark: SparkSession, root: str) -> DataFrame:
    """(label, name, relative_path, pos) of image files in numbered folders, by label and name; other folders and endings are left out.

    The position is a label's offset and a rank within the label, which is cut into parts by the name: no task sorts all files. Names of a release share long prefixes, so a
    part is a range of the sorted distinct names' first differing characters, taken from a bounded sample of 10,000 names; the ranks don't depend on it.
    """
    parts = F.split("relative_path", "/")
    rows = inventory(spark, root).select(parts[0].try_cast("int").alias("label"), F.element_at(parts, -1).alias("name"), "relative_path")
    kept = rows.where(F.col("label").isNotNull() & F.lower(F.element_at(F.split("name", r"\."), -1)).isin(*IMAGES))
    edges = sorted({r["name"] for r in kept.select("name").distinct().orderBy(F.xxhash64("name")).limit(10_000).collect()})[:: 100] or [""]
    bounds = F.array(*[F.lit(e) for e in edges])
    rows = kept.withColumn("__part", F.size(F.filter(bounds, lambda e: e <= F.col("name"))))
    upto = Window.orderBy("label", "__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("label", "__part").agg(F.count(F.lit(1)).alias("__n")).withColumn("__before", F.coalesce(F.sum("__n").over(upto), F.lit(0))).drop("__n")
    place = F.row_number().over(Window.partitionBy("label", "__part").orderBy("name", "relative_path")) + F.col("__before")
    return rows.join(offsets, ["label", "__part"]).withColumn("pos", place.cast("bigint")).select("label", "name", "relative_path", "pos")


def images(spark: SparkSession, root: str) -> DataFrame:
    """Decoded images (JVM), files that can't be decoded left out."""
    return spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", True).load(root)


@F.pandas_udf(T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType()), T.StructField("mode", T.StringType())]))
def _header(content: pd.Series) -> pd.DataFrame:
    found = [pictures.header(None if c is None else bytes(c)) or (None, None, None) for c in content]
    return pd.DataFrame(found, columns=["width", "height", "mode"]).astype({"width": "Int32", "height": "Int32"})


def headers(spark: SparkSession, root: str) -> DataFrame:
    """(path, width, height, mode) of all files with an image's ending; all null where the header can't be read. No pixel is decoded.

    The first 64 KiB of a file nearly always hold its header; a JPEG with longer notes before it is looked at as a whole.
    """
    ship(spark)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(_plain(F.col("path")).alias("path"), "content")
    found = found.where(F.lower(F.element_at(F.split("path", r"\."), -1)).isin(*IMAGES))
    first = found.withColumn("h", _header(F.substring("content", 1, 1 << 16)))
    late = F.col("h.width").isNull() & (F.octet_length("content") > 1 << 16)
    whole = first.withColumn("w", _header(F.when(late, F.col("content"))))
    return whole.select("path", *[F.coalesce(f"h.{c}", f"w.{c}").alias(c) for c in ("width", "height", "mode")])


def gray_images(spark: SparkSession, root: str) -> DataFrame:
    """(path, pixels, width, height): grey bytes of every image that can be decoded."""
    ship(spark)
    return images(spark, root).select(_plain(F.col("image.origin")).alias("path"), to_gray("image.data", "image.nChannels").alias("pixels"), F.col("image.width").alias("width"), F.col("image.height").alias("height"))


def number_assets(files: DataFrame, copied_to: str | None) -> DataFrame:
    """(asset_id, asset_filename, release_relative_path) numbered A_0001, ... in order of the file name; the path is null where files aren't copied."""
    name = F.element_at(F.split("relative_path", "/"), -1)
    rows = files.select(name.alias("asset_filename")).distinct()
    path = F.concat(F.lit(f"{copied_to.rstrip('/')}/"), F.col("asset_filename")) if copied_to else F.lit(None).cast("string")
    return rows.select(asset_key(F.row_number().over(Window.orderBy("asset_filename"))).alias("asset_id"), "asset_filename", path.alias("release_relative_path"))


def annotations(spark: SparkSession, path: str) -> DataFrame:
    """An annotation CSV with its position; missing required columns are ``ValueError``, labels that aren't numbers are null."""
    raw = spark.read.option("header", True).csv(path)
    if missing := {"image_id", "annotator", "label"} - set(raw.columns):
        raise ValueError(f"missing columns: {sorted(missing)}")
    return raw.select("image_id", "annotator", F.col("label").try_cast("double").alias("label"), F.monotonically_increasing_id().alias("pos"))


def json_document(spark: SparkSession, path: str) -> dict:
    """A small JSON document of configuration, read on the driver through the file system of ``path``."""
    text = "\n".join(r["value"] for r in spark.read.option("wholetext", True).text(path).collect())
    return json.loads(text)


def reused(spark: SparkSession, path: str, ids: DataFrame, compute: Callable[[], DataFrame], id: str = "image_id") -> DataFrame:
    """The table at ``path`` if its ids are exactly those of ``ids``, else ``compute()``, written there and read back.

    The comparison is one pass over both id columns; put a digest of what the values depend on into the path, so that changed pixels or kernels aren't taken for the same.
    """
    if exists(spark, path):
        old = spark.read.parquet(path)
        sides = old.select(F.col(id).alias("k"), F.lit(1).alias("s")).unionAll(ids.select(F.col(id).alias("k"), F.lit(2).alias("s"))).groupBy("k").agg(F.bit_or("s").alias("m"))
        if sides.where("m < 3").isEmpty():
            return old
    compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
