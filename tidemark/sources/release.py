"""A release: its tables in one schema, official splits by capture, settings. Everything is lazy."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import key
from tidemark.sources.tables import table

#: The 33 public columns in their order, with their types.
COLUMNS = (
    "image_id string, origin string, synthetic boolean, label int, source_label int, target_label int, cam string, state string, cam_state string, day string, "
    "sec int, capture_id string, block_index int, group_id string, synthetic_split string, asset_split string, parent_image_id string, parent_label int, "
    "width int, height int, relative_path string, source_filename string, asset_id string, asset_filename string, rotation_deg int, coverage_scale double, "
    "blur_scale_factor int, opacity double, avg_blockage double, label_boost int, synthetic_seed bigint, generator_version string, sha256 string"
)
KEYS = ("image_id", "capture_id", "group_id", "parent_image_id", "asset_id")
#: Columns that never leave the house, besides those that begin with an underscore.
PRIVATE = ("absolute_path", "source_path", "release_path", "original_path", "local_path")
#: Setting -> part -> whether synthetic images belong to it.
SETTINGS = {
    "train_real_only__eval_real_only": {"train": False, "val": False, "test": False},
    "train_real_plus_synthetic__eval_real_only": {"train": True, "val": False, "test": False},
    "train_real_only__eval_real_plus_synthetic": {"train": False, "val": True, "test": True},
    "train_real_plus_synthetic__eval_real_plus_synthetic": {"train": True, "val": True, "test": True},
}


def columns() -> list[tuple[str, str]]:
    return [tuple(c.strip().split(" ")) for c in COLUMNS.split(",")]


def sanitized(df: DataFrame) -> DataFrame:
    """Without private columns."""
    return df.drop(*[c for c in df.columns if c.startswith("_") or c in PRIVATE])


def aligned(df: DataFrame) -> DataFrame:
    """The 33 public columns in order: missing ones null, others dropped, values cast. A value that its type can't hold is an error, never a silent null.

    Whole numbers may come as text with a zero fraction (``45.0``); blank text is null.
    """
    def one(name: str, kind: str) -> Column:
        if name not in df.columns:
            return F.lit(None).cast(kind).alias(name)
        c = F.col(name)
        if dict(df.dtypes)[name] == "string" and kind != "string":
            c = F.nullif(F.trim(c), F.lit(""))
            if kind in ("int", "bigint"):
                c = F.when(c.isNotNull() & (c.try_cast("double") == F.floor(c.try_cast("double"))), F.regexp_replace(c, r"\.0*$", "")).otherwise(c)
        return c.cast(kind).alias(name)

    return sanitized(df).select(*[one(n, k) for n, k in columns()])


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A release CSV: all columns read as text (no inference), then aligned. A missing file is ``FileNotFoundError``."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return aligned(spark.read.option("header", True).option("inferSchema", False).csv(path))


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def first_existing(spark: SparkSession, candidates: list[str]) -> str:
    """The first path that exists; none: ``FileNotFoundError`` naming all."""
    for c in candidates:
        if exists(spark, c):
            return c
    raise FileNotFoundError(", ".join(candidates))


def with_keys(df: DataFrame) -> DataFrame:
    """Key columns in their one form; nothing else changes."""
    return df.withColumns({k: key(k) for k in KEYS if k in df.columns})


def split_rule(capture: Column) -> Column:
    """The split of a capture by its digest, about 3:1... train, val and test as 12:2:2; a null capture is train."""
    digit = F.substring(F.md5(capture), 1, 1)
    return F.when(digit.isin("0", "1"), "val").when(digit.isin("2", "3"), "test").otherwise("train")


def capture_splits(real: DataFrame, captures: DataFrame) -> DataFrame:
    """``real`` with ``split`` from the table captures(capture_id, split); other captures and null ones are train.

    A capture listed twice takes its smallest split. The join is an ordinary one: Spark broadcasts the table if its size is below the session's threshold.
    """
    one = captures.where(F.col("capture_id").isNotNull()).groupBy("capture_id").agg(F.min("split").alias("split"))
    return real.drop("split").join(one, "capture_id", "left").withColumn("split", F.coalesce("split", F.lit("train")))


def six_views(images: DataFrame) -> DataFrame:
    """``images`` with view: every official view that a row belongs to, {train, val, test} by {real_only, real_plus_synthetic}; rows outside the three splits are in none."""
    of = F.when(F.col("origin") == "real", F.array(F.lit("real_only"), F.lit("real_plus_synthetic"))).otherwise(F.array(F.lit("real_plus_synthetic")))
    return images.where(F.col("split").isin("train", "val", "test")).withColumn("view", F.explode(of)).withColumn("view", F.concat("split", F.lit("_"), "view"))


@dataclass(frozen=True)
class Release:
    """The tables of a release folder, keys in one form, with ``split`` per row: by capture for real images, as filed for synthetic ones."""

    real: DataFrame
    synthetic: DataFrame
    master: DataFrame
    assets: DataFrame
    stats: DataFrame

    @staticmethod
    def load(spark: SparkSession, folder: str) -> Release:
        read = lambda n: with_keys(table(spark, folder, n))
        real, synthetic = read("metadata_real"), read("metadata_synthetic")
        return Release(
            real.withColumn("split", split_rule(F.col("capture_id"))), synthetic.withColumn("split", F.col("synthetic_split")), read("metadata"), read("dirt_assets_manifest"),
            read("synthetic_real_severe_low_level_stats"),
        )

    @property
    def images(self) -> DataFrame:
        """Real and synthetic rows, one after the other."""
        return self.real.unionByName(self.synthetic)

    def register(self) -> None:
        """Temporary views for SQL: real, synthetic, master, assets, stats, images."""
        for name in ("real", "synthetic", "master", "assets", "stats", "images"):
            getattr(self, name).createOrReplaceTempView(name)

    def split(self, name: str, with_synthetic: bool = False) -> DataFrame:
        """One of the six official views; an unknown name is ``ValueError``."""
        if name not in ("train", "val", "test"):
            raise ValueError(f"{name!r} is none of train, val, test")
        return (self.images if with_synthetic else self.real).where(F.col("split") == name)

    def setting(self, name: str) -> dict[str, DataFrame]:
        """train, val and test of a named setting; an unknown name is ``ValueError``."""
        if name not in SETTINGS:
            raise ValueError(f"{name!r} is none of {', '.join(SETTINGS)}")
        return {part: self.split(part, both) for part, both in SETTINGS[name].items()}
