"""Where results go: CSV, JSON, LaTeX, partitioned Parquet, manifests, archives."""

from __future__ import annotations

import hashlib
import importlib.metadata
import json
import platform
import sys
import uuid
import zipfile
from dataclasses import dataclass
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import files, pictures
from tidemark.sources.release import columns, sanitized
from tidemark.sources.workspace import ship


def save_csv(df: DataFrame, path: str, fields: list[str] | None = None, one_file: bool = False) -> None:
    """CSV with a header in the folder ``path``; ``fields`` picks and orders the columns. ``one_file`` is for small tables: it writes from one task."""
    rows = df.select(*fields) if fields else df
    (rows.coalesce(1) if one_file else rows).write.mode("overwrite").option("header", True).option("lineSep", "\n").csv(path)


def save_public_csv(df: DataFrame, path: str) -> None:
    """CSV without private columns."""
    save_csv(sanitized(df), path)


def latex(df: DataFrame, most: int = 1000) -> str:
    """A plain LaTeX tabular of a small table; more than ``most`` rows are an error, not a cut."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows")
    lines = [" & ".join(df.columns), *[" & ".join("" if v is None else str(v) for v in r) for r in rows]]
    return "\n".join(["\\begin{tabular}{" + "l" * len(df.columns) + "}", "\\toprule", lines[0] + " \\\\", "\\midrule", *[x + " \\\\" for x in lines[1:]], "\\bottomrule", "\\end{tabular}", ""])


def save_table(df: DataFrame, csv: str, tex: str | None = None) -> None:
    """A result table as CSV and, if named, as LaTeX on the driver's file system."""
    save_csv(df, csv, one_file=True)
    if tex:
        Path(tex).parent.mkdir(parents=True, exist_ok=True)
        Path(tex).write_text(latex(df))


def save_json(value: dict, path: str) -> None:
    """Indented JSON, characters as they are."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(value, indent=2, ensure_ascii=False, default=str))


@dataclass(frozen=True)
class Layout:
    """The folders of an output root."""

    root: str

    def at(self, kind: str, *names: str) -> str:
        if kind not in ("tables", "figures", "logs", "summaries", "benchmark"):
            raise ValueError(kind)
        return "/".join([self.root.rstrip("/"), kind, *names])

    def benchmark(self, model: str, setting: str, seed: int, head: str | None = None) -> str:
        return self.at("benchmark", *filter(None, (model, head)), setting, f"seed_{seed}")


def write_metadata(real: DataFrame, synthetic: DataFrame, root: str) -> None:
    """metadata, metadata_real and metadata_synthetic as Parquet in the public column order, sorted within files by origin, label and id.

    The master table is partitioned by origin, so that either subset is a pruned read of it.
    """
    names = [n for n, _ in columns()]
    for name, df in (("metadata_real", real), ("metadata_synthetic", synthetic)):
        df.select(*names).sortWithinPartitions("label", "image_id").write.mode("overwrite").parquet(f"{root}/{name}.parquet")
    real.select(*names).unionByName(synthetic.select(*names)).repartition("origin", "capture_id").sortWithinPartitions("origin", "label", "image_id").write.mode("overwrite").partitionBy("origin").parquet(f"{root}/metadata.parquet")


def write_splits(images: DataFrame, root: str) -> None:
    """One table of all official splits, partitioned by split and origin: each of the six views is a pruned read."""
    images.repartition("split", "origin", "capture_id").sortWithinPartitions("split", "origin", "label", "image_id").write.mode("overwrite").partitionBy("split", "origin").parquet(f"{root}/splits.parquet")


def build_summary(images: DataFrame, **also) -> dict:
    """Counts by origin, split and label, and the sorted cameras, states and days: one aggregation, some dozens of numbers and names."""
    row = images.agg(
        F.count(F.lit(1)).alias("n_images"), F.count_if(F.col("origin") == "real").alias("n_real"), F.count_if(F.col("origin") == "synthetic").alias("n_synthetic"),
        *[F.count_if(F.col("label") == k).alias(f"label_{k}") for k in range(1, 6)], *[F.sort_array(F.collect_set(c)).alias(f"{c}s") for c in ("cam", "state", "day")],
    ).first()
    return row.asDict() | also


def expect(summary: dict, **numbers: int) -> None:
    """Raise if a summary's number isn't what is expected."""
    wrong = {k: (summary.get(k), n) for k, n in numbers.items() if summary.get(k) != n}
    if wrong:
        raise ValueError(f"found, expected: {wrong}")


def file_manifest(spark: SparkSession, root: str, name: str = "file_manifest.csv") -> DataFrame:
    """(relative_path, size_bytes, sha256) of a release, the manifest itself left out, by path."""
    return files.digests(spark, root, (name,)).orderBy("relative_path")


def contents(spark: SparkSession, root: str) -> DataFrame:
    """The files of a release outside its images, by path."""
    return files.inventory(spark, root).where("not startswith(relative_path, 'images/')").orderBy("relative_path")


def environment(spark: SparkSession) -> dict:
    """Versions and settings of a run."""
    return {"python": sys.version.split()[0], "platform": platform.platform(), "spark": spark.version, "partitions": spark.conf.get("spark.sql.shuffle.partitions")}


def build_zip(source: str, target: str) -> None:
    """A stored ZIP of a local folder with sorted entries and fixed times: the same bytes for the same files."""
    top = Path(source)
    with zipfile.ZipFile(target, "w", zipfile.ZIP_STORED) as z:
        for p in sorted(x for x in top.rglob("*") if x.is_file()):
            info = zipfile.ZipInfo(p.relative_to(top).as_posix(), (1980, 1, 1, 0, 0, 0))
            info.external_attr = 0o644 << 16
            z.writestr(info, p.read_bytes())


#: What :func:`write_images` can make of pixels.
ENCODERS = {"png": pictures.png, "ppm": pictures.ppm, "jpeg": pictures.jpeg}


def _local(root: str) -> str:
    """A folder that tasks write to with ordinary files: it must be mounted on all executors."""
    kind, _, rest = root.partition(":") if ":" in root.split("/", 1)[0] else ("file", "", root)
    if kind != "file":
        raise ValueError(f"{root}: tasks write files to a mounted folder only")
    return "/" + rest.lstrip("/")


def write_files(rows: DataFrame, root: str) -> DataFrame:
    """Write (path, content binary) below ``root`` from the tasks and return (path, size). A file is written beside its place and moved there, so a task that is run again does no harm."""
    top = _local(root)

    def run(batches):
        import pandas as pd

        for b in batches:
            out = []
            for path, content in zip(b["path"], b["content"]):
                target = Path(top) / path
                target.parent.mkdir(parents=True, exist_ok=True)
                beside = target.with_name(f".{target.name}.{uuid.uuid4().hex}")
                beside.write_bytes(content)
                beside.replace(target)
                out.append((path, len(content)))
            yield pd.DataFrame(out, columns=["path", "size"])

    ship(rows.sparkSession)
    return rows.select("path", "content").where("path is not null and content is not null").mapInPandas(run, "path string, size bigint")


def write_images(rows: DataFrame, root: str, kind: str = "ppm") -> DataFrame:
    """Write (path, pixels, width, height) as image files below ``root`` from the tasks and return (path, size). Only for a folder that all executors share.

    ``kind``: ``jpeg`` (grey or RGB, quality 95), ``png`` (grey, RGB or RGBA) or ``ppm`` (RGB).
    """
    if kind not in ENCODERS:
        raise ValueError(f"no encoder for {kind}: {', '.join(ENCODERS)}")
    ship(rows.sparkSession)
    encode = F.pandas_udf(lambda p, w, h: p.combine(w, lambda a, b: (a, b)).combine(h, lambda a, c: ENCODERS[kind](bytes(a[0]), int(a[1]), int(c))), "binary")
    return write_files(rows.where("path is not null and pixels is not null").select("path", encode("pixels", "width", "height").alias("content")), root)


def copy_files(spark: SparkSession, source: str, target: str, leave_out: tuple[str, ...] = ()) -> DataFrame:
    """Byte copies of all files below ``source`` under ``target``, made by the tasks, as (path, size). Files of the desktop (``.DS_Store``, ``._*``) and ``leave_out`` stay behind."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    rows = found.select(files.below(F.col("path"), source).alias("path"), "content")
    name = F.element_at(F.split("path", "/"), -1)
    return write_files(rows.where((name != ".DS_Store") & ~F.startswith(name, F.lit("._")) & ~F.col("path").isin(*leave_out, "")), target)


def reset(spark: SparkSession, root: str, mark: str = "_release") -> None:
    """Empty the output folder of a release. A folder that holds something but no ``mark`` wasn't made by :func:`reset` and is ``ValueError``: nothing is removed by mistake."""
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    sign = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{mark}")
    if fs.exists(where) and len(fs.listStatus(where)) and not fs.exists(sign):
        raise ValueError(f"{root} isn't a release folder")
    fs.delete(where, True)
    fs.mkdirs(where)
    fs.create(sign).close()


def patched_summary(summary: dict, tag: str, expected: dict[str, int], **also) -> dict:
    """A build summary with its tag, further fields and the time in UTC, once its numbers are what is expected (else ``ValueError``)."""
    expect(summary, **expected)
    return summary | {"release_tag": tag} | also | {"finalized_utc": datetime.now(timezone.utc).replace(microsecond=0).isoformat()}


def reproducibility_manifest(spark: SparkSession, root: str, config: dict, packages: tuple[str, ...] = ("pyspark", "numpy", "pandas", "pyarrow"), name: str = "reproducibility_manifest.json", **also) -> dict:
    """What a run made and with what: size and digest of every output, the digest of its settings, versions of packages (null where one is missing), environment."""
    def version(package: str) -> str | None:
        try:
            return importlib.metadata.version(package)
        except importlib.metadata.PackageNotFoundError:
            return None

    text = json.dumps(config, sort_keys=True, ensure_ascii=False)
    outputs = [r.asDict() for r in file_manifest(spark, root, name).collect()]
    return environment(spark) | also | {
        "config": config, "config_sha256": hashlib.sha256(text.encode()).hexdigest(), "package_versions": {p: version(p) for p in packages}, "outputs": outputs,
    }


def write_assets(assets: DataFrame, pools: DataFrame, root: str) -> None:
    """dirt_assets_manifest with asset_split from ``pools(asset_id, split)``: null for an asset in no pool."""
    one = pools.groupBy(F.col("asset_id").alias("__a")).agg(F.min("split").alias("__s"))
    mapped = sanitized(assets).drop("asset_split").join(one, F.col("asset_id") == F.col("__a"), "left").withColumnRenamed("__s", "asset_split").drop("__a")
    mapped.orderBy("asset_id").coalesce(1).write.mode("overwrite").parquet(f"{root}/dirt_assets_manifest.parquet")


def write_predictions(predictions: DataFrame, root: str, model: str, setting: str, seed: int) -> str:
    """The prediction table of a run in its folder; returns the path."""
    path = Layout(root).benchmark(model, setting, seed) + "/predictions.parquet"
    predictions.select("image_id", "target_label", "pred_label", *[f"prob_L{k}" for k in range(1, 6)]).write.mode("overwrite").parquet(path)
    return path


#: The columns of a training log.
LOG = ("epoch", "train_loss", "val_accuracy", "val_macro_f1", "val_weighted_kappa", "val_mae", "val_within1", "lr", "epoch_time_sec", "improved")


def write_train_log(log: DataFrame, root: str, model: str, setting: str, seed: int) -> str:
    """The log of a run, an epoch a row, as one CSV in its folder; returns the path."""
    path = Layout(root).benchmark(model, setting, seed) + "/train_log"
    save_csv(log.orderBy("epoch"), path, list(LOG), one_file=True)
    return path
