"""Cutting lineage by tables written to the folder that all executors share."""

from __future__ import annotations

import atexit
import io
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Where that is unset, a temporary one if everything runs in this process (tests), else ``RuntimeError``: a folder of one machine isn't shared."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master) is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="tidemark-")
    return _own[app]


class Workspace:
    """Names written tables, and removes those that are superseded.

    A table that a returned DataFrame still reads must stay until the session ends; what is left is removed at exit.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{shared_folder(spark)}/tidemark-{uuid.uuid4().hex}"
        self._n = 0
        atexit.register(self._end)

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return a reader of the written rows: what follows neither recomputes it nor depends on one executor."""
        self._n += 1
        path = f"{self.root}/{self._n:03d}-{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._tidemark_path = path  # type: ignore[attr-defined]
        return out

    def drop(self, df: DataFrame) -> None:
        """Remove the files behind a table from :meth:`cut` that nothing reads any more."""
        if path := getattr(df, "_tidemark_path", None):
            self._delete(path)

    def _delete(self, path: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)

    def _end(self) -> None:
        try:
            self._delete(self.root)
        except Exception:  # the session is gone
            pass


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once an application: zipped into the shared folder and added to their path.

    Needed wherever a function of the package runs in a worker; where workers can import it anyway nothing changes.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent).as_posix())
    path = f"{shared_folder(spark)}/tidemark-{uuid.uuid4().hex}.zip"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where)
    out.write(bytearray(packed.getvalue()))
    out.close()
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
