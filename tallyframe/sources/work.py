"""Tables that a job writes for itself, in the folder that the driver and all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession, *modules: Path) -> None:
    """Sends this package, and modules that stand beside it, to all Python workers, once for each application.

    The archive is made on the driver, and Spark's file server hands it to executors, those that join later too.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp()
    archive = Path(folder) / f"{package.name}-{uuid.uuid4().hex[:8]}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for path in [*sorted(package.rglob("*.py")), *modules]:
            z.write(path, path.relative_to(package.parent).as_posix() if path.is_relative_to(package.parent) else path.name)
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``.

    Where that is unset in local mode, as in tests, a folder below the SQL warehouse takes its place; on a cluster it has to
    be set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: lineage ends there, so lost executors cost nothing upstream."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(table: DataFrame) -> None:
    """Deletes a table that materialize wrote and nothing will read again."""
    spark = table.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.written_to)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
