"""Helpers shared by the training-data operators."""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..sources.work import discard, materialize, new_path, shared_dir  # noqa: F401


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Reads ``<sf_dir>/<table>.parquet``, a file or a folder, in any store that Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def column(df: DataFrame, name: str):
    """The column of that very name, dots and all."""
    return df["`" + name.replace("`", "``") + "`"]


def map_columns(df: DataFrame, run, schema: StructType) -> DataFrame:
    """mapInArrow for tables with any names of columns: within run they are c0, c1, and so on."""
    plain = df.toDF(*[f"c{k}" for k in range(len(df.columns))])
    inner = StructType([StructField(f"c{k}", f.dataType, True) for k, f in enumerate(schema)])
    return plain.mapInArrow(run, inner).toDF(*schema.names)


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text): all that the operators read, whatever else a table holds."""
    return df.select(column(df, id_col).cast("long").alias("doc_id"), column(df, text_col).cast("string").alias("text"))


def local_table(spark: SparkSession, rows: list[tuple], schema: pa.Schema) -> DataFrame:
    """A small table from the driver as a part of the plan. A list of rows would go through Python workers of another kind,
    which every executor then keeps beside those of the operators."""
    return spark.createDataFrame(pa.table([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema))


def fold(doc_id: int, folds: int) -> int:
    """Remainder of the crc32 of the id as text."""
    return zlib.crc32(str(doc_id).encode()) % folds


def fold_column(col, folds: int):
    return F.crc32(col.cast("string").cast("binary")) % folds


def settle() -> None:
    """Gives memory that a Python worker has freed back to the system; Spark keeps workers for the tasks to come."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:  # glibc has it
        trim(0)


def utf8(text: str | None) -> bytes:
    """UTF-8 bytes; a null text has none."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")
