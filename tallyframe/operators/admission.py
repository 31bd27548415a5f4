"""Admission checks: violations of input rows as a table, and a gate that fails before anything is written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.typed import scalar_json

IDENTITY = ("engine_id", "document_id", "page_id", "table_id")


class AdmissionError(ValueError):
    """Input rows break the contract of their profile."""


def row_violations(rows: DataFrame, fields: Sequence[str], page_index_required: bool = False) -> DataFrame:
    """(row_uid, violation): a row for each rule that an input row breaks. No shuffle."""
    page = F.col("page_index")
    required = {c: F.col(c).isNull() | (F.col(c) == "") for c in ("document_id", "page_id", "table_id", "engine_id")}
    rules: dict[str, Column] = {
        "undeclared_field": F.size(F.array_except(F.map_keys("cells"), F.array(*map(F.lit, fields)))) > 0,
        "engine_version_required": F.col("engine_version").isNull() | (F.col("engine_version") == ""),
        "page_index_invalid": page.isNotNull() & ~F.coalesce((page["t"] == "int") & ~page["s"].startswith("-"), F.lit(False)),
        "row_index_required": F.col("row_index").isNull(),
        "float_not_finite": F.exists(F.map_values("cells"), lambda v: (v["t"] == "float") & v["s"].isin("nan", "inf", "-inf", "NaN", "Infinity", "-Infinity")),
    } | {f"{c}_required": broken for c, broken in required.items()}
    if page_index_required:
        rules["page_index_required"] = page.isNull()
    found = F.filter(F.array(*[F.when(F.coalesce(broken, F.lit(False)), name) for name, broken in rules.items()]), lambda x: x.isNotNull())
    return rows.select("row_uid", F.explode_outer(found).alias("violation")).where("violation IS NOT NULL")


def duplicate_identities(rows: DataFrame) -> DataFrame:
    """(row_uid, occurrence): second and later rows of an identity, in stream order."""
    order = Window.partitionBy(*IDENTITY, "_index").orderBy("pos", "row_uid")
    return rows.withColumn("_index", scalar_json(F.col("row_index"))).withColumn("occurrence", F.row_number().over(order)).where("occurrence > 1").select("row_uid", "occurrence")


def engine_count(rows: DataFrame, least: int = 2) -> DataFrame:
    """(engines, enough)."""
    return rows.agg(F.count_distinct("engine_id").alias("engines")).select("engines", (F.col("engines") >= max(2, least)).alias("enough"))


def admit(rows: DataFrame, fields: Sequence[str], page_index_required: bool = False, least_engines: int = 2) -> DataFrame:
    """The rows themselves, or an AdmissionError that names the first violations."""
    bad = row_violations(rows, fields, page_index_required).unionByName(duplicate_identities(rows).select("row_uid", F.lit("duplicate_identity").alias("violation")))
    found = bad.orderBy("row_uid", "violation").take(5)
    if found:
        raise AdmissionError("; ".join(f"{r.row_uid}: {r.violation}" for r in found))
    engines = engine_count(rows, least_engines).first()
    if not engines.enough:
        raise AdmissionError(f"{engines.engines} engines, at least {max(2, least_engines)} are needed")
    return rows
