"""Runs as folders: reconcile, export for review, apply decisions, validate, publish.

A run's folder is named by what determines it, so the same inputs give the same folder. Tables become one file each, written
by the driver a partition at a time; ``parts`` leaves them as folders of parts instead, for results that no driver should
stream.
"""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import VERSION
from ..functions.text import natural_key
from ..operators import decisions, enrich, quality, review
from ..sources import artifacts, sinks
from ..sources.profile import Profile, load_profile
from ..sources.work import discard, materialize
from . import reconcile as job


class WorkflowError(ValueError):
    """A step of the workflow can't be done."""


def _lines(values: DataFrame, path: Path, parts: bool) -> str:
    if parts:
        values.write.mode("overwrite").text(str(path))
    else:
        sinks.write_lines(values, path)
    return str(path)


def parameters(profile: Profile, engines: Sequence[str]) -> dict:
    """What besides its inputs determines a reconciliation."""
    alignment, voting = profile.alignment(), profile.consensus()
    return {
        "command": "reconcile", "engine_ids": list(engines), "comparison_normalization": dict(profile.section("comparison_normalization")),
        "alignment": {
            "field_weights": dict(alignment.weights), "default_weight": alignment.default_weight, "gap_penalty": alignment.gap_penalty, "mismatch_penalty": alignment.mismatch_penalty,
            "minimum_match_similarity": alignment.minimum_match_similarity, "fuzzy_strings": alignment.fuzzy_strings, "anchor_engine": alignment.anchor_engine,
        },
        "consensus": {"fields": list(profile.fields), "majority_fraction": voting.majority_fraction, "minimum_majority_votes": voting.minimum_majority_votes},
    }


def reconciliation_summary(found: job.Reconciled) -> dict:
    """Counts of a reconciliation, before any review."""
    rows = {r.engine_id: r.n_rows for r in quality.rows_by_engine(found.records).collect()}
    status = {r["status"]: r["n"] for r in quality.status_counts(found.cells).collect()}
    heads = found.records.agg(F.count("*").alias("n"), F.count_if(F.size("members") < len(found.expected)).alias("lacking")).first()
    return {
        "schema_version": "1", "rows_by_engine": dict(sorted(rows.items())), "aligned_records": heads.n, "cell_status_counts": dict(sorted(status.items())),
        "unresolved_cells": review.unresolved(found.cells).count(), "missing_source_rows": heads.lacking, "claim_boundary": quality.AGREEMENT_BOUNDARY,
    }


def run_reconcile(spark: SparkSession, profile_path: str, inputs: Sequence[str], output: str, parts: bool = False) -> dict:
    """Reconciles files into <output>/<run id>/01-reconcile and returns paths and counts."""
    if not inputs:
        raise WorkflowError("at least two input files are required")
    files = [Path(p).expanduser().resolve() for p in inputs]
    if lost := [str(p) for p in files if not p.is_file()]:
        raise WorkflowError(f"input does not exist: {', '.join(lost)}")
    profile = load_profile(profile_path)
    found = job.reconcile_files(spark, [str(p) for p in files], profile)
    try:
        about = sinks.manifest(profile_path, files, VERSION, parameters(profile, found.expected), Path.cwd())
        run = Path(output).expanduser().resolve() / about["run_id"]
        stage = run / "01-reconcile"
        if not (run / "manifest.json").exists():
            sinks.write_document(about, run / "manifest.json")
        _lines(artifacts.aligned_lines(found.records, found.rows), stage / "aligned-rows.jsonl", parts)
        consensus = _lines(artifacts.consensus_lines(found.records, found.cells, found.expected), stage / "consensus.jsonl", parts)
        queue = _lines(artifacts.review_lines(found.review_queue(), found.records), stage / "review-queue.jsonl", parts)
        summary = reconciliation_summary(found)
        sinks.write_document(summary, stage / "reconciliation-summary.json")
        report = quality.validation_document(found.records, found.cells, profile.fields, len(found.expected), profile.page_identity_required())
        sinks.write_document(report, stage / "validation-report.json")
        return {"run_id": about["run_id"], "run_directory": str(run), "manifest": str(run / "manifest.json"), "consensus": consensus, "review_queue": queue, **summary}
    finally:
        found.close()


def _loaded(spark: SparkSession, path: str) -> tuple[Path, DataFrame, DataFrame]:
    artifact = artifacts.resolve_consensus(path)
    records, cells = artifacts.load_consensus(spark, str(artifact))
    return artifact, materialize(records, "records"), materialize(cells, "cells")


def _sha256(path: Path) -> str:
    """Of a file, or of a folder's parts in order."""
    if path.is_file():
        return sinks.file_sha256(path)
    import hashlib

    whole = hashlib.sha256()
    for part in sorted(path.glob("part-*")):
        with open(part, "rb") as f:
            while chunk := f.read(1 << 20):
                whole.update(chunk)
    return whole.hexdigest()


def export_review(spark: SparkSession, consensus: str, output: str, parts: bool = False) -> dict:
    """Writes a packet and an empty decision for each cell to review."""
    artifact, records, cells = _loaded(spark, consensus)
    try:
        target, items, digest = Path(output).expanduser().resolve(), review.review_items(cells), _sha256(artifact)
        queue = _lines(artifacts.review_lines(items, records), target / "review-queue.jsonl", parts)
        template = _lines(artifacts.template_lines(items, digest), target / "decision-template.jsonl", parts)
        summary = {"source_consensus": artifact.name, "source_consensus_sha256": digest, "review_item_count": items.count(), "review_queue": queue, "decision_template": template}
        sinks.write_document(summary, target / "review-export.json")
        return summary
    finally:
        discard(records)
        discard(cells)


def expected_of(records: DataFrame) -> list[str]:
    """Engines that a consensus expects: those that are there and those that are named as missing."""
    names = records.select(F.explode(F.concat(F.transform("members", lambda m: m["engine_id"]), "missing_engine_ids")).alias("e")).distinct().collect()
    return sorted(r.e for r in names)


def load_decisions(spark: SparkSession, path: str, records: DataFrame, cells: DataFrame, reviewer: str | None = None, decided_at: str | None = None) -> DataFrame:
    """Decisions of a file of decisions, or compiled from a file of workflow events."""
    if artifacts.decision_file_kind(spark, path) == "decisions":
        return artifacts.read_decisions(spark, path)
    return decisions.compile_events(artifacts.read_events(spark, path), records, cells, expected_of(records), reviewer, decided_at)


def apply_decision_file(spark: SparkSession, consensus: str, decision_path: str, profile_path: str, output: str | None = None, reviewer: str | None = None, decided_at: str | None = None, parts: bool = False) -> dict:
    """Applies a decision file into a folder that is named by the consensus, the decisions and the profile."""
    import hashlib

    artifact, records, cells = _loaded(spark, consensus)
    temporary = [records, cells]
    try:
        file = Path(decision_path).expanduser().resolve()
        if not file.is_file():
            raise WorkflowError(f"decision file does not exist: {file}")
        profile = load_profile(profile_path)
        made = materialize(review.decision_id(load_decisions(spark, str(file), records, cells, reviewer, decided_at)), "decisions")
        temporary.append(made)
        reviewed = materialize(review.apply_decisions(cells, made), "reviewed-cells")
        temporary.append(reviewed)
        digests = {"source_consensus_sha256": _sha256(artifact), "profile_sha256": sinks.file_sha256(profile_path)}
        # the decisions' part of the identity: their lines' digests, in order, so that no list of them is needed in one place
        lines = artifacts.decision_lines(made)
        compiled = hashlib.sha256()
        for r in lines.toLocalIterator():
            compiled.update(r[0].encode() + b"\n")
        application = "apply_" + hashlib.sha256(sinks.compact_json(digests | {"compiled_decisions_sha256": compiled.hexdigest()}).encode()).hexdigest()[:16]
        if output is None:
            root = artifact.parent.parent / "02-review" if artifact.parent.name == "01-reconcile" else artifact.parent / "review-applications"
        else:
            root = Path(output).expanduser().resolve()
        target = root / application
        names = {
            "compiled_decisions": _lines(lines, target / "compiled-decisions.jsonl", parts),
            "reviewed_consensus": _lines(artifacts.consensus_lines(records, reviewed, []), target / "reviewed-consensus.jsonl", parts),
        }
        remaining = review.review_items(reviewed)
        names["remaining_review_queue"] = _lines(artifacts.review_lines(remaining, records), target / "remaining-review-queue.jsonl", parts)
        report = quality.validation_document(records, reviewed, profile.fields, None, profile.page_identity_required())
        names["validation_report"] = str(sinks.write_document(report, target / "validation-report.json"))
        about = {
            "schema_version": "1", "application_id": application, **digests, "source_decisions_sha256": sinks.file_sha256(file), "compiled_decision_count": made.count(),
            "remaining_review_items": remaining.count(), "reviewed_consensus_sha256": _sha256(Path(names["reviewed_consensus"])),
        }
        sinks.write_document(about, target / "application.json")
        return {**about, "application_directory": str(target), **names, "ready_to_publish": report["ready_to_publish"]}
    finally:
        for table in temporary:
            discard(table)


def validate(spark: SparkSession, consensus: str, profile_path: str, report_path: str | None = None) -> dict:
    """The validation report of an artifact, with what it is a report of."""
    profile = load_profile(profile_path)
    artifact, records, cells = _loaded(spark, consensus)
    try:
        report = quality.validation_document(records, cells, profile.fields, None, profile.page_identity_required())
    finally:
        discard(records)
        discard(cells)
    report |= {"consensus_sha256": _sha256(artifact), "profile_sha256": sinks.file_sha256(profile_path)}
    if report_path:
        sinks.write_document(report, report_path)
        report["report"] = str(Path(report_path).expanduser().resolve())
    return report


def quality_document(records: DataFrame, cells: DataFrame, prices: DataFrame, expected: Sequence[str]) -> dict:
    """The quality summary of a publication."""
    one = quality.quality_summary(records, cells, prices, expected).first()
    status = {r["status"]: r["n"] for r in quality.status_counts(cells).collect()}
    rows = {r.engine_id: r.n_rows for r in quality.rows_by_engine(records).collect()}
    return {
        "total_cells": one.total, "status_counts": dict(sorted(status.items())), "unresolved_cells": one.unresolved, "unresolved_rate": one.unresolved_rate, "claim_boundary": quality.RECONCILIATION_BOUNDARY,
        "aligned_records": one.aligned_records, "published_records": one.aligned_records, "rows_by_engine": dict(sorted(rows.items())), "manual_or_agent_decisions": one.manual_or_agent_decisions,
        "cell_decisions": one.cell_decisions, "price_observations": one.price_observations, "unresolved_price_observations": one.unresolved_price_observations,
        "currencies": one.currencies.split(",") if one.currencies else [], "provenance_completeness": one.provenance_completeness, "source_accuracy_estimate": None, "source_accuracy_note": quality.ACCURACY_NOTE,
    }


def publish(spark: SparkSession, consensus: str, profile_path: str, output: str, allow_unresolved: bool = False, research_formats: bool = False, parts: bool = False) -> dict:
    """Writes records and prices as JSON lines, records, cells and prices as CSV, the quality summary and the validation report,
    and with research_formats Parquet tables and a DuckDB file. Parts: folders of parts in place of single files."""
    profile = load_profile(profile_path)
    artifact, records, cells = _loaded(spark, consensus)
    temporary = [records, cells]
    try:
        report = quality.validation_document(records, cells, profile.fields, None, profile.page_identity_required())
        job.check_ready(report, allow_unresolved)
        target = Path(output).expanduser().resolve()
        expected = expected_of(records)
        if "amount" in profile.roles:
            prices = materialize(enrich.price_views(cells, profile.roles, profile.prices()), "prices")
            temporary.append(prices)
        else:
            prices = spark.createDataFrame([], "record_id string, segment_index int, price_id string, value_raw string, value_numeric double, currency_code string, scale_factor double, basis string, denominator_unit string, conversion_role string, source_reported boolean, unresolved_reason string, source_cell_ids array<string>, currency_alias_matched string")
        views = materialize(enrich.research_views(cells, records, profile.fields, profile.roles, prices, **profile.dates()), "views")
        temporary.append(views)
        section = [natural_key(F.col(c)) for c in ("document_id", "page_id", "table_id")]
        order = [*section, "document_id", "page_id", "table_id", "ordinal"]
        _lines(views.orderBy(*order).select(enrich.research_json(views, profile.fields).alias("value")), target / "records.jsonl", parts)
        wide = enrich.record_table(views, profile.fields).orderBy(*order).select(*enrich.RECORD_COLUMNS, *[n for f in profile.fields for n in (f, f"{f}__status")])
        long = enrich.cell_table(views, profile.fields).orderBy(*order, "field_pos").select(*enrich.CELL_COLUMNS)
        place = views.select(F.col("record_id"), F.col("document_id").alias("d"), F.col("page_id").alias("p"), F.col("table_id").alias("t"), F.col("ordinal").alias("o"))
        by_record = prices.join(place, "record_id").orderBy(*[natural_key(F.col(c)) for c in "dpt"], "d", "p", "t", "o", "segment_index").select(*enrich.PRICE_COLUMNS)
        whole = lambda c: F.when(F.col(c) == F.floor(c), F.col(c).cast("decimal(38,0)").cast("string")).otherwise(F.col(c).cast("string"))
        from ..functions.typed import double_text, json_object, json_value

        kinds = {f.name: f.dataType for f in by_record.schema}
        number = lambda c: F.when(F.col(c).isNull(), "null").when(F.col(c) == F.floor(c), whole(c)).otherwise(double_text(F.col(c)))
        json_of = {n: number(n) if n in ("value_numeric", "scale_factor") else json_value(F.col(n), kinds[n]) for n in enrich.PRICE_COLUMNS}
        _lines(by_record.select(json_object(json_of).alias("value")), target / "prices.jsonl", parts)
        flat = by_record.withColumns(
            {
                **{c: F.when(F.col(c) == F.floor(c), whole(c)).otherwise(double_text(F.col(c))) for c in ("value_numeric", "scale_factor")}, "source_reported": F.initcap(F.col("source_reported").cast("string")),
                "source_cell_ids": F.concat(F.lit("["), F.array_join(F.transform("source_cell_ids", lambda x: F.concat(F.lit('"'), x, F.lit('"'))), ", "), F.lit("]")),
            }
        )
        for name, table in (("records", wide), ("cells", long), ("prices", flat)):
            if parts:
                sinks.write_csv(table, str(target / f"{name}.csv"))
            else:
                sinks.write_csv_file(table, target / f"{name}.csv", table.columns)
        summary = quality_document(records, cells, prices, expected)
        formats = None
        if research_formats:
            for name, table in (("records", wide), ("cells", long), ("prices", by_record)):
                table.write.mode("overwrite").option("compression", "zstd").parquet(str(target / f"{name}.parquet"))
            made = sinks.write_duckdb({n: str(target / f"{n}.parquet") for n in ("records", "cells", "prices")}, target / "research.duckdb")
            formats = {f"{n}_parquet": f"{n}.parquet" for n in ("records", "cells", "prices")} | ({"duckdb": made.name} if made else {})
        summary["research_formats"] = formats or {"status": "not_generated"}
        sinks.write_document(summary, target / "quality-summary.json")
        sinks.write_document(report, target / "validation-report.json")
        about = {
            "schema_version": "1", "consensus_sha256": _sha256(artifact), "profile_sha256": sinks.file_sha256(profile_path), "allow_unresolved": allow_unresolved, "output_directory": str(target),
            "record_count": report["record_count"], "unresolved_cell_count": report["unresolved_cell_count"], "quality_summary": str(target / "quality-summary.json"),
        }
        sinks.write_document(about, target / "publication.json")
        return {**about, "quality": summary}
    finally:
        for table in temporary:
            discard(table)
