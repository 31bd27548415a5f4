"""The whole job: rows of several engines to reviewed, published records.

Rows, records and cells are written once, to the shared work folder, and read back by everything that follows: lines are
parsed once and sections aligned once, however many checks, views and summaries there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..operators import align, consensus, decisions, enrich, quality, review
from ..operators.admission import admit
from ..operators.normalize import check_collisions, normalized_rows
from ..sources import jsonl, sinks
from ..sources.profile import Profile
from ..sources.work import discard, materialize


@dataclass(frozen=True)
class Reconciled:
    records: DataFrame
    cells: DataFrame
    expected: list[str]
    rows: DataFrame | None = None
    written: tuple[DataFrame, ...] = field(default=(), repr=False)

    def review_queue(self) -> DataFrame:
        return review.review_items(self.cells)

    def decided(self, rows: DataFrame) -> Reconciled:
        """With decisions on cells in place. The new cells are written as well."""
        cells = materialize(review.apply_decisions(self.cells, rows), "decided-cells")
        return Reconciled(self.records, cells, self.expected, self.rows, (*self.written, cells))

    def compiled(self, events: DataFrame, reviewer: str | None = None, decided_at: str | None = None) -> Reconciled:
        """Events to decisions, and those applied; all or nothing."""
        return self.decided(decisions.compile_events(events, self.records, self.cells, self.expected, reviewer, decided_at))

    def close(self) -> None:
        """Deletes what the job wrote for itself. The tables can't be read any more then."""
        for table in self.written:
            discard(table)


def reconcile(rows: DataFrame, profile: Profile, expected: Sequence[str] | None = None) -> Reconciled:
    """Admits, normalises, aligns and votes. Fails on the first broken contract, before records are made."""
    kept = materialize(rows, "rows")
    admitted = admit(jsonl.check_rows(kept) if "problem" in kept.columns else kept, profile.fields, profile.page_index_required(), profile.minimum_engines())
    config = profile.normalization()
    check_collisions(admitted, profile.fields, config)
    engines = consensus.expected_engines(admitted, expected)
    normal = normalized_rows(admitted, profile.fields, config)
    records = materialize(align.records_of(align.align_fuzzy(normal, profile.alignment()), normal), "records")
    cells = materialize(consensus.cells(records, profile.fields, engines, profile.consensus()), "cells")
    return Reconciled(records, cells, engines, kept, (kept, records, cells))


def reconcile_files(spark: SparkSession, paths: Sequence[str], profile: Profile, expected: Sequence[str] | None = None) -> Reconciled:
    return reconcile(jsonl.read_rows(spark, paths), profile, expected)


class PublicationError(ValueError):
    """What is to be published isn't ready."""


def check_ready(report: dict, allow_unresolved: bool) -> None:
    """Structural violations always block; unresolved cells do unless they are allowed."""
    if not report["structurally_valid"]:
        raise PublicationError("publication blocked, structural errors: " + "; ".join(report["errors"][:5]))
    if report["unresolved_cell_count"] and not allow_unresolved:
        targets = ", ".join(f"{t['record_id']}.{t['field']}" for t in report["unresolved_targets"][:5])
        raise PublicationError(f"publication blocked, {report['unresolved_cell_count']} unresolved cells: {targets}")


def publish(found: Reconciled, profile: Profile, path: str, allow_unresolved: bool = False) -> dict:
    """Writes records, cells, wide rows and prices as Parquet, and returns the quality summary. See workflow for all formats."""
    check_ready(quality.validation_document(found.records, found.cells, profile.fields, len(found.expected), profile.page_identity_required()), allow_unresolved)
    prices = enrich.prices(found.cells, profile.roles, profile.prices()) if "amount" in profile.roles else None
    sinks.write_parquet(enrich.published_records(found.cells, found.records, profile.roles, **profile.dates()), f"{path}/records")
    sinks.write_parquet(enrich.cell_rows(found.cells), f"{path}/cells")
    sinks.write_parquet(enrich.wide_rows(found.cells, profile.fields), f"{path}/wide")
    summary = quality.status_summary(found.cells)
    if prices is not None:
        sinks.write_parquet(prices, f"{path}/prices")
        summary = quality.quality_summary(found.records, found.cells, prices, found.expected)
    return summary.first().asDict()
