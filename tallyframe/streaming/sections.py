"""Reconciliation of arriving sections.

Everything after alignment is a matter of one section, so a stream of whole sections can be reconciled batch by batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..plans.reconcile import reconcile
from ..sources.profile import Profile


def reconcile_stream(rows: DataFrame, profile: Profile, expected: list[str], path: str, checkpoint: str, finish: Callable[[DataFrame, int], None] | None = None):
    """Starts a query that writes the cells of each micro-batch below path, under its number, so that a batch that is run
    again replaces its own output."""

    def batch(df: DataFrame, number: int) -> None:
        if df.isEmpty():
            return
        found = reconcile(df, profile, expected)  # writes its rows, records and cells once
        try:
            found.cells.write.mode("overwrite").parquet(f"{path}/batch={number}")
            if finish:
                finish(found.cells, number)
        finally:
            found.close()

    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).start()
