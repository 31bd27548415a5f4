"""Sharding by global byte-size prefix sums: contiguous shards cut at equal targets.

Rows are put in order by doc_id (nulls first; then size and checksum, so that ties have a fixed order), over range
partitions. Each partition adds up its bytes; the running total of those few sums places every partition in the whole, and
a second scan adds a running sum within the partition. A row goes to the shard in whose equal share of all bytes its
middle byte falls. No text is shuffled: size and checksum are computed where the text is read.

Defined results: a null text has no bytes; its size is ``row_bytes``; repeated rows are rows of their own; an empty table
gives no rows; shards may be empty where there are fewer rows than shards; extra columns are not read.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_text, load, shared_dir

SCHEMA = "doc_id long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int"


def _shard_of(start: np.ndarray, size: np.ndarray, total: int, shards: int) -> np.ndarray:
    """floor((start + size / 2) / total * shards) in whole numbers; by quotient and remainder, so that nothing overflows."""
    middle = 2 * start + size
    q, r = np.divmod(middle, 2 * total)
    if total < 2**62 // (2 * shards):
        got = q * shards + r * shards // (2 * total)
    else:
        got = np.array([int(x) * shards // (2 * total) for x in middle.tolist()], np.int64)
    return np.minimum(got, shards - 1)


def shard_by_bytes(docs: DataFrame, shards: int = 24, row_bytes: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    narrow = id_text(docs, id_col, text_col).select(
        "doc_id", (F.octet_length(text) + F.lit(row_bytes)).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    order = ["doc_id", "size", "text_crc32"]
    # kept in the shared folder with its partitions: ranges sampled again could be cut elsewhere
    shared_dir(docs.sparkSession)
    placed = narrow.repartitionByRange(*order).withColumn("part", F.spark_partition_id()).sortWithinPartitions(*order).checkpoint()
    sums = placed.groupBy("part").agg(F.sum("size").alias("bytes")).collect()  # a row for each partition
    start, before = {}, 0
    for r in sorted(sums, key=lambda r: r["part"]):
        start[r["part"]] = before
        before += r["bytes"]
    total = before
    def assign(batches, count: bool, first: dict):
        part, at, seen = None, 0, {}
        for batch in batches:
            parts = batch.column(3).to_numpy(zero_copy_only=False)
            sizes = batch.column(1).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if parts[a] != part:
                    part, at, seen = int(parts[a]), start[int(parts[a])], dict(first.get(int(parts[a]), {}))
                size = sizes[a:b]
                end = at + np.cumsum(size)
                shard = _shard_of(end - size, size, total, shards)
                at = int(end[-1])
                if count:
                    ids, n = np.unique(shard, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), part, np.int32)), pa.array(ids.astype(np.int32)), pa.array(n)], ["part", "shard", "n"])
                    continue
                slot = np.empty(b - a, np.int64)
                for s in np.unique(shard).tolist():  # contiguous, as are the shards
                    lo, hi = bisect.bisect_left(shard, s), bisect.bisect_right(shard, s)
                    slot[lo:hi] = np.arange(hi - lo) + seen.get(s, 0)
                    seen[s] = seen.get(s, 0) + hi - lo
                piece = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [
                        *piece.columns[:3],
                        pa.array(["bytes"] * (b - a)),
                        pa.array(shard.astype(np.int32)),
                        pa.array(slot),
                        pa.nulls(b - a, pa.int32()),
                    ],
                    ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
                )

    counted = placed.mapInArrow(lambda it: assign(it, True, {}), "part int, shard int, n long")
    # at most one row for each partition and shard that it touches: partitions + shards
    rows = counted.groupBy("part", "shard").agg(F.sum("n").alias("n")).collect()
    first, so_far = {}, {}
    for r in sorted(rows, key=lambda r: (r["part"], r["shard"])):
        first.setdefault(r["part"], {})[r["shard"]] = so_far.get(r["shard"], 0)
        so_far[r["shard"]] = so_far.get(r["shard"], 0) + r["n"]
    return placed.mapInArrow(lambda it: assign(it, False, first), SCHEMA)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(load(spark, sf_dir, "documents"), shards=24)
