"""SimHash near-duplicates, searched with pivot distance tables.

Fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles of three words (repeats included; fewer words make
one shingle; none gives zero), XXH64 with seed 42 of each shingle; a bit is 1 where over half the hashes have it.

Links: two fingerprints with at most ``radius`` differing bits. Equal fingerprints are one node first, so copies cost
nothing. Nodes meet where one of ``radius + 1`` parts of the 64 bits is equal, which every linked pair has. In such a
bucket, a table holds each fingerprint's Hamming distances to reference fingerprints (pivots); by the triangle inequality
a pair is out as soon as one coordinate differs by more than ``radius``; the survivors are compared bit by bit. A bucket
over ``SPLIT`` nodes is split by the parts of its remaining bits in the same way, as often as needed, so no large group
is compared with itself as a whole. A bucket hands on a spanning forest of its links at most, never all pairs.

Defined results: null and empty texts and texts of white space have fingerprint zero and are linked like any other;
repeated rows each get a row; rows with a null id get a fingerprint and link others but lend no id to a component, whose id
is null where no row of it has one; very long texts are read whole; an empty table gives no rows; extra columns are not read.

Which pairs are looked at is decided by equal parts, of which every linked pair has one; the pivot tables then leave few of
those pairs to be compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_text, load, materialize, settle, utf8
from .components import connected_components
from .units import slices

SEED = 42
PIVOTS = 16
SPLIT = 2048


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash."""
    from xxhash import xxh64_intdigest

    words = utf8(text).lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(line, SEED)
    ends = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(ends + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    total, n = np.zeros(64, np.int64), len(words) - shingle + 1
    a, b = starts[:n].tolist(), ends[shingle - 1 :].tolist()
    for at in range(0, n, 4096):
        h = [xxh64_intdigest(line[x:y], SEED) for x, y in zip(a[at : at + 4096], b[at : at + 4096])]
        total += np.unpackbits(np.array(h, ">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            texts = (t for a, n in slices(batch.column(1)) for t in batch.column(1).slice(a, n).to_pylist())
            fps = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])
        settle()

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints from a fixed generator: the finaliser of splitmix64 over 1..n."""
    z = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def bit_parts(bits: list[int], parts: int) -> list[list[int]]:
    return [[int(b) for b in x] for x in np.array_split(np.array(bits), parts)]


def extract(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    """The given bits of each fingerprint, packed."""
    out = np.zeros(len(fp), np.uint64)
    for k, b in enumerate(bits):
        out |= ((fp >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)
    return out


def linked_pairs(fp: np.ndarray, key: np.ndarray, radius: int, ref: np.ndarray):
    """Yields (i, j) arrays of positions with equal key and at most radius differing bits; key must be sorted."""
    table = np.bitwise_count(fp[:, None] ^ ref[None, :]).astype(np.int8)
    i, lag = np.arange(len(fp)), 0
    while True:
        lag += 1
        i = i[i + lag < len(fp)]
        i = i[key[i] == key[i + lag]]
        if not len(i):
            return
        left = i
        for p in range(table.shape[1]):  # the maximum coordinate difference, a coordinate at a time
            left = left[np.abs(table[left, p] - table[left + lag, p]) <= radius]
        left = left[np.bitwise_count(fp[left] ^ fp[left + lag]) <= radius]
        if len(left):
            yield left, left + lag


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def bucket_links(fp: np.ndarray, key: np.ndarray, radius: int, ref: np.ndarray, bits: list[int], split: int = SPLIT) -> list[tuple[int, int]]:
    """A spanning forest of the links within the runs of equal key. bits: those that the key doesn't fix."""
    forest, links = Forest(len(fp)), []

    def gather(at: np.ndarray, k: np.ndarray, free: list[int]) -> None:
        order = np.argsort(k, kind="stable")
        at, k = at[order], k[order]
        cuts = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1], [True])))
        size = np.diff(cuts)
        small = np.repeat((size > 1) & ((size <= split) | (len(free) <= radius + 1)), size)
        if small.any():
            here = at[small]
            for i, j in linked_pairs(fp[here], k[small], radius, ref):
                for x, y in zip(here[i].tolist(), here[j].tolist()):
                    if forest.join(x, y):
                        links.append((x, y))
        if len(free) > radius + 1:
            for c in np.flatnonzero(size > split).tolist():
                group = at[cuts[c] : cuts[c + 1]]
                for part in bit_parts(free, radius + 1):
                    gather(group, extract(fp[group], part), [b for b in free if b not in set(part)])

    gather(np.arange(len(fp)), key, bits)
    return links


def fingerprint_links(nodes: DataFrame, radius: int = 3, n_pivots: int = PIVOTS, split: int = SPLIT) -> DataFrame:
    """(a, b): links between the nodes of (node, fp), enough of them to connect whatever is within radius, step by step."""
    parts = bit_parts(list(range(64)), radius + 1)
    n_parts = len(parts)

    def key_of(p: int):
        lo, width = parts[p][0], len(parts[p])
        return F.shiftrightunsigned(F.col("fp"), lo).bitwiseAND(F.lit((1 << width) - 1))

    keyed = nodes.select("node", "fp", F.posexplode(F.array(*[key_of(p) for p in range(n_parts)])).alias("part", "value"))
    ref = pivots(n_pivots)
    dealt = keyed.repartition("part", "value").sortWithinPartitions("part", "value", "fp")

    def run(batches):
        def flush(rows):
            node = np.concatenate([r[0] for r in rows])
            fp = np.concatenate([r[1] for r in rows]).view(np.uint64)
            part = np.concatenate([r[2] for r in rows])
            value = np.concatenate([r[3] for r in rows])
            a, b = [], []
            for p in np.unique(part).tolist():
                on = part == p
                at, bits = node[on], [x for x in range(64) if x not in parts[p]]
                for x, y in bucket_links(fp[on], value[on], radius, ref, bits, split):
                    a.append(at[x])
                    b.append(at[y])
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        held, n = [], 0
        for batch in batches:
            cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
            if n >= 200_000:  # whole buckets only: flush up to the last one's start
                last = np.flatnonzero((cols[2] != held[-1][2][-1]) | (cols[3] != held[-1][3][-1]))
                if len(last):
                    c = int(last[0])
                    held.append([x[:c] for x in cols])
                    yield flush(held)
                    held, n, cols = [], 0, [x[c:] for x in cols]
            held.append(cols)
            n += len(cols[0])
        if n:
            yield flush(held)

    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = 3, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id): component_id is the least doc_id that links lead to."""
    prints = materialize(fingerprints(docs, shingle, id_col, text_col), "simhash")
    # a node is a fingerprint; ids are only what it carries, so that rows without one are no node of their own
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    found = connected_components(fingerprint_links(nodes.select(F.col("fp").alias("node"), "fp"), radius), "simhash-links")
    classes = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    least = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    named = classes.select("fp", "component").join(least, "component").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(load(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
