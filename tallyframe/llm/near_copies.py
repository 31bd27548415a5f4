"""Near copies by the Jaccard similarity of word shingles: SimHash and pivot distance tables find candidates, exact sets decide.

Words are those of ``simhash``; a document is the set of its shingles of five words (fewer words make one shingle). Two
documents are linked where the sets' Jaccard similarity is ``LEAST`` or more.

The search is that of ``simhash``, by a wider rule. At 0.8 a bit of the fingerprint differs with a probability of 0.15 (0.161
for the worst sizes of sets from six shingles on), far too often for one fingerprint's parts, so there are ``LANES``
fingerprints of 64 bits, the first by the shingles' XXH64 and the others by that hash mixed with a constant. Nodes meet where
one of the ``PARTS`` parts of one of them is equal; a pair at 0.8 meets nowhere once in 15,000, and once in 3,500 at the worst
sizes. Only five shingles and four of them differ more often (0.1875): those meet by the four themselves. In a bucket, pivot
distance tables leave out what can't be within ``RADIUS`` bits, and what is left is compared, that fingerprint and the next.
Small buckets have fixed pivots; a large one takes its own from among its nodes, each the farthest from those before it, so
that groups of near copies leave each other out as a whole. (Between unrelated nodes no pivot is near enough to one of them
to tell much: those are mostly left out by the comparison.) A bucket hands on a spanning forest of its links.

What fingerprints link, step by step, is a family, and in a family all pairs are decided on the texts, by an index of its
shingles; a large family is cut into chunks, and each two chunks are a block of their own. A block hands on a spanning forest
of the pairs that are similar. So no bucket or family has a cap, and rows grow with documents, not with pairs.

Documents with the same words are one node (a 64-bit hash of them), so copies cost nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, materialize, settle, utf8
from .components import connected_components
from .simhash import SEED, Forest, bit_parts, linked_pairs, pivots
from .units import release, slices

SHINGLE, LEAST = 5, 0.8
LANES, PARTS, RADIUS, NEXT_RADIUS = 15, 5, 14, 17
#: Buckets of more nodes have pivots of their own.
SMALL, PIVOTS = 64, 4
#: Nodes and bytes of text in a chunk of a family.
CHUNK, CHUNK_BYTES = 512, 4 << 20
_SALTS = pivots(LANES)
_PARTS = [(bits[0], len(bits)) for bits in bit_parts(list(range(64)), PARTS)]


def mixed(z: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def sketch(text: str | None) -> tuple[int, np.ndarray, list[int]]:
    """Hash of the words, the fingerprints of the set of shingles, and hashes of the four shingles of sets of four and five."""
    from xxhash import xxh64_intdigest

    words = utf8(text).lower().split()
    line, n = b" ".join(words), max(1, len(words) - SHINGLE + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    ends = ends[SHINGLE - 1 :].tolist() or [len(line)]
    h = np.unique(np.fromiter((xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, n))
    total = np.zeros(64 * LANES, np.int64)
    for at in range(0, len(h), 255):  # so many fit a byte's sum
        own = h[at : at + 255, None]
        each = np.concatenate((own, mixed(own ^ _SALTS[None, 1:])), axis=1).astype(">u8").view(np.uint8)
        total += np.unpackbits(each, axis=1).sum(axis=0, dtype=np.uint8)
    fps = np.packbits(2 * total > len(h)).view(">u8").astype(np.uint64)
    parts = mixed(h)
    whole = parts.sum(dtype=np.uint64)
    fours = [int(whole)] if len(h) == 4 else (whole - parts).tolist() if len(h) == 5 else []
    return xxh64_intdigest(line, SEED), fps, fours


def shingles(text: str | None) -> set[bytes]:
    words = utf8(text).lower().split()
    return {b" ".join(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}


def similar(a: set, b: set) -> bool:
    both = len(a & b)
    return 5 * both >= 4 * (len(a) + len(b) - both)  # LEAST, in whole numbers


def sketches(docs: DataFrame, names: list[str], kinds: str, text_col: str = "text") -> DataFrame:
    """The named columns of docs, whose types are kinds, then node, fps and fours."""

    def run(batches):
        release()
        for whole in batches:
            for a, n in slices(whole.column(len(names))):
                yield one(whole.slice(a, n))
        settle()

    def lists(values: list) -> pa.ListArray:
        ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
        flat = np.concatenate([np.zeros(0, np.uint64), *(np.array(v, np.uint64) for v in values)])
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))

    def one(batch):
        got = [sketch(t) for t in batch.column(len(names)).to_pylist()]
        node = pa.array(np.array([g[0] for g in got], np.uint64).view(np.int64))
        return pa.RecordBatch.from_arrays([*batch.columns[: len(names)], node, *(lists([g[k] for g in got]) for k in (1, 2))], [*names, "node", "fps", "fours"])

    return docs.select(*names, column(docs, text_col).cast("string").alias("__text")).mapInArrow(run, f"{kinds}, node long, fps array<long>, fours array<long>")


def dealt(nodes: DataFrame) -> DataFrame:
    """(key, node, fp, next): a row for each part of each fingerprint of (node, fps), with the fingerprint behind that one."""

    def run(batches):
        release()
        for batch in batches:
            fps = batch.column(1).flatten().to_numpy().view(np.uint64).reshape(-1, LANES)
            node = batch.column(0).to_numpy()
            for lane in range(LANES):
                fp, behind = fps[:, lane], fps[:, (lane + 1) % LANES]
                keys = [((fp >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) + ((lane * PARTS + p) << 16) for p, (at, width) in enumerate(_PARTS)]
                columns = [np.concatenate(keys), *(np.tile(x, PARTS) for x in (node, fp.view(np.int64), behind.view(np.int64)))]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["key", "node", "fp", "next"])

    return nodes.select("node", "fps").mapInArrow(run, "key long, node long, fp long, next long")


def own_pivots(fp: np.ndarray) -> np.ndarray:
    """Some of the fingerprints, each the farthest from those before it."""
    chosen, away = [0], np.bitwise_count(fp ^ fp[0])
    for _ in range(PIVOTS - 1):
        chosen.append(int(away.argmax()))
        away = np.minimum(away, np.bitwise_count(fp ^ fp[chosen[-1]]))
    return fp[chosen]


def spanning(fp: np.ndarray, behind: np.ndarray):
    """Yields (x, y): positions in a bucket, a position and those within the radii that nothing has led to before."""
    table = np.bitwise_count(fp[None, :] ^ own_pivots(fp)[:, None]).astype(np.int8)
    left, queue = np.arange(1, len(fp)), [0]
    while len(left):
        if not queue:
            queue, left = [int(left[0])], left[1:]
        x = queue.pop()
        near = np.ones(len(left), bool)
        for d in table:
            near &= np.abs(d[left] - d[x]) <= RADIUS
        y = left[near]
        y = y[np.bitwise_count(fp[y] ^ fp[x]) <= RADIUS]
        y = y[np.bitwise_count(behind[y] ^ behind[x]) <= NEXT_RADIUS]
        if len(y):
            yield np.full(len(y), x), y
            queue += y.tolist()
            left = np.setdiff1d(left, y, assume_unique=True)


def bucket_forests(key: np.ndarray, fp: np.ndarray, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (x, y): a spanning forest of the links of each bucket; rows are sorted by key."""
    cuts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
    size = np.repeat(np.diff(cuts), np.diff(cuts))
    found, forest = [(np.zeros(0, np.int64),) * 2], Forest(len(key))
    small = np.flatnonzero((size > 1) & (size <= SMALL))
    for i, j in linked_pairs(fp[small], key[small], RADIUS, pivots(PIVOTS)) if len(small) else ():
        x, y = small[i], small[j]
        near = np.bitwise_count(behind[x] ^ behind[y]) <= NEXT_RADIUS
        x, y = x[near], y[near]
        new = np.array([forest.join(a, b) for a, b in zip(x.tolist(), y.tolist())], bool)
        found.append((x[new], y[new]))
    for c in np.flatnonzero(np.diff(cuts) > SMALL).tolist():
        own = slice(int(cuts[c]), int(cuts[c + 1]))
        found += [(x + own.start, y + own.start) for x, y in spanning(fp[own], behind[own])]
    return tuple(np.concatenate([f[k] for f in found]) for k in (0, 1))


def fingerprint_links(nodes: DataFrame) -> DataFrame:
    """(a, b), a < b: links between the fingerprints of (node, fps), enough of them to connect whatever meets in a bucket."""
    rows = dealt(nodes).repartition("key").sortWithinPartitions("key", "fp", "node")

    def run(batches):
        def flush(held):
            key, node, fp, behind = (np.concatenate([r[k] for r in held]) for k in range(4))
            x, y = bucket_forests(key, fp.view(np.uint64), behind.view(np.uint64))
            a, b = np.unique(np.stack((np.minimum(node[x], node[y]), np.maximum(node[x], node[y]))), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        release()
        held, n = [], 0
        for batch in batches:
            cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
            if n >= 50_000:  # whole buckets only: flush up to the last one's start
                last = np.flatnonzero(cols[0] != held[-1][0][-1])
                if len(last):
                    c = int(last[0])
                    held.append([x[:c] for x in cols])
                    yield flush(held)
                    held, n, cols = [], 0, [x[c:] for x in cols]
            held.append(cols)
            n += len(cols[0])
        if n:
            yield flush(held)
        settle()

    return rows.mapInArrow(run, "a long, b long").distinct()


def of_fours(nodes: DataFrame) -> DataFrame:
    """(a, b): sets of four shingles and of those four and a fifth."""
    four = nodes.where(F.size("fours") == 1).select(F.col("node").alias("x"), F.col("fours")[0].alias("four"))
    five = nodes.where(F.size("fours") == 5).select(F.col("node").alias("y"), F.explode("fours").alias("four"))
    return four.join(five, "four").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def similar_pairs(texts: list) -> list[tuple[int, int]]:
    """Positions of a spanning forest of the pairs that are similar."""
    if len(texts) <= 8:
        forest, sets = Forest(len(texts)), [shingles(t) for t in texts]
        pairs = ((x, y) for y in range(len(texts)) for x in range(y))
        return [(x, y) for x, y in pairs if forest.find(x) != forest.find(y) and similar(sets[x], sets[y]) and forest.join(x, y)]
    from xxhash import xxh64_intdigest

    own = [np.fromiter((xxh64_intdigest(s, SEED) for s in shingles(t)), np.uint64) for t in texts]
    size = np.array([len(h) for h in own])
    ends = np.cumsum(size)
    _, which = np.unique(np.concatenate(own), return_inverse=True)
    order = np.argsort(which, kind="stable")
    holder = np.repeat(np.arange(len(texts)), size)[order]  # who holds a shingle, one shingle behind the other
    stop = np.cumsum(np.bincount(which)).tolist()
    links, left, queue = [], np.ones(len(texts), bool), []
    for start in range(len(texts)):
        if not left[start]:
            continue
        left[start], queue = False, [start]
        while queue:
            x = queue.pop()
            met = [holder[stop[w - 1] if w else 0 : stop[w]] for w in which[ends[x] - size[x] : ends[x]].tolist()]
            both = np.bincount(np.concatenate(met), minlength=len(texts))
            near = np.flatnonzero(left & (5 * both >= 4 * (size[x] + size - both))).tolist()
            mine = shingles(texts[x]) if near else None
            near = [y for y in near if similar(mine, shingles(texts[y]))]
            left[near] = False
            links += [(x, y) for y in near]
            queue += near
    return links


def similar_links(links: DataFrame, texts) -> DataFrame:
    """(a, b): of the families that links make, enough pairs of similar texts to connect what such pairs connect, step by step."""
    families = connected_components(links, "near-families").withColumnRenamed("component", "family")
    members = materialize(texts(families.select("node")).join(families, "node").select("family", "node", "text"), "near-texts")
    counted = members.groupBy("family").agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes"))
    large = counted.select("family", F.ceil(F.greatest(F.col("rows") / CHUNK, F.col("bytes") / CHUNK_BYTES)).cast("long").alias("n")).where("n > 1")
    placed = members.join(large, "family", "left").withColumn("n", F.coalesce("n", F.lit(1))).withColumn("chunk", F.pmod(F.xxhash64("node"), "n"))
    blocks = placed.select("family", "node", "text", "n", "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("other")).where("n = 1 OR chunk <> other")
    rows = blocks.select("family", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "node", "text")

    def run(batches):
        def flush():
            nodes = [node for node, _ in held]
            return [(nodes[x], nodes[y]) for x, y in similar_pairs([text for _, text in held])]

        release()
        of, held = None, []
        for batch in batches:
            out = []
            for at, n in slices(batch.column(4), 1 << 20):
                family, i, j, node, text = (c.to_pylist() for c in batch.slice(at, n).columns)
                for key, own in zip(zip(family, i, j), zip(node, text)):
                    if key != of:
                        out += flush()
                        of, held = key, []
                    held.append(own)
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], ["a", "b"])
        out = flush()
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], ["a", "b"])
        settle()

    return rows.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j", "node").mapInArrow(run, "a long, b long")


def node_components(found: DataFrame, texts) -> DataFrame:
    """(node, component) of the sketches; texts: a function that gives (node, text) of a table of nodes."""
    nodes = found.select("node", "fps", "fours").dropDuplicates(["node"])
    linked = connected_components(similar_links(fingerprint_links(nodes).union(of_fours(nodes)), texts), "near-links")
    return found.select("node").distinct().join(linked, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
