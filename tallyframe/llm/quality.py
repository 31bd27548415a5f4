"""Quality classifier: hashed word n-grams and logistic regression, trained with follow-the-regularised-leader updates.

A token is a run of letters and digits or a run of other visible characters, case kept. A text's features are its tokens,
token pairs, and pairs and triples of token shapes (case, digits, first symbol), with a pair of equal tokens as a feature of
its own; all hashed to ``2**bits`` places. A place's value is 1 + log of its count, and the vector has length one. The
score is a sparse dot product with the weights, put through the logistic function.

Training: per-coordinate FTRL-proximal, one row at a time, over a sample of at most ``max_rows`` labelled rows (chosen by
hash of the id) with ``max_bytes`` of whole texts together; both are parameters. Scoring reads whole texts.

Defined results: a null or empty text has no features and gets the score of the bias alone; rows that repeat are scored
each; very long texts are scored whole; labelled rows without a text count as empty; with no labels the score is 0.5 everywhere; an empty table gives no
rows; extra columns are not read.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, fold_column, id_text, load, settle, utf8
from .units import Carried, Memo, held, new_key, slices

BITS, MAX_ROWS, MAX_BYTES, EPOCHS = 18, 4000, 16 << 20, 3
_TOKEN = re.compile(rb"[A-Za-z0-9_\x80-\xff]+|[^A-Za-z0-9_\x80-\xff\s]+")
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _token(token: bytes) -> int:
    """Hash of a token in the low 32 bits, its shape above."""
    text = token.decode("utf-8", "replace")
    if token[:1].isalnum() or token[0] >= 128 or token[:1] == b"_":
        if text.isdigit():
            shape = 1
        elif any(c.isdigit() for c in text):
            shape = 2
        elif len(text) > 1 and text.isupper():
            shape = 3
        elif text[:1].isupper():
            shape = 4
        else:
            shape = 5 + min(4, len(text) // 4)
    else:
        shape = 16 + token[0] % 64 + 64 * min(3, len(token) - 1)
    return zlib.crc32(token) | shape << 32


class Features:
    def __init__(self, bits: int = BITS):
        self.bits, self.memo = bits, Memo(lambda tokens: [*map(_token, tokens)])

    def __getstate__(self):
        return {"bits": self.bits}

    def __setstate__(self, state):
        self.__init__(state["bits"])

    def vector(self, text: str | bytes | None) -> tuple[np.ndarray, np.ndarray]:
        """Places and values of one text."""
        tokens = _TOKEN.findall(text if isinstance(text, bytes) else utf8(text))
        if not tokens:
            return np.zeros(0, np.int64), np.zeros(0)
        both = np.array(self.memo.all(tokens), np.uint64)
        word, shape = both & np.uint64(0xFFFFFFFF), both >> np.uint64(32)
        same = word[1:] == word[:-1]
        pair = np.where(same, np.uint64(7), word[:-1] * _A + word[1:])
        two = shape[:-1] * np.uint64(512) + shape[1:]
        three = two[:-1] * np.uint64(512) + shape[2:]
        keys = np.concatenate([word, pair + np.uint64(1 << 40), two + np.uint64(2 << 40), three + np.uint64(3 << 40)])
        places = ((keys * _B) >> np.uint64(64 - self.bits)).astype(np.int64)
        if len(places) > 1 << (self.bits - 3):
            counts = np.bincount(places, minlength=1 << self.bits)
            places = np.flatnonzero(counts)
            counts = counts[places]
        else:
            places, counts = np.unique(places, return_counts=True)
        values = 1 + np.log(counts)
        return places, values / np.sqrt((values * values).sum())


class FollowTheLeader:
    """Logistic regression by FTRL-proximal. The last weight is the bias."""

    def __init__(self, size: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.05, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def update(self, places: np.ndarray, values: np.ndarray, label: int) -> None:
        at = np.append(places, len(self.z) - 1)
        x = np.append(values, 1.0)
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - label) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


class QualityModel:
    def __init__(self, bits: int = BITS):
        self.features, self.weights, self.key = Features(bits), np.zeros((1 << bits) + 1), new_key()

    def fit(self, rows: list[tuple[bytes, int]], epochs: int = EPOCHS, seed: int = 7) -> QualityModel:
        vectors = [(at.astype(np.int32), x.astype(np.float32), y) for t, y in rows for at, x in [self.features.vector(t)]]
        learner = FollowTheLeader(1 << self.features.bits)
        rng = np.random.default_rng(seed)
        for _ in range(epochs):
            for i in rng.permutation(len(vectors)).tolist():
                learner.update(*vectors[i])
        self.weights = learner.weights()
        return self

    def score(self, text: str | bytes | None) -> float:
        places, values = self.features.vector(text)
        return float(1 / (1 + np.exp(-np.clip(self.weights[places] @ values + self.weights[-1], -30, 30))))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, wanted, max_rows: int | tuple[int, int], max_bytes: int, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[bytes, int]]:
    """Whole texts and labels of at most max_rows rows, chosen by the hash of the id (or so many of label 0 and of label 1),
    and of these, in that order, as many as have max_bytes together.

    An id with both labels is left out; of the texts that share an id the one with the least hash counts, so that repeated
    ids cost a row. Ids are chosen in the narrow table of labels, then texts by their sizes; only those are read and sent.
    """
    known = labels.select(column(labels, "doc_id").cast("long").alias("doc_id"), column(labels, label).cast("int").alias("y")).where("doc_id IS NOT NULL AND y IN (0, 1)")
    if wanted is not None:
        known = known.where(wanted)
    known = known.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("other")).where("y = other").select("doc_id", "y")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    if isinstance(max_rows, tuple):
        picked = [r for y in (0, 1) for r in known.where(F.col("y") == y).orderBy(*order).limit(max_rows[y]).collect()]
    else:
        picked = known.orderBy(*order).limit(max_rows).collect()
    by_id = {r.doc_id: r.y for r in picked}
    if not by_id:
        return []
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    narrow = id_text(docs, id_col, text_col).select("doc_id", text.cast("binary").alias("raw"), F.xxhash64(text).alias("hash"))
    ids = spark.createDataFrame([(i,) for i in by_id], "doc_id long")
    sizes = narrow.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min(F.struct("hash", F.octet_length("raw").alias("n"))).alias("first"))
    chosen, total = [], 0
    for r in sorted(sizes.select("doc_id", "first.*").collect(), key=lambda r: (zlib.crc32(str(r.doc_id).encode()), r.doc_id)):
        if total + r.n <= max_bytes:
            total += r.n
            chosen.append((r.doc_id, r["hash"]))
    if not chosen:
        return []
    few = F.broadcast(spark.createDataFrame(chosen, "doc_id long, hash long"))
    found = narrow.join(few, ["doc_id", "hash"]).groupBy("doc_id", "hash").agg(F.min("raw").alias("raw")).collect()
    return [(bytes(r.raw), by_id[r.doc_id]) for r in sorted(found, key=lambda r: (zlib.crc32(str(r.doc_id).encode()), r.doc_id))]


def score_documents(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score)."""
    carried = Carried(model)

    def run(batches):
        own = held(carried)
        for batch in batches:
            scores = [own.score(t) for a, n in slices(batch.column(1)) for t in batch.column(1).slice(a, n).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])
        settle()

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    rows = labelled_sample(docs, labels, "quality", fold_column(F.col("doc_id"), 5) != 0, MAX_ROWS, MAX_BYTES)
    scored = score_documents(docs, QualityModel().fit(rows))
    held = (fold_column(F.col("doc_id"), 5) == 0).alias("held_out")
    return scored.select("doc_id", held, "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
