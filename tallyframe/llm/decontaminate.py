"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark windows.

Texts are lower-cased in A-Z only and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. Byte for byte this is a
translation table over UTF-8, so the position of a word in the normalised bytes is its position in the original.
Every window of an item (``window`` consecutive words; a shorter item is one window) is a key of the automaton, and
each document is scanned once.

Defined results: a null or empty text has no words and no hits; a benchmark row with a null id or without words is
ignored; rows that share an id are one item; repeated documents each get their own row; empty tables give no rows or no
hits; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, id_text, load, settle, utf8
from .units import Carried, held, new_key, slices

#: Bytes of patterns in one automaton. A benchmark beyond that is scanned for by several.
BLOCK_BYTES = 4_000_000
_KEEP = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(rb"[^ ]+")

SCHEMA = (
    "doc_id long, n_words long, items array<string>, "
    "hits array<struct<first_word:int,last_word:int,byte_start:int,byte_end:int,char_start:int,char_end:int>>"
)


def words_of(text: str | None) -> list[bytes]:
    return utf8(text).translate(_KEEP).split()


def windows_of(words: list[bytes], window: int) -> list[tuple[int, bytes]]:
    """(number of words, the words between single spaces with one before and one behind)."""
    if not words:
        return []
    k = min(window, len(words))
    return [(k, b" " + b" ".join(words[i : i + k]) + b" ") for i in range(len(words) - k + 1)]


class Matcher:
    """The automaton, built where it is first used; what travels is the windows' text."""

    def __init__(self, patterns: dict[bytes, tuple[int, tuple[str, ...]]]):
        self.patterns = patterns
        self.automaton, self.key = None, new_key()

    def __getstate__(self):
        return {"patterns": self.patterns, "automaton": None, "key": self.key}

    def build(self):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for key, value in self.patterns.items():
            self.automaton.add_word(key.decode("latin-1"), value)
        self.automaton.make_automaton()

    def scan(self, text: str | None) -> tuple[int, list[str], list[tuple[int, int, int, int, int, int]]]:
        """Number of words, sorted ids of the items found, and maximal runs of hit words with their place in the original."""
        if self.automaton is None:
            self.build()
        raw = utf8(text)
        kept = raw.translate(_KEEP)
        words = kept.split()
        norm = b" " + b" ".join(words) + b" "
        found = list(self.automaton.iter(norm.decode("latin-1"))) if words and self.patterns else []
        if not found:
            return len(words), [], []
        spaces = np.flatnonzero(np.frombuffer(norm, np.uint8) == 32)
        ends = np.searchsorted(spaces, np.fromiter((e for e, _ in found), np.int64))
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, ends - np.fromiter((k for _, (k, _) in found), np.int64), 1)
        np.add.at(change, ends, -1)
        hit = np.concatenate(([0], (np.cumsum(change[:-1]) > 0).view(np.int8), [0]))
        edges = np.flatnonzero(np.diff(hit))
        places = [m.span() for m in _WORD.finditer(kept)]
        runs, at, chars = [], 0, 0
        for first, last in zip(edges[::2].tolist(), (edges[1::2] - 1).tolist()):
            start, end = places[first][0], places[last][1]
            chars += len(raw[at:start].decode("utf-8", "replace"))
            stop = chars + len(raw[start:end].decode("utf-8", "replace"))
            runs.append((first, last, start, end, chars, stop))
            at, chars = end, stop
        return len(words), sorted({i for _, (_, ids) in found for i in ids}), runs


def matchers(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = 8, block_bytes: int = BLOCK_BYTES) -> list[Matcher]:
    """One automaton, or several where the benchmark's windows are over ``block_bytes``."""
    rows = benchmark.select(column(benchmark, id_col).cast("string").alias("i"), column(benchmark, text_col).cast("string").alias("t"))
    blocks: list[dict] = [{}]
    size = 0
    for i, t in rows.where("i IS NOT NULL").orderBy("i", "t").toLocalIterator():
        for k, key in windows_of(words_of(t), window):
            if size + len(key) > block_bytes:
                blocks.append({})
                size = 0
            if key not in blocks[-1]:
                size += len(key)
            blocks[-1].setdefault(key, (k, set()))[1].add(i)
    return [Matcher({key: (k, tuple(sorted(ids))) for key, (k, ids) in b.items()}) for b in blocks]


class Matchers:
    """All automata of a benchmark."""

    def __init__(self, every: list[Matcher]):
        self.all, self.key = every, new_key()


def _scanner(matchers: list[Matcher]):
    carried = Carried(Matchers(matchers))
    kind = pa.list_(pa.struct([(n, pa.int32()) for n in ("first_word", "last_word", "byte_start", "byte_end", "char_start", "char_end")]))
    names = [f.name for f in kind.value_type]

    def scan(batches):
        own = held(carried).all
        for batch in batches:
            out = []
            for t in (t for a, n in slices(batch.column(1)) for t in batch.column(1).slice(a, n).to_pylist()):
                found = [m.scan(t) for m in own]
                out.append((found[0][0], sorted({i for f in found for i in f[1]}), [r for f in found for r in f[2]]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([o[0] for o in out], pa.int64()),
                    pa.array([o[1] for o in out], pa.list_(pa.string())),
                    pa.array([[dict(zip(names, r)) for r in o[2]] for o in out], kind),
                ],
                ["doc_id", "n_words", "items", "hits"],
            )
        settle()

    return scan


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 8, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: n_words, ids of the items with occurring windows, and the hit runs with byte and character offsets.

    No shuffle: each row is decided where it is read. Where the benchmark needs several automata, a worker holds them all.
    """
    found = matchers(benchmark, window=window, block_bytes=block_bytes)
    return id_text(docs, id_col, text_col).mapInArrow(_scanner(found), SCHEMA)


def contamination_report(found: DataFrame, min_items: int = 2) -> DataFrame:
    """The digest columns. Runs from several passes may overlap, so hit words are counted as a set where that can be."""
    runs = F.flatten(F.transform("hits", lambda h: F.sequence(h.first_word, h.last_word)))
    return found.select(
        "doc_id",
        "n_words",
        F.size(F.array_distinct(runs)).cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("items") >= min_items).alias("contaminated"),
    )


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(find_contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item, least(8, len(w)) AS k, array_to_string(w[i:i + least(8, len(w)) - 1], ' ') AS s
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 7, 1) + 1)) AS i FROM b WHERE len(w) > 0 AND item IS NOT NULL)),
ks AS (SELECT DISTINCT k FROM iw),
dw AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
h AS (SELECT dw.doc_id, dw.i, dw.k, iw.item FROM dw JOIN iw ON dw.k = iw.k AND dw.s = iw.s),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM h) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS l FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(l, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated
FROM d LEFT JOIN hw ON d.doc_id = hw.doc_id LEFT JOIN hi ON d.doc_id = hi.doc_id
"""
