"""Alignment of engines' rows within a section (document, page, table).

Two ways: by exact key, all in Catalyst, and by progressive Needleman-Wunsch over fuzzy row similarity, a Python function
of one section at a time. Sections are independent, so both scale with their number.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.typed import record_id, scalar_json

SECTION = ("document_id", "page_id", "table_id")


# The defaults are fixed values.
@dataclass(frozen=True)
class AlignmentConfig:
    """default_weight applies to fields without a weight; with no weights at all every field weighs 1."""

    weights: Mapping[str, float] = field(default_factory=dict)
    default_weight: float = 0.0
    gap_penalty: float = -0.4
    mismatch_penalty: float = -0.85
    minimum_match_similarity: float = 0.45
    fuzzy_strings: bool = True
    anchor_engine: str | None = None

    def __post_init__(self):
        if any(w < 0 for w in self.weights.values()) or self.default_weight < 0:
            raise ValueError("weights must not be negative")
        if not 0 <= self.minimum_match_similarity <= 1:
            raise ValueError("minimum_match_similarity must be from 0 to 1")
        if self.gap_penalty > 0 or self.mismatch_penalty > 0:
            raise ValueError("penalties must not be positive")

    def weight(self, name: str) -> float:
        return self.weights.get(name, self.default_weight) if self.weights else 1.0


def _with_record_id(records: DataFrame) -> DataFrame:
    anchor = F.filter("members", lambda m: m["engine_id"] == F.col("anchor_engine_id"))[0]
    return records.withColumn(
        "record_id",
        record_id(F.col("document_id"), F.col("page_id"), F.col("table_id"), F.col("anchor_engine_id"), scalar_json(anchor["row_index"]), scalar_json(anchor["page_index"])),
    )


def _member(rows: DataFrame):
    """What a record keeps of a row; tables without references or metadata have none."""
    ref = F.col("source_ref") if "source_ref" in rows.columns else F.lit(None).cast("string").alias("source_ref")
    metadata = F.coalesce("metadata_json", F.lit("{}")) if "metadata_json" in rows.columns else F.lit("{}")
    return F.struct("engine_id", "engine_version", "row_index", "page_index", "printed_page_label", ref, metadata.alias("metadata_json"), "row_uid", "pos", "norm")


def align_by_key(rows: DataFrame, anchor_engine: str | None = None) -> DataFrame:
    """Records of rows with the same typed row index in a section.

    Rows are dealt out by section once; grouping by key and numbering both use that. Ordinals follow the first position of
    a record in any engine, by row index.
    """
    member = _member(rows)
    dealt = rows.repartition(*SECTION)
    grouped = dealt.groupBy(*SECTION, "row_index").agg(F.array_sort(F.collect_list(member), lambda a, b: F.when(a["engine_id"] < b["engine_id"], -1).when(a["engine_id"] > b["engine_id"], 1).otherwise(0)).alias("members"))
    engines = F.transform("members", lambda m: m["engine_id"])
    anchor = engines[0] if anchor_engine is None else F.when(F.array_contains(engines, anchor_engine), anchor_engine).otherwise(engines[0])
    first = F.array_min(F.transform("members", lambda m: m["pos"]))
    order = Window.partitionBy(*SECTION).orderBy("_first", "row_index")
    numbered = grouped.withColumn("_first", first).withColumn("ordinal", F.row_number().over(order)).withColumn("anchor_engine_id", anchor)
    return _with_record_id(numbered.drop("_first", "row_index"))


def shared_letters(texts: list[str], rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """How many letters each of some texts has in common with each of others, whatever their order: a product of matrices
    with a column for each letter's first, second, ... occurrence."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    letters, at = np.unique(codes, return_inverse=True)
    if not len(letters):
        return np.zeros((len(rows), len(cols)))
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    count = np.bincount(owner * len(letters) + at, minlength=len(texts) * len(letters)).reshape(len(texts), len(letters))
    most = np.minimum(count[rows].max(axis=0), count[cols].max(axis=0))
    shared = np.zeros((len(rows), len(cols)), np.float32)
    for t in range(1, int(most.max()) + 1):
        some = np.flatnonzero(most >= t)
        shared += (count[np.ix_(rows, some)] >= t).astype(np.float32) @ (count[np.ix_(cols, some)] >= t).astype(np.float32).T
    return shared.astype(float)


class SectionAligner:
    """Progressive alignment of one section. Rows are dicts of field to (type, text) or None.

    Comparing two texts in full is what costs, so bounds from above (characters in common, whatever their order) and from
    below (equal values) are computed for all pairs at once. Alignments by the bounds alone show which pairs can be on a best
    path at all; only these are compared in full, which leaves the result, ties included, as it would be.
    """

    def __init__(self, config: AlignmentConfig):
        self.config, self.known = config, {}

    def text_similarity(self, a: str, b: str) -> float:
        got = self.known.get((a, b))
        if got is None:
            got = self.known[a, b] = SequenceMatcher(None, a, b, autojunk=False).ratio()
        return got

    def value_similarity(self, a, b) -> float:
        if a == b:
            return 1.0
        if a is None or b is None:
            return 0.0
        if self.config.fuzzy_strings and a[0] == "str" and b[0] == "str":
            return self.text_similarity(a[1], b[1])
        return 0.0

    def row_similarity(self, a: dict, b: dict) -> float:
        """Weighted mean over the fields that both have a value of, in order of name."""
        total = weight_sum = 0.0
        for name in sorted(a.keys() & b.keys()):
            w = self.config.weight(name)
            if w > 0 and a[name] is not None and b[name] is not None:
                total += w * self.value_similarity(a[name], b[name])
                weight_sum += w
        return total / weight_sum if weight_sum else 0.0

    def increment(self, group: list[dict], row: dict) -> float:
        """What pairing a group with a row adds: its most similar member's similarity, if that is a match."""
        best = max((self.row_similarity(m, row) for m in group), default=-1.0)
        return best if best >= self.config.minimum_match_similarity else self.config.mismatch_penalty

    def bounds(self, left: list[dict], right: list[dict]) -> tuple[np.ndarray, np.ndarray]:
        """At least and at most the similarity of each row of left with each of right."""
        shape = (len(left), len(right))
        most, least, weight = np.zeros(shape), np.zeros(shape), np.zeros(shape)
        for name in sorted({f for r in (*left, *right) for f in r}):
            w = self.config.weight(name)
            if w <= 0:
                continue
            kinds: dict = {}
            ids = [np.array([-1 if r.get(name) is None else kinds.setdefault(r[name], len(kinds)) for r in rows], np.int64) for rows in (left, right)]
            own, rows, cols = list(kinds), *(np.unique(i[i >= 0]) for i in ids)
            if not len(rows) or not len(cols):
                continue
            equal = (rows[:, None] == cols[None, :]).astype(float)
            upper = equal
            if self.config.fuzzy_strings:
                text = np.array([v[0] == "str" for v in own])
                size = np.array([len(v[1]) for v in own], float)
                shared = shared_letters([v[1] if v[0] == "str" else "" for v in own], rows, cols)
                ratio = 2 * shared / np.maximum(1, size[rows][:, None] + size[cols][None, :])
                upper = np.where(text[rows][:, None] & text[cols][None, :], np.maximum(ratio, equal), equal)
            a, b = (np.searchsorted(u, i) for u, i in zip((rows, cols), ids))
            has = (ids[0] >= 0)[:, None] & (ids[1] >= 0)[None, :]
            at = np.ix_(np.minimum(a, len(rows) - 1), np.minimum(b, len(cols) - 1))
            weight += w * has
            most += np.where(has, w * upper[at], 0)
            least += np.where(has, w * equal[at], 0)
        weight = np.where(weight > 0, weight, 1)
        return most / weight, least / weight

    def scores(self, *gains: np.ndarray) -> np.ndarray:
        """For each gain, the best scores of aligning the first i and the first j, up to rounding.

        All go row by row together, as scores less the gaps that a path without pairs has: then only pairs add anything.
        """
        gap, (n, m) = self.config.gap_penalty, gains[0].shape
        over = np.stack(gains) - 2 * gap
        table = np.zeros((len(gains), n + 1, m + 1))
        for i in range(1, n + 1):
            before, now = table[:, i - 1], table[:, i]
            np.add(before[:, :-1], over[:, i - 1], out=now[:, 1:])
            np.maximum(now, before, out=now)
            np.maximum.accumulate(now, axis=1, out=now)
        return table + gap * np.add.outer(np.arange(n + 1), np.arange(m + 1))

    def merge(self, groups: list[list], rows: list, cells) -> list[list]:
        """Global alignment of groups and one more engine's rows; equal scores prefer a pair, then a group alone."""
        gap, bad, n, m = self.config.gap_penalty, self.config.mismatch_penalty, len(groups), len(rows)
        members, new = [[cells(x) for x in g] for g in groups], [cells(x) for x in rows]
        flat = [c for g in members for c in g]
        starts = np.cumsum([0, *(len(g) for g in members[:-1])])
        most, least = (np.maximum.reduceat(x, starts, axis=0) for x in self.bounds(flat, new))
        match = self.config.minimum_match_similarity
        best = np.where(most >= match - 1e-9, most, bad)
        there, back, sure = self.scores(best, best[::-1, ::-1], np.where(least >= match, least, bad))
        back, floor = back[::-1, ::-1], sure[n, m] - 1e-6 * (n + m)
        open_ = there + back >= floor  # places on a path that may be the best
        paired = there[:-1, :-1] + best + back[1:, 1:] >= floor
        moves: list[dict[int, str]] = []
        before: dict[int, float] = {}
        for i in range(n + 1):
            now, steps = {}, {}
            for j in np.flatnonzero(open_[i]).tolist():
                score, step = (0.0, "") if i == j == 0 else (-np.inf, "")
                if i and j and (j - 1) in before and paired[i - 1, j - 1]:
                    score, step = before[j - 1] + self.increment(members[i - 1], new[j - 1]), "pair"
                if i and j in before and (up := before[j] + gap) > score:
                    score, step = up, "up"
                if j and (j - 1) in now and (left := now[j - 1] + gap) > score:
                    score, step = left, "left"
                now[j], steps[j] = score, step
            before = now
            moves.append(steps)
        out, i, j = [], n, m
        while i or j:
            step = moves[i][j]
            if step == "pair":
                i, j = i - 1, j - 1
                out.append([*groups[i], rows[j]])
            elif step == "up":
                i -= 1
                out.append(groups[i])
            else:
                j -= 1
                out.append([rows[j]])
        return out[::-1]

    def align(self, engines: dict[str, list], cells=lambda row: row) -> list[list]:
        """Groups of rows; engines by falling number of rows, then by name, the anchor first."""
        order = sorted(engines, key=lambda e: (e != self.config.anchor_engine, -len(engines[e]), e))
        groups: list[list] = []
        for k, e in enumerate(order):
            groups = [[r] for r in engines[e]] if not k else self.merge(groups, engines[e], cells)
        return groups


def align_fuzzy(rows: DataFrame, config: AlignmentConfig) -> DataFrame:
    """(section, ordinal, member_pos, row_uid, anchor_engine_id): one group of records at a time, input order kept.

    Only what the similarity reads goes to Python. Ties and gaps resolve as in ``SectionAligner``.
    """
    entries = F.map_entries("norm")
    if config.weights and config.default_weight == 0:
        counted = [f for f, w in config.weights.items() if w > 0]
        entries = F.filter(entries, lambda e: e["key"].isin(counted)) if counted else F.filter(entries, lambda e: F.lit(False))
    slim = rows.select(*SECTION, "engine_id", "pos", "row_uid", F.transform(entries, lambda e: F.struct(e["key"].alias("f"), e["value"]["value"]["t"].alias("t"), e["value"]["value"]["s"].alias("s"))).alias("values"))

    def run(table: pa.Table) -> pa.Table:
        found = table.select(["engine_id", "pos", "row_uid", "values"]).to_pydict()
        engines: dict[str, list] = {}
        for engine, _, uid, own in sorted(zip(*found.values()), key=lambda r: r[:3]):
            engines.setdefault(engine, []).append((engine, uid, {v["f"]: None if v["t"] is None else (v["t"], v["s"]) for v in own}))
        out = []
        for n, group in enumerate(SectionAligner(config).align(engines, lambda row: row[2]), 1):
            out += [(n, k, uid, group[0][0]) for k, (_, uid, _) in enumerate(group)]
        section = [pa.array([table.column(c)[0].as_py()] * len(out), pa.string()) for c in SECTION]
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.string())
        return pa.table([*section, *[pa.array(list(c), k) for c, k in zip(zip(*out), kinds)]], [*SECTION, "ordinal", "member_pos", "row_uid", "anchor_engine_id"])

    return slim.groupBy(*SECTION).applyInArrow(run, "document_id string, page_id string, table_id string, ordinal int, member_pos int, row_uid string, anchor_engine_id string")


def records_of(aligned: DataFrame, rows: DataFrame) -> DataFrame:
    """Records with their members, from the long form of an alignment."""
    member = _member(rows)
    joined = aligned.join(rows.drop(*SECTION), "row_uid")
    grouped = joined.groupBy(*SECTION, "ordinal", "anchor_engine_id").agg(F.array_sort(F.collect_list(member), lambda a, b: F.when(a["engine_id"] < b["engine_id"], -1).when(a["engine_id"] > b["engine_id"], 1).otherwise(0)).alias("members"))
    return _with_record_id(grouped)


def exact_similarity(pairs: DataFrame, left: str, right: str, fields, config: AlignmentConfig):
    """Row similarity without fuzzy strings, as a Column over two normalised maps."""
    total, weight = F.lit(0.0), F.lit(0.0)
    for name in sorted(fields):
        w = config.weight(name)
        if w > 0:
            a, b = F.col(left)[name]["value"], F.col(right)[name]["value"]
            both = a.isNotNull() & b.isNotNull()
            total = total + F.when(both & (a["t"] == b["t"]) & (a["s"] == b["s"]), w).otherwise(0.0)
            weight = weight + F.when(both, w).otherwise(0.0)
    return F.when(weight > 0, total / weight).otherwise(0.0)


