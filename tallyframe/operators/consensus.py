"""Voting: one cell for each record and field, with status, chosen value, candidates and supporters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import each, settled
from ..functions.typed import SCALAR, cell_id, json_object, scalar_json, stable_id, text_json


@dataclass(frozen=True)
class ConsensusConfig:
    majority_fraction: float = 0.5
    minimum_majority_votes: int = 2

    def __post_init__(self):
        if not 0.5 <= self.majority_fraction < 1:
            raise ValueError("majority_fraction must be from 0.5 to below 1")
        if self.minimum_majority_votes < 1:
            raise ValueError("minimum_majority_votes must be positive")


def expected_engines(rows: DataFrame, given: Sequence[str] | None = None) -> list[str]:
    """The engines to expect: those given, which must hold all observed ones, or the observed ones. A few names."""
    seen = sorted(r[0] for r in rows.select("engine_id").distinct().collect())
    if given is None:
        return seen
    if len(set(given)) != len(given) or not all(given):
        raise ValueError("expected engines must be unique and not empty")
    if missing := sorted(set(seen) - set(given)):
        raise ValueError(f"unexpected engines: {', '.join(missing)}")
    return list(given)


def provenance_json(member: Column, document: Column, page: Column, table: Column) -> Column:
    """Origin of a member's row, whole: it is what a candidate's id covers."""
    return json_object(
        {
            "document_id": text_json(document), "page_id": text_json(page), "table_id": text_json(table), "engine_id": text_json(member["engine_id"]),
            "engine_version": text_json(member["engine_version"]), "source_row_index": scalar_json(member["row_index"]), "source_pdf_page_index": scalar_json(member["page_index"]),
            "printed_page_label": text_json(member["printed_page_label"]), "source_ref": text_json(member["source_ref"]), "metadata": member["metadata_json"],
        }
    )


#: A decision as a cell holds it. metadata_json also has the source event's id and type, if there was one.
DECISION = f"struct<decision_id:string,chosen:{SCALAR},candidate_id:string,reason:string,reviewer:string,decided_at:string,source_decision_id:string,metadata_json:string>"


def with_votes(df: DataFrame, n_expected: int, config: ConsensusConfig) -> DataFrame:
    """Adds status and chosen to rows with ``_values``, the scalars (null ones too) that the engines have.

    Each step is a projection of its own, so that what several conditions read is computed once.
    """
    df = df.withColumn("_voting", F.filter("_values", lambda v: v.isNotNull()))
    df = df.withColumn("_kinds", F.array_distinct("_voting"))
    one = F.size("_kinds") <= 1
    counted = F.transform("_kinds", lambda v: F.struct(F.size(F.filter("_voting", lambda w: w == v)).alias("n"), v.alias("v")))
    df = df.withColumn("_top", F.when(one, F.struct(F.size("_voting").alias("n"), F.get("_kinds", F.lit(0)).alias("v"))).otherwise(F.array_max(counted)))
    n, n_all = F.size("_voting"), F.size("_values")
    needed = F.greatest(F.lit(config.minimum_majority_votes), F.floor(n * F.lit(config.majority_fraction)).cast("int") + 1)
    status = (
        F.when(n == 0, F.when((n_all >= 2) | ((n_all == 1) & F.lit(n_expected == 1)), "unanimous").otherwise("missing"))
        .when(one, F.when((n == 1) & F.lit(n_expected > 1), "missing").otherwise("unanimous"))
        .otherwise(F.when(F.col("_top.n") >= needed, "majority").otherwise("conflict"))
    )
    df = df.withColumn("status", status).withColumn("chosen", F.when((F.size("_voting") > 0) & (F.col("status") != "conflict"), F.col("_top.v")))
    return df.drop("_voting", "_kinds", "_top")


def cells(records: DataFrame, fields: Sequence[str], expected: Sequence[str], config: ConsensusConfig = ConsensusConfig(), keep_extra: bool = True) -> DataFrame:
    """The cells of records: declared fields in order, then others that occur, by name.

    A record's members come with it, so cells need no join and no shuffle: fields are exploded and each engine's value is
    looked up in its map. Members are in order of engine, and so are candidates. A member's provenance is written once a
    record, and votes are counted once a cell: filters on them leave cells out before candidates get their ids.
    """
    declared = F.array(*[F.lit(f) for f in fields]) if fields else F.array().cast("array<string>")
    names = declared
    if keep_extra:
        seen = F.array_distinct(F.flatten(F.transform("members", lambda m: F.map_keys(m["norm"]))))
        names = F.concat(declared, F.array_sort(F.array_except(seen, declared)))
    engines = max(1, len(expected))
    sources = each(F.col("members"), lambda m, _: provenance_json(m, F.col("document_id"), F.col("page_id"), F.col("table_id")), engines)
    heads = records.select("record_id", "document_id", "page_id", "table_id", "ordinal", "anchor_engine_id", "members", sources.alias("_sources"), names.alias("_names"))
    long = heads.select("*", F.posexplode("_names").alias("field_pos", "field")).drop("_names")
    field = F.col("field")

    def candidate(o: Column, _: Column) -> Column:
        c = o["c"]
        made = stable_id("cand", [text_json(F.col("record_id")), text_json(field), text_json(c["source"]), scalar_json(c["raw"]), F.get("_sources", o["i"])])
        return F.struct(o["engine_id"].alias("engine_id"), made.alias("candidate_id"), c["source"].alias("source_field"), c["raw"].alias("raw"), c["value"].alias("value"))

    found = lambda m, i: F.struct(m["engine_id"].alias("engine_id"), m["norm"][field].alias("c"), i.alias("i"))
    all_ = long.withColumn("_all", each(F.col("members"), found, engines)).drop("members")
    own = all_.withColumn("_own", F.filter("_all", lambda o: o["c"].isNotNull())).drop("_all")
    voted = with_votes(own.withColumn("_values", F.col("_own.c.value")), len(expected), config).drop("_values")
    fixed = settled(voted.withColumnsRenamed({"status": "_status", "chosen": "_chosen"}), status=F.col("_status"), chosen=F.col("_chosen")).drop("_status", "_chosen")
    made = fixed.withColumn("candidates", each(F.col("_own"), candidate, engines))
    every = (F.col("status") == "unanimous") & F.col("chosen").isNull()
    support = F.filter("candidates", lambda c: every | (c["value"] == F.col("chosen")))
    missing = F.array_except(F.array(*[F.lit(e) for e in expected]), F.col("_own.engine_id"))
    return made.select(
        "record_id", cell_id(F.col("record_id"), field).alias("cell_id"), "document_id", "page_id", "table_id", "ordinal", "anchor_engine_id", "field", "field_pos",
        "status", "chosen", "candidates", F.transform(support, lambda c: c["candidate_id"]).alias("supporting_candidate_ids"), missing.alias("missing_engine_ids"),
        F.lit(None).cast(DECISION).alias("decision"),
    )


def resolved() -> Column:
    """A cell is resolved by its votes or by a decision."""
    return F.col("status").isin("unanimous", "majority") | F.col("decision").isNotNull()


def missing_engines(records: DataFrame, expected: Sequence[str]) -> DataFrame:
    """(record_id, missing_engine_ids), in expected order."""
    here = F.transform("members", lambda m: m["engine_id"])
    return records.select("record_id", F.array_except(F.array(*[F.lit(e) for e in expected]), here).alias("missing_engine_ids"))
