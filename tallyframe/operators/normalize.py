"""Rows of one engine to normalised observations: aliasing, comparison transforms, missing sentinels."""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import KEEP_TIDY, TRANSFORMS, canonical_number, once, tidy


class NormalizationCollisionError(ValueError):
    """Two source columns of a row have the same canonical field."""


@dataclass(frozen=True)
class Rule:
    """Transforms in order, then literal replacements in order, then values that count as null.

    Missing values are JSON scalars: a text is compared with texts, a number or boolean with numbers and booleans by value
    (0, 0.0 and false are the same).
    """

    transforms: Sequence[str] = ("nfkc", "strip", "collapse_whitespace")
    replacements: Mapping[str, str] = field(default_factory=dict)
    missing: Sequence[str | int | float | bool | None] = ("",)

    def apply(self, value: Column, custom: Mapping[str, Callable[[Column], Column]] | None = None) -> Column:
        """Normalised scalar. Text transforms leave other types as they are; canonical_number also writes numbers as text."""
        made = self.changed(value, custom)
        return once(made, self.kept) if self.missing else made

    def changed(self, value: Column, custom: Mapping[str, Callable[[Column], Column]] | None = None) -> Column:
        """The scalar after transforms and replacements, missing values included. Tidy text skips what can't change it."""
        known = TRANSFORMS | dict(custom or {})
        unknown = [t for t in self.transforms if t not in known]
        if unknown:
            raise ValueError(f"unknown transforms: {', '.join(unknown)}")
        kind = value["t"]
        text, other = value["s"], value["s"]  # of strings, of other types
        steps = [known[name] for name in self.transforms]
        numbers = canonical_number in steps
        first = list(itertools.takewhile(lambda step: step in KEEP_TIDY, steps))
        if first:
            text = F.when(tidy(text), text).otherwise(once(text, lambda t: functools.reduce(lambda done, step: step(done), first, t)))
        for step in steps[len(first) :]:
            text = step(text)
        for old, new in self.replacements.items():
            text = F.replace(text, F.lit(old), F.lit(new))
        if numbers:
            other = F.when(kind.isin("int", "float"), canonical_number(other)).otherwise(other)
        text = F.when(kind == "str", text).otherwise(other)
        if numbers:
            kind = F.when(kind.isin("int", "float"), "str").otherwise(kind)
        return F.when(value.isNotNull(), F.struct(kind.alias("t"), text.alias("s")))

    def kept(self, value: Column) -> Column:
        """A changed scalar, null where it is a missing value."""
        return F.when(~self._gone(value), value) if self.missing else value

    def _gone(self, value: Column) -> Column:
        texts = [m for m in self.missing if isinstance(m, str)]
        numbers = sorted({float(m) for m in self.missing if isinstance(m, (bool, int, float))})
        gone = (value["t"] == "str") & value["s"].isin(texts) if texts else F.lit(False)
        if numbers:
            as_number = F.when(value["t"] == "bool", (value["s"] == "true").cast("double")).when(value["t"].isin("int", "float"), value["s"].try_cast("double"))
            gone = gone | F.coalesce(as_number.isin(numbers), F.lit(False))
        return gone


@dataclass(frozen=True)
class Normalization:
    default: Rule = Rule()
    fields: Mapping[str, Rule] = field(default_factory=dict)
    aliases: Mapping[str, str] = field(default_factory=dict)
    custom: Mapping[str, Callable[[Column], Column]] = field(default_factory=dict)

    def rule(self, name: str) -> Rule:
        """A field's own rule replaces the default one entirely."""
        return self.fields.get(name, self.default)

    def sources(self, name: str, source_fields: Sequence[str]) -> list[str]:
        return [s for s in source_fields if self.aliases.get(s, s) == name]


def normalized_rows(rows: DataFrame, source_fields: Sequence[str], config: Normalization) -> DataFrame:
    """Adds ``norm``: MAP<field, STRUCT<source, raw, value>> of the fields that each row has.

    Expressions are laid out for each field, a step a projection, so that all of it stays in generated code, no row is
    multiplied and nothing is computed twice. Only the map of a row that lacks a field takes a filter.
    """
    names = list(dict.fromkeys(config.aliases.get(s, s) for s in source_fields))
    own = [(name, s) for name in names for s in config.sources(name, source_fields)]
    if not own:
        return rows.withColumn("norm", F.create_map().cast("map<string,struct<source:string,raw:struct<t:string,s:string>,value:struct<t:string,s:string>>>"))
    raws = rows.withColumns({f"_raw{k}": F.col("cells")[s] for k, (_, s) in enumerate(own)})
    changed = raws.withColumns({f"_value{k}": config.rule(name).changed(F.col(f"_raw{k}"), config.custom) for k, (name, _) in enumerate(own)})
    entries, here = [], F.lit(True)
    for k, (name, s) in enumerate(own):
        value = F.struct(F.lit(s).alias("source"), F.col(f"_raw{k}").alias("raw"), config.rule(name).kept(F.col(f"_value{k}")).alias("value"))
        entries.append(F.struct(F.lit(name).alias("key"), value.alias("value")))
        here = here & F.map_contains_key("cells", s)
    some = F.filter(F.array(*[F.when(F.map_contains_key("cells", s), e) for e, (_, s) in zip(entries, own)]), lambda e: e.isNotNull())
    whole = F.create_map(*[c for e, (name, s) in zip(entries, own) for c in (F.lit(name), e["value"])])
    return changed.withColumn("norm", F.when(here, whole).otherwise(F.map_from_entries(some))).drop(*[c for k in range(len(own)) for c in (f"_raw{k}", f"_value{k}")])


def collisions(rows: DataFrame, source_fields: Sequence[str], config: Normalization) -> DataFrame:
    """(row_uid, field, n): fields that several columns of a row claim."""
    out = []
    for name in dict.fromkeys(config.aliases.get(s, s) for s in source_fields):
        own = config.sources(name, source_fields)
        if len(own) > 1:
            n = sum((F.map_contains_key("cells", s).cast("int") for s in own), F.lit(0))
            out.append(F.when(n > 1, F.struct(F.lit(name).alias("field"), n.alias("n"))))
    if not out:
        return rows.select("row_uid", F.lit("").alias("field"), F.lit(0).alias("n")).limit(0)
    return rows.select("row_uid", F.explode_outer(F.filter(F.array(*out), lambda x: x.isNotNull())).alias("c")).where("c IS NOT NULL").select("row_uid", "c.field", "c.n")


def check_collisions(rows: DataFrame, source_fields: Sequence[str], config: Normalization) -> None:
    found = collisions(rows, source_fields, config).take(1)
    if found:
        raise NormalizationCollisionError(f"row {found[0].row_uid}: several columns map onto {found[0].field}")


def observations(rows: DataFrame) -> DataFrame:
    """Long form of normalised rows: (row_uid, engine_id, field, source_field, raw, value)."""
    return exploded(rows, "row_uid", "engine_id").select("row_uid", "engine_id", "field", F.col("c.source").alias("source_field"), "c.raw", "c.value")


def exploded(rows: DataFrame, *keep: str | Column) -> DataFrame:
    """The columns to keep, field and c, which is STRUCT<source, raw, value>: a row for each field of normalised rows.

    An outer explosion, as the filter that an inner one lets the optimiser infer computes the whole map two more times.
    """
    return rows.select(*keep, F.explode_outer("norm").alias("field", "c")).where("field IS NOT NULL")
