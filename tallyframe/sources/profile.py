"""Profiles: which fields a record has and how they are compared, aligned, voted on and parsed."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from ..functions.prices import PriceConfig
from ..operators.align import AlignmentConfig
from ..operators.consensus import ConsensusConfig
from ..operators.normalize import Normalization, Rule


class ProfileError(ValueError):
    """A profile breaks its contract."""


@dataclass(frozen=True)
class Profile:
    name: str
    version: str
    fields: tuple[str, ...]
    roles: Mapping[str, str] = field(default_factory=dict)
    raw: Mapping[str, Any] = field(default_factory=dict)

    def section(self, name: str) -> Mapping[str, Any]:
        found = self.raw.get(name) or {}
        if not isinstance(found, Mapping):
            raise ProfileError(f"{name} must be a mapping")
        return found

    def normalization(self) -> Normalization:
        own = self.section("comparison_normalization")
        default = own.get("default") or own.get("defaults")
        return Normalization(
            default=_rule(default) if default else Rule(),
            fields={k: _rule(v) for k, v in (own.get("fields") or {}).items()},
            aliases=own.get("field_aliases") or own.get("aliases") or {},
        )

    def alignment(self) -> AlignmentConfig:
        own = self.section("alignment")
        weights = dict(own.get("weights") or {}) or {f: 1.0 for f in own.get("anchor_fields") or self.fields}
        if unknown := sorted(set(weights) - set(self.fields)):
            raise ProfileError(f"weights of undeclared fields: {', '.join(unknown)}")
        keys = ("default_weight", "gap_penalty", "mismatch_penalty", "minimum_match_similarity", "fuzzy_strings", "anchor_engine")
        return AlignmentConfig(weights=weights, **{k: own[k] for k in keys if k in own})

    def consensus(self) -> ConsensusConfig:
        own = self.section("consensus")
        return ConsensusConfig(**{k: own[k] for k in ("majority_fraction", "minimum_majority_votes") if k in own})

    def minimum_engines(self) -> int:
        return int(self.section("ocr").get("minimum_independent_engines", 2))

    def page_index_required(self) -> bool:
        return bool((self.section("page_identity").get("source_pdf_page_index") or {}).get("required", False))

    def page_identity_required(self) -> bool:
        """Whether validation asks for a page index of every source; admission has a key of its own, see above."""
        return bool(self.section("quality").get("require_complete_page_identity", False))

    def prices(self) -> PriceConfig:
        rules = self.section("normalization")
        own = rules.get("amounts") or rules.get("prices") or {}
        given = {k: _texts(own[k]) for k in ("group_total_markers", "per_unit_markers", "conversion_markers", "item_labels") if k in own}
        label = own.get("denominator_label")
        return PriceConfig(
            currency_aliases=own.get("currency_aliases") or {}, scale_factors=own.get("scale_factors") or {},
            group_label=label or PriceConfig.group_label, unit_label=label or PriceConfig.unit_label, **given,
        )

    def dates(self) -> dict[str, int]:
        own = self.section("normalization").get("dates") or {}
        found = {"century": own.get("two_digit_century"), "edition_year": own.get("edition_year")}
        return {k: int(v) for k, v in found.items() if v is not None}


def _texts(value) -> tuple[str, ...]:
    return (value,) if isinstance(value, str) else tuple(str(v) for v in value or ())


def _rule(value) -> Rule:
    """A list of transforms, or a mapping; nothing is the default rule."""
    if not value:
        return Rule()
    if not isinstance(value, Mapping):
        return Rule(transforms=_texts(value))
    return Rule(
        transforms=_texts(value.get("transforms", Rule.transforms)), replacements=dict(value.get("replacements") or {}),
        missing=tuple(value.get("missing_values", Rule.missing) or ()),
    )


def parse_profile(raw: Any) -> Profile:
    if not isinstance(raw, Mapping):
        raise ProfileError("a profile must be a mapping")
    if missing := [k for k in ("profile_version", "name", "record_type", "fields") if not raw.get(k)]:
        raise ProfileError(f"profile lacks {', '.join(missing)}")
    names, roles = [], {}
    if not isinstance(raw["fields"], list):
        raise ProfileError("fields must be a list")
    for f in raw["fields"]:
        if not isinstance(f, Mapping) or not f.get("name"):
            raise ProfileError("each field needs a name")
        names.append(str(f["name"]))
        if role := f.get("semantic_role"):
            if str(role) in roles and role in ("quantity", "date", "amount", "amount_unit"):
                raise ProfileError(f"several fields have the semantic role {role}")
            roles.setdefault(str(role), str(f["name"]))
    if len(set(names)) != len(names):
        raise ProfileError("duplicate fields")
    profile = Profile(str(raw["name"]), str(raw["profile_version"]), tuple(names), roles, raw)
    profile.alignment()
    return profile


def load_profile(path: str) -> Profile:
    import yaml

    with open(path, encoding="utf-8") as f:
        try:
            raw = yaml.safe_load(f)
        except yaml.YAMLError as e:
            raise ProfileError(f"{path}: {e}") from e
    return parse_profile(raw)
