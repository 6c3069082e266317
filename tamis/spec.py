"""Declarative specifications: the canonical schema, mixtures and retention plans, read from YAML and checked."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

CANONICAL = (
    "id string, messages array<struct<role:string,content:string>>, category string, source string, language string, subcategory string, script string, "
    "code_switching boolean, difficulty string, quality struct<reviewed:boolean,native_authored:boolean,synthetic:boolean,flagged:boolean>, variation_group string"
)


class SpecError(ValueError):
    """A specification that contradicts itself."""


@dataclass(frozen=True)
class Schema:
    """Closed-world schema of a canonical record."""

    required: tuple[str, ...] = ("id", "messages", "category", "source", "language")
    optional: tuple[str, ...] = ("subcategory", "script", "code_switching", "difficulty", "quality", "variation_group")
    roles: tuple[str, ...] = ("system", "user", "assistant")
    categories: tuple[str, ...] = ("mathematics", "reasoning", "coding", "general_instruction", "knowledge_qa")
    languages: tuple[str, ...] = ("arabizi", "ar", "fr", "en", "mixed")
    scripts: tuple[str, ...] = ("latin", "arabic", "mixed")
    difficulties: tuple[str, ...] = ("easy", "medium", "hard")
    quality_flags: tuple[str, ...] = ("reviewed", "native_authored", "synthetic", "flagged")
    min_turns: int = 2
    id_pattern: str = "^[A-Za-z0-9._:-]+$"

    @property
    def known(self) -> tuple[str, ...]:
        return self.required + self.optional

    @staticmethod
    def load(path: str | Path) -> Schema:
        """From YAML with any of the fields by name; unknown names are an error."""
        import yaml

        raw = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
        unknown = set(raw) - set(Schema.__dataclass_fields__)
        if unknown:
            raise SpecError(f"unknown schema fields: {sorted(unknown)}")
        return Schema(**{k: tuple(v) if isinstance(v, list) else v for k, v in raw.items()})


@dataclass(frozen=True)
class MixtureSpec:
    """Shares of slices; each has a purpose of its own."""

    shares: dict[str, float]
    purposes: dict[str, str] = field(default_factory=dict)
    required: tuple[str, ...] = ()

    def problems(self) -> list[str]:
        out = []
        if abs(sum(self.shares.values()) - 1.0) > 1e-6:
            out.append(f"shares sum to {sum(self.shares.values()):.6f}, not 1")
        out += [f"required slice {s} is missing" for s in self.required if s not in self.shares]
        out += [f"share of {s} is outside 0..1" for s, x in self.shares.items() if not 0.0 <= x <= 1.0]
        named = [p for p in self.purposes.values() if p]
        if len(named) != len(set(named)):
            out.append("purposes are not distinct")
        return out

    def validate(self) -> MixtureSpec:
        if p := self.problems():
            raise SpecError("; ".join(p))
        return self

    @staticmethod
    def load(path: str | Path) -> MixtureSpec:
        import yaml

        raw = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
        slices = raw["slices"]
        return MixtureSpec({k: float(v["share"]) for k, v in slices.items()}, {k: v.get("purpose", "") for k, v in slices.items()}, tuple(raw.get("required_slices", ()))).validate()


@dataclass(frozen=True)
class RetentionSpec:
    """Plan of a selection: counts or token budgets by category, a reserved holdout, allow-lists."""

    targets: dict[str, int] = field(default_factory=dict)
    holdout_size: int = 0
    languages: tuple[str, ...] = ("en",)
    exclude_flagged: bool = True
    seed: int = 42
    max_share_per_source: float = 1.0
    stratify_by: str = "category"
    anchor: str = "coding"
    anchor_examples: int = 0
    multipliers: dict[str, float] = field(default_factory=dict)
    holdout_shares: dict[str, float] = field(default_factory=dict)
    holdout_ratio: float = 0.05
    holdout_tokens: float | None = None
    tolerance: float = 0.02
    metric: str = "assistant"
    max_tokens: int = 15_500
    template_cap: int | None = None
    template_source: str | None = None
    on_insufficient: str = "error"
    aliases: dict[str, str] = field(default_factory=lambda: {"instruction_following": "general_instruction"})

    def canonical_targets(self) -> dict[str, int]:
        out: dict[str, int] = {}
        for k, v in self.targets.items():
            k = self.aliases.get(k, k)
            out[k] = out.get(k, 0) + v
        return out

    def problems(self, schema: Schema = Schema()) -> list[str]:
        out = [f"unknown category {c}" for c in {*self.canonical_targets(), *self.multipliers, *self.holdout_shares} if c not in schema.categories]
        if self.holdout_size < 0:
            out.append("holdout is negative")
        if self.multipliers and self.anchor not in self.multipliers:
            out.append("the anchor has no multiplier")
        if self.holdout_shares and abs(sum(self.holdout_shares.values()) - 1.0) > 1e-6:
            out.append("holdout shares do not sum to 1")
        if self.metric not in ("assistant", "total"):
            out.append(f"unknown metric {self.metric}")
        return out

    def validate(self, schema: Schema = Schema()) -> RetentionSpec:
        if p := self.problems(schema):
            raise SpecError("; ".join(p))
        return self

    @staticmethod
    def load(path: str | Path) -> RetentionSpec:
        import yaml

        raw = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
        unknown = set(raw) - set(RetentionSpec.__dataclass_fields__)
        if unknown:
            raise SpecError(f"unknown fields: {sorted(unknown)}")
        return RetentionSpec(**{k: tuple(v) if isinstance(v, list) else v for k, v in raw.items()}).validate()


@dataclass(frozen=True)
class SliceSpec:
    """Plan of one slice: what may enter it and the token budgets of its categories around an anchor."""

    name: str
    languages: tuple[str, ...]
    scripts: tuple[str, ...] = ()
    anchor: str = "knowledge_qa"
    multipliers: dict[str, float] = field(default_factory=dict)
    unit_tokens: int | None = None
    holdout_ratio: float = 0.05
    tolerance: float = 0.02
    max_tokens: int = 15_500
    seed: int = 42

    def problems(self, schema: Schema = Schema()) -> list[str]:
        out = [f"unknown category {c}" for c in self.multipliers if c not in schema.categories]
        out += [f"unknown language {x}" for x in self.languages if x not in schema.languages] + [f"unknown script {x}" for x in self.scripts if x not in schema.scripts]
        if not self.languages or not self.multipliers:
            out.append("a slice needs languages and multipliers")
        if self.unit_tokens is None and self.anchor not in self.multipliers:
            out.append("the anchor has no multiplier and there is no unit")
        return out

    @staticmethod
    def load(path: str | Path) -> SliceSpec:
        import yaml

        raw = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
        if unknown := set(raw) - set(SliceSpec.__dataclass_fields__):
            raise SpecError(f"unknown fields: {sorted(unknown)}")
        spec = SliceSpec(**{k: tuple(v) if isinstance(v, list) else v for k, v in raw.items()})
        if p := spec.problems():
            raise SpecError("; ".join(p))
        return spec
