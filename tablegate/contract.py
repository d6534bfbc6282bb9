"""Data contract: columns, types and quality rules as read from YAML (or an equal dict).

A column whose name starts with an underscore is an audit column: it is added when the table is
written and has no counterpart upstream.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from tablegate.functions.families import BUSINESS_TYPES

# The policies a rule may carry.
DROP, FLAG, KEEP, RESOLVED_UPSTREAM = "drop", "flag", "keep", "resolved_upstream"
POLICIES = (DROP, FLAG, KEEP, RESOLVED_UPSTREAM)


class ContractError(ValueError):
    """The contract document itself is unusable."""


@dataclass(frozen=True)
class ContractColumn:
    name: str
    type: str
    nullable: bool = True
    description: str = ""

    @property
    def is_audit(self) -> bool:
        return self.name.startswith("_")

    @property
    def family(self) -> str:
        return BUSINESS_TYPES[self.type]


@dataclass(frozen=True)
class Rule:
    id: str
    policy: str
    condition: str | None = None
    rationale: str = ""

    @property
    def metric(self) -> str:
        return f"{self.id}_count"


@dataclass(frozen=True)
class Contract:
    name: str
    version: str
    table: dict[str, Any]
    columns: tuple[ContractColumn, ...]
    rules: tuple[Rule, ...] = field(default_factory=tuple)

    @property
    def business_columns(self) -> list[ContractColumn]:
        return [c for c in self.columns if not c.is_audit]

    @property
    def audit_columns(self) -> list[ContractColumn]:
        return [c for c in self.columns if c.is_audit]

    @property
    def counted_rules(self) -> list[Rule]:
        """Rules with something to evaluate; FLT-6: ``resolved_upstream`` ones have nothing."""
        return [r for r in self.rules if r.policy != RESOLVED_UPSTREAM]

    @property
    def drop_rules(self) -> list[Rule]:
        return [r for r in self.rules if r.policy == DROP]

    @property
    def flag_rules(self) -> list[Rule]:
        return [r for r in self.rules if r.policy == FLAG]

    def enforcing_not_null(self) -> Contract:
        """The same contract with a drop rule for every column declared non-nullable."""
        extra = tuple(
            Rule(f"not_null_{c.name}", DROP, f"`{c.name}` IS NULL", "declared non-nullable")
            for c in self.business_columns
            if not c.nullable
        )
        return Contract(self.name, self.version, self.table, self.columns, self.rules + extra)


def _required(mapping: Any, key: str, where: str) -> Any:
    if not isinstance(mapping, dict) or mapping.get(key) in (None, ""):
        raise ContractError(f"{where}: '{key}' is missing")
    return mapping[key]


def _column(entry: Any, position: int) -> ContractColumn:
    name = _required(entry, "name", f"columns[{position}]")
    kind = _required(entry, "type", f"column '{name}'")
    if kind not in BUSINESS_TYPES:
        raise ContractError(f"column '{name}': unknown type '{kind}', expected one of {sorted(BUSINESS_TYPES)}")
    return ContractColumn(name, kind, entry.get("nullable", True), " ".join(entry.get("description", "").split()))


def _rule(entry: Any, position: int) -> Rule:
    rule_id = _required(entry, "id", f"quality_rules[{position}]")
    policy = _required(entry, "policy", f"rule '{rule_id}'")
    if policy not in POLICIES:
        raise ContractError(f"rule '{rule_id}': unknown policy '{policy}', expected one of {list(POLICIES)}")
    if policy != RESOLVED_UPSTREAM:
        _required(entry, "condition", f"rule '{rule_id}'")
    return Rule(rule_id, policy, entry.get("condition"), " ".join(entry.get("rationale", "").split()))


def _reject_repeats(names: list[str], what: str) -> None:
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ContractError(f"{what} declared more than once: {repeated}")


def load(source: str | Path | dict[str, Any]) -> Contract:
    """Read a contract from a YAML file or from an already parsed document."""
    if isinstance(source, dict):
        document = source
    else:
        try:
            import yaml
        except ImportError as exc:  # pragma: no cover - depends on the installation
            raise ContractError("reading a contract file needs PyYAML; pass a dict instead") from exc
        document = yaml.safe_load(Path(source).read_text(encoding="utf-8"))

    head = _required(document, "contract", "document")
    columns = tuple(_column(c, i) for i, c in enumerate(_required(document, "columns", "document")))
    rules = tuple(_rule(r, i) for i, r in enumerate(document.get("quality_rules") or []))
    _reject_repeats([c.name for c in columns], "columns")
    _reject_repeats([r.id for r in rules], "rules")
    return Contract(
        name=_required(head, "name", "contract"),
        version=str(_required(head, "version", "contract")),
        table=document.get("table") or {},
        columns=columns,
        rules=rules,
    )
