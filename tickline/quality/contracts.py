"""Contract model: columns with their checks, dataset-level checks, severity."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from pathlib import Path

import yaml

SEVERITIES = ("error", "warn")
BUILTIN_DIR = Path(__file__).with_name("contracts")


class ContractError(ValueError):
    """A contract file or dict does not describe a valid contract."""


def _severity(value, where: str) -> str:
    if value not in SEVERITIES:
        raise ContractError(f"{where}: severity must be one of {SEVERITIES}, got {value!r}")
    return value


def _number(value, where: str) -> float | None:
    if value is None:
        return None
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        raise ContractError(f"{where}: expected a number, got {value!r}")
    return float(value)


@dataclass
class ColumnSpec:
    name: str
    dtype: str | None = None
    not_null: bool = False
    unique: bool = False
    accepted_values: list[str] | None = None
    min_value: float | None = None
    max_value: float | None = None
    inclusive: bool = True
    severity: str = "error"

    @classmethod
    def from_dict(cls, raw: dict) -> "ColumnSpec":
        _reject_unknown(cls, raw, "column")
        if "name" not in raw:
            raise ContractError("column: name is required")
        where = f"column {raw['name']}"
        values = raw.get("accepted_values")
        if values is not None and not isinstance(values, list):
            raise ContractError(f"{where}: accepted_values must be a list")
        return cls(
            name=str(raw["name"]),
            dtype=raw.get("dtype"),
            not_null=bool(raw.get("not_null", False)),
            unique=bool(raw.get("unique", False)),
            accepted_values=[str(v) for v in values] if values is not None else None,
            min_value=_number(raw.get("min_value"), where),
            max_value=_number(raw.get("max_value"), where),
            inclusive=bool(raw.get("inclusive", True)),
            severity=_severity(raw.get("severity", "error"), where),
        )


@dataclass
class RowCheck:
    """A row-level condition every row must satisfy (a NULL result counts as a pass)."""

    name: str
    condition: str
    severity: str = "error"


@dataclass
class DatasetChecks:
    min_rows: int | None = None
    freshness_column: str | None = None
    freshness_max_age_minutes: int | None = None
    unique_key: list[str] | None = None
    row_checks: list[RowCheck] = field(default_factory=list)
    severity: str = "error"

    @classmethod
    def from_dict(cls, raw: dict | None) -> "DatasetChecks":
        raw = raw or {}
        _reject_unknown(cls, raw, "checks")
        key = raw.get("unique_key")
        if key is not None and (not isinstance(key, list) or not key):
            raise ContractError("checks: unique_key must be a non-empty list")
        severity = _severity(raw.get("severity", "error"), "checks")
        rows = [
            RowCheck(r["name"], r["condition"], _severity(r.get("severity", severity), f"row check {r.get('name')}"))
            for r in raw.get("row_checks") or []
        ]
        return cls(
            min_rows=raw.get("min_rows"),
            freshness_column=raw.get("freshness_column"),
            freshness_max_age_minutes=raw.get("freshness_max_age_minutes"),
            unique_key=[str(k) for k in key] if key else None,
            row_checks=rows,
            severity=severity,
        )


@dataclass
class Contract:
    dataset: str
    owner: str = "data-platform"
    description: str = ""
    columns: list[ColumnSpec] = field(default_factory=list)
    checks: DatasetChecks = field(default_factory=DatasetChecks)

    @classmethod
    def from_dict(cls, raw: dict) -> "Contract":
        if not isinstance(raw, dict) or "dataset" not in raw:
            raise ContractError("contract: dataset is required")
        _reject_unknown(cls, raw, "contract")
        return cls(
            dataset=str(raw["dataset"]),
            owner=str(raw.get("owner", "data-platform")),
            description=str(raw.get("description", "")),
            columns=[ColumnSpec.from_dict(c) for c in raw.get("columns") or []],
            checks=DatasetChecks.from_dict(raw.get("checks")),
        )

    def check_count(self) -> int:
        """Number of result rows the contract yields on a frame with every column."""
        n = sum(x is not None for x in (self.checks.min_rows, self.checks.unique_key))
        n += bool(self.checks.freshness_column and self.checks.freshness_max_age_minutes)
        n += len(self.checks.row_checks)
        for c in self.columns:
            n += (c.dtype is not None) + c.not_null + c.unique + (c.accepted_values is not None)
            n += c.min_value is not None or c.max_value is not None
        return n


def _reject_unknown(cls, raw: dict, where: str) -> None:
    known = {f.name for f in fields(cls)}
    unknown = set(raw) - known
    if unknown:
        raise ContractError(f"{where}: unknown keys {sorted(unknown)}")


def load_contract(path: str | Path) -> Contract:
    """Parse and validate one contract YAML file."""
    return Contract.from_dict(yaml.safe_load(Path(path).read_text()))


def load_builtin(name: str) -> Contract:
    """One of the shipped contracts: ``silver_ticks``, ``silver_trades``, ``gold_ohlcv_1m``."""
    return load_contract(BUILTIN_DIR / f"{name}.yml")


def load_all_contracts(directory: str | Path = BUILTIN_DIR) -> list[Contract]:
    return [load_contract(p) for p in sorted(Path(directory).glob("*.yml"))]
