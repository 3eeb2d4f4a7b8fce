"""Data contracts: declared expectations compiled into single-pass Spark checks."""

from tickline.quality.contracts import ColumnSpec, Contract, ContractError, DatasetChecks, load_contract
from tickline.quality.checks import ContractViolationError, enforce, run_contract

__all__ = [
    "ColumnSpec",
    "Contract",
    "ContractError",
    "ContractViolationError",
    "DatasetChecks",
    "enforce",
    "load_contract",
    "run_contract",
]
