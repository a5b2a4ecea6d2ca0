"""Every checked query and its expected result; importing the modules registers them."""

from standin import load_checks, plan_checks, record_checks, scope_checks, store_checks
from standin.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES", "QUERIES", "load_checks", "plan_checks", "record_checks", "scope_checks",
    "store_checks",
]
