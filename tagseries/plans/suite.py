"""All registered queries."""

from . import suite_aggregate, suite_raw, suite_registry, suite_store, suite_types  # noqa: F401
from .registered import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
