"""All registered queries."""
from . import catalog_baskets, catalog_chain, catalog_live, catalog_records, catalog_usage  # noqa: F401  (they register)
from .catalog_usage import flagship
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship"]
