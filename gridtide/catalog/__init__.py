"""Every operator as a named query on the sample tables, and the SQL that checks it."""

from gridtide.catalog.oracles import ORACLES
from gridtide.catalog.queries import QUERIES, flagship_features

__all__ = ["ORACLES", "QUERIES", "flagship_features"]
