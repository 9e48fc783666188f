"""Named queries over the given tables, and the SQL that must give the same rows."""

from wardlake.catalog.oracle import ORACLE
from wardlake.catalog.queries import QUERIES

__all__ = ["ORACLE", "QUERIES"]
