"""Input tables: schema contracts, file readers, and the views derived from
the TPC-H-like test tables."""

from pos360.sources.fixtures import Tables, fixture_tables, tables_from_paths
from pos360.sources.readers import read_table, write_table
from pos360.sources.schema import SCHEMAS

__all__ = ["Tables", "fixture_tables", "tables_from_paths", "read_table", "write_table", "SCHEMAS"]
