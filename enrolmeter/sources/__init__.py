from .schema import SCHEMAS, conform
from .tables import catalog_tables, jdbc_tables, load_tables

__all__ = ["SCHEMAS", "catalog_tables", "conform", "jdbc_tables", "load_tables"]
