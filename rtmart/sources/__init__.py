from rtmart.sources.tables import read_table, TABLES

__all__ = ["read_table", "TABLES"]
