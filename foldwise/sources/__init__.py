from foldwise.sources.tables import TABLES, table  # noqa: F401
