from bandwise.sources.tables import read_table, read_csv, read_catalog  # noqa: F401
