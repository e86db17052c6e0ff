"""Table schemas, readers, writers and the mapping of the parquet test tables."""
