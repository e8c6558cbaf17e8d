"""Named queries over a directory of Parquet tables, with their SQL twins."""
