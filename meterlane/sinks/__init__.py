"""Writers for Parquet folders, files, catalog tables and external systems."""
