"""Readers (JDBC, file snapshots, CSV with quarantine) and the manifest-published Parquet store."""
