"""Sources: Parquet test tables, CSV drops, JDBC, object-store settings."""
