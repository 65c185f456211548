"""Sources: parquet tables, JDBC tables, SQL templates and multi-database unions."""
