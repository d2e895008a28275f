"""Readers for ledgers: delimited files, parquet, JDBC, warehouse and Kafka."""
