"""Readers: Parquet tables, text lines, delimited records, access logs, Kafka, named external tables."""
