"""Writers: keyed upserts, JSON documents, JDBC rows, delimited files, Kafka payloads, console."""
