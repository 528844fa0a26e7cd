"""Supply-chain lakehouse on Spark: ingest validation, medallion layers, history-keeping dimensions."""
