"""DataFrame -> DataFrame operators (joins, aggregation, windows, history, upsert, quality, ledger)."""
