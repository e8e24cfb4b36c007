"""fieldops: field-operations analytics as Spark DataFrame functions.

Layout:
  sources/    scans and sinks (parquet tables, typed seeds, NDJSON snapshots, text tables, writers)
  functions/  Column -> Column helpers (cleaning, calendar arithmetic, safe maths, keys)
  operators/  DataFrame -> DataFrame operators (joins, aggregation, windows, history, upsert, quality, ledger)
  plans/      business computations built from the operators (supply chain, vending, service, help desk, finance)
  streaming/  Structured Streaming variants of the incremental operators
  catalog/    the registered queries over the driver tables, each with an independent SQL oracle
"""

__version__ = "0.1.0"
