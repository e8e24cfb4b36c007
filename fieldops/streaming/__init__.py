"""W — Structured Streaming variants of the incremental operators (bounded file-source streams)."""
