"""Column -> Column helpers.  All are built-in Spark expressions: they stay inside codegen."""
