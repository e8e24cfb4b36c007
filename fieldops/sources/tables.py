"""A — scans and sinks.

Every reader returns a lazy DataFrame: column pruning and filter pushdown reach the parquet scan
because nothing here materialises or selects ``*`` eagerly.
"""
from __future__ import annotations

import os
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """A01 — parquet table scan.  ``columns`` is only a convenience: Catalyst prunes anyway."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def register_views(spark: SparkSession, sf_dir: str, names: Iterable[str] = TABLES) -> None:
    """A07 — expose tables to ``spark.sql`` as temp views."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)


def read_seed(spark: SparkSession, path: str, schema: T.StructType | str,
              header: bool = True, sep: str = ",") -> DataFrame:
    """A02 — typed CSV lookup with a declared schema (no inference).

    Seeds are small by construction (a few hundred rows); callers broadcast them.
    """
    return (spark.read.schema(schema).option("header", header).option("sep", sep)
            .option("mode", "FAILFAST").csv(path))


def seed_frame(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A02 (in-query form) — a tiny literal lookup (rule tables, scenarios, calendars)."""
    return spark.createDataFrame(list(rows), schema)


def read_text_table(spark: SparkSession, path: str, header: bool = True, sep: str = ",") -> DataFrame:
    """A04 — CSV/spreadsheet export read as all-string columns; typing happens in a later cast step."""
    return (spark.read.option("header", header).option("sep", sep)
            .option("inferSchema", False).csv(path))


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                sort_by: Sequence[str] | None = None, mode: str = "overwrite",
                max_records_per_file: int | None = None) -> None:
    """A05/A06 — full-refresh sink, optionally partitioned by a date column and clustered.

    Clustering = a range repartition on the partition and sort columns (so that a large
    partition value is spread over many tasks and files) followed by a sort within
    partitions on ``sort_by``: each output file then holds a narrow key range so parquet
    row-group min/max statistics prune well on reads.
    """
    out = df
    if partition_by:
        out = out.repartitionByRange(*[F.col(c) for c in [*partition_by, *(sort_by or [])]])
    if sort_by:
        out = out.sortWithinPartitions(*(list(partition_by or []) + list(sort_by)))
    w = out.write.mode(mode)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """A07 — ephemeral relation: register and hand back the same lazy plan."""
    df.createOrReplaceTempView(name)
    return df


def with_audit(df: DataFrame, run_id: str, now) -> DataFrame:
    """A08 — audit columns; ``now`` is injected so reruns are reproducible."""
    return (df.withColumn("_run_id", F.lit(run_id))
              .withColumn("_loaded_at", F.lit(now).cast("timestamp")))


def lit_date(d) -> Column:
    return F.lit(str(d)).cast("date")
