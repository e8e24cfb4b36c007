"""E22–E24 / W01 — keyed upserts on plain parquet (no table format needed).

``merge`` is the relational core: target rows whose key is not in the batch, plus the newest batch
row per key (anti join + union; both sides shuffle once on the key).  ``upsert_table`` applies it to a
manifest table, where a rewrite is seen whole or not at all; ``upsert_partitions`` to a partitioned table in
the plain folder layout (dynamic partition overwrite through a staging folder and a journal — a path is never
overwritten while read).
"""
from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldops.operators.aggs import keep_latest
from fieldops.session import ensure_checkpoint_dir
from fieldops.sources.manifest import NULL_PART, ManifestTable


def changed_since(df: DataFrame, updated_col: str, high_water_mark, now: dt.datetime,
                  lookback: dt.timedelta) -> DataFrame:
    """E23 — incremental window: newer than the target's high-water mark, or inside the lookback."""
    u = F.col(updated_col).cast("timestamp_ntz")
    floor = F.lit(str(now - lookback)).cast("timestamp_ntz")
    if high_water_mark is None:
        return df
    hwm = high_water_mark if not isinstance(high_water_mark, (str, dt.datetime)) else F.lit(str(high_water_mark)).cast("timestamp_ntz")
    return df.where((u > hwm) | (u >= floor))


def merge(target: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str],
          widen: bool = True) -> DataFrame:
    """E22/E24 — replace-on-key upsert; duplicates inside the batch resolve to the newest row by
    ``order``; new columns in the batch widen the schema (missing ones become NULL)."""
    latest = keep_latest(changes, keys, order)
    rest = target.join(latest.select(*keys), list(keys), "left_anti")
    return rest.unionByName(latest, allowMissingColumns=widen)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint directory (never a machine-local temp dir)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/fieldops-{label}-{uuid.uuid4().hex[:12]}"


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def upsert_table(spark: SparkSession, root: str, changes: DataFrame, keys: Sequence[str], order: Sequence[str],
                 partition: Column) -> dict:
    """E22/E24 — ``merge`` into a manifest table (``sources/manifest.py``), rewriting only partitions that hold a
    changed key, old or new.  Readers see the table before or after; a failure on the way leaves it as it was, and
    the call may be made again.

    ``partition`` is an expression over the row's columns.  Where the old row of a key lies is found by a scan of
    keys alone; only touched partitions are read whole."""
    table = ManifestTable(spark, root)
    base = table.manifest()
    latest = keep_latest(changes, keys, order)
    if base is None:
        return table.replace(latest, partition, [], None)
    target = table.read(base=base)
    name = F.coalesce(partition.cast("string"), F.lit(NULL_PART)).alias("v")
    held = target.join(changes.select(*keys).distinct(), list(keys), "left_semi").select(name)
    touched = [r[0] for r in latest.select(name).unionByName(held).distinct().collect()]  # one row per partition
    return table.replace(merge(table.read(touched, base), latest, keys, order), partition, touched, base)


def upsert_partitions(spark: SparkSession, path: str, changes: DataFrame, keys: Sequence[str],
                      order: Sequence[str], partition_col: str) -> None:
    """Apply ``merge`` to a partitioned table in the plain folder layout, rewriting only the partitions that hold a
    changed key, old or new.  A key that moves to another partition leaves the old one.

    The merged rows are staged, then a journal in the table's folder names them and the partitions that end up
    empty, then both are put in place.  A call that finds a journal first finishes what it names, so a failure on
    the way is mended by the next call or by ``finish_upsert``; until then readers of the plain layout may see a
    mixture (``upsert_table`` has no such moment).  Only a missing path means first load; any other failure to
    read is raised."""
    fs, root = _file_system(spark, path)
    stage = scratch_dir(spark, "stage")
    if not fs.exists(root):
        keep_latest(changes, keys, order).write.partitionBy(partition_col).parquet(path)
        return
    finish_upsert(spark, path)
    target = spark.read.parquet(path)
    held = target.join(changes.select(*keys).distinct(), list(keys), "left_semi").select(partition_col)
    touched = changes.select(partition_col).unionByName(held).distinct()
    part = target.join(touched, target[partition_col].eqNullSafe(touched[partition_col]), "left_semi")
    merge(part, changes, keys, order).write.partitionBy(partition_col).parquet(stage)
    merged = spark.read.schema(target.schema).parquet(stage) if set(changes.columns) <= set(target.columns) else spark.read.parquet(stage)
    emptied = touched.join(merged.select(partition_col).distinct(),
                           touched[partition_col].eqNullSafe(merged[partition_col]), "left_anti")
    gone = [r[0] for r in emptied.select(F.col(partition_col).cast("string")).collect()]  # one row per partition
    journal = {"stage": stage, "schema": merged.schema.jsonValue(), "column": partition_col, "gone": gone}
    out = fs.create(_journal(spark, root), False)
    out.write(bytearray(json.dumps(journal).encode()))
    out.close()
    finish_upsert(spark, path)


def _journal(spark: SparkSession, root):
    return spark._jvm.org.apache.hadoop.fs.Path(root, "_upsert.json")


def finish_upsert(spark: SparkSession, path: str) -> bool:
    """Put in place what a journal of ``upsert_partitions`` names, if there is one; may be repeated."""
    fs, root = _file_system(spark, path)
    file = _journal(spark, root)
    if not fs.exists(file):
        return False
    stream = fs.open(file)
    raw = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    try:
        todo = json.loads(raw)
    except ValueError:  # the writer died while it wrote the journal: nothing was put in place yet
        fs.delete(file, False)
        return False
    column = todo["column"]
    merged = spark.read.schema(StructType.fromJson(todo["schema"])).parquet(todo["stage"])
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for value in todo["gone"]:
        name = NULL_PART if value is None else escape(value)
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(root, f"{column}={name}"), True)
    fs.delete(file, False)
    return True
