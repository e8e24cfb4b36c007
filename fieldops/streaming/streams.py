"""W01–W05 on a file source.

Every stream keeps its checkpoint with the table it writes, and tables are manifest tables or folders named by
batch, so a restarted driver goes on from the last committed batch and a batch given twice counts once.  ``trigger(availableNow=True)`` processes
what is there and stops: the reference re-runs small batches several times a day, which is this.
"""
from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldops.operators.aggs import keep_latest
from fieldops.operators.windows import bucketed_lag, null_safe_join
from fieldops.sources.manifest import ManifestTable

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def file_stream(spark: SparkSession, path: str, schema: T.StructType = EVENTS_SCHEMA,
                glob: str | None = None, files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.parquet(path)


def run_available(stream_df: DataFrame, batch_fn, checkpoint: str, output_mode: str = "append") -> list[dict]:
    """Run ``batch_fn(batch_df, epoch_id)`` over everything available, then stop; the progress of each batch.

    Started again with the same checkpoint, it goes on where it stopped.  A batch that had not ended is given
    again under the same epoch, so ``batch_fn`` must be repeatable."""
    q = (stream_df.writeStream.outputMode(output_mode).foreachBatch(batch_fn)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return [json.loads(p.json) if hasattr(p, "json") and isinstance(p.json, str) else dict(p) for p in q.recentProgress]


def upsert_stream(spark: SparkSession, stream_df: DataFrame, target: str, keys: Sequence[str], order: Sequence[str],
                  checkpoint: str | None = None, buckets: int = 16) -> ManifestTable:
    """W01 — micro-batch upsert by key into a manifest table, the newest row by ``order`` standing whatever the
    order of arrival.

    The table is split by a hash of the key; a batch rewrites the buckets it touches, as one version that notes
    the batch.  The checkpoint lies with the table, so a stream that stopped, between batches or within one, goes
    on from there, and a batch that is given again changes nothing.  Empty batches are accepted."""
    table, source = ManifestTable(spark, target), checkpoint or f"{target}/_checkpoint"
    part = F.pmod(F.xxhash64(*keys), F.lit(buckets))

    def apply(batch: DataFrame, epoch: int) -> None:
        base = table.manifest()
        if table.applied(source, epoch, base) or batch.isEmpty():
            return
        latest = keep_latest(batch, keys, order)
        touched = [str(r[0]) for r in batch.select(part).distinct().collect()]  # at most one row per bucket
        if base is not None:
            latest = keep_latest(table.read(touched, base).unionByName(latest, allowMissingColumns=True), keys, order)
        table.replace(latest, part, touched, base, {"source": source, "number": epoch})

    run_available(stream_df, apply, source)
    return table


def dedupe_within_watermark(stream_df: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """W02 — late duplicates of a key inside the watermark delay are dropped (state is bounded).
    Event time must be a TIMESTAMP (instant): NTZ columns are cast, and cast back afterwards."""
    ntz = dict(stream_df.dtypes).get(ts) == "timestamp_ntz"
    s = stream_df.withColumn(ts, F.col(ts).cast("timestamp")) if ntz else stream_df
    s = s.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
    return s.withColumn(ts, F.col(ts).cast("timestamp_ntz")) if ntz else s


def _instant(stream_df: DataFrame, ts: str, watermark: str | None) -> DataFrame:
    """Event time as an instant, with a watermark."""
    if dict(stream_df.dtypes).get(ts) == "timestamp_ntz":
        stream_df = stream_df.withColumn(ts, F.col(ts).cast("timestamp"))
    return stream_df.withWatermark(ts, watermark) if watermark else stream_df


def tumbling_counts(stream_df: DataFrame, ts: str, width: str, start_offset: str | None,
                    by: Sequence[str], value: str, watermark: str | None = None) -> DataFrame:
    """W03 — tumbling windows; ``start_offset='4 days'`` with a 7-day width gives Monday weeks.

    With a watermark a window closes once the watermark has passed its end: it is emitted once and leaves the
    state.  Rows of closed windows are late."""
    s = _instant(stream_df, ts, watermark)
    w = F.window(ts, width, width, start_offset) if start_offset else F.window(ts, width)
    return (s.groupBy(w.alias("w"), *by)
            .agg(F.count(F.lit(1)).alias("n_events"), F.sum(F.col(value).cast("decimal(18,2)")).alias("total_value"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), *by, "n_events", "total_value"))


def sessions(stream_df: DataFrame, ts: str, gap: str, by: Sequence[str], watermark: str | None = None) -> DataFrame:
    """W04 — episodes separated by more than ``gap`` (a gap exactly equal stays in the session).

    With a watermark a session closes once the watermark has passed its end, as in W03."""
    return (_instant(stream_df, ts, watermark).groupBy(F.session_window(ts, gap).alias("s"), *by)
            .agg(F.count(F.lit(1)).alias("n_events"))
            .select(*by, F.col("s.start").cast("timestamp_ntz").alias("session_start"),
                    F.col("s.end").cast("timestamp_ntz").alias("session_end"), "n_events"))


def emit_closed(closed: DataFrame, out: str, checkpoint: str | None = None) -> dict:
    """Append what a watermarked aggregate closes, a folder per batch, so that a batch that is given again
    replaces its own rows.

    Returns emitted rows, rows left in the state, and late rows: these belong to windows that were emitted
    before and are left out by the state store, counted here.  The caller decides what a number of them means."""
    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={epoch}")

    progress = run_available(closed, write, checkpoint or f"{out}/_checkpoint")
    states = [p["stateOperators"][0] for p in progress if p.get("stateOperators")]
    return {"emitted": sum(s.get("numRowsRemoved", 0) for s in states), "state_rows": [s["numRowsTotal"] for s in states],
            "late": sum(s.get("numRowsDroppedByWatermark", 0) for s in states)}


def emitted(spark: SparkSession, out: str) -> DataFrame:
    """All rows that emit_closed has written."""
    return spark.read.parquet(out).drop("batch")


def interval_state_stream(spark: SparkSession, stream_df: DataFrame, key: str, ts: str, order_tail: str, out: str,
                          checkpoint: str | None = None, buckets: int = 16) -> ManifestTable:
    """W05 — open-interval state per key across micro-batches: (key, valid_from, order_tail, valid_to).

    An event closes the interval of the one before it and opens its own (NULL end).  One manifest table holds
    both: closed intervals by the day of their end, open ones by a hash of the key.  A batch reads the open
    buckets of its keys and the days from its earliest event on; of these, intervals that end at or after a key's
    first event of the batch are made anew from their starts and the new events.  On-time batches so touch
    recent days only; a late event cuts the interval it falls into, closed or not.  Events that are there
    already change nothing, and a batch that is given again after a restart is skipped.  Events without a time
    take no part."""
    table, source = ManifestTable(spark, out), checkpoint or f"{out}/_checkpoint"
    bucket = F.concat(F.lit("open-"), F.pmod(F.xxhash64(key), F.lit(buckets)).cast("string"))
    day = F.date_format("valid_to", "yyyy-MM-dd")
    part = F.when(F.col("valid_to").isNull(), bucket).otherwise(day)

    def apply(batch: DataFrame, epoch: int) -> None:
        base = table.manifest()
        if table.applied(source, epoch, base) or batch.isEmpty():
            return
        events = batch.where(F.col(ts).isNotNull()).select(key, F.col(ts).alias("valid_from"), order_tail).distinct()
        kept, touched = None, []
        if base is not None:
            first = events.agg(F.min(F.date_format("valid_from", "yyyy-MM-dd"))).first()[0]
            if first is None:
                return
            open_now = {r[0] for r in events.select(bucket).distinct().collect()}  # at most one row per bucket
            touched = [v for v in base["parts"] if v in open_now or (not v.startswith("open-") and v >= first)]
            low = events.groupBy(key).agg(F.min("valid_from").alias("_low"))
            seen = null_safe_join(table.read(touched, base), low, [key], "left")
            hit = F.col("_low").isNotNull() & (F.col("valid_to").isNull() | (F.col("valid_to") >= F.col("_low")))
            kept = seen.where(~hit).drop("_low")
            events = events.unionByName(seen.where(hit).select(*events.columns)).distinct()
        made = bucketed_lag(events, [key], ["valid_from", order_tail], ["valid_from"], F.col("valid_from").cast("date"),
                            offset_direction="lead", prefix="_next_").withColumnRenamed("_next_valid_from", "valid_to")
        rows = made if kept is None else kept.unionByName(made)
        table.replace(rows, part, touched, base, {"source": source, "number": epoch})

    run_available(stream_df, apply, source)
    return table
