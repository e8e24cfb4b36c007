"""E25–E30 — type-2 history (snapshots) and the history view.

A snapshot run is one keyed full outer join between the open versions and the current state,
followed by a union with the closed versions: one shuffle on the key, no per-row Python.
``now`` is an argument, so a rerun with the same inputs and the same ``now`` is idempotent.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldops.operators.windows import null_safe_join

from fieldops.functions.keys import surrogate_key

META = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]
# Floor of the first version and open end in the history view.
FIRST_VALID_FROM = "2000-01-01 00:00:00"
OPEN_VALID_TO = "9999-12-31 00:00:00"


def _ts(x) -> Column:
    return F.lit(str(x)).cast("timestamp_ntz")


def _changed(cols: Sequence[str], a: str = "_h_", b: str = "_c_") -> Column:
    cond = F.lit(False)
    for c in cols:
        cond = cond | ~F.col(f"{a}{c}").eqNullSafe(F.col(f"{b}{c}"))  # NULL ↔ value is a change
    return cond


def _new_rows(cur: DataFrame, keys: Sequence[str], data_cols: Sequence[str], valid_from: Column) -> DataFrame:
    return cur.select(*keys, *data_cols,
                      surrogate_key(*keys, valid_from).alias("dbt_scd_id"),
                      valid_from.alias("dbt_updated_at"), valid_from.alias("dbt_valid_from"),
                      F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"))


def scd2_snapshot(history: DataFrame | None, current: DataFrame, keys: Sequence[str], now: dt.datetime,
                  check_cols: Sequence[str] | str = "all", strategy: str = "check",
                  updated_at: str | None = None, invalidate_hard_deletes: bool = False,
                  exclude_cols: Sequence[str] = ()) -> DataFrame:
    """E25/E26/E27/E28 — next state of a type-2 history table.

    strategy ``check``: a version changes when any of ``check_cols`` differs (NULL-safe);
    ``check_cols='all'`` tracks every column except keys and ``exclude_cols`` (the latter are still
    stored).  strategy ``timestamp``: a version changes when ``updated_at`` is newer; the new version
    starts at that timestamp.  ``invalidate_hard_deletes`` closes versions whose key disappeared.
    """
    data_cols = [c for c in current.columns if c not in keys]
    tracked = ([c for c in data_cols if c not in exclude_cols] if check_cols == "all" else list(check_cols))
    now_c = _ts(now)
    start = F.col(updated_at).cast("timestamp_ntz") if strategy == "timestamp" else now_c
    if history is None:
        return _new_rows(current.withColumn("_vf", start), keys, data_cols, F.col("_vf"))

    closed = history.where(F.col("dbt_valid_to").isNotNull())
    open_ = history.where(F.col("dbt_valid_to").isNull())
    h = open_.select(*[F.col(c).alias(f"_h_{c}") for c in open_.columns], F.lit(True).alias("_in_h"))
    c = current.select(*[F.col(x).alias(f"_c_{x}") for x in current.columns], F.lit(True).alias("_in_c"))
    # NULL parts of a composite key are values like others
    j = h.join(c, [h[f"_h_{k}"].eqNullSafe(c[f"_c_{k}"]) for k in keys], "full")
    in_h, in_c = F.col("_in_h").isNotNull(), F.col("_in_c").isNotNull()
    if strategy == "timestamp":
        changed = F.col(f"_c_{updated_at}") > F.col(f"_h_{updated_at}")
        new_start = F.col(f"_c_{updated_at}").cast("timestamp_ntz")
    else:
        changed = _changed(tracked)
        new_start = now_c
    # open versions: unchanged stay open; changed ones end where the new one starts, deleted ones (when asked) now
    gone = in_h & ~in_c & F.lit(invalidate_hard_deletes)
    kept = j.where(in_h).select(*[F.col(f"_h_{x}").alias(x) for x in open_.columns if x != "dbt_valid_to"],
                                F.when(gone, now_c).when(in_c & changed, new_start)
                                 .otherwise(F.col("_h_dbt_valid_to")).alias("dbt_valid_to"))
    fresh = j.where(in_c & (~in_h | changed)).select(*[F.col(f"_c_{x}").alias(x) for x in current.columns],
                                                    new_start.alias("_vf"))
    new = _new_rows(fresh, keys, data_cols, F.col("_vf"))
    cols = list(history.columns)
    return closed.select(*cols).unionByName(kept.select(*cols)).unionByName(new.select(*cols))


def frozen_periods(history: DataFrame | None, current: DataFrame, keys: Sequence[str], now: dt.datetime,
                   period: str = "month", revise: bool = True) -> DataFrame:
    """E27 — next state of a history of period values: composite key (``period_start``, keys), closed periods never change.

    Each run writes the current values under the period of ``now``.  Rows of earlier periods are absent from them, so the
    first run of a later period closes their open versions, and no run touches them again.  Within a period a later run
    revises: a changed row gets a new version, a row that has gone is closed.  ``revise=False``: the first value of
    a period stands (the snapshot's timestamp strategy), only new keys are added and lost ones closed."""
    start = F.date_trunc(period, _ts(now)).cast("date")
    state = current.select(start.alias("period_start"), *current.columns)
    key = ["period_start", *keys]
    if revise:
        return scd2_snapshot(history, state, key, now, invalidate_hard_deletes=True)
    stamped = state.withColumn("period_updated_at", F.col("period_start").cast("timestamp_ntz"))
    return scd2_snapshot(history, stamped, key, now, strategy="timestamp", updated_at="period_updated_at", invalidate_hard_deletes=True)


def period_values(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The final value of each period and key: its last version, as a partial aggregate."""
    data = [c for c in history.columns if c not in (*keys, "period_start", *META)]
    g = history.groupBy("period_start", *keys).agg(F.max_by(F.struct(*data), F.col("dbt_valid_from")).alias("_v"))
    return g.select("period_start", *keys, *[F.col(f"_v.{c}").alias(c) for c in data])


def history_view(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """E29 — half-open validity [from, to): first version floored, open end 9999-12-31, is_current."""
    w = Window.partitionBy(*keys)
    first = F.col("dbt_valid_from") == F.min("dbt_valid_from").over(w)
    return (history.withColumn("valid_from", F.when(first, _ts(FIRST_VALID_FROM)).otherwise(F.col("dbt_valid_from")))
                   .withColumn("valid_to", F.coalesce(F.col("dbt_valid_to"), _ts(OPEN_VALID_TO)))
                   .withColumn("is_current", F.col("dbt_valid_to").isNull()))


def backfill_leading_nulls(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """E30 — NULLs take the first known value of the key (``first_value(… ignore nulls)`` over the
    full frame).  Computed as a partial aggregate (``min_by`` of the non-NULL values) joined back, so
    a key with a huge history is reduced map-side instead of sorted in one task."""
    o = F.struct(*[F.col(c) for c in order])
    firsts = df.groupBy(*keys).agg(*[F.min_by(F.when(F.col(c).isNotNull(), F.col(c)),
                                              F.when(F.col(c).isNotNull(), o)).alias(f"_first_{c}") for c in cols])
    out = null_safe_join(df, firsts, keys, "left")
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"_first_{c}"))).drop(f"_first_{c}")
    return out
