"""F — window helpers: top-1 per group, episodes/islands, running and centred frames."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top1(df: DataFrame, partition: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """F01/F02/F03/F19 — QUALIFY row_number() = 1 (Spark SQL has no QUALIFY).

    The planner inserts a WindowGroupLimit before the shuffle, so each map task keeps only its
    local top-1 per group.  ``order`` must be a total order (append unique columns).
    """
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def episodes(df: DataFrame, partition: Sequence[str], order: Sequence[Column], day_col: str,
             gap_days: int, prefix: str = "") -> DataFrame:
    """F15 / K24 — a new episode starts when the gap to the previous row exceeds ``gap_days``.

    Adds ``gap`` (days since previous), ``episode_no`` (running count of starts) and
    ``episode_rank`` (position inside the episode).
    """
    w = Window.partitionBy(*partition).orderBy(*order)
    prev = F.lag(F.col(day_col)).over(w)
    gap = F.datediff(F.col(day_col), prev)
    out = (df.withColumn(f"{prefix}gap_days", gap)
             .withColumn(f"{prefix}is_new_episode",
                         F.col(f"{prefix}gap_days").isNull() | (F.col(f"{prefix}gap_days") > gap_days)))
    out = out.withColumn(f"{prefix}episode_no",
                         F.sum(F.col(f"{prefix}is_new_episode").cast("int"))
                          .over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    we = Window.partitionBy(*partition, f"{prefix}episode_no").orderBy(*order)
    return out.withColumn(f"{prefix}episode_rank", F.row_number().over(we))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys where NULL equals NULL, as a window's partitions have it; keys come from the left."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(r, on, how).drop(*[f"_r_{k}" for k in keys])


def bucketed_lag(df: DataFrame, key: Sequence[str], order: Sequence[str], values: Sequence[str], bucket: Column,
                 offset_direction: str = "lag", prefix: str = "prev_") -> DataFrame:
    """Exact ``lag`` / ``lead`` of ``values`` per ``key`` ordered by ``order`` without sending a
    whole key to one task.

    Rows are windowed per (key, bucket) — e.g. per user and day — so a key holding a third of the
    data is split over its buckets.  The first (for lag; last for lead) row of each bucket takes
    its neighbour from the adjacent non-empty bucket: one row per (key, bucket) is reduced with
    ``max_by``/``min_by``, ordered per key (one row per bucket: bounded by the time span), and
    joined back.  ``bucket`` must be monotone in ``order`` (a truncation of the first order column).
    """
    b = df.withColumn("_bkt", bucket)
    ordcols = [F.col(c) for c in order]
    w = Window.partitionBy(*key, "_bkt").orderBy(*ordcols)
    fn = F.lag if offset_direction == "lag" else F.lead
    out = b
    for v in values:
        out = out.withColumn(f"{prefix}{v}", fn(v).over(w))
    edge = F.struct(*ordcols)
    agg_fn = F.max_by if offset_direction == "lag" else F.min_by   # last row of a bucket feeds the next bucket
    per_b = b.groupBy(*key, "_bkt").agg(*[agg_fn(F.col(v), edge).alias(f"_e_{v}") for v in values])
    wb = Window.partitionBy(*key).orderBy("_bkt")
    nb = per_b.select(*key, "_bkt", *[fn(f"_e_{v}").over(wb).alias(f"_n_{v}") for v in values])
    pos = F.row_number().over(w if offset_direction == "lag" else Window.partitionBy(*key, "_bkt").orderBy(*[c.desc() for c in ordcols]))
    out = out.withColumn("_pos", pos).transform(lambda x: null_safe_join(x, nb, [*key, "_bkt"], "left"))
    for v in values:
        out = out.withColumn(f"{prefix}{v}", F.when(F.col("_pos") == 1, F.col(f"_n_{v}")).otherwise(F.col(f"{prefix}{v}")))
    return out.drop("_bkt", "_pos", *[f"_n_{v}" for v in values])


def bucketed_running(df: DataFrame, key: Sequence[str], order: Sequence[str], bucket: Column,
                     sums: dict[str, Column] | None = None, maxes: dict[str, Column] | None = None,
                     totals: dict[str, str] | None = None) -> DataFrame:
    """Running (unbounded preceding → current row) sums and maxes per ``key`` without a key-wide
    window: windows run per (key, bucket); each bucket's totals (one row per key-bucket) give the
    offset contributed by earlier buckets.  Exact when ``bucket`` is monotone in ``order``.

    sums / maxes: output name → Column to accumulate; totals: output name → the one of ``sums`` whose sum over
    the whole key it holds.
    """
    sums, maxes, totals = sums or {}, maxes or {}, totals or {}
    b = df.withColumn("_bkt", bucket)
    for n, c in {**sums, **maxes}.items():
        b = b.withColumn(f"_v_{n}", c)
    w = (Window.partitionBy(*key, "_bkt").orderBy(*[F.col(c) for c in order])
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    per = b.groupBy(*key, "_bkt").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums],
                                      *[F.max(f"_v_{n}").alias(f"_t_{n}") for n in maxes])
    wb = Window.partitionBy(*key).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    off = per.select(*key, "_bkt", *[F.sum(f"_t_{n}").over(wb).alias(f"_o_{n}") for n in sums],
                     *[F.max(f"_t_{n}").over(wb).alias(f"_o_{n}") for n in maxes],
                     *[F.sum(f"_t_{n}").over(Window.partitionBy(*key)).alias(t) for t, n in totals.items()])
    out = null_safe_join(b, off, [*key, "_bkt"], "left")
    for n in sums:
        out = out.withColumn(n, F.sum(f"_v_{n}").over(w) + F.coalesce(F.col(f"_o_{n}"), F.lit(0)))
    for n in maxes:
        out = out.withColumn(n, F.greatest(F.max(f"_v_{n}").over(w), F.col(f"_o_{n}")))
    drop = ["_bkt"] + [f"_v_{n}" for n in {**sums, **maxes}] + [f"_o_{n}" for n in {**sums, **maxes}]
    return out.drop(*drop)


def bucketed_neighbours(df: DataFrame, key: Sequence[str], order: Sequence[str], bucket: Column, leads: dict[str, str] | None = None,
                        position: str | None = None) -> DataFrame:
    """``lead`` of several columns (output name → column) and the running row number of a key, exact, in one window pass
    per (key, bucket) and one join with a table of one row per bucket.

    The bucket's row holds its count and its first row's values, so both come from the same partial aggregate."""
    leads = leads or {}
    b = df.withColumn("_bkt", bucket)
    ordcols = [F.col(c) for c in order]
    w, wb = Window.partitionBy(*key, "_bkt").orderBy(*ordcols), Window.partitionBy(*key).orderBy("_bkt")
    per = b.groupBy(*key, "_bkt").agg(F.count(F.lit(1)).alias("_n"), F.min_by(F.struct(*[F.col(c).alias(o) for o, c in leads.items()], F.lit(0)),
                                                                           F.struct(*ordcols)).alias("_first"))
    edge = per.select(*key, "_bkt", F.coalesce(F.sum("_n").over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
                      F.lead("_first").over(wb).alias("_next"))
    out = b.withColumn("_pos", F.row_number().over(w)).withColumn("_last", F.lead(F.lit(1)).over(w).isNull())
    for o, c in leads.items():
        out = out.withColumn(o, F.lead(c).over(w))
    out = null_safe_join(out, edge, [*key, "_bkt"], "left")
    for o in leads:
        out = out.withColumn(o, F.when(F.col("_last"), F.col(f"_next.{o}")).otherwise(F.col(o)))
    if position:
        out = out.withColumn(position, F.col("_before") + F.col("_pos"))
    return out.drop("_bkt", "_pos", "_last", "_before", "_next")


def episodes_bucketed(df: DataFrame, key: Sequence[str], order: Sequence[str], day_col: str, gap_days: int,
                      bucket: Column) -> DataFrame:
    """F15 / K24 at scale — same columns as ``episodes`` (gap_days, is_new_episode, episode_no,
    episode_rank) plus ``episode_size``, with no window wider than one (key, bucket).

    One window pass finds gaps, starts and positions inside a bucket.  Only a bucket's first row depends on
    the bucket before; that, and how many rows and episodes precede, comes from a table of one row per bucket:
    its first and last day, its rows, its inner starts and the place of the last of them."""
    b = df.withColumn("_bkt", bucket)
    w = Window.partitionBy(*key, "_bkt").orderBy(*[F.col(c) for c in order])
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def passed(rows: DataFrame) -> DataFrame:
        x = rows.withColumn("_pos", F.row_number().over(w)).withColumn("gap_days", F.datediff(F.col(day_col), F.lag(day_col).over(w)))
        # inside a bucket only: its first row is settled later
        x = x.withColumn("_inner", F.when(F.col("_pos") > 1, F.coalesce(F.col("gap_days") > gap_days, F.lit(True))).otherwise(F.lit(False)))
        return (x.withColumn("_starts", F.sum(F.col("_inner").cast("long")).over(run))
                 .withColumn("_start", F.max(F.when(F.col("_inner"), F.col("_pos"))).over(run)))

    slim = list(dict.fromkeys([*key, "_bkt", *order, day_col]))
    per = passed(b.select(*slim)).groupBy(*key, "_bkt").agg(
        F.count(F.lit(1)).alias("_n"), F.max("_starts").alias("_s"), F.max("_start").alias("_p"),
        F.min_by(F.col(day_col), "_pos").alias("_f"), F.max_by(F.struct(F.col(day_col).alias("d")), F.col("_pos"))["d"].alias("_l"))
    wb = Window.partitionBy(*key).orderBy("_bkt")
    before = wb.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_gap", F.datediff(F.col("_f"), F.lag("_l").over(wb)))
    per = per.withColumn("_new", F.coalesce(F.col("_gap") > gap_days, F.lit(True)))
    per = per.withColumn("_rows", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    # global place of the last start of a bucket, if it has one
    per = per.withColumn("_place", F.col("_rows") + F.coalesce(F.col("_p"), F.when(F.col("_new"), F.lit(1))))
    edge = per.select(*key, "_bkt", F.col("_gap").alias("_e_gap"), F.col("_new").alias("_e_new"), F.col("_rows").alias("_e_rows"),
                      F.coalesce(F.sum(F.col("_s") + F.col("_new").cast("long")).over(before), F.lit(0)).alias("_e_no"),
                      F.max("_place").over(before).alias("_e_place"))
    x = null_safe_join(passed(b), edge, [*key, "_bkt"], "left")
    head = F.col("_pos") == 1
    own = F.when(F.col("_start").isNotNull(), F.col("_e_rows") + F.col("_start")).when(F.col("_e_new"), F.col("_e_rows") + 1)
    x = (x.withColumns({"gap_days": F.when(head, F.col("_e_gap")).otherwise(F.col("gap_days")),
                        "is_new_episode": F.when(head, F.col("_e_new")).otherwise(F.col("_inner")),
                        "episode_no": F.col("_e_no") + F.col("_e_new").cast("long") + F.col("_starts"),
                        "episode_rank": (F.col("_e_rows") + F.col("_pos") - F.coalesce(own, F.col("_e_place")) + 1).cast("int")})
          .drop("_bkt", "_pos", "_inner", "_starts", "_start", "_e_gap", "_e_new", "_e_rows", "_e_no", "_e_place"))
    size = x.groupBy(*key, "episode_no").agg(F.count(F.lit(1)).alias("episode_size"))
    return null_safe_join(x, size, [*key, "episode_no"], "inner")
