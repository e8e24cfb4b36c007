"""F — window functions over the driver tables."""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldops.catalog import register
from fieldops.catalog.fixtures import t
from fieldops.functions.scalar import round_half_up
from fieldops.operators.windows import bucketed_lag, bucketed_running, episodes_bucketed, top1

DEC = "decimal(18,2)"
LKEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
LKEY_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice"


@register("f01_top1_per_group", sql=f"""
select l_orderkey, l_linenumber, l_partkey, l_extendedprice from lineitem
qualify row_number() over (partition by l_orderkey order by l_extendedprice desc, {LKEY_SQL}) = 1""")
def f01(spark, d):
    l = t(spark, d, "lineitem")
    return top1(l, ["l_orderkey"], [F.col("l_extendedprice").desc()] + [F.col(c) for c in LKEY]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@register("f02_qualify_latest", sql=f"""
select l_suppkey, l_partkey, l_shipdate, l_orderkey from lineitem
qualify row_number() over (partition by l_suppkey, l_partkey order by l_shipdate desc, {LKEY_SQL}) = 1""")
def f02(spark, d):
    l = t(spark, d, "lineitem")
    return top1(l, ["l_suppkey", "l_partkey"], [F.col("l_shipdate").desc()] + [F.col(c) for c in LKEY]).select(
        "l_suppkey", "l_partkey", "l_shipdate", "l_orderkey")


@register("f03_priority_row_number", sql="""
select o_custkey, o_orderkey, o_orderstatus from orders
qualify row_number() over (partition by o_custkey
  order by case when o_orderstatus = 'F' then 1 else 2 end, o_orderdate desc, o_orderkey) = 1""")
def f03(spark, d):
    o = t(spark, d, "orders")
    prio = F.when(F.col("o_orderstatus") == "F", 1).otherwise(2)
    return top1(o, ["o_custkey"], [prio, F.col("o_orderdate").desc(), F.col("o_orderkey")]).select(
        "o_custkey", "o_orderkey", "o_orderstatus")


@register("f04_lag_multi_column", sql="""
select event_id, lag(ts) over w as prev_ts, lag(event_type) over w as prev_type,
       lag(value, 2) over w as prev2_value
from events window w as (partition by user_id order by ts, event_id)""")
def f04(spark, d):
    e = t(spark, d, "events")
    day = F.col("ts").cast("date")
    # bucketed by day so a hot user is split over its days; lag 2 = lag 1 of the lagged value
    x = bucketed_lag(e, ["user_id"], ["ts", "event_id"], ["ts", "event_type", "value"], day)
    x = bucketed_lag(x, ["user_id"], ["ts", "event_id"], ["prev_value"], day, prefix="lag2_")
    return x.select("event_id", "prev_ts", F.col("prev_event_type").alias("prev_type"),
                    F.col("lag2_prev_value").alias("prev2_value"))


@register("f05_lag_year_on_year", sql="""
with m as (select year(o_orderdate) as yr, month(o_orderdate) as mo,
                  sum(cast(o_totalprice as decimal(18,2))) as revenue from orders group by 1, 2)
select yr, mo, revenue, lag(revenue) over (partition by mo order by yr) as revenue_prev_year from m""")
def f05(spark, d):
    o = t(spark, d, "orders")
    m = o.groupBy(F.year("o_orderdate").alias("yr"), F.month("o_orderdate").alias("mo")).agg(
        F.sum(F.col("o_totalprice").cast(DEC)).alias("revenue"))
    # gaps are not filled: the lag is "previous year present", as in the source model
    return m.withColumn("revenue_prev_year", F.lag("revenue").over(Window.partitionBy("mo").orderBy("yr")))


@register("f06_lead_interval_end", sql="""
select event_id, user_id, ts as valid_from,
       lead(ts) over (partition by user_id order by ts, event_id) as valid_to
from events""")
def f06(spark, d):
    e = t(spark, d, "events")
    x = bucketed_lag(e, ["user_id"], ["ts", "event_id"], ["ts"], F.col("ts").cast("date"), offset_direction="lead",
                     prefix="next_")
    return x.select("event_id", "user_id", F.col("ts").alias("valid_from"), F.col("next_ts").alias("valid_to"))


@register("f07_running_sum_ytd", sql="""
with m as (select year(o_orderdate) as yr, month(o_orderdate) as mo,
                  sum(cast(o_totalprice as decimal(18,2))) as revenue from orders group by 1, 2)
select yr, mo, revenue, sum(revenue) over (partition by yr order by mo) as revenue_ytd from m""")
def f07(spark, d):
    o = t(spark, d, "orders")
    m = o.groupBy(F.year("o_orderdate").alias("yr"), F.month("o_orderdate").alias("mo")).agg(
        F.sum(F.col("o_totalprice").cast(DEC)).alias("revenue"))
    return m.withColumn("revenue_ytd", F.sum("revenue").over(Window.partitionBy("yr").orderBy("mo")))


@register("f08_cumulative_share_rows", sql="""
with v as (select l_suppkey, l_partkey, sum(cast(l_extendedprice as decimal(18,2))) as value
           from lineitem group by 1, 2)
select l_suppkey, l_partkey, value,
  cast(round(cast(100 * cast(sum(value) over (partition by l_suppkey order by value desc, l_partkey
                                   rows between unbounded preceding and current row) as double)
             / cast(sum(value) over (partition by l_suppkey) as double) as decimal(38,10)), 4) as double) as cum_pct
from v""")
def f08(spark, d):
    l = t(spark, d, "lineitem")
    v = l.groupBy("l_suppkey", "l_partkey").agg(F.sum(F.col("l_extendedprice").cast(DEC)).alias("value"))
    # running share per supplier without a supplier-wide window: windows per (supplier, value
    # octave slice) + offsets of the earlier slices; exact because the sums are decimals
    bucket = F.when(F.col("value") > 0, -F.floor(F.log2(F.col("value").cast("double")) * 8)).otherwise(F.lit(1 << 30))
    x = bucketed_running(v.withColumn("_neg", -F.col("value")), ["l_suppkey"], ["_neg", "l_partkey"], bucket.cast("long"),
                         sums={"_cum": F.col("value")})
    tot = v.groupBy("l_suppkey").agg(F.sum("value").alias("_tot"))
    pct = 100 * F.col("_cum").cast("double") / F.col("_tot").cast("double")
    return x.join(tot, "l_suppkey").select("l_suppkey", "l_partkey", "value", round_half_up(pct, 4).alias("cum_pct"))


SQL_F09 = """
with wk as (select l_suppkey, cast(date_trunc('week', l_shipdate) as date) as week,
                   cast(sum(l_quantity) as double) as qty from lineitem group by 1, 2)
select l_suppkey, week, qty, sum(qty) over w as qty_4w, count(*) over w as n_weeks_4w
from wk window w as (partition by l_suppkey order by date_diff('day', date '1970-01-01', week)
                     range between 21 preceding and current row)"""


def _f09(spark, d):
    l = t(spark, d, "lineitem")
    wk = l.groupBy("l_suppkey", F.trunc(F.col("l_shipdate").cast("date"), "week").alias("week")).agg(
        F.sum("l_quantity").alias("qty"))
    # 4 ISO weeks = value RANGE of 21 days on the day number; absent weeks are simply absent
    w = Window.partitionBy("l_suppkey").orderBy(F.unix_date("week")).rangeBetween(-21, 0)
    return wk.select("l_suppkey", "week", "qty", F.sum("qty").over(w).alias("qty_4w"),
                     F.count(F.lit(1)).over(w).alias("n_weeks_4w"))


register("f09_range_frame_4_weeks", sql=SQL_F09)(_f09)
register("f10_named_window_reuse", sql=SQL_F09)(_f09)


@register("f11_partition_totals", sql=f"""
select {LKEY_SQL}, l_quantity,
  sum(l_quantity) over (partition by l_orderkey) as order_qty,
  count(*) over (partition by l_orderkey) as order_lines,
  cast(round(cast(avg(l_quantity) over (partition by l_orderkey) as decimal(38,10)), 4) as double) as order_avg_qty
from lineitem""")
def f11(spark, d):
    w = Window.partitionBy("l_orderkey")
    return t(spark, d, "lineitem").select(*LKEY, "l_quantity", F.sum("l_quantity").over(w).alias("order_qty"),
                                          F.count(F.lit(1)).over(w).alias("order_lines"),
                                          round_half_up(F.avg("l_quantity").over(w), 4).alias("order_avg_qty"))


@register("f12_ratio_two_partition_levels", sql="""
with v as (select l_suppkey, l_partkey, cast(sum(l_quantity) as double) as qty from lineitem group by 1, 2)
select l_suppkey, l_partkey,
  cast(round(cast(qty / sum(qty) over (partition by l_suppkey) as decimal(38,10)), 6) as double) as share_in_supplier,
  cast(round(cast(sum(qty) over (partition by l_partkey) / sum(qty) over () as decimal(38,10)), 6) as double) as part_share
from v""")
def f12(spark, d):
    v = t(spark, d, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("qty"))
    # partition totals as aggregates joined back (the grand total is one row: no window over all rows)
    by_supp = v.groupBy("l_suppkey").agg(F.sum("qty").alias("_s"))
    by_part = v.groupBy("l_partkey").agg(F.sum("qty").alias("_p"))
    grand = v.agg(F.sum("qty").alias("_g"))
    x = v.join(by_supp, "l_suppkey").join(by_part, "l_partkey").crossJoin(F.broadcast(grand))
    return x.select("l_suppkey", "l_partkey", round_half_up(F.col("qty") / F.col("_s"), 6).alias("share_in_supplier"),
                    round_half_up(F.col("_p") / F.col("_g"), 6).alias("part_share"))


@register("f13_first_value_full_frame", sql="""
select event_id, first_value(event_type) over (partition by user_id order by ts, event_id
  rows between unbounded preceding and unbounded following) as first_type
from events""")
def f13(spark, d):
    e = t(spark, d, "events")
    # first_value over the full frame == min_by per key: a partial aggregate joined back (no key-wide window)
    first = e.groupBy("user_id").agg(F.min_by("event_type", F.struct("ts", "event_id")).alias("first_type"))
    return e.join(first, "user_id").select("event_id", "first_type")


@register("f14_conditional_max_full_frame", sql="""
select event_id, max(case when event_type = 'purchase' then ts end) over (partition by user_id) as last_purchase
from events""")
def f14(spark, d):
    e = t(spark, d, "events")
    last = e.groupBy("user_id").agg(F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("last_purchase"))
    return e.join(last, "user_id").select("event_id", "last_purchase")


@register("f15_running_countif_islands", sql="""
with g as (select event_id, user_id, ts,
             date_diff('day', lag(cast(ts as date)) over (partition by user_id order by ts, event_id),
                       cast(ts as date)) as gap_days
           from events),
s as (select *, gap_days is null or gap_days > 1 as is_new_episode from g),
n as (select *, sum(cast(is_new_episode as integer)) over (partition by user_id order by ts, event_id
                 rows between unbounded preceding and current row) as episode_no from s)
select event_id, user_id, gap_days, is_new_episode, episode_no,
  row_number() over (partition by user_id, episode_no order by ts, event_id) as episode_rank
from n""")
def f15(spark, d):
    e = t(spark, d, "events").withColumn("day", F.col("ts").cast("date"))
    # bucketed by week: a user holding a third of all events is split over its weeks
    out = episodes_bucketed(e, ["user_id"], ["ts", "event_id"], "day", gap_days=1, bucket=F.trunc("day", "week"))
    return out.select("event_id", "user_id", "gap_days", "is_new_episode",
                      F.col("episode_no").cast("long").alias("episode_no"), "episode_rank")


@register("f16_conditional_count_per_day", sql=f"""
select {LKEY_SQL},
  count(case when l_returnflag = 'R' then 1 end) over (partition by l_suppkey, cast(l_shipdate as date)) as n_returns_same_day
from lineitem""")
def f16(spark, d):
    l = t(spark, d, "lineitem").withColumn("_day", F.col("l_shipdate").cast("date"))
    per = l.groupBy("l_suppkey", "_day").agg(F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("n_returns_same_day"))
    return l.join(per, ["l_suppkey", "_day"]).select(*LKEY, "n_returns_same_day")


@register("f17_min_over_other_grain", sql="""
with v as (select l_suppkey, l_partkey, min(l_shipdate) as first_ship from lineitem group by 1, 2)
select l_suppkey, l_partkey, first_ship, min(first_ship) over (partition by l_partkey) as first_ship_any_supplier
from v""")
def f17(spark, d):
    v = t(spark, d, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.min("l_shipdate").alias("first_ship"))
    return v.withColumn("first_ship_any_supplier", F.min("first_ship").over(Window.partitionBy("l_partkey")))


@register("f18_max_over_period", sql="""
select event_id, ts = max(ts) over (partition by cast(ts as date)) as is_latest_of_day from events""")
def f18(spark, d):
    e = t(spark, d, "events").withColumn("_day", F.col("ts").cast("date"))
    # a day may hold a large share of all rows: per-day max as an aggregate (one row per day) joined back
    latest = e.groupBy("_day").agg(F.max("ts").alias("_max"))
    return e.join(F.broadcast(latest), "_day").select("event_id", (F.col("ts") == F.col("_max")).alias("is_latest_of_day"))


@register("f19_desc_nulls_last", sql=f"""
select l_orderkey, l_linenumber, l_partkey, l_discount from lineitem
qualify row_number() over (partition by l_orderkey order by nullif(l_discount, 0) desc nulls last, {LKEY_SQL}) = 1""")
def f19(spark, d):
    l = t(spark, d, "lineitem")
    return top1(l, ["l_orderkey"], [F.nullif("l_discount", F.lit(0.0)).desc_nulls_last()]
                + [F.col(c) for c in LKEY]).select("l_orderkey", "l_linenumber", "l_partkey", "l_discount")
