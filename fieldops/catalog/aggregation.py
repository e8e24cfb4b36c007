"""E — aggregation, pivot, unpivot, arg-max, string aggregation, surrogate keys."""
from __future__ import annotations

from pyspark.sql import functions as F

from fieldops.catalog import register
from fieldops.catalog.fixtures import t
from fieldops.functions.keys import surrogate_key
from fieldops.functions.scalar import round_half_up, safe_div
from fieldops.operators.aggs import arg_max, pivot_labels, string_agg_distinct, unpivot_multi

DEC = "decimal(18,2)"


@register("e01_hash_group_by", sql="""
select l_returnflag, l_linestatus, cast(sum(l_quantity) as double) as sum_qty,
  sum(cast(l_extendedprice as decimal(18,2))) as sum_price, count(*) as n_lines,
  min(l_shipdate) as first_ship, max(l_shipdate) as last_ship,
  cast(round(cast(avg(l_discount) as decimal(38,10)), 4) as double) as avg_disc
from lineitem group by 1, 2""")
def e01(spark, d):
    return t(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), F.sum(F.col("l_extendedprice").cast(DEC)).alias("sum_price"),
        F.count(F.lit(1)).alias("n_lines"), F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"), round_half_up(F.avg("l_discount"), 4).alias("avg_disc"))


@register("e02_group_by_expression", sql="""
select year(l_shipdate) as ship_year, l_returnflag = 'R' as is_return, count(*) as n_lines
from lineitem group by 1, 2""")
def e02(spark, d):
    return t(spark, d, "lineitem").groupBy(
        F.year("l_shipdate").alias("ship_year"), (F.col("l_returnflag") == "R").alias("is_return")
    ).agg(F.count(F.lit(1)).alias("n_lines"))


@register("e03_group_by_as_dedupe", sql="select distinct l_orderkey, l_returnflag from lineitem")
def e03(spark, d):
    return t(spark, d, "lineitem").select("l_orderkey", "l_returnflag").dropDuplicates()


@register("e04_conditional_sum", sql="""
select cast(date_trunc('month', l_shipdate) as date) as month,
  cast(sum(case when l_returnflag = 'R' then l_quantity else 0 end) as double) as qty_returned,
  cast(sum(case when l_returnflag <> 'R' then l_quantity else 0 end) as double) as qty_kept
from lineitem group by 1""")
def e04(spark, d):
    r = F.col("l_returnflag") == "R"
    return t(spark, d, "lineitem").groupBy(F.trunc(F.col("l_shipdate").cast("date"), "MM").alias("month")).agg(
        F.sum(F.when(r, F.col("l_quantity")).otherwise(0)).alias("qty_returned"),
        F.sum(F.when(~r, F.col("l_quantity")).otherwise(0)).alias("qty_kept"))


@register("e05_countif", sql="""
select user_id, count_if(event_type = 'click') as n_clicks, count_if(value > 20) as n_high
from events group by 1""")
def e05(spark, d):
    return t(spark, d, "events").groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "click").alias("n_clicks"),
        F.count_if(F.col("value") > 20).alias("n_high"))


@register("e06_count_distinct_conditional", sql="""
select l_suppkey, count(distinct l_partkey) as n_parts,
  count(distinct case when l_returnflag = 'R' then l_orderkey end) as n_orders_with_return
from lineitem group by 1""")
def e06(spark, d):
    return t(spark, d, "lineitem").groupBy("l_suppkey").agg(
        F.countDistinct("l_partkey").alias("n_parts"),
        F.countDistinct(F.when(F.col("l_returnflag") == "R", F.col("l_orderkey"))).alias("n_orders_with_return"))


@register("e07_any_value_deterministic", sql="""
select o_custkey, min(o_orderpriority) as a_priority, count(*) as n_orders from orders group by 1""")
def e07(spark, d):
    # any_value is nondeterministic across runs; min() gives the same grain deterministically
    return t(spark, d, "orders").groupBy("o_custkey").agg(
        F.min("o_orderpriority").alias("a_priority"), F.count(F.lit(1)).alias("n_orders"))


@register("e08_arg_max", sql="""
select o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) as last_status,
       max(o_orderdate) as last_order
from orders group by 1""")
def e08(spark, d):
    return t(spark, d, "orders").groupBy("o_custkey").agg(
        arg_max("o_orderstatus", "o_orderdate", "o_orderkey").alias("last_status"),
        F.max("o_orderdate").alias("last_order"))


@register("e09_min_max_under_condition", sql="""
select user_id, min(case when event_type = 'signup' then ts end) as first_signup,
       max(case when event_type = 'purchase' then ts end) as last_purchase
from events group by 1""")
def e09(spark, d):
    e = t(spark, d, "events")
    return e.groupBy("user_id").agg(
        F.min(F.when(F.col("event_type") == "signup", F.col("ts"))).alias("first_signup"),
        F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("last_purchase"))


@register("e10_label_pivot", sql="""
select user_id,
  max(case when event_type = 'view' then value end) as view,
  max(case when event_type = 'click' then value end) as click,
  max(case when event_type = 'purchase' then value end) as purchase,
  max(case when event_type = 'signup' then value end) as signup,
  max(case when event_type = 'error' then value end) as error
from events group by 1""")
def e10(spark, d):
    return pivot_labels(t(spark, d, "events"), ["user_id"], "event_type", "value",
                        ["view", "click", "purchase", "signup", "error"])


@register("e11_native_pivot", sql="""
select year(l_shipdate) as ship_year,
  cast(sum(case when l_returnflag = 'A' then l_quantity end) as double) as "A",
  cast(sum(case when l_returnflag = 'N' then l_quantity end) as double) as "N",
  cast(sum(case when l_returnflag = 'R' then l_quantity end) as double) as "R"
from lineitem group by 1""")
def e11(spark, d):
    return (t(spark, d, "lineitem").groupBy(F.year("l_shipdate").alias("ship_year"))
            .pivot("l_returnflag", ["A", "N", "R"]).agg(F.sum("l_quantity")))


@register("e12_unpivot_multi_column", sql="""
with m as (
  select cast(date_trunc('month', o_orderdate) as date) as month,
    count(case when o_orderstatus = 'F' then 1 end) as n_f,
    sum(case when o_orderstatus = 'F' then cast(o_totalprice as decimal(18,2)) end) as amt_f,
    count(case when o_orderstatus = 'O' then 1 end) as n_o,
    sum(case when o_orderstatus = 'O' then cast(o_totalprice as decimal(18,2)) end) as amt_o
  from orders group by 1)
select month, 'F' as status, n_f as n_orders, amt_f as amount from m where n_f is not null or amt_f is not null
union all
select month, 'O', n_o, amt_o from m where n_o is not null or amt_o is not null""")
def e12(spark, d):
    o = t(spark, d, "orders")
    st = F.col("o_orderstatus")
    m = o.groupBy(F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("month")).agg(
        F.count(F.when(st == "F", 1)).alias("n_f"),
        F.sum(F.when(st == "F", F.col("o_totalprice").cast(DEC))).alias("amt_f"),
        F.count(F.when(st == "O", 1)).alias("n_o"),
        F.sum(F.when(st == "O", F.col("o_totalprice").cast(DEC))).alias("amt_o"))
    return unpivot_multi(m, ["month"], {"F": ["n_f", "amt_f"], "O": ["n_o", "amt_o"]},
                         "status", ["n_orders", "amount"])


@register("e13_logical_or", sql="""
select l_orderkey, bool_or(l_returnflag = 'R') as has_return, bool_and(l_linestatus = 'F') as all_final
from lineitem group by 1""")
def e13(spark, d):
    return t(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.bool_or(F.col("l_returnflag") == "R").alias("has_return"),
        F.bool_and(F.col("l_linestatus") == "F").alias("all_final"))


@register("e14_string_agg_distinct", sql="""
select l_orderkey, string_agg(distinct l_returnflag, ', ' order by l_returnflag) as flags,
       string_agg(cast(l_partkey as varchar), '-' order by l_linenumber, l_partkey, l_suppkey, l_shipdate,
                  l_extendedprice) as parts_in_line_order
from lineitem group by 1""")
def e14(spark, d):
    ordered = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey",
                                                   "l_shipdate", "l_extendedprice")))
    return t(spark, d, "lineitem").groupBy("l_orderkey").agg(
        string_agg_distinct("l_returnflag", ", ").alias("flags"),
        F.array_join(F.transform(ordered, lambda s: s["l_partkey"].cast("string")), "-")
         .alias("parts_in_line_order"))


@register("e15_ordered_first_ignore_nulls", sql="""
select l_orderkey,
  arg_min(l_partkey, (l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice))
    filter (where l_returnflag <> 'N') as first_non_n_part
from lineitem group by 1""")
def e15(spark, d):
    l = t(spark, d, "lineitem")
    key = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    keep = F.col("l_returnflag") != "N"
    return l.groupBy("l_orderkey").agg(
        F.min_by(F.when(keep, F.col("l_partkey")), F.when(keep, key)).alias("first_non_n_part"))


@register("e16_stddev_cv2", sql="""
select l_partkey, count(*) as n,
  cast(round(cast(stddev_samp(l_quantity) as decimal(38,10)), 4) as double) as sd_qty,
  cast(round(cast(power(stddev_samp(l_quantity) / nullif(avg(l_quantity), 0), 2) as decimal(38,10)), 2)
       as double) as cv2
from lineitem group by 1""")
def e16(spark, d):
    q = F.col("l_quantity")
    return t(spark, d, "lineitem").groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n"), round_half_up(F.stddev_samp(q), 4).alias("sd_qty"),
        round_half_up(F.pow(safe_div(F.stddev_samp(q), F.avg(q)), 2), 2).alias("cv2"))


@register("e17_approx_median", sql="""
select o.o_orderpriority,
  quantile_disc(date_diff('day', cast(o.o_orderdate as date), cast(l.l_shipdate as date)), 0.5) as median_delay
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
where date_diff('day', cast(o.o_orderdate as date), cast(l.l_shipdate as date)) >= 0
group by 1""")
def e17(spark, d):
    l, o = t(spark, d, "lineitem"), t(spark, d, "orders")
    gap = F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date"))
    return (l.join(o, l.l_orderkey == o.o_orderkey).withColumn("gap", gap).where("gap >= 0")
            .groupBy("o_orderpriority").agg(  # exact: it keeps a count per distinct day, of which there are few
                F.expr("percentile_disc(0.5) within group (order by gap)").cast("int").alias("median_delay")))


@register("e18_having", sql="""
select l_partkey, cast(sum(l_quantity) as double) as total_qty from lineitem group by 1
having sum(l_quantity) > 900""")
def e18(spark, d):
    return (t(spark, d, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("total_qty"))
            .where(F.col("total_qty") > 900))


@register("e19_safe_ratio_of_sums", sql="""
select l_suppkey,
  cast(round(cast(sum(case when l_returnflag = 'R' then l_quantity else 0 end)
             / nullif(sum(case when l_shipdate >= timestamp '2001-01-01' then l_quantity else 0 end), 0)
             as decimal(38,10)), 4) as double) as return_ratio
from lineitem group by 1""")
def e19(spark, d):
    q = F.col("l_quantity")
    num = F.sum(F.when(F.col("l_returnflag") == "R", q).otherwise(0))
    den = F.sum(F.when(F.col("l_shipdate") >= F.lit("2001-01-01").cast("timestamp_ntz"), q).otherwise(0))
    return t(spark, d, "lineitem").groupBy("l_suppkey").agg(round_half_up(safe_div(num, den), 4).alias("return_ratio"))


@register("e20_two_level_aggregate", sql="""
with per_order as (select l_orderkey, sum(cast(l_extendedprice as decimal(18,2))) as order_value
                   from lineitem group by 1)
select o.o_custkey, count(*) as n_orders, sum(p.order_value) as total_value, max(p.order_value) as max_order
from per_order p join orders o on p.l_orderkey = o.o_orderkey group by 1""")
def e20(spark, d):
    l, o = t(spark, d, "lineitem"), t(spark, d, "orders")
    per_order = l.groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice").cast(DEC)).alias("order_value"))
    return (per_order.join(o, per_order.l_orderkey == o.o_orderkey).groupBy("o_custkey")
            .agg(F.count(F.lit(1)).alias("n_orders"), F.sum("order_value").alias("total_value"),
                 F.max("order_value").alias("max_order")))


@register("e21_surrogate_key", sql="""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
  md5(concat_ws('-', coalesce(cast(l_orderkey as varchar), '_dbt_utils_surrogate_key_null_'),
                     coalesce(cast(l_linenumber as varchar), '_dbt_utils_surrogate_key_null_'),
                     coalesce(nullif(l_returnflag, 'N'), '_dbt_utils_surrogate_key_null_'))) as line_sk
from lineitem""")
def e21(spark, d):
    l = t(spark, d, "lineitem")
    return l.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
                    surrogate_key("l_orderkey", "l_linenumber", F.nullif("l_returnflag", F.lit("N"))).alias("line_sk"))
