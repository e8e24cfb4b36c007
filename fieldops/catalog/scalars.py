"""S — scalar functions whose reference semantics need care (NULLs, ties, units, zones)."""
from __future__ import annotations

from pyspark.sql import functions as F

from fieldops.catalog import REGISTRY, register
from fieldops.catalog.fixtures import t
from fieldops.functions.scalar import join_non_null, month_diff, regex_first, strict_greatest, strict_least


@register("s01_upper_lower_trim", sql="""
select c_custkey, upper(c_mktsegment) as seg_upper, lower(c_mktsegment) as seg_lower,
       trim('  ' || c_mktsegment || ' ') as seg_trim from customer""")
def s01(spark, d):
    c = t(spark, d, "customer")
    return c.select("c_custkey", F.upper("c_mktsegment").alias("seg_upper"), F.lower("c_mktsegment").alias("seg_lower"),
                    F.trim(F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" "))).alias("seg_trim"))


@register("s02_initcap", sql="""
select p_partkey, array_to_string(list_transform(string_split(p_name, ' '),
                    lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') as name_title from part""")
def s02(spark, d):
    return t(spark, d, "part").select("p_partkey", F.initcap("p_name").alias("name_title"))


@register("s03_concat_null_propagating", sql="""
select c_custkey, c_name || '-' || nullif(c_mktsegment, 'BUILDING') as label from customer""")
def s03(spark, d):
    c = t(spark, d, "customer")
    return c.select("c_custkey", F.concat("c_name", F.lit("-"), F.nullif("c_mktsegment", F.lit("BUILDING"))).alias("label"))


@register("s04_replace_regexp_replace", sql="""
select c_custkey, regexp_replace(c_name, 'Customer#0*([0-9]+)', 'C-\\1') as short_name,
       replace(c_mktsegment, 'O', '0') as seg_zero from customer""")
def s04(spark, d):
    c = t(spark, d, "customer")
    return c.select("c_custkey", F.regexp_replace("c_name", "Customer#0*([0-9]+)", "C-$1").alias("short_name"),
                    F.replace("c_mktsegment", F.lit("O"), F.lit("0")).alias("seg_zero"))


@register("s05_regexp_extract_contains", sql="""
select p_partkey, nullif(regexp_extract(p_brand, 'Brand#([0-9]+)', 1), '') as brand_no,
       nullif(regexp_extract(p_name, 'z+', 0), '') as zs, regexp_matches(p_name, 'o[a-z]d') as has_old
from part""")
def s05(spark, d):
    p = t(spark, d, "part")
    return p.select("p_partkey", regex_first("p_brand", "Brand#([0-9]+)", 1).alias("brand_no"),
                    regex_first("p_name", "z+", 0).alias("zs"), F.col("p_name").rlike("o[a-z]d").alias("has_old"))


@register("s06_left_substr_lpad_strpos", sql="""
select p_partkey, left(p_name, 3) as name3, substr(p_type, 2, 3) as type_mid,
       lpad(cast(p_size as varchar), 4, '0') as size4, strpos(p_name, ' ') as space_at from part""")
def s06(spark, d):
    p = t(spark, d, "part")
    return p.select("p_partkey", F.left("p_name", F.lit(3)).alias("name3"), F.substring("p_type", 2, 3).alias("type_mid"),
                    F.lpad(F.col("p_size").cast("string"), 4, "0").alias("size4"),
                    F.instr("p_name", " ").cast("bigint").alias("space_at"))


@register("s07_split_safe_offset", sql="""
select p_partkey, string_split(p_name, ' ')[1] as w0, string_split(p_name, ' ')[2] as w1,
       string_split(p_name, ' ')[3] as w2 from part""")
def s07(spark, d):
    p = t(spark, d, "part")
    parts = F.split("p_name", " ")  # the separator is a regex in Spark
    return p.select("p_partkey", F.get(parts, 0).alias("w0"), F.get(parts, 1).alias("w1"), F.get(parts, 2).alias("w2"))


@register("s08_format_string", sql="""
select o_orderkey, printf('%02d.%04d', month(o_orderdate), year(o_orderdate)) as period_label from orders""")
def s08(spark, d):
    o = t(spark, d, "orders")
    return o.select("o_orderkey", F.format_string("%02d.%04d", F.month("o_orderdate"), F.year("o_orderdate"))
                    .alias("period_label"))


@register("s10_round_abs_ceil_floor_sqrt_pow", sql="""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice,
  round(cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(4,2))), 1) as net_1,
  abs(l_quantity - 25) as dist25, cast(ceil(l_quantity / 7) as bigint) as packs,
  cast(floor(l_quantity / 7) as bigint) as full_packs,
  cast(round(cast(sqrt(l_quantity) as decimal(38,10)), 4) as double) as sqrt_q,
  power(l_quantity, 2) as q2 from lineitem""")
def s10(spark, d):
    l = t(spark, d, "lineitem")
    net = F.col("l_extendedprice").cast("decimal(18,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    return l.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
                    F.round(net, 1).alias("net_1"), F.abs(F.col("l_quantity") - 25).alias("dist25"),
                    F.ceil(F.col("l_quantity") / 7).cast("bigint").alias("packs"),
                    F.floor(F.col("l_quantity") / 7).cast("bigint").alias("full_packs"),
                    F.round(F.sqrt("l_quantity").cast("decimal(38,10)"), 4).cast("double").alias("sqrt_q"),
                    F.pow("l_quantity", 2).alias("q2"))


@register("s11_greatest_least_null_aware", sql="""
with x as (select o_orderkey, o_totalprice, case when o_orderkey % 5 = 0 then null else o_totalprice / 2 end as half
           from orders)
select o_orderkey, case when half is null then null else greatest(o_totalprice, half) end as g,
       case when half is null then null else least(o_totalprice, half) end as l,
       greatest(o_totalprice, half) as g_skip_null from x""")
def s11(spark, d):
    o = t(spark, d, "orders")
    x = o.select("o_orderkey", "o_totalprice",
                 F.when(F.col("o_orderkey") % 5 == 0, F.lit(None)).otherwise(F.col("o_totalprice") / 2).alias("half"))
    return x.select("o_orderkey", strict_greatest("o_totalprice", "half").alias("g"),
                    strict_least("o_totalprice", "half").alias("l"),
                    F.greatest("o_totalprice", "half").alias("g_skip_null"))


@register("s13_cast_safe_cast", sql="""
select event_id, try_cast(json_extract_string(props, '$.k') as integer) as k_int,
       try_cast(event_type as integer) as type_int, cast(user_id as varchar) as user_txt from events""")
def s13(spark, d):
    e = t(spark, d, "events")
    return e.select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k_int"),
                    F.col("event_type").try_cast("int").alias("type_int"), F.col("user_id").cast("string").alias("user_txt"))


@register("s14_date_trunc", sql="""
select o_orderkey, cast(date_trunc('month', o_orderdate) as date) as m, cast(date_trunc('week', o_orderdate) as date) as w,
       cast(date_trunc('year', o_orderdate) as date) as y from orders""")
def s14(spark, d):
    od = F.col("o_orderdate").cast("date")
    return t(spark, d, "orders").select("o_orderkey", F.trunc(od, "MM").alias("m"), F.trunc(od, "week").alias("w"),
                                        F.trunc(od, "YEAR").alias("y"))


@register("s15_date_diff_day_month", sql="""
select l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_shipdate, l.l_extendedprice,
  date_diff('day', cast(o.o_orderdate as date), cast(l.l_shipdate as date)) as days,
  (year(l.l_shipdate) - year(o.o_orderdate)) * 12 + month(l.l_shipdate) - month(o.o_orderdate) as months
from lineitem l join orders o on l.l_orderkey = o.o_orderkey""")
def s15(spark, d):
    l, o = t(spark, d, "lineitem"), t(spark, d, "orders")
    j = l.join(o, l.l_orderkey == o.o_orderkey)
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
                    F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date")).alias("days"),
                    month_diff("l_shipdate", "o_orderdate").alias("months"))


@register("s16_timestamp_diff_units", sql="""
with x as (select event_id, ts, lead(ts) over (partition by user_id order by ts, event_id) as nxt from events)
select event_id, date_sub('minute', ts, nxt) as mins, date_sub('second', ts, nxt) as secs,
       date_sub('day', ts, nxt) as days from x""")
def s16(spark, d):
    from fieldops.operators.windows import bucketed_lag
    e = t(spark, d, "events")
    x = bucketed_lag(e, ["user_id"], ["ts", "event_id"], ["ts"], F.col("ts").cast("date"), offset_direction="lead",
                     prefix="next_").select("event_id", "ts", F.col("next_ts").alias("nxt"))
    return x.select("event_id", F.timestamp_diff("MINUTE", "ts", "nxt").alias("mins"),
                    F.timestamp_diff("SECOND", "ts", "nxt").alias("secs"),
                    F.timestamp_diff("DAY", "ts", "nxt").alias("days"))


@register("s17_date_add_sub_months", sql="""
select o_orderkey, cast(o_orderdate as date) + interval 10 day as plus10,
       cast(cast(o_orderdate as date) - interval 3 day as date) as minus3,
       cast(cast(date_trunc('month', o_orderdate) as date) + interval 1 month - interval 1 day + interval 1 month as date)
         as eom_plus_month,
       o_orderdate + interval 90 minute as plus90min from orders""")
def s17(spark, d):
    od = F.col("o_orderdate")
    eom = F.last_day(od.cast("date"))
    return t(spark, d, "orders").select(
        "o_orderkey", F.date_add(od.cast("date"), 10).cast("timestamp_ntz").alias("plus10"),
        F.date_sub(od.cast("date"), 3).alias("minus3"), F.add_months(eom, 1).alias("eom_plus_month"),
        (od + F.expr("interval 90 minutes")).alias("plus90min"))


@register("s18_extract_parts", sql="""
select event_id, year(ts) as y, month(ts) as m, day(ts) as dd, dayofweek(ts) + 1 as dow,
       week(ts) as isoweek, isoyear(ts) as isoyear, strftime(ts, '%H:%M:%S') as time_of_day from events""")
def s18(spark, d):
    ts = F.col("ts")
    return t(spark, d, "events").select(
        "event_id", F.year(ts).alias("y"), F.month(ts).alias("m"), F.dayofmonth(ts).alias("dd"),
        F.dayofweek(ts).alias("dow"), F.weekofyear(ts).alias("isoweek"),
        F.extract(F.lit("YEAROFWEEK"), ts).alias("isoyear"), F.date_format(ts, "HH:mm:ss").alias("time_of_day"))


@register("s19_zoned_date_and_timestamp", sql="""
select event_id, cast(timezone('Europe/Paris', cast(ts as timestamptz)) as date) as local_day,
       timezone('UTC', timezone('Europe/Paris', cast(cast(timezone('Europe/Paris', cast(ts as timestamptz)) as date)
         as timestamp) + interval 9 hour)) as local_open_utc from events""")
def s19(spark, d):
    tz = "Europe/Paris"
    ts = F.col("ts").cast("timestamp")
    day = F.to_date(F.from_utc_timestamp(ts, tz))
    open_local = F.make_timestamp_ntz(F.year(day), F.month(day), F.dayofmonth(day), F.lit(9), F.lit(0), F.lit(0))
    return t(spark, d, "events").select("event_id", day.alias("local_day"),
                                        F.to_utc_timestamp(open_local, tz).cast("timestamp_ntz").alias("local_open_utc"))


@register("s20_format_timestamp", sql="""
select event_id, strftime(ts, '%H:%M:%S') as hms, strftime(ts, '%Y-%m-%d') as ymd from events""")
def s20(spark, d):
    return t(spark, d, "events").select("event_id", F.date_format("ts", "HH:mm:ss").alias("hms"),
                                        F.date_format("ts", "yyyy-MM-dd").alias("ymd"))


@register("s21_parse_date_timestamp", sql="""
with x as (select event_id, strftime(ts, '%d/%m/%Y %H:%M') as txt,
                  case when event_id % 9 = 0 then 'garbage' else strftime(ts, '%Y%m%d') end as dtxt from events)
select event_id, try_strptime(txt, '%d/%m/%Y %H:%M') as parsed_ts, cast(try_strptime(dtxt, '%Y%m%d') as date) as parsed_day
from x""")
def s21(spark, d):
    e = t(spark, d, "events")
    x = e.select("event_id", F.date_format("ts", "dd/MM/yyyy HH:mm").alias("txt"),
                 F.when(F.col("event_id") % 9 == 0, "garbage").otherwise(F.date_format("ts", "yyyyMMdd")).alias("dtxt"))
    return x.select("event_id", F.try_to_timestamp("txt", F.lit("dd/MM/yyyy HH:mm")).cast("timestamp_ntz").alias("parsed_ts"),
                    F.try_to_date("dtxt", "yyyyMMdd").alias("parsed_day"))


@register("s23_unix_date", sql="""
select o_orderkey, date_diff('day', date '1970-01-01', cast(o_orderdate as date)) as unix_day from orders""")
def s23(spark, d):
    return t(spark, d, "orders").select("o_orderkey", F.unix_date(F.col("o_orderdate").cast("date")).alias("unix_day"))


@register("s25_json_functions", sql="""
with x as (select event_id, props, '[' || json_extract_string(props, '$.k') || ', 1, 2]' as arr_txt from events)
select event_id, json_extract_string(props, '$.k') as k_scalar, json_extract(props, '$') as k_object,
       cast(json_extract_string(arr_txt, '$[0]') as bigint) as first_elem, json_array_length(arr_txt) as n_elems from x""")
def s25(spark, d):
    e = t(spark, d, "events")
    x = e.select("event_id", "props", F.concat(F.lit("["), F.get_json_object("props", "$.k"), F.lit(", 1, 2]")).alias("arr_txt"))
    return x.select("event_id", F.get_json_object("props", "$.k").alias("k_scalar"),
                    F.to_json(F.from_json("props", "map<string,int>")).alias("k_object"),
                    F.get_json_object("arr_txt", "$[0]").cast("bigint").alias("first_elem"),
                    F.json_array_length("arr_txt").cast("bigint").alias("n_elems"))


@register("s26_join_non_null", sql="""
select p_partkey, concat_ws('-', case when p_size > 40 then 'BIG' end, case when p_type = 'SMALL' then 'SMALL' end,
                             case when p_name like '%red%' then 'RED' end) as flags from part""")
def s26(spark, d):
    p = t(spark, d, "part")
    return p.select("p_partkey", join_non_null("-", F.when(F.col("p_size") > 40, "BIG"),
                                               F.when(F.col("p_type") == "SMALL", "SMALL"),
                                               F.when(F.col("p_name").like("%red%"), "RED")).alias("flags"))


@register("s27_timestamp_minus_timestamp", sql="""
select l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_shipdate, l.l_extendedprice,
       date_diff('second', o.o_orderdate, l.l_shipdate) as lead_seconds
from lineitem l join orders o on l.l_orderkey = o.o_orderkey""")
def s27(spark, d):
    l, o = t(spark, d, "lineitem"), t(spark, d, "orders")
    j = l.join(o, l.l_orderkey == o.o_orderkey)
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
                    F.timestamp_diff("SECOND", F.col("o_orderdate"), F.col("l_shipdate")).alias("lead_seconds"))


@register("s28_month_label_to_date", sql="""
with x as (select distinct strftime(o_orderdate, '%Y-%m') as periode from orders)
select periode, cast(periode || '-01' as date) as periode_date from x""")
def s28(spark, d):
    x = t(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("periode")).distinct()
    return x.select("periode", F.to_date(F.concat("periode", F.lit("-01"))).alias("periode_date"))
