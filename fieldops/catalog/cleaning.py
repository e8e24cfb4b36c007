"""C — staging clean-up on text-ified versions of the driver tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from fieldops.catalog import register
from fieldops.catalog.fixtures import t
from fieldops.functions import clean
from fieldops.operators.aggs import keep_latest
from fieldops.sources import latest_snapshot

LKEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
LKEY_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice"


@register("c01_safe_cast", sql="""
with x as (select l_orderkey, l_partkey, l_suppkey, l_shipdate, l_extendedprice,
             case when l_linenumber % 7 = 0 then 'n/a' else cast(l_linenumber as varchar) end as ln_txt,
             cast(cast(l_quantity as bigint) as varchar) as qty_txt from lineitem)
select l_orderkey, l_partkey, l_suppkey, l_shipdate, l_extendedprice, ln_txt,
       try_cast(ln_txt as integer) as l_linenumber, cast(qty_txt as bigint) as l_quantity from x""")
def c01(spark, d):
    l = t(spark, d, "lineitem")
    x = l.select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
                 F.when(F.col("l_linenumber") % 7 == 0, "n/a").otherwise(F.col("l_linenumber").cast("string")).alias("ln_txt"),
                 F.col("l_quantity").cast("long").cast("string").alias("qty_txt"))
    x = x.withColumn("l_linenumber", F.col("ln_txt")).withColumn("l_quantity", F.col("qty_txt")).drop("qty_txt")
    x = clean.cast_columns(x, {"l_linenumber": "int"}, safe=True)
    return clean.cast_columns(x, {"l_quantity": "bigint"}, safe=False)  # strict: raises on bad text


SQL_C02_TXT = """case json_extract_string(props, '$.k')::integer % 10 when 0 then 'nan' when 1 then ' # '
  when 2 then '' when 3 then 'NaT' else ' ' || json_extract_string(props, '$.k') || ' ' end"""


@register("c02_sentinel_to_null", sql=f"""
with x as (select event_id, {SQL_C02_TXT} as raw from events)
select event_id, raw, case when lower(trim(raw)) in ('nan', 'nat', '#', '') then null else trim(raw) end as cleaned
from x""")
def c02(spark, d):
    e = t(spark, d, "events")
    k = F.get_json_object("props", "$.k")
    m = k.cast("int") % 10
    raw = (F.when(m == 0, "nan").when(m == 1, " # ").when(m == 2, "").when(m == 3, "NaT")
           .otherwise(F.concat(F.lit(" "), k, F.lit(" "))))
    return e.select("event_id", raw.alias("raw")).withColumn("cleaned", clean.null_if_sentinel("raw"))


@register("c03_placeholder_date", sql="""
with x as (select o_orderkey, case when o_orderkey % 50 = 0 then date '1753-01-01'
                                   else cast(o_orderdate as date) end as d from orders)
select o_orderkey, case when d = date '1753-01-01' then null else d end as order_day from x""")
def c03(spark, d):
    o = t(spark, d, "orders")
    x = o.select("o_orderkey", F.when(F.col("o_orderkey") % 50 == 0, F.lit("1753-01-01").cast("date"))
                 .otherwise(F.col("o_orderdate").cast("date")).alias("d"))
    return x.select("o_orderkey", clean.null_dates("d", "1753-01-01").alias("order_day"))


@register("c04_multi_format_timestamp", sql="""
with x as (select o_orderkey, case o_orderkey % 3
    when 0 then strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
    when 1 then strftime(o_orderdate, '%d/%m/%Y %H:%M')
    else strftime(o_orderdate, '%d/%m/') || '00' || lpad(cast(year(o_orderdate) % 100 as varchar), 2, '0') end as txt
  from orders),
p as (select o_orderkey, txt, coalesce(try_strptime(txt, '%Y-%m-%d %H:%M:%S'), try_strptime(txt, '%d/%m/%Y %H:%M'),
                                        try_strptime(txt, '%d/%m/%Y')) as ts from x)
select o_orderkey, txt, case when year(ts) < 100 then ts + interval 2000 year else ts end as parsed_ts from p""")
def c04(spark, d):
    o = t(spark, d, "orders")
    od = F.col("o_orderdate")
    m = F.col("o_orderkey") % 3
    txt = (F.when(m == 0, F.date_format(od, "yyyy-MM-dd HH:mm:ss"))
           .when(m == 1, F.date_format(od, "dd/MM/yyyy HH:mm"))
           .otherwise(F.concat(F.date_format(od, "dd/MM/"), F.lit("00"),
                               F.lpad((F.year(od) % 100).cast("string"), 2, "0"))))
    x = o.select("o_orderkey", txt.alias("txt"))
    return x.select("o_orderkey", "txt", clean.parse_ts("txt").alias("parsed_ts"))


@register("c05_code_repair", sql="""
with x as (select c_custkey, cast(cast(c_nationkey * 1000 + c_custkey % 1000 as double) as varchar) as raw from customer),
y as (select c_custkey, raw, nullif(regexp_replace(trim(raw), '\\.0$', ''), '') as v from x)
select c_custkey, raw, case when length(v) >= 5 then v else lpad(v, 5, '0') end as code from y""")
def c05(spark, d):
    c = t(spark, d, "customer")
    x = c.select("c_custkey", (F.col("c_nationkey") * 1000 + F.col("c_custkey") % 1000).cast("double")
                 .cast("string").alias("raw"))
    return x.select("c_custkey", "raw", clean.clean_code("raw", 5).alias("code"))


@register("c06_decimal_comma", sql="""
with x as (select p_partkey, replace(cast(p_retailprice as varchar), '.', ',') as raw from part)
select p_partkey, raw, try_cast(replace(trim(raw), ',', '.') as double) as price from x""")
def c06(spark, d):
    p = t(spark, d, "part")
    x = p.select("p_partkey", F.replace(F.col("p_retailprice").cast("string"), F.lit("."), F.lit(",")).alias("raw"))
    return x.select("p_partkey", "raw", clean.parse_decimal("raw").alias("price"))


@register("c07_eav_json_to_columns", sql="""
with x as (select event_id, '[{"name":"k","value":"' || json_extract_string(props, '$.k') || '"},'
                  || '{"name":"type","value":"' || event_type || '"},{"name":"k","value":"dup"}]' as custom from events),
y as (select event_id, from_json(custom, '[{"name":"VARCHAR","value":"VARCHAR"}]') as arr from x)
select event_id, list_filter(arr, lambda e: e.name = 'k')[1].value as k_value,
       list_filter(arr, lambda e: e.name = 'type')[1].value as type_value,
       list_filter(arr, lambda e: e.name = 'missing')[1].value as missing_value
from y""")
def c07(spark, d):
    e = t(spark, d, "events")
    custom = F.concat(F.lit('[{"name":"k","value":"'), F.get_json_object("props", "$.k"),
                      F.lit('"},{"name":"type","value":"'), F.col("event_type"),
                      F.lit('"},{"name":"k","value":"dup"}]'))
    x = e.select("event_id", custom.alias("custom"))
    return clean.eav_json_to_columns(x, "custom", {"k": "k_value", "type": "type_value",
                                                   "missing": "missing_value"}).drop("custom")


@register("c08_json_lines_explode", sql="""
select l_orderkey, l_linenumber, l_partkey, cast(l_quantity as bigint) as qty from lineitem""")
def c08(spark, d):
    l = t(spark, d, "lineitem")
    # header with its lines as a JSON array (as an API returns it), then exploded back
    hdr = l.groupBy("l_orderkey").agg(F.to_json(F.collect_list(F.struct(
        F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("item"),
        F.col("l_quantity").cast("long").alias("qty")))).alias("lines"))
    schema = "array<struct<line:int,item:bigint,qty:bigint>>"
    x = clean.explode_json_lines(hdr, "lines", schema)
    return x.select("l_orderkey", F.col("line.line").alias("l_linenumber"),
                    F.col("line.item").alias("l_partkey"), F.col("line.qty").alias("qty"))


@register("c09_json_path_scalar", sql="""
select event_id, json_extract_string(props, '$.k') as k_text, json_extract_string(props, '$.nope') as nope
from events""")
def c09(spark, d):
    e = t(spark, d, "events")
    return e.select("event_id", clean.json_value("props", "$.k").alias("k_text"),
                    clean.json_value("props", "$.nope").alias("nope"))


@register("c10_xml_field_decode", sql="""
select page_id,
  replace(replace(replace(replace(replace(nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), ''),
    '&apos;', ''''), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') as title
from pages""")
def c10(spark, d):
    return t(spark, d, "pages").select("page_id", clean.xml_field("html", "title").alias("title"))


@register("c11_leading_int", sql="""
select page_id, url,
  case when upper(trim(url)) = 'AUCUN' then 0
       else try_cast(nullif(regexp_replace(regexp_extract(url, '[\\d\\s]+'), '\\s+', '', 'g'), '') as bigint) end
    as first_number
from pages""")
def c11(spark, d):
    return t(spark, d, "pages").select("page_id", "url", clean.leading_int("url").alias("first_number"))


@register("c12_hm_to_minutes", sql="""
with x as (select event_id, strftime(ts, '%H:%M') || ' hrs' as dur from events)
select event_id, dur,
  try_cast(string_split(replace(dur, ' hrs', ''), ':')[1] as bigint) * 60
  + try_cast(string_split(replace(dur, ' hrs', ''), ':')[2] as bigint) as minutes from x""")
def c12(spark, d):
    e = t(spark, d, "events")
    x = e.select("event_id", F.concat(F.date_format("ts", "HH:mm"), F.lit(" hrs")).alias("dur"))
    return x.select("event_id", "dur", clean.hm_to_minutes("dur").alias("minutes"))


@register("c13_int_to_bool", sql="""
select doc_id, cast(quality as boolean) as quality, cast(toxic as boolean) as toxic from labels""")
def c13(spark, d):
    return clean.int_to_bool(t(spark, d, "labels"), ["quality", "toxic"])


@register("c14_keep_latest", sql=f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity from lineitem
qualify row_number() over (partition by l_orderkey order by l_shipdate desc, l_linenumber desc, l_partkey desc,
  l_suppkey desc, l_extendedprice desc) = 1""")
def c14(spark, d):
    l = t(spark, d, "lineitem").select(*LKEY, "l_quantity")
    return keep_latest(l, ["l_orderkey"], ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey",
                                           "l_extendedprice"])


@register("c15_latest_load_per_period", sql="""
select event_id, user_id, ts from events e
where ts = (select max(ts) from events x where cast(x.ts as date) = cast(e.ts as date))""")
def c15(spark, d):
    e = t(spark, d, "events").select("event_id", "user_id", "ts", F.col("ts").cast("date").alias("period"))
    return latest_snapshot(e, ["period"], "ts").drop("period")


@register("c16_updated_fallback", sql="""
select o_orderkey, coalesce(case when o_orderkey % 4 = 0 then null else o_orderdate + interval 1 day end, o_orderdate)
  as updated_at from orders""")
def c16(spark, d):
    o = t(spark, d, "orders")
    upd = F.when(F.col("o_orderkey") % 4 == 0, F.lit(None)).otherwise(F.col("o_orderdate") + F.expr("interval 1 day"))
    return o.select("o_orderkey", clean.coalesce_updated(upd, "o_orderdate").alias("updated_at"))


@register("c17_orphan_guard_semi", sql="""
select l_returnflag, count(*) as n_lines from lineitem l
where exists (select 1 from orders o where o.o_orderkey = l.l_orderkey and o.o_orderstatus = 'F') group by 1""")
def c17(spark, d):
    l, o = t(spark, d, "lineitem"), t(spark, d, "orders")
    return (clean.semi_filter(l, o.where("o_orderstatus = 'F'"), "l_orderkey", "o_orderkey")
            .groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_lines")))


@register("c18_polymorphic_as_text", sql="""
select event_id, 'user' as field, cast(user_id as varchar) as value_text from events
union all select event_id, 'ts', cast(ts as varchar) from events
union all select event_id, 'props', props from events""")
def c18(spark, d):
    e = clean.as_text(t(spark, d, "events"), ["user_id", "ts"])
    parts = [e.select("event_id", F.lit(f).alias("field"), F.col(c).alias("value_text"))
             for f, c in (("user", "user_id"), ("ts", "ts"), ("props", "props"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("c19_key_normalise", sql="""
select c_custkey, upper(trim(regexp_replace(c_name, '^Customer#0*', ''))) as name_key from customer""")
def c19(spark, d):
    return t(spark, d, "customer").select("c_custkey", clean.norm_key("c_name", "^Customer#0*").alias("name_key"))
