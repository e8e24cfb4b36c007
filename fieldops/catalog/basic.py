"""B (projection/filter/predicates), G (sort/top-k/latest partition), H (unions) on the driver tables."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from fieldops.catalog import register
from fieldops.catalog.fixtures import AS_OF_LO, t
from fieldops.functions.scalar import first_matching_token, lit_date


@register("b01_projection_rename", sql="""
select o_orderkey as order_id, o_custkey as customer_id, o_orderstatus as status,
       cast(o_orderdate as date) as ordered_on from orders""")
def b01(spark, d):
    o = t(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                    F.col("o_orderstatus").alias("status"),
                    F.col("o_orderdate").cast("date").alias("ordered_on"))


@register("b02_select_except", sql="select * exclude (l_tax, l_discount, l_comment_free) from "
          "(select *, 1 as l_comment_free from lineitem)")
def b02(spark, d):
    l = t(spark, d, "lineitem").withColumn("l_comment_free", F.lit(1))
    return l.drop("l_tax", "l_discount", "l_comment_free")


@register("b03_searched_case", sql="""
select case when l_quantity >= 40 then 'bulk' when l_quantity >= 20 then 'medium'
            when l_quantity > 0 then 'small' else 'none' end as size_class,
       count(*) as n_lines
from lineitem group by 1""")
def b03(spark, d):
    q = F.col("l_quantity")
    cls = (F.when(q >= 40, "bulk").when(q >= 20, "medium").when(q > 0, "small").otherwise("none"))
    return t(spark, d, "lineitem").groupBy(cls.alias("size_class")).agg(F.count(F.lit(1)).alias("n_lines"))


@register("b04_simple_case", sql="""
select o_orderkey, case o_orderstatus when 'F' then 'FAIT' when 'O' then 'ENCOURS'
                        when 'P' then 'PARTIEL' else 'AUTRE' end as status_label
from orders""")
def b04(spark, d):
    # value translation as a literal map: one expression, no join
    m = F.create_map(*[F.lit(x) for x in ("F", "FAIT", "O", "ENCOURS", "P", "PARTIEL")])
    return t(spark, d, "orders").select(
        "o_orderkey", F.coalesce(F.element_at(m, F.col("o_orderstatus")), F.lit("AUTRE")).alias("status_label"))


@register("b05_coalesce_nullif_if", sql="""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
       coalesce(nullif(l_discount, 0), -1) as discount_or_flag,
       case when l_tax = 0 then 'no_tax' else 'taxed' end as tax_state,
       ifnull(nullif(l_returnflag, 'N'), 'none') as return_state
from lineitem""")
def b05(spark, d):
    l = t(spark, d, "lineitem")
    return l.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
                    F.coalesce(F.nullif("l_discount", F.lit(0.0)), F.lit(-1.0)).alias("discount_or_flag"),
                    F.when(F.col("l_tax") == 0, "no_tax").otherwise("taxed").alias("tax_state"),
                    F.ifnull(F.nullif("l_returnflag", F.lit("N")), F.lit("none")).alias("return_state"))


@register("b06_conjunctive_filter", sql="""
select l_returnflag, count(*) as n_lines, cast(sum(l_quantity) as double) as qty
from lineitem
where l_shipdate between timestamp '1996-01-01' and timestamp '1996-12-31'
  and l_returnflag in ('R', 'A') and l_linestatus not in ('O') and (l_quantity > 10 or l_discount = 0)
group by 1""")
def b06(spark, d):
    l = t(spark, d, "lineitem")
    f = (F.col("l_shipdate").between(F.lit("1996-01-01").cast("timestamp_ntz"),
                                     F.lit("1996-12-31").cast("timestamp_ntz"))
         & F.col("l_returnflag").isin("R", "A") & ~F.col("l_linestatus").isin("O")
         & ((F.col("l_quantity") > 10) | (F.col("l_discount") == 0)))
    return (l.where(f).groupBy("l_returnflag")
            .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").cast("double").alias("qty")))


@register("b07_like", sql="""
select p_partkey, p_name from part
where (p_name like '%bolt%' or p_name like 'r_d %') and p_type not like 'PRO%'""")
def b07(spark, d):
    p = t(spark, d, "part")
    return p.where((F.col("p_name").like("%bolt%") | F.col("p_name").like("r_d %"))
                   & ~F.col("p_type").like("PRO%")).select("p_partkey", "p_name")


@register("b08_regex_predicate", sql="""
select p_partkey, p_brand from part where regexp_matches(p_brand, '^Brand#1[0-9]$')""")
def b08(spark, d):
    return t(spark, d, "part").where(F.col("p_brand").rlike("^Brand#1[0-9]$")).select("p_partkey", "p_brand")


@register("b09_starts_with", sql="""
select p_type, count(*) as n_parts from part where starts_with(p_type, 'S') group by 1""")
def b09(spark, d):
    return (t(spark, d, "part").where(F.startswith("p_type", F.lit("S")))
            .groupBy("p_type").agg(F.count(F.lit(1)).alias("n_parts")))


@register("b10_is_distinct_from", sql="""
with tot as (select l_orderkey, sum(cast(l_extendedprice as decimal(18,2))) as lines_total
             from lineitem group by 1)
select o.o_orderkey, cast(o.o_totalprice as decimal(18,2)) as header_total, t.lines_total
from orders o left join tot t on o.o_orderkey = t.l_orderkey
where cast(o.o_totalprice as decimal(18,2)) is distinct from t.lines_total""")
def b10(spark, d):
    o, l = t(spark, d, "orders"), t(spark, d, "lineitem")
    tot = l.groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("lines_total"))
    j = o.join(tot, o.o_orderkey == tot.l_orderkey, "left")
    hdr = F.col("o_totalprice").cast("decimal(18,2)")
    return j.where(~hdr.eqNullSafe(F.col("lines_total"))).select(
        "o_orderkey", hdr.alias("header_total"), "lines_total")


@register("b11_tristate_flag", sql="""
select event_id, coalesce(try_cast(json_extract_string(props, '$.k') as integer) > 50, false) as is_high,
       coalesce(try_cast(json_extract_string(props, '$.missing') as integer) > 50, false) as is_missing_high
from events""")
def b11(spark, d):
    e = t(spark, d, "events")
    k = F.get_json_object("props", "$.k").try_cast("int")
    miss = F.get_json_object("props", "$.missing").try_cast("int")
    return e.select("event_id", F.coalesce(k > 50, F.lit(False)).alias("is_high"),
                    F.coalesce(miss > 50, F.lit(False)).alias("is_missing_high"))


@register("b12_boolean_expression", sql="""
select user_id, count(*) filter (where event_type = 'purchase' and value > 10) as n_big_purchases,
       bool_or(event_type = 'error' and value > 15) as had_big_error
from events group by 1""")
def b12(spark, d):
    e = t(spark, d, "events")
    big = (F.col("event_type") == "purchase") & (F.col("value") > 10)
    err = (F.col("event_type") == "error") & (F.col("value") > 15)
    return e.groupBy("user_id").agg(F.count_if(big).alias("n_big_purchases"),
                                    F.bool_or(err).alias("had_big_error"))


@register("b13_select_distinct", sql="select distinct l_returnflag, l_linestatus from lineitem")
def b13(spark, d):
    return t(spark, d, "lineitem").select("l_returnflag", "l_linestatus").distinct()


@register("b14_first_acceptable_token", sql="""
select doc_id,
  list_filter(regexp_extract_all(text, '[0-9]+'), lambda x: length(x) = 5 and left(x, 1) <> '0')[1]
    as first_code
from documents""")
def b14(spark, d):
    doc = t(spark, d, "documents")
    tok = first_matching_token("text", "[0-9]+",
                               lambda x: (F.length(x) == 5) & (F.left(x, F.lit(1)) != "0"))
    return doc.select("doc_id", tok.alias("first_code"))


@register("b15_soft_delete_filter", sql="""
select o_orderstatus, count(*) as n_orders from orders where o_orderstatus <> 'P' group by 1""")
def b15(spark, d):
    return (t(spark, d, "orders").where(F.col("o_orderstatus") != "P")
            .groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders")))


@register("b16_exclusion_list", sql="""
select c_custkey, c_name from customer
where c_nationkey not in (select n_nationkey from nation where n_regionkey = 0)""")
def b16(spark, d):
    c, n = t(spark, d, "customer"), t(spark, d, "nation")
    excluded = n.where(F.col("n_regionkey") == 0).select(F.col("n_nationkey").alias("c_nationkey"))
    # exclusion list held as a (checked) broadcast lookup, not a giant literal NOT IN
    return c.join(excluded, "c_nationkey", "left_anti").select("c_custkey", "c_name")


@register("b17_as_of_predicate", sql="""
select o_orderpriority, count(*) as n_orders from orders
where cast(o_orderdate as date) >= date '2001-06-01' - interval 90 day
  and cast(o_orderdate as date) < date '2001-06-01'
group by 1""")
def b17(spark, d, as_of: dt.date = AS_OF_LO):
    o = t(spark, d, "orders")
    day = F.col("o_orderdate").cast("date")
    return (o.where((day >= F.date_sub(lit_date(as_of), 90)) & (day < lit_date(as_of)))
            .groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_orders")))


@register("b18_prefix_classification", sql="""
select case when p_brand like 'Brand#1%' then 'B1X' when p_brand like 'Brand#2%' then 'B2X'
            else 'OTHER' end as brand_family, count(*) as n_parts
from part group by 1""")
def b18(spark, d):
    b = F.col("p_brand")
    fam = F.when(b.like("Brand#1%"), "B1X").when(b.like("Brand#2%"), "B2X").otherwise("OTHER")
    return t(spark, d, "part").groupBy(fam.alias("brand_family")).agg(F.count(F.lit(1)).alias("n_parts"))


@register("b19_priority_default", sql="""
select p_partkey,
  coalesce(case when p_size > 45 then 'XL' end, case when p_type = 'LARGE' then 'L' end,
           case when p_name like 'small%' then 'S' end, 'STD') as size_label
from part""")
def b19(spark, d):
    p = t(spark, d, "part")
    lab = F.coalesce(F.when(F.col("p_size") > 45, "XL"), F.when(F.col("p_type") == "LARGE", "L"),
                     F.when(F.col("p_name").like("small%"), "S"), F.lit("STD"))
    return p.select("p_partkey", lab.alias("size_label"))


# ------------------------------------------------------------------ G / H
@register("g01_order_by", sql="""
select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey""")
def g01(spark, d):
    return (t(spark, d, "orders").select("o_orderkey", "o_totalprice")
            .orderBy(F.col("o_totalprice").desc(), "o_orderkey"))


@register("g04_latest_partition_filter", sql="""
select l_orderkey, l_linenumber, l_partkey, l_quantity from lineitem
where l_shipdate = (select max(l_shipdate) from lineitem)""")
def g04(spark, d):
    l = t(spark, d, "lineitem")
    latest = l.agg(F.max("l_shipdate").alias("_latest"))  # one row: broadcast scalar
    return (l.crossJoin(F.broadcast(latest)).where(F.col("l_shipdate") == F.col("_latest"))
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"))


@register("h01_union_all", sql="""
select 'C' as src, c_custkey as id, c_name as name, c_nationkey as nationkey from customer
union all
select 'S' as src, s_suppkey as id, s_name as name, s_nationkey as nationkey from supplier""")
def h01(spark, d):
    c = t(spark, d, "customer").select(F.lit("C").alias("src"), F.col("c_custkey").alias("id"),
                                       F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"))
    s = t(spark, d, "supplier").select(F.lit("S").alias("src"), F.col("s_suppkey").alias("id"),
                                       F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"))
    return c.unionByName(s)


@register("h02_union_typed_null_padding", sql="""
select event_id, 'purchase' as kind, value as amount, cast(null as varchar) as payload from events
where event_type = 'purchase'
union all
select event_id, 'error' as kind, cast(null as double) as amount, props as payload from events
where event_type = 'error'
union all
select event_id, 'signup' as kind, cast(null as double) as amount, cast(null as varchar) as payload
from events where event_type = 'signup'""")
def h02(spark, d):
    e = t(spark, d, "events")
    a = e.where("event_type = 'purchase'").select("event_id", F.lit("purchase").alias("kind"),
                                                  F.col("value").alias("amount"))
    b = e.where("event_type = 'error'").select("event_id", F.lit("error").alias("kind"),
                                               F.col("props").alias("payload"))
    c = e.where("event_type = 'signup'").select("event_id", F.lit("signup").alias("kind"))
    return a.unionByName(b, allowMissingColumns=True).unionByName(c, allowMissingColumns=True)


@register("h03_union_classified_flows_pivot", sql="""
with flows as (
  select cast(date_trunc('year', l_shipdate) as date) as yr, 'out' as flow, l_quantity as qty
  from lineitem where l_returnflag = 'N'
  union all
  select cast(date_trunc('year', l_shipdate) as date), 'back', -l_quantity from lineitem
  where l_returnflag = 'R'
  union all
  select cast(date_trunc('year', o_orderdate) as date), 'orders', 1 from orders where o_orderstatus = 'F')
select yr, sum(case when flow = 'out' then qty else 0 end) as qty_out,
       sum(case when flow = 'back' then qty else 0 end) as qty_back,
       sum(case when flow = 'orders' then qty else 0 end) as n_done_orders
from flows group by 1""")
def h03(spark, d):
    l, o = t(spark, d, "lineitem"), t(spark, d, "orders")
    yr = lambda c: F.trunc(F.col(c).cast("date"), "YEAR").alias("yr")
    flows = (l.where("l_returnflag = 'N'").select(yr("l_shipdate"), F.lit("out").alias("flow"),
                                                  F.col("l_quantity").alias("qty"))
             .unionByName(l.where("l_returnflag = 'R'").select(yr("l_shipdate"), F.lit("back").alias("flow"),
                                                               (-F.col("l_quantity")).alias("qty")))
             .unionByName(o.where("o_orderstatus = 'F'").select(yr("o_orderdate"), F.lit("orders").alias("flow"),
                                                                F.lit(1.0).alias("qty"))))
    s = lambda k, n: F.sum(F.when(F.col("flow") == k, F.col("qty")).otherwise(0)).alias(n)
    return flows.groupBy("yr").agg(s("out", "qty_out"), s("back", "qty_back"), s("orders", "n_done_orders"))


@register("h04_literal_relation", sql="""
with sc as (select * from (values ('REEL', 1.0), ('BUDGET', 1.1)) v(scenario, factor))
select sc.scenario, year(o_orderdate) as yr,
       cast(sum(cast(o_totalprice as decimal(18,2))) * cast(sc.factor as decimal(4,2)) as decimal(38,2)) as amount
from orders cross join sc group by 1, 2, sc.factor""")
def h04(spark, d):
    sc = spark.createDataFrame([("REEL", 1.0), ("BUDGET", 1.1)], "scenario string, factor double")
    o = t(spark, d, "orders")
    agg = o.groupBy(F.year("o_orderdate").alias("yr")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("_tot"))
    # aggregate first, then the 2-row scenario cross join (cheaper than crossing every order)
    return agg.crossJoin(F.broadcast(sc)).select(
        "scenario", "yr", (F.col("_tot") * F.col("factor").cast("decimal(4,2)")).cast("decimal(38,2)").alias("amount"))
