"""D — joins over the driver tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from fieldops.catalog import register
from fieldops.catalog.calendar_q import _cal, holidays_sql, _lo_pairs, SQL_LO_PAIRS
from fieldops.catalog.fixtures import t
from fieldops.catalog.supply import _demand
from fieldops.catalog import fixtures as fx
from fieldops.functions import calendar as cal
from fieldops.operators.business_time import business_days
from fieldops.operators.windows import bucketed_lag
from fieldops.operators.joins import (effective_dated_join, explode_months,
                                      fallback_lookup, interval_join, rule_flags, typed_key_join,
                                      wildcard_rule_match)

DEC = "decimal(18,2)"
LKEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
LKEY_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice"


@register("d01_inner_join", sql="""
select o.o_orderstatus, count(*) as n_lines, cast(sum(l.l_quantity) as double) as qty
from orders o join lineitem l on o.o_orderkey = l.l_orderkey group by 1""")
def d01(spark, d):
    o, l = t(spark, d, "orders"), t(spark, d, "lineitem")
    return (o.join(l, o.o_orderkey == l.l_orderkey).groupBy("o_orderstatus")
            .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("qty")))


@register("d02_left_join_dimensions", sql="""
select o.o_orderkey, c.c_name, n.n_name, r.r_name
from orders o left join customer c on o.o_custkey = c.c_custkey
left join nation n on c.c_nationkey = n.n_nationkey left join region r on n.n_regionkey = r.r_regionkey""")
def d02(spark, d):
    o, c, n, r = (t(spark, d, x) for x in ("orders", "customer", "nation", "region"))
    # nation/region are 25/5-row dimensions: broadcast; customer is left to the planner (AQE)
    return (o.join(c, o.o_custkey == c.c_custkey, "left")
            .join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left")
            .join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left")
            .select("o_orderkey", "c_name", "n_name", "r_name"))


@register("d03_full_outer_coalesced_keys", sql="""
with lm as (select cast(date_trunc('month', l_shipdate) as date) as month, cast(sum(l_quantity) as double) as qty_shipped
            from lineitem where l_returnflag = 'R' group by 1),
om as (select cast(date_trunc('month', o_orderdate) as date) as month, count(*) as n_orders
       from orders where o_orderstatus = 'F' and year(o_orderdate) >= 1997 group by 1)
select coalesce(lm.month, om.month) as month, lm.qty_shipped, om.n_orders
from lm full outer join om on lm.month = om.month""")
def d03(spark, d):
    l, o = t(spark, d, "lineitem"), t(spark, d, "orders")
    lm = (l.where("l_returnflag = 'R'").groupBy(F.trunc(F.col("l_shipdate").cast("date"), "MM").alias("month"))
          .agg(F.sum("l_quantity").alias("qty_shipped")))
    om = (o.where((F.col("o_orderstatus") == "F") & (F.year("o_orderdate") >= 1997))
          .groupBy(F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("month"))
          .agg(F.count(F.lit(1)).alias("n_orders")))
    return lm.join(om, "month", "full")  # USING-style join coalesces the key


@register("d04_three_way_full_outer", sql="""
with v as (select user_id, cast(ts as date) as day, count(*) as n_view from events where event_type = 'view' group by 1, 2),
c as (select user_id, cast(ts as date) as day, count(*) as n_click from events where event_type = 'click' group by 1, 2),
p as (select user_id, cast(ts as date) as day, count(*) as n_purchase from events where event_type = 'purchase' group by 1, 2)
select coalesce(v.user_id, c.user_id, p.user_id) as user_id, coalesce(v.day, c.day, p.day) as day,
       v.n_view, c.n_click, p.n_purchase
from v full outer join c on v.user_id = c.user_id and v.day = c.day
full outer join p on coalesce(v.user_id, c.user_id) = p.user_id and coalesce(v.day, c.day) = p.day""")
def d04(spark, d):
    e = t(spark, d, "events").where(F.col("event_type").isin("view", "click", "purchase"))
    # full ∘ full on coalesced keys == one grouped union: a single shuffle instead of two joins
    cnt = lambda k: F.count(F.when(F.col("event_type") == k, 1))
    g = e.groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(
        cnt("view").alias("n_view"), cnt("click").alias("n_click"), cnt("purchase").alias("n_purchase"))
    nz = lambda c: F.when(F.col(c) > 0, F.col(c))  # noqa: E731  (absent side = NULL, as in the joins)
    return g.select("user_id", "day", nz("n_view").alias("n_view"), nz("n_click").alias("n_click"),
                    nz("n_purchase").alias("n_purchase"))


@register("d05_left_anti", sql="""
select o_orderkey, o_orderstatus from orders o
where not exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey)""")
def d05(spark, d):
    o, l = t(spark, d, "orders"), t(spark, d, "lineitem")
    return o.join(l, o.o_orderkey == l.l_orderkey, "left_anti").select("o_orderkey", "o_orderstatus")


@register("d06_left_semi", sql="""
select l_returnflag, count(*) as n_lines from lineitem
where l_partkey in (select p_partkey from part where p_size > 45) group by 1""")
def d06(spark, d):
    l, p = t(spark, d, "lineitem"), t(spark, d, "part")
    big = p.where("p_size > 45")
    return (l.join(big, l.l_partkey == big.p_partkey, "left_semi").groupBy("l_returnflag")
            .agg(F.count(F.lit(1)).alias("n_lines")))


@register("d07_cross_join_tiny", sql="""
with last as (select max(o_orderdate) as last_day from orders)
select o.o_orderstatus, min(date_diff('day', cast(o.o_orderdate as date), cast(last.last_day as date))) as min_age,
       max(date_diff('day', cast(o.o_orderdate as date), cast(last.last_day as date))) as max_age
from orders o cross join last group by 1""")
def d07(spark, d):
    o = t(spark, d, "orders")
    last = o.agg(F.max("o_orderdate").alias("last_day"))  # one row by construction
    age = F.datediff(F.col("last_day").cast("date"), F.col("o_orderdate").cast("date"))
    return (o.crossJoin(F.broadcast(last)).groupBy("o_orderstatus")
            .agg(F.min(age).alias("min_age"), F.max(age).alias("max_age")))


@register("d08_self_join_next_month", sql="""
with m as (select cast(date_trunc('month', o_orderdate) as date) as month,
                  sum(cast(o_totalprice as decimal(18,2))) as revenue from orders group by 1)
select a.month, a.revenue, b.revenue as revenue_next_month
from m a left join m b on b.month = a.month + interval 1 month""")
def d08(spark, d):
    o = t(spark, d, "orders")
    m = o.groupBy(F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("month")).agg(
        F.sum(F.col("o_totalprice").cast(DEC)).alias("revenue"))
    b = m.select(F.col("month").alias("b_month"), F.col("revenue").alias("revenue_next_month"))
    return (m.join(b, b.b_month == F.add_months(m.month, 1), "left")
            .select("month", "revenue", "revenue_next_month"))


def _price_periods(spark, d):
    p = t(spark, d, "part")
    price = F.col("p_retailprice").cast(DEC)
    g1 = p.select("p_partkey", F.lit("1995-01-01").cast("date").alias("valid_from"),
                  F.lit("1997-12-31").cast("date").alias("valid_to"), price.alias("unit_price"), F.lit(1).alias("gen"))
    g2 = p.select("p_partkey", F.lit("1998-01-01").cast("date").alias("valid_from"),
                  F.lit(None).cast("date").alias("valid_to"),
                  F.round(price * F.lit(1.1).cast("decimal(3,1)"), 2).cast(DEC).alias("unit_price"), F.lit(2).alias("gen"))
    g3 = p.where("p_size > 40").select("p_partkey", F.lit("1998-06-01").cast("date").alias("valid_from"),
                                       F.lit("1998-12-31").cast("date").alias("valid_to"),
                                       F.round(price * F.lit(1.2).cast("decimal(3,1)"), 2).cast(DEC).alias("unit_price"),
                                       F.lit(3).alias("gen"))
    return g1.unionByName(g2).unionByName(g3).withColumnRenamed("p_partkey", "l_partkey")


SQL_PERIODS = """
periods as (
  select p_partkey, date '1995-01-01' as valid_from, date '1997-12-31' as valid_to,
         cast(p_retailprice as decimal(18,2)) as unit_price, 1 as gen from part
  union all
  select p_partkey, date '1998-01-01', null, cast(round(cast(p_retailprice as decimal(18,2)) * 1.1, 2) as decimal(18,2)), 2
  from part
  union all
  select p_partkey, date '1998-06-01', date '1998-12-31',
         cast(round(cast(p_retailprice as decimal(18,2)) * 1.2, 2) as decimal(18,2)), 3 from part where p_size > 40)"""


@register("d09_effective_dated_join", sql=f"""
with {SQL_PERIODS}
select {LKEY_SQL}, p.unit_price, p.gen from (select *, row_number() over () as rid from lineitem) l left join periods p
  on l.l_partkey = p.p_partkey and cast(l.l_shipdate as date) >= p.valid_from
  and (p.valid_to is null or cast(l.l_shipdate as date) <= p.valid_to)
qualify row_number() over (partition by rid order by p.valid_from desc nulls last) = 1""")
def d09(spark, d):
    l = t(spark, d, "lineitem").select(*LKEY)
    return effective_dated_join(l, _price_periods(spark, d), ["l_partkey"], "l_shipdate").select(*LKEY, "unit_price", "gen")


@register("d10_rolling_range_join", sql="""
with pts as (select distinct cast(date_trunc('month', l_shipdate) as date) as as_of_day from lineitem)
select p.as_of_day, count(l.l_orderkey) as n_lines_180d, cast(coalesce(sum(l.l_quantity), 0) as double) as qty_180d
from pts p left join lineitem l
  on cast(l.l_shipdate as date) > p.as_of_day - interval 180 day and cast(l.l_shipdate as date) <= p.as_of_day
group by 1""")
def d10(spark, d):
    l = t(spark, d, "lineitem").select(F.col("l_shipdate").cast("date").alias("ship_day"), "l_quantity")
    # pre-aggregate to one row per day before the range join: the join then sees days, not lines
    per_day = l.groupBy("ship_day").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))
    pts = per_day.select(F.trunc("ship_day", "MM").alias("as_of_day")).distinct()
    iv = pts.withColumn("win_start", F.date_sub("as_of_day", 180))
    j = interval_join(iv, per_day, [], "win_start", "as_of_day", "ship_day", bucket_days=30,
                      start_inclusive=False, how="left", interval_id=["as_of_day"])
    return j.groupBy("as_of_day").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_lines_180d"),
                                      F.coalesce(F.sum("q"), F.lit(0.0)).alias("qty_180d"))


@register("d11_between_events_inclusive", sql="""
with v as (select event_id, user_id, ts,
                  coalesce(lag(ts) over (partition by user_id order by ts, event_id), timestamp '2024-01-01 00:00:00') as prev_ts
           from events where event_type = 'signup'),
p as (select user_id, ts, value from events where event_type = 'purchase')
select v.event_id, v.user_id, count(p.ts) as n_purchases,
       coalesce(sum(cast(p.value as decimal(18,2))), 0) as purchase_value
from v left join p on v.user_id = p.user_id and p.ts between v.prev_ts and v.ts
group by 1, 2""")
def d11(spark, d):
    e = t(spark, d, "events")
    signups = e.where("event_type = 'signup'").select("event_id", "user_id", "ts")
    visits = bucketed_lag(signups, ["user_id"], ["ts", "event_id"], ["ts"], F.trunc(F.col("ts").cast("date"), "MM")).select(
        "event_id", "user_id", F.col("ts").alias("visit_ts"),
        F.coalesce("prev_ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("prev_ts"))
    facts = e.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("p_ts"),
                                                      F.col("value").cast(DEC).alias("p_value"))
    # inclusive at both ends: a purchase exactly on a visit counts for both intervals (kept as is)
    j = interval_join(visits, facts, ["user_id"], "prev_ts", "visit_ts", "p_ts", bucket_days=1, how="left",
                      interval_id=["event_id"])
    return j.groupBy("event_id", "user_id").agg(
        F.count("p_ts").alias("n_purchases"),
        F.coalesce(F.sum("p_value"), F.lit(0).cast("decimal(28,2)")).alias("purchase_value"))


@register("d12_bounded_history_join", sql=f"""
with {fx.SQL_SUPPLY_BASE}
select t.company_id, t.product_id, t.demande_mois, cast(sum(h.quantite_demandee) as double) as qty_13m,
       count(*) as n_months_13m
from demand t join demand h on t.company_id = h.company_id and t.product_id = h.product_id
  and h.demande_mois between t.demande_mois - interval 12 month and t.demande_mois
group by 1, 2, 3""")
def d12(spark, d):
    dm = _demand(spark, d)
    # each history month feeds the targets m .. m+12: exact equi-join on the target month
    h = explode_months(dm.select("company_id", "product_id", "demande_mois", "quantite_demandee"),
                       "demande_mois", back=0, forward=12, out="target_mois")
    tgt = dm.select("company_id", "product_id", F.col("demande_mois").alias("target_mois"))
    return (tgt.join(h.drop("demande_mois"), ["company_id", "product_id", "target_mois"])
            .groupBy("company_id", "product_id", F.col("target_mois").alias("demande_mois"))
            .agg(F.sum("quantite_demandee").alias("qty_13m"), F.count(F.lit(1)).alias("n_months_13m")))


RULES_D13 = [
    (1, None, None, None, None, "GENERIC"),
    (2, "SMALL", None, None, None, "SMALL_ANY"),
    (3, "SMALL", "S", None, None, "SMALL_S"),
    (4, None, "L", "Brand#1", None, "L_BRAND1"),
    (5, "LARGE", None, None, "red", "LARGE_RED"),
    (6, None, None, None, "blue", "BLUE_ANY"),
    (7, "ECONOMY", "L", None, "old", "ECO_L_OLD"),
    (8, None, "S", None, "hot", "S_HOT"),
]


def _rules_sql(rows, cols):
    def q(v):
        return "null" if v is None else (f"'{v}'" if isinstance(v, str) else str(v))
    body = ", ".join("(" + ", ".join(q(v) for v in r) + ")" for r in rows)
    return f"(values {body}) v({', '.join(cols)})"


@register("d13_wildcard_rule_join", sql=f"""
with f as (select p_partkey, p_type, case when p_size <= 25 then 'S' else 'L' end as size_class, p_brand,
                  split_part(p_name, ' ', 1) as name_word from part),
r as (select * from {_rules_sql(RULES_D13, ['rule_id', 'r_type', 'r_size', 'r_brand', 'r_word', 'label'])})
select f.p_partkey, r.rule_id, r.label,
  (case when r.r_type is not null then 16 else 0 end) + (case when r.r_size is not null then 8 else 0 end)
  + (case when r.r_brand is not null then 4 else 0 end) + (case when r.r_word is not null then 2 else 0 end) as score
from f left join r on (r.r_type is null or r.r_type = f.p_type) and (r.r_size is null or r.r_size = f.size_class)
  and (r.r_brand is null or r.r_brand = f.p_brand) and (r.r_word is null or r.r_word = f.name_word)
qualify row_number() over (partition by f.p_partkey order by score desc, r.rule_id) = 1""")
def d13(spark, d):
    p = t(spark, d, "part").select(
        "p_partkey", "p_type", F.when(F.col("p_size") <= 25, "S").otherwise("L").alias("size_class"),
        "p_brand", F.split_part("p_name", F.lit(" "), F.lit(1)).alias("name_word"))
    fields = ("rule_id", "r_type", "r_size", "r_brand", "r_word", "label")
    out = wildcard_rule_match(p, [dict(zip(fields, r)) for r in RULES_D13],
                              [("p_type", "r_type", 16), ("size_class", "r_size", 8), ("p_brand", "r_brand", 4),
                               ("name_word", "r_word", 2)], order=["rule_id"])
    return out.select("p_partkey", "rule_id", "label", F.col("_score").alias("score"))


RULES_D14 = [
    dict(l_suppkey=5, l_returnflag=None, date_from="1996-01-01", date_to="1997-01-01", is_takeover=True),
    dict(l_suppkey=None, l_returnflag="R", date_from="1998-03-01", date_to="1998-04-01", is_takeover=False),
    dict(l_suppkey=7, l_returnflag="A", date_from="1995-01-01", date_to="2002-01-01", is_takeover=True),
    dict(l_suppkey=None, l_returnflag=None, date_from="2000-12-25", date_to="2000-12-26", is_takeover=False),
]


@register("d14_rule_flags_max_case", sql=f"""
with r as (select * from {_rules_sql([(x['l_suppkey'], x['l_returnflag'], x['date_from'], x['date_to'],
                                        str(x['is_takeover']).lower()) for x in RULES_D14],
                                      ['r_supp', 'r_flag', 'date_from', 'date_to', 'is_takeover'])})
select {LKEY_SQL},
  coalesce(max(case when r.r_supp is not null or r.r_flag is not null or r.date_from is not null then 1 end), 0) = 1
    and bool_or(r.date_from is not null) as is_claimed,
  coalesce(bool_or(r.is_takeover::boolean), false) as is_takeover
from lineitem l left join r on (r.r_supp is null or r.r_supp = l.l_suppkey)
  and (r.r_flag is null or r.r_flag = l.l_returnflag)
  and cast(l.l_shipdate as date) >= cast(r.date_from as date)
  and (r.date_to is null or cast(l.l_shipdate as date) < cast(r.date_to as date))
group by all""")
def d14(spark, d):
    l = t(spark, d, "lineitem").select(*LKEY, "l_returnflag")
    out = rule_flags(l, RULES_D14, {"l_suppkey": "l_suppkey", "l_returnflag": "l_returnflag"},
                     date_col="l_shipdate", flags=["is_takeover"])
    return out.select(*LKEY, "is_claimed", "is_takeover")


@register("d15_polymorphic_fk", sql=f"""
with x as (select {LKEY_SQL}, case when l_linenumber % 2 = 1 then 'PART' else 'SUPP' end as ref_type,
                  case when l_linenumber % 2 = 1 then l_partkey else l_suppkey end as ref_id from lineitem)
select x.{LKEY_SQL.replace(', ', ', x.')}, x.ref_type,
  case when x.ref_type = 'PART' then p.p_name when x.ref_type = 'SUPP' then s.s_name end as ref_name
from x left join part p on x.ref_type = 'PART' and x.ref_id = p.p_partkey
left join supplier s on x.ref_type = 'SUPP' and x.ref_id = s.s_suppkey""")
def d15(spark, d):
    l, p, s = t(spark, d, "lineitem"), t(spark, d, "part"), t(spark, d, "supplier")
    odd = (F.col("l_linenumber") % 2) == 1
    x = l.select(*LKEY, F.when(odd, "PART").otherwise("SUPP").alias("ref_type"),
                 F.when(odd, F.col("l_partkey")).otherwise(F.col("l_suppkey")).alias("ref_id"))
    j = (x.join(p, (x.ref_type == "PART") & (x.ref_id == p.p_partkey), "left")
          .join(s, (x.ref_type == "SUPP") & (x.ref_id == s.s_suppkey), "left"))
    return j.select(*[x[c] for c in LKEY], "ref_type",
                    F.when(x.ref_type == "PART", p.p_name).when(x.ref_type == "SUPP", s.s_name).alias("ref_name"))


@register("d16_or_join_typed_key", sql="""
with ent as (select 'C' as src, c_custkey as id, c_name as name from customer
             union all select 'S', s_suppkey, s_name from supplier),
refs as (select o_orderkey, case when o_orderkey % 2 = 0 then 'C' else 'S' end as ref_type,
                case when o_orderkey % 2 = 0 then o_custkey else o_custkey % 100 end as ref_id from orders)
select r.o_orderkey, e.name from refs r left join ent e on e.src = r.ref_type and e.id = r.ref_id""")
def d16(spark, d):
    c, s, o = t(spark, d, "customer"), t(spark, d, "supplier"), t(spark, d, "orders")
    ent = (c.select(F.lit("C").alias("src"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
           .unionByName(s.select(F.lit("S").alias("src"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))))
    even = (F.col("o_orderkey") % 2) == 0
    refs = o.select("o_orderkey", F.when(even, "C").otherwise("S").alias("ref_type"),
                    F.when(even, F.col("o_custkey")).otherwise(F.col("o_custkey") % 100).alias("ref_id"))
    return typed_key_join(refs, ent, "ref_type", "ref_id", "src", "id").select("o_orderkey", "name")


@register("d17_expression_key_join", sql="""
with a as (select cast(o_orderdate as date) as day, count(*) as n_orders from orders group by 1),
b as (select cast(l_shipdate as date) as day, count(*) as n_lines from lineitem group by 1)
select a.day, a.n_orders, b.n_lines from a join b on a.day = b.day""")
def d17(spark, d):
    o, l = t(spark, d, "orders"), t(spark, d, "lineitem")
    a = o.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n_orders"))
    b = l.groupBy(F.col("l_shipdate").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n_lines"))
    # aggregate both sides to the day first: joining raw rows on a date key would fan out
    return a.join(b, "day")


@register("d18_fallback_join", sql="""
select coalesce(s.s_nationkey, c.c_nationkey) as nationkey, count(*) as n_lines
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
left join (select * from supplier where s_acctbal > 0) s on l.l_suppkey = s.s_suppkey
left join customer c on o.o_custkey = c.c_custkey group by 1""")
def d18(spark, d):
    l, o, s, c = (t(spark, d, x) for x in ("lineitem", "orders", "supplier", "customer"))
    lo = l.join(o.select("o_orderkey", "o_custkey"), l.l_orderkey == o.o_orderkey)
    first = s.where("s_acctbal > 0").select("s_suppkey", F.col("s_nationkey").alias("nationkey"))
    second = c.select("c_custkey", F.col("c_nationkey").alias("nationkey"))
    x = fallback_lookup(lo.withColumnRenamed("l_suppkey", "s_suppkey").withColumnRenamed("o_custkey", "c_custkey"),
                        first, second, "s_suppkey", "c_custkey", "nationkey", "nationkey")
    return x.groupBy("nationkey").agg(F.count(F.lit(1)).alias("n_lines"))


@register("d19_conditional_multipart_key", sql="""
with fix as (select o_orderkey, case when o_orderkey % 3 = 0 then null else 1 end as fix_line,
                    year(o_orderdate) as fix_year from orders)
select year(l.l_shipdate) as ship_year, count(*) as n_matched
from lineitem l join fix f on l.l_orderkey = f.o_orderkey
  and (f.fix_line is null or l.l_linenumber = f.fix_line)
  and (year(l.l_shipdate) <> 1998 or f.fix_year = 1998)
group by 1""")
def d19(spark, d):
    l, o = t(spark, d, "lineitem"), t(spark, d, "orders")
    fix = o.select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(None)).otherwise(F.lit(1)).alias("fix_line"),
                   F.year("o_orderdate").alias("fix_year"))
    cond = ((l.l_orderkey == fix.o_orderkey)  # equi part → hash/sort-merge join
            & (fix.fix_line.isNull() | (l.l_linenumber == fix.fix_line))
            & ((F.year(l.l_shipdate) != 1998) | (fix.fix_year == 1998)))
    return l.join(fix, cond).groupBy(F.year("l_shipdate").alias("ship_year")).agg(F.count(F.lit(1)).alias("n_matched"))


@register("d20_lateral_date_explode", sql=f"""
with {holidays_sql()}, {SQL_LO_PAIRS},
days as (select *, cast(unnest(generate_series(a, b, interval 1 day)) as date) as d from pairs)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, count(*) as n_open_days
from days where isodow(d) < 6 and d not in (select date_ferie from hol) group by 1, 2, 3, 4, 5""")
def d20(spark, d):
    # the days between are counted by the running calendar, not made into rows
    x = business_days(_lo_pairs(spark, d), "a", "b", _cal(spark)).where("business_days is not null")
    return x.groupBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").agg(
        F.sum(F.col("business_days") + 1).cast("long").alias("n_open_days"))


@register("d21_non_equi_first_demand", sql=f"""
with {fx.SQL_SUPPLY_BASE},
months as (select distinct demande_mois as target_mois from demand),
firsts as (select company_id, product_id, min(demande_mois) as first_mois from demand group by 1, 2)
select f.company_id, f.product_id, f.first_mois, count(*) as n_target_months
from firsts f join months m on f.first_mois <= m.target_mois group by 1, 2, 3""")
def d21(spark, d):
    dm = _demand(spark, d)
    months = dm.select(F.col("demande_mois").alias("target_mois")).distinct()  # ≤ 12 per year
    firsts = dm.groupBy("company_id", "product_id").agg(F.min("demande_mois").alias("first_mois"))
    j = firsts.join(F.broadcast(months), F.col("first_mois") <= F.col("target_mois"))
    return j.groupBy("company_id", "product_id", "first_mois").agg(F.count(F.lit(1)).alias("n_target_months"))


@register("d22_shared_parent_document", sql="""
with first_order as (select o_custkey, min(o_orderdate) as first_order_date from orders group by 1),
x as (select o.o_custkey, date_diff('day', cast(f.first_order_date as date), cast(l.l_shipdate as date)) as lead_days
      from lineitem l join orders o on l.l_orderkey = o.o_orderkey
      left join first_order f on o.o_custkey = f.o_custkey)
select o_custkey, count(*) filter (where lead_days >= 0) as n_valid, min(lead_days) as min_lead from x group by 1""")
def d22(spark, d):
    l, o = t(spark, d, "lineitem"), t(spark, d, "orders")
    first = o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order_date"))
    x = (l.join(o.select("o_orderkey", "o_custkey"), l.l_orderkey == o.o_orderkey)
         .join(first, "o_custkey", "left")
         .withColumn("lead_days", F.datediff(F.col("l_shipdate").cast("date"), F.col("first_order_date").cast("date"))))
    return x.groupBy("o_custkey").agg(F.count_if(F.col("lead_days") >= 0).alias("n_valid"),
                                      F.min("lead_days").alias("min_lead"))
