"""Q — data-quality checks over the driver tables (one result row per check)."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from fieldops.catalog import register
from fieldops.catalog.fixtures import t
from fieldops.operators.quality import Check, run_checks

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
AS_OF_E = dt.datetime(2024, 1, 31, 0, 0, 0)


def _tables(spark, d):
    return {n: t(spark, d, n) for n in TABLES}


def _one(spark, d, ck, **kw):
    return run_checks(_tables(spark, d), [ck], as_of=AS_OF_E, **kw)


def _sql(name, table, column, severity, failures_sql, warn=">0", error=">0"):
    col = f"'{column}'" if column else "cast(null as varchar)"
    def cond(spec):
        return f"f {spec}"
    status = (f"case when {cond(warn)} then 'warn' else 'pass' end" if severity == "warn"
              else f"case when {cond(error)} then 'error' when {cond(warn)} then 'warn' else 'pass' end")
    return (f"with x as (select cast(({failures_sql}) as bigint) as f) select '{name}' as check_name, "
            f"'{table}' as table_name, {col} as column_name, '{severity}' as severity, f as failures, "
            f"{status} as status from x")


def _reg(qid, ck, failures_sql, **kw):
    register(qid, sql=_sql(ck.name, ck.table, ck.column, ck.severity, failures_sql, ck.warn_if, ck.error_if))(
        lambda spark, d, ck=ck: _one(spark, d, ck, **kw))


_reg("q01_not_null", Check("cust_name_not_null", "not_null", "customer", "c_name"),
     "select count(*) from customer where c_name is null")
_reg("q02_unique", Check("orders_pk_unique", "unique", "orders", "o_orderkey"),
     "select count(*) from (select o_orderkey from orders where o_orderkey is not null group by 1 having count(*) > 1)")
_reg("q03_unique_combination",
     Check("line_key_unique", "unique_combination", "lineitem", params={"columns": ["l_orderkey", "l_linenumber"]}),
     "select count(*) from (select l_orderkey, l_linenumber from lineitem group by 1, 2 having count(*) > 1)")
_reg("q04_accepted_values",
     Check("order_status_domain", "accepted_values", "orders", "o_orderstatus", params={"values": ["F", "O"]}),
     "select count(*) from orders where o_orderstatus is not null and o_orderstatus not in ('F', 'O')")
_reg("q05_relationships",
     Check("line_part_fk", "relationships", "lineitem", "l_partkey", severity="warn",
           params={"to": "part", "field": "p_partkey"}, parents=("lineitem", "part")),
     "select count(*) from lineitem l where l_partkey is not null and not exists "
     "(select 1 from part p where p.p_partkey = l.l_partkey)")
_reg("q06_expression_is_true",
     Check("discount_sane", "expression", "lineitem", params={"expr": "l_discount between 0 and 0.1 and l_tax >= 0"}),
     "select count(*) from lineitem where not coalesce(l_discount between 0 and 0.1 and l_tax >= 0, false)")
_reg("q07_accepted_range",
     Check("discount_range", "range", "lineitem", "l_discount", severity="warn", params={"min": 0, "max": 0.08}),
     "select count(*) from lineitem where l_discount is not null and (l_discount < 0 or l_discount > 0.08)")
_reg("q08_row_count_between", Check("region_rows", "row_count", "region", severity="warn", params={"min": 5, "max": 5}),
     "select case when count(*) < 5 or count(*) > 5 then 1 else 0 end from region")
_reg("q09_recency",
     Check("events_recent", "recency", "events", "ts", severity="warn", params={"interval": 1, "datepart": "day"}),
     "select case when max(ts) is null or max(ts) < timestamp '2024-01-31 00:00:00' - interval 1 day then 1 else 0 end "
     "from events")
_reg("q11_failure_threshold",
     Check("negative_balances", "expression", "customer", severity="error", warn_if=">10", error_if=">100",
           params={"expr": "c_acctbal >= 0"}),
     "select count(*) from customer where not coalesce(c_acctbal >= 0, false)")


@register("q17_collision_between_sources", sql=_sql(
    "order_refs_single_source", "orders", None, "warn",
    "select count(*) from (select o_custkey from orders where o_custkey in (select s_suppkey from supplier) "
    "group by 1)"))
def q17(spark, d):
    # an id present in two contributing sources (customers and suppliers) is a collision
    o, s = t(spark, d, "orders"), t(spark, d, "supplier")
    refs = o.select("o_custkey").distinct().join(s.select(F.col("s_suppkey").alias("o_custkey")), "o_custkey", "left_semi")
    ck = Check("order_refs_single_source", "assertion", "orders", severity="warn", parents=("orders", "supplier"))
    return run_checks(_tables(spark, d), [ck], as_of=AS_OF_E, assertions={"order_refs_single_source": lambda: refs})


@register("q10_source_freshness", sql="""
with a as (select (epoch(timestamp '2024-01-31 00:00:00') - epoch(max(ts))) / 3600 as age_h from events),
x as (select cast(case when age_h > 36 then 2 when age_h > 26 then 1 else 0 end as bigint) as f from a)
select 'events_fresh' as check_name, 'events' as table_name, 'ts' as column_name, 'warn' as severity, f as failures,
  case when f = 2 then 'error' when f = 1 then 'warn' else 'pass' end as status from x""")
def q10(spark, d):
    ck = Check("events_fresh", "freshness", "events", "ts", severity="warn",
               params={"warn_after_hours": 26, "error_after_hours": 36})
    return _one(spark, d, ck)


def _price_lines(spark, d):
    from fieldops.catalog.joins import d09
    return d09(spark, d)


@register("q12_assertion_price_integrity", sql=_sql(
    "price_integrity", "lineitem", None, "error",
    "select count(*) from lineitem l join part p on l.l_partkey = p.p_partkey "
    "where cast(l.l_extendedprice as decimal(18,2)) < 0 or p.p_retailprice <= 0"))
def q12(spark, d):
    ck = Check("price_integrity", "assertion", "lineitem", parents=("lineitem", "part"))
    l, p = t(spark, d, "lineitem"), t(spark, d, "part")
    bad = lambda: l.join(p, l.l_partkey == p.p_partkey).where(
        (F.col("l_extendedprice").cast("decimal(18,2)") < 0) | (F.col("p_retailprice") <= 0))
    return run_checks(_tables(spark, d), [ck], as_of=AS_OF_E, assertions={"price_integrity": bad})


@register("q13_assertion_missing_price", sql=_sql(
    "missing_price", "lineitem", None, "warn",
    "select count(*) from lineitem where year(l_shipdate) = 1998 and month(l_shipdate) between 6 and 12 "
    "and l_partkey not in (select p_partkey from part where p_size > 40)"))
def q13(spark, d):
    ck = Check("missing_price", "assertion", "lineitem", severity="warn", parents=("lineitem", "part"))
    lines = _price_lines(spark, d)
    bad = lambda: lines.where((F.col("gen") == 2) & (F.year("l_shipdate") == 1998) & (F.month("l_shipdate") >= 6))
    return run_checks(_tables(spark, d), [ck], as_of=AS_OF_E, assertions={"missing_price": bad})


@register("q14_assertion_single_assignment", sql=_sql(
    "part_single_supplier_group", "lineitem", None, "warn",
    "select count(*) from (select l_partkey, string_agg(distinct cast(l_suppkey % 4 as varchar), ',') as groups "
    "from lineitem group by 1 having count(distinct l_suppkey % 4) > 3)"))
def q14(spark, d):
    ck = Check("part_single_supplier_group", "assertion", "lineitem", severity="warn")
    l = t(spark, d, "lineitem")
    g = F.col("l_suppkey") % 4
    bad = lambda: (l.groupBy("l_partkey").agg(F.countDistinct(g).alias("n"),
                                             F.array_join(F.array_sort(F.collect_set(g.cast("string"))), ",").alias("groups"))
                   .where("n > 3"))
    return run_checks(_tables(spark, d), [ck], as_of=AS_OF_E, assertions={"part_single_supplier_group": bad})


@register("q15_assertion_regex_suspects_in_lookup", sql=_sql(
    "bolt_parts_in_lookup", "part", None, "warn",
    "select count(*) from part p where regexp_matches(p_name, 'bolt$') and not exists "
    "(select 1 from part k where k.p_size < 10 and k.p_partkey = p.p_partkey)"))
def q15(spark, d):
    ck = Check("bolt_parts_in_lookup", "assertion", "part", severity="warn")
    p = t(spark, d, "part")
    lookup = p.where("p_size < 10").select(F.col("p_partkey").alias("_k"))
    bad = lambda: p.where(F.col("p_name").rlike("bolt$")).join(lookup, F.col("p_partkey") == F.col("_k"), "left_anti")
    return run_checks(_tables(spark, d), [ck], as_of=AS_OF_E, assertions={"bolt_parts_in_lookup": bad})


@register("q16_boundary_aware_run", sql="""
select 'cust_name_not_null' as check_name, 'customer' as table_name, 'c_name' as column_name, 'error' as severity,
  cast(count(*) filter (where c_name is null) as bigint) as failures,
  case when count(*) filter (where c_name is null) > 0 then 'error' else 'pass' end as status from customer""")
def q16(spark, d):
    checks = [Check("cust_name_not_null", "not_null", "customer", "c_name"),
              Check("line_part_fk", "relationships", "lineitem", "l_partkey", params={"to": "part", "field": "p_partkey"},
                    parents=("lineitem", "part"))]
    # a fast-lane run over customer only: the FK check crosses the boundary and is skipped
    return run_checks(_tables(spark, d), checks, as_of=AS_OF_E, run_tables=["customer"])
