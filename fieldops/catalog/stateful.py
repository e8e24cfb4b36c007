"""Sources/sinks (A), incremental upserts (E22–E24), history (E25–E30) and streams (W01–W05).

Queries that write go to a fresh folder under the shared ``spark.checkpoint.dir``; each reads its
result back as the returned DataFrame.
"""
from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldops.catalog import register
from fieldops.catalog.fixtures import t
from fieldops.functions.clean import cast_columns
from fieldops.operators.history import backfill_leading_nulls, history_view, scd2_snapshot
from fieldops.operators.upsert import changed_since, merge, scratch_dir, upsert_table
from fieldops.sources import as_view, latest_snapshot, read_seed, read_snapshots, read_text_table, with_audit, write_table
from fieldops.sources.manifest import ManifestTable
from fieldops.streaming import streams as st

SEED_DIR = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "seeds")


# ------------------------------------------------------------------ A: sources and sinks
@register("a01_table_scan_projection", sql="select l_orderkey, l_quantity from lineitem where l_shipdate >= timestamp '2001-01-01'")
def a01(spark, d):
    return t(spark, d, "lineitem").where(F.col("l_shipdate") >= F.lit("2001-01-01").cast("timestamp_ntz")).select(
        "l_orderkey", "l_quantity")


@register("a02_typed_seed_scan", sql="""
with seed as (select * from (values ('F', 'FAIT', true), ('O', 'ENCOURS', false), ('P', 'PARTIEL', false))
              v(status_code, status_label, is_final))
select s.status_label, s.is_final, count(*) as n_orders from orders o join seed s on o.o_orderstatus = s.status_code
group by 1, 2""")
def a02(spark, d):
    seed = read_seed(spark, os.path.join(SEED_DIR, "order_status.csv"),
                     "status_code string, status_label string, is_final boolean")
    o = t(spark, d, "orders")
    return (o.join(F.broadcast(seed), o.o_orderstatus == seed.status_code)
            .groupBy("status_label", "is_final").agg(F.count(F.lit(1)).alias("n_orders")))


@register("a03_ndjson_snapshot_scan", sql="""
select event_id, user_id, event_type as kind, '2024-01' as periode from events where value <= 90""")
def a03(spark, d):
    e = t(spark, d, "events").select("event_id", "user_id", "event_type", "value",
                                     F.date_format("ts", "yyyy-MM").alias("periode"))
    root = scratch_dir(spark, "ndjson")
    load1 = e.withColumn("loaded", F.lit("20240131T000000Z"))
    load2 = e.where("value <= 90").withColumn("loaded", F.lit("20240201T000000Z"))  # later file revokes rows
    (load1.unionByName(load2).withColumnRenamed("event_type", "kind").write.mode("overwrite")
     .partitionBy("kind", "periode", "loaded").json(root))
    snap = read_snapshots(spark, root, "event_id long, user_id long, value double",
                          kind_pattern=r"kind=([^/]+)/", period_pattern=r"periode=(\d{4}-\d{2})/",
                          stamp_pattern=r"loaded=([^/]+)/", file_glob="*.json")
    return latest_snapshot(snap, ["kind", "periode"]).select("event_id", "user_id", "kind", "periode")


@register("a04_text_table_scan", sql="""
select l_orderkey, l_linenumber, l_quantity, cast(l_shipdate as date) as ship_day from lineitem""")
def a04(spark, d):
    path = scratch_dir(spark, "csv")
    l = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                       F.col("l_shipdate").cast("date").alias("ship_day"))
    l.write.mode("overwrite").option("header", True).csv(path)
    txt = read_text_table(spark, path)
    return cast_columns(txt, {"l_orderkey": "bigint", "l_linenumber": "int", "l_quantity": "double", "ship_day": "date"},
                        safe=False)


@register("a05_full_refresh_sink", sql="select o_orderkey, o_orderstatus, cast(date_trunc('month', o_orderdate) as date) as month from orders")
def a05(spark, d):
    path = scratch_dir(spark, "sink")
    o = t(spark, d, "orders").select("o_orderkey", "o_orderstatus",
                                     F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("month"))
    write_table(o, path, partition_by=["month"])
    return spark.read.parquet(path).select("o_orderkey", "o_orderstatus", F.col("month").cast("date").alias("month"))


@register("a06_partitioned_clustered_sink", sql="""
select l_orderkey, l_partkey, l_quantity, year(l_shipdate) as ship_year from lineitem where year(l_shipdate) = 1998""")
def a06(spark, d):
    path = scratch_dir(spark, "clustered")
    l = t(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", F.year("l_shipdate").alias("ship_year"))
    write_table(l, path, partition_by=["ship_year"], sort_by=["l_partkey"])
    return spark.read.parquet(path).where("ship_year = 1998").select("l_orderkey", "l_partkey", "l_quantity",
                                                                     F.col("ship_year").cast("int"))


@register("a07_view_relation", sql="select o_orderstatus, count(*) as n from orders group by 1")
def a07(spark, d):
    as_view(t(spark, d, "orders"), "orders_v")
    return spark.sql("select o_orderstatus, count(*) as n from orders_v group by 1")


@register("a08_audit_columns", sql="""
select r_regionkey, r_name, 'run-001' as _run_id, timestamp '2024-02-01 06:00:00' as _loaded_at from region""")
def a08(spark, d):
    out = with_audit(t(spark, d, "region"), "run-001", "2024-02-01 06:00:00")
    return out.withColumn("_loaded_at", F.col("_loaded_at").cast("timestamp_ntz"))


# ------------------------------------------------------------------ E22–E24: incremental
SQL_E22 = """
with target as (select o_orderkey, o_orderstatus, o_totalprice, o_orderdate as updated_at from orders
                where o_orderdate < timestamp '2000-01-01'),
batch as (select o_orderkey, o_orderstatus, o_totalprice + 1 as o_totalprice, o_orderdate + interval 1 day as updated_at
          from orders where o_orderdate >= timestamp '1999-12-01'
          union all
          select o_orderkey, 'X', o_totalprice, o_orderdate as updated_at from orders
          where o_orderdate >= timestamp '1999-12-01' and o_orderkey % 5 = 0),
latest as (select * from batch qualify row_number() over (partition by o_orderkey order by updated_at desc) = 1)
select * from target where o_orderkey not in (select o_orderkey from latest)
union all select * from latest"""


def _e22_inputs(spark, d):
    o = t(spark, d, "orders")
    target = o.where(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").alias("updated_at"))
    recent = o.where(F.col("o_orderdate") >= F.lit("1999-12-01").cast("timestamp_ntz"))
    batch = recent.select("o_orderkey", "o_orderstatus", (F.col("o_totalprice") + 1).alias("o_totalprice"),
                          (F.col("o_orderdate") + F.expr("interval 1 day")).alias("updated_at")).unionByName(
        recent.where(F.col("o_orderkey") % 5 == 0).select("o_orderkey", F.lit("X").alias("o_orderstatus"),
                                                          "o_totalprice", F.col("o_orderdate").alias("updated_at")))
    return target, batch


@register("e22_incremental_upsert", sql=SQL_E22)
def e22(spark, d):
    """First load, then an upsert that rewrites the months it touches, in a manifest table."""
    target, batch = _e22_inputs(spark, d)
    root = scratch_dir(spark, "e22")
    month = F.date_format("updated_at", "yyyy-MM")
    upsert_table(spark, root, target, ["o_orderkey"], ["updated_at"], month)
    upsert_table(spark, root, batch, ["o_orderkey"], ["updated_at"], month)
    return ManifestTable(spark, root).read()


@register("e23_incremental_window", sql="""
select o_orderkey, o_orderdate from orders
where o_orderdate > timestamp '2001-06-01' or o_orderdate >= timestamp '2001-06-03' - interval 7 day""")
def e23(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return changed_since(o, "o_orderdate", "2001-06-01 00:00:00", dt.datetime(2001, 6, 3), dt.timedelta(days=7))


@register("e24_schema_widening", sql=SQL_E22.replace(
    "select * from target where", "select *, cast(null as varchar) as channel from target where").replace(
    "union all select * from latest", "union all select *, 'api' as channel from latest"))
def e24(spark, d):
    target, batch = _e22_inputs(spark, d)
    return merge(target, batch.withColumn("channel", F.lit("api")), ["o_orderkey"], ["updated_at"], widen=True)


# ------------------------------------------------------------------ E25–E30: history
NOW1, NOW2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)


def _states(spark, d):
    c = t(spark, d, "customer")
    s1 = c.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal")
    k = F.col("c_custkey")
    s2 = (c.where(k % 11 != 0)
          .select("c_custkey",
                  F.when(k % 17 == 0, F.concat(F.col("c_name"), F.lit(" (renamed)"))).otherwise(F.col("c_name")).alias("c_name"),
                  "c_nationkey",
                  F.when(k % 7 == 0, F.lit("MOVED")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
                  F.when(k % 10 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")).alias("c_acctbal"))
          .unionByName(c.where(k % 13 == 0).select((k + 100000).alias("c_custkey"), "c_name", "c_nationkey",
                                                  "c_mktsegment", "c_acctbal")))
    return s1, s2


def _sql_scd2(tracked: list[str]) -> str:
    chg = " or ".join(f"h.{c} is distinct from c.{c}" for c in tracked)
    sk = ("md5(concat_ws('-', coalesce(cast(c_custkey as varchar), '_dbt_utils_surrogate_key_null_'), "
          "coalesce(cast(vf as varchar), '_dbt_utils_surrogate_key_null_')))")
    return f"""
with s1 as (select c_custkey, c_name, c_nationkey, c_mktsegment, c_acctbal from customer),
s2 as (select c_custkey, case when c_custkey % 17 = 0 then c_name || ' (renamed)' else c_name end as c_name, c_nationkey,
         case when c_custkey % 7 = 0 then 'MOVED' else c_mktsegment end as c_mktsegment,
         case when c_custkey % 10 = 0 then c_acctbal + 1 else c_acctbal end as c_acctbal
       from customer where c_custkey % 11 <> 0
       union all select c_custkey + 100000, c_name, c_nationkey, c_mktsegment, c_acctbal from customer where c_custkey % 13 = 0),
h1 as (select *, timestamp '2024-01-01 00:00:00' as vf from s1),
kept as (select h.c_custkey, h.c_name, h.c_nationkey, h.c_mktsegment, h.c_acctbal, h.vf,
           case when c.c_custkey is null then timestamp '2024-02-01 00:00:00'
                when {chg} then timestamp '2024-02-01 00:00:00' end as vt
         from h1 h left join s2 c on h.c_custkey = c.c_custkey),
fresh as (select c.*, timestamp '2024-02-01 00:00:00' as vf, cast(null as timestamp) as vt
          from s2 c left join h1 h on h.c_custkey = c.c_custkey where h.c_custkey is null or {chg}),
allv as (select * from kept union all select * from fresh)
select c_custkey, c_name, c_nationkey, c_mktsegment, c_acctbal, {sk} as dbt_scd_id, vf as dbt_updated_at,
       vf as dbt_valid_from, vt as dbt_valid_to from allv"""


@register("e25_scd2_check_columns", sql=_sql_scd2(["c_mktsegment", "c_nationkey"]))
def e25(spark, d):
    s1, s2 = _states(spark, d)
    h1 = scd2_snapshot(None, s1, ["c_custkey"], NOW1, check_cols=["c_mktsegment", "c_nationkey"])
    return scd2_snapshot(h1, s2, ["c_custkey"], NOW2, check_cols=["c_mktsegment", "c_nationkey"],
                         invalidate_hard_deletes=True)


@register("e26_scd2_check_all_but_excluded", sql=_sql_scd2(["c_name", "c_nationkey", "c_mktsegment"]))
def e26(spark, d):
    s1, s2 = _states(spark, d)
    h1 = scd2_snapshot(None, s1, ["c_custkey"], NOW1, check_cols="all", exclude_cols=["c_acctbal"])
    return scd2_snapshot(h1, s2, ["c_custkey"], NOW2, check_cols="all", exclude_cols=["c_acctbal"],
                         invalidate_hard_deletes=True)


register("e28_hard_delete_close", sql=_sql_scd2(["c_mktsegment", "c_nationkey"]))(e25)


@register("e27_scd2_timestamp_strategy", sql="""
with s1 as (select p_partkey, p_retailprice, timestamp '2024-01-01 00:00:00' as updated_at from part),
s2 as (select p_partkey, case when p_partkey % 4 = 0 then p_retailprice * 2 else p_retailprice end as p_retailprice,
         case when p_partkey % 4 = 0 then timestamp '2024-01-15 00:00:00' else timestamp '2024-01-01 00:00:00' end as updated_at
       from part),
sk as (select 1)
select p_partkey, p_retailprice, updated_at,
  md5(concat_ws('-', cast(p_partkey as varchar), cast(updated_at as varchar))) as dbt_scd_id,
  updated_at as dbt_updated_at, updated_at as dbt_valid_from,
  case when p_partkey % 4 = 0 and updated_at = timestamp '2024-01-01 00:00:00' then timestamp '2024-01-15 00:00:00' end
    as dbt_valid_to
from (select * from s1 union all select * from s2 where p_partkey % 4 = 0)""")
def e27(spark, d):
    p = t(spark, d, "part")
    k = F.col("p_partkey") % 4 == 0
    s1 = p.select("p_partkey", "p_retailprice", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("updated_at"))
    s2 = p.select("p_partkey", F.when(k, F.col("p_retailprice") * 2).otherwise(F.col("p_retailprice")).alias("p_retailprice"),
                  F.when(k, F.lit("2024-01-15 00:00:00")).otherwise(F.lit("2024-01-01 00:00:00"))
                  .cast("timestamp_ntz").alias("updated_at"))
    h1 = scd2_snapshot(None, s1, ["p_partkey"], NOW1, strategy="timestamp", updated_at="updated_at")
    return scd2_snapshot(h1, s2, ["p_partkey"], NOW2, strategy="timestamp", updated_at="updated_at")


@register("e29_history_view", sql=f"""
with h as ({_sql_scd2(["c_mktsegment", "c_nationkey"])})
select *, case when dbt_valid_from = min(dbt_valid_from) over (partition by c_custkey)
               then timestamp '2000-01-01 00:00:00' else dbt_valid_from end as valid_from,
       coalesce(dbt_valid_to, timestamp '9999-12-31 00:00:00') as valid_to, dbt_valid_to is null as is_current from h""")
def e29(spark, d):
    return history_view(e25(spark, d), ["c_custkey"])


@register("e30_backfill_leading_nulls", sql="""
with x as (select event_id, user_id, ts, case when event_type = 'signup' then null else value end as value from events)
select event_id, user_id, ts, coalesce(value, first_value(value ignore nulls) over (partition by user_id order by ts, event_id
  rows between unbounded preceding and unbounded following)) as value from x""")
def e30(spark, d):
    e = t(spark, d, "events").select("event_id", "user_id", "ts",
                                     F.when(F.col("event_type") == "signup", F.lit(None)).otherwise(F.col("value")).alias("value"))
    return backfill_leading_nulls(e, ["user_id"], ["ts", "event_id"], ["value"])


# ------------------------------------------------------------------ W01–W05: streams
def _drops(spark, d, copies: bool = False) -> str:
    """Events written as three file drops (10-day slices) in a fresh folder, optionally with a
    fourth drop repeating purchases (late duplicates)."""
    root = scratch_dir(spark, "drops")
    e = t(spark, d, "events")
    day = F.dayofmonth("ts")
    for i, (lo, hi) in enumerate([(1, 10), (11, 20), (21, 31)]):
        e.where(day.between(lo, hi)).write.mode("overwrite").parquet(f"{root}/drop{i}")
    if copies:
        e.where("event_type = 'purchase'").write.mode("overwrite").parquet(f"{root}/drop3")
    return root


def _stream(spark, root):
    return (spark.readStream.schema(st.EVENTS_SCHEMA).option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", 1).parquet(root))


@register("w01_stream_upsert_by_key", sql="""
select event_id, user_id, ts, event_type from events
qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""")
def w01(spark, d):
    root = _drops(spark, d)
    out = scratch_dir(spark, "w01")
    return st.upsert_stream(spark, _stream(spark, root).select("event_id", "user_id", "ts", "event_type"),
                            out, ["user_id"], ["ts", "event_id"]).read()


@register("w02_late_duplicate_dedupe", sql="select event_id, user_id, ts from events")
def w02(spark, d):
    root = _drops(spark, d, copies=True)
    out = scratch_dir(spark, "w02")
    s = st.dedupe_within_watermark(_stream(spark, root).select("event_id", "user_id", "ts"), ["event_id"], "ts", "40 days")
    st.run_available(s, lambda b, i: b.write.mode("append").parquet(out), scratch_dir(spark, "ckpt-w02"))
    return spark.read.parquet(out)


# more than a drop's span, so that no event is late whatever the order of a drop's files
DELAY_DAYS = 12


@register("w03_tumbling_monday_weeks", sql=f"""
with seen as (select max(ts) - interval {DELAY_DAYS} day as mark from events)
select * from (
  select cast(date_trunc('week', ts) as timestamp) as window_start,
         cast(date_trunc('week', ts) as timestamp) + interval 7 day as window_end, event_type,
         count(*) as n_events, sum(cast(value as decimal(18,2))) as total_value
  from events group by 1, 2, 3), seen where window_end <= mark""".replace("select * from (", "select * exclude (mark) from ("))
def w03(spark, d):
    """Weeks that the watermark has closed."""
    root = _drops(spark, d)
    out = scratch_dir(spark, "w03")
    st.emit_closed(st.tumbling_counts(_stream(spark, root), "ts", "7 days", "4 days", ["event_type"], "value",
                                      f"{DELAY_DAYS} days"), out)
    return st.emitted(spark, out)


@register("w04_session_episodes", sql="""
with g as (select user_id, ts, case when lag(ts) over (partition by user_id order by ts) is null
             or ts - lag(ts) over (partition by user_id order by ts) > interval 2 hour then 1 else 0 end as brk from events),
s as (select *, sum(brk) over (partition by user_id order by ts rows between unbounded preceding and current row) as sid from g)
select user_id, min(ts) as session_start, max(ts) + interval 2 hour as session_end, count(*) as n_events
from s group by user_id, sid""")
def w04(spark, d):
    """All sessions, those still open after the last drop included: no watermark, so no event is late."""
    root = _drops(spark, d)
    out = scratch_dir(spark, "w04")
    st.run_available(st.sessions(_stream(spark, root), "ts", "2 hours", ["user_id"]),
                     lambda b, i: b.write.mode("overwrite").parquet(out), scratch_dir(spark, "ckpt-w04"), output_mode="complete")
    return spark.read.parquet(out)


@register("w05_open_interval_state", sql="""
select user_id, ts as valid_from, event_id, lead(ts) over (partition by user_id order by ts, event_id) as valid_to
from events""")
def w05(spark, d):
    root = _drops(spark, d)
    return st.interval_state_stream(spark, _stream(spark, root), "user_id", "ts", "event_id", scratch_dir(spark, "w05")).read()
