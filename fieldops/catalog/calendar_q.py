"""T — calendar and business-time queries."""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldops.catalog import register
from fieldops.catalog.fixtures import t, season_calendar
from fieldops.functions import calendar as cal
from fieldops.operators.business_time import business_days, business_minutes

YEARS = list(range(1994, 2003)) + list(range(2023, 2026))
CAL_FIRST, CAL_LAST = 1994, 2025


def holidays_sql() -> str:
    vals = ", ".join(f"(date '{r[2].isoformat()}', '{r[3].replace(chr(39), chr(39) * 2)}')"
                     for r in cal.holiday_rows(YEARS))
    return f"hol as (select * from (values {vals}) v(date_ferie, nom_jour_ferie))"


def _cal(spark):
    return cal.business_calendar(spark, CAL_FIRST, CAL_LAST,
                                 [r[2] for r in cal.holiday_rows(range(CAL_FIRST, CAL_LAST + 1))])


def _event_pairs(spark, d):
    from fieldops.operators.windows import bucketed_lag
    e = t(spark, d, "events")
    # next event per user, bucketed by day so a very active user is not one task
    x = bucketed_lag(e, ["user_id"], ["ts", "event_id"], ["ts"], F.col("ts").cast("date"), offset_direction="lead",
                     prefix="next_")
    return x.select("event_id", "user_id", F.col("ts").alias("start_ts"), F.col("next_ts").alias("end_ts"))


@register("t01_business_minutes", sql=f"""
with {holidays_sql()},
p as (select event_id, ts as s, lead(ts) over (partition by user_id order by ts, event_id) as e from events),
p2 as (select *, cast(timezone('Europe/Paris', cast(s as timestamptz)) as date) as d1,
                 cast(timezone('Europe/Paris', cast(e as timestamptz)) as date) as d2 from p where e is not null),
days as (select event_id, s, e, cast(unnest(generate_series(d1, d2, interval 1 day)) as date) as d from p2),
m as (select event_id,
        sum(greatest(date_sub('minute',
              greatest(timezone('UTC', timezone('Europe/Paris', d + interval 9 hour)), s),
              least(timezone('UTC', timezone('Europe/Paris', d + interval 17 hour + interval 30 minute)), e)), 0))
          as mins
      from days where isodow(d) < 6 and d not in (select date_ferie from hol) group by 1)
select p.event_id, p.s as start_ts, p.e as end_ts, coalesce(m.mins, 0) as business_minutes
from p left join m on p.event_id = m.event_id""")
def t01(spark, d):
    out = business_minutes(_event_pairs(spark, d), "start_ts", "end_ts", _cal(spark))
    return out.select("event_id", "start_ts", "end_ts", "business_minutes")


SQL_LO_PAIRS = """
pairs as (select l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice,
                 cast(o.o_orderdate as date) as a, cast(l.l_shipdate as date) as b
          from lineitem l join orders o on l.l_orderkey = o.o_orderkey
          where date_diff('day', cast(o.o_orderdate as date), cast(l.l_shipdate as date)) >= 0)"""


def _lo_pairs(spark, d):
    l, o = t(spark, d, "lineitem"), t(spark, d, "orders")
    a, b = F.col("o_orderdate").cast("date"), F.col("l_shipdate").cast("date")
    return (l.join(o, l.l_orderkey == o.o_orderkey).where(F.datediff(b, a) >= 0)
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                    a.alias("a"), b.alias("b")))


SQL_T02 = f"""
with {holidays_sql()}, {SQL_LO_PAIRS},
days as (select *, cast(unnest(generate_series(a, b, interval 1 day)) as date) as d from pairs),
bd as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, a, b, count(*) - 1 as business_days
       from days where isodow(d) < 6 and d not in (select date_ferie from hol) group by all)
select p.*, bd.business_days from pairs p left join bd using (l_orderkey, l_linenumber, l_partkey, l_suppkey,
  l_extendedprice, a, b)"""


@register("t02_business_days", sql=SQL_T02)
def t02(spark, d):
    return business_days(_lo_pairs(spark, d), "a", "b", _cal(spark))


@register("t05_delay_bucket", sql=f"""
with x as ({SQL_T02})
select case when business_days is null then null when business_days <= 0 then 'J+0'
            when business_days = 1 then 'J+1' when business_days = 2 then 'J+2'
            when business_days = 3 then 'J+3' else 'J++' end as delay_class, count(*) as n_lines
from x group by 1""")
def t05(spark, d):
    x = t02(spark, d)
    return x.groupBy(cal.delay_bucket("business_days").alias("delay_class")).agg(F.count(F.lit(1)).alias("n_lines"))


@register("t04_cutoff_shift", sql="""
select event_id, case when strftime(ts, '%H:%M:%S') > '16:00:00'
                      then cast(cast(ts as date) + interval 1 day as timestamp) else ts end as reference_ts
from events""")
def t04(spark, d):
    return t(spark, d, "events").select("event_id", cal.cutoff_shift("ts", "16:00:00").alias("reference_ts"))


@register("t06_fortnight", sql="""
select year(l_shipdate) as yr,
  cast(floor(date_diff('day', cast(date_trunc('week', date_trunc('year', l_shipdate)) as date),
                       cast(l_shipdate as date)) / 14) + 1 as integer) as fortnight,
  cast(sum(l_quantity) as double) as qty
from lineitem group by 1, 2""")
def t06(spark, d):
    l = t(spark, d, "lineitem")
    return l.groupBy(F.year("l_shipdate").alias("yr"), cal.fortnight("l_shipdate").alias("fortnight")).agg(
        F.sum("l_quantity").alias("qty"))


@register("t07_iso_week_label", sql="""
select lpad(cast(week(o_orderdate) as varchar), 2, '0') || '.' || lpad(cast(isoyear(o_orderdate) as varchar), 4, '0')
         as iso_week, count(*) as n_orders
from orders group by 1""")
def t07(spark, d):
    return t(spark, d, "orders").groupBy(cal.iso_week_label("o_orderdate").alias("iso_week")).agg(
        F.count(F.lit(1)).alias("n_orders"))


@register("t08_month_spine", sql="""
with r as (select l_suppkey, l_partkey, min(cast(date_trunc('month', l_shipdate) as date)) as first_m,
                  max(cast(date_trunc('month', l_shipdate) as date)) as last_m from lineitem group by 1, 2)
select l_suppkey, l_partkey, cast(unnest(generate_series(first_m, last_m, interval 1 month)) as date) as month
from r""")
def t08(spark, d):
    l = t(spark, d, "lineitem")
    r = l.groupBy("l_suppkey", "l_partkey").agg(F.min("l_shipdate").alias("f"), F.max("l_shipdate").alias("l"))
    return r.select("l_suppkey", "l_partkey", F.explode(cal.month_spine("f", "l")).alias("month"))


@register("t09_season_by_iso_week", sql="""
with seasons as (select cast(i as integer) as numero_semaine,
                        case when i between 14 and 39 then 'ete' else 'hiver' end as saison
                 from range(1, 54) r(i))
select s.saison, cast(sum(l.l_quantity) as double) as qty, count(*) as n_lines
from lineitem l join seasons s on weekofyear(l.l_shipdate) = s.numero_semaine group by 1""")
def t09(spark, d):
    l = t(spark, d, "lineitem")
    s = season_calendar(spark)
    return (l.join(F.broadcast(s), F.weekofyear("l_shipdate") == s.numero_semaine)
            .groupBy("saison").agg(F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).alias("n_lines")))


@register("t11_workday_bounds", sql="""
with e as (select user_id, cast(ts as date) as day, ts from events),
b as (select user_id, day, min(case when hour(ts) >= 3 then ts end) as first_in, max(ts) as last_out
      from e group by 1, 2)
select * from b where last_out > first_in""")
def t11(spark, d):
    e = t(spark, d, "events").withColumn("day", F.col("ts").cast("date"))
    b = e.groupBy("user_id", "day").agg(F.min(F.when(F.hour("ts") >= 3, F.col("ts"))).alias("first_in"),
                                        F.max("ts").alias("last_out"))
    return b.where(F.col("last_out") > F.col("first_in"))


@register("t12_period_day", sql="""
select o_orderkey, cast(cast(date_trunc('month', o_orderdate) as date) + cast(o_orderkey % 28 as integer) as date)
         as accounting_date
from orders""")
def t12(spark, d):
    o = t(spark, d, "orders")
    return o.select("o_orderkey", cal.period_day(F.trunc(F.col("o_orderdate").cast("date"), "MM"),
                                                 (F.col("o_orderkey") % 28 + 1)).alias("accounting_date"))


@register("t13_holiday_calendar", sql=f"""
with {holidays_sql()}
select h.nom_jour_ferie, count(*) as n_orders from orders o join hol h on cast(o.o_orderdate as date) = h.date_ferie
group by 1""")
def t13(spark, d):
    h = cal.holidays(spark, YEARS)
    o = t(spark, d, "orders")
    return (o.join(F.broadcast(h), o.o_orderdate.cast("date") == h.date_ferie)
            .groupBy("nom_jour_ferie").agg(F.count(F.lit(1)).alias("n_orders")))


def sql_business_minutes(name: str, src: str, ids: str, s: str, e: str) -> str:
    """Brute-force SQL twin of ``business_minutes`` (explode every local day), for the oracles.
    Yields rows only for spans holding at least one business day."""
    paris = "'Europe/Paris'"
    return f"""{name}_days as (
  select {ids}, {s} as _s, {e} as _e, cast(unnest(generate_series(
      cast(timezone({paris}, cast({s} as timestamptz)) as date),
      cast(timezone({paris}, cast({e} as timestamptz)) as date), interval 1 day)) as date) as d
  from {src} where {s} is not null and {e} is not null),
{name} as (
  select {ids}, sum(greatest(date_sub('minute',
      greatest(timezone('UTC', timezone({paris}, d + interval 9 hour)), _s),
      least(timezone('UTC', timezone({paris}, d + interval 17 hour + interval 30 minute)), _e)), 0)) as minutes
  from {name}_days where isodow(d) < 6 and d not in (select date_ferie from hol) group by {ids})"""
