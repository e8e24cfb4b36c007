"""Adapters from the driver tables to the reference's business shapes.

The driver ships TPC-H-like tables; the operators are written against reference-shaped columns
(depot, item, month, quantity ...).  These adapters are the single place where that mapping lives,
and every oracle SQL repeats the same mapping in plain SQL.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldops.sources import read_table

# Fixed "today" of the fixtures (L/O span 1995-01 .. 2001-11, events span January 2024).
AS_OF_LO = dt.date(2001, 6, 1)
AS_OF_EVENTS = dt.date(2024, 1, 31)


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def money(c) -> F.Column:
    """Money as exact decimal(18,2) before any sum (same cast in the oracle)."""
    return F.col(c).cast("decimal(18,2)") if isinstance(c, str) else c.cast("decimal(18,2)")


# ---------------------------------------------------------------- supply-chain shapes
# Depot = l_suppkey % 4 with depot 3 re-attached to depot 2 (K05 remap); item = part.
DEPOT_MOD = 4
DEPOT_REMAP = {3: 2}


def supply_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outgoing movements: order lines of done/open orders, customer deliveries (flag N/A) and
    van loads (flag R, line status F)."""
    l, o = t(spark, sf_dir, "lineitem"), t(spark, sf_dir, "orders")
    lo = (l.join(o.select("o_orderkey", "o_orderstatus"), l.l_orderkey == o.o_orderkey)
          .where(F.col("o_orderstatus").isin("F", "O")
                 & (F.col("l_returnflag").isin("N", "A")
                    | ((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")))))
    return lo.select((F.col("l_suppkey") % DEPOT_MOD).alias("company_id"),
                     F.col("l_partkey").alias("product_id"),
                     F.concat(F.lit("ART"), F.col("l_partkey").cast("string")).alias("product_code"),
                     F.col("l_shipdate").alias("event_date"),
                     F.col("l_quantity").alias("quantity"))


def supply_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t(spark, sf_dir, "part")
    ty = F.col("p_type")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lit("ART"), F.col("p_partkey").cast("string")).alias("product_code"),
        F.col("p_name").alias("product_name"),
        F.lit("OWN").alias("product_owner"),
        ty.alias("product_family"),
        F.when(F.col("p_size") <= 45, "OUI").otherwise("NON").alias("product_exploit"),
        F.when(ty.isin("SMALL", "STANDARD", "LARGE"), "OUI").otherwise("NON").alias("product_planoete"),
        F.when(ty.isin("MEDIUM", "STANDARD", "LARGE"), "OUI").otherwise("NON").alias("product_planohiver"),
        F.col("p_retailprice").alias("purchase_unit_price"),
        F.col("p_size").alias("coeff_conditionnement"))


def supply_depots(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = t(spark, sf_dir, "supplier")
    return (s.where(F.col("s_suppkey") < 3)
            .select(F.col("s_suppkey").alias("company_id"),
                    F.concat(F.lit("DEPOT"), F.col("s_suppkey").cast("string")).alias("company_code"),
                    F.col("s_name").alias("company_name")))


def season_calendar(spark: SparkSession) -> DataFrame:
    """ISO week -> season seed (weeks 14..39 summer)."""
    return spark.range(1, 54).select(
        F.col("id").cast("int").alias("numero_semaine"),
        F.when(F.col("id").between(14, 39), "ete").otherwise("hiver").alias("saison"))


SUPPLY_EXCLUDED_FAMILIES = ("PROMO",)
SUPPLY_EXCLUDED_CODES = ("ART0",)

# The same mapping in SQL, shared by the supply-chain oracles.
SQL_SUPPLY_BASE = """
flows as (
  select l.l_suppkey % 4 as company_id0, l.l_partkey as product_id,
         concat('ART', cast(l.l_partkey as varchar)) as product_code,
         cast(date_trunc('month', l.l_shipdate) as date) as demande_mois, l.l_quantity as quantity
  from lineitem l join orders o on l.l_orderkey = o.o_orderkey
  where o.o_orderstatus in ('F','O')
    and (l.l_returnflag in ('N','A') or (l.l_returnflag = 'R' and l.l_linestatus = 'F'))
),
demand as (
  select case when company_id0 = 3 then 2 else company_id0 end as company_id,
         product_id, product_code, demande_mois,
         sum(quantity) as quantite_demandee, count(*) as nb_mouvements
  from flows where quantity > 0 group by 1, 2, 3, 4
),
products as (
  select p_partkey as product_id, concat('ART', cast(p_partkey as varchar)) as product_code,
         p_name as product_name, 'OWN' as product_owner, p_type as product_family,
         case when p_size <= 45 then 'OUI' else 'NON' end as product_exploit,
         case when p_type in ('SMALL','STANDARD','LARGE') then 'OUI' else 'NON' end as product_planoete,
         case when p_type in ('MEDIUM','STANDARD','LARGE') then 'OUI' else 'NON' end as product_planohiver,
         p_retailprice as purchase_unit_price, p_size as coeff_conditionnement
  from part
),
depots as (
  select s_suppkey as company_id, concat('DEPOT', cast(s_suppkey as varchar)) as company_code,
         s_name as company_name
  from supplier where s_suppkey < 3
),
seasons as (
  select cast(i as integer) as numero_semaine,
         case when i between 14 and 39 then 'ete' else 'hiver' end as saison
  from range(1, 54) r(i)
)"""


def rhu(expr: str, n: int) -> str:
    """SQL twin of ``round_half_up``."""
    return f"cast(round(cast(({expr}) as decimal(38,10)), {n}) as double)"


def supply_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipt lead times: order date → ship date of each line; valid from 0 days."""
    l, o = t(spark, sf_dir, "lineitem"), t(spark, sf_dir, "orders")
    lead = F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date"))
    return (l.join(o, l.l_orderkey == o.o_orderkey)
            .select(F.col("l_partkey").alias("product_id"), lead.alias("lead_days"),
                    (lead >= 0).alias("is_lead_time_valid"), F.col("o_orderdate").alias("start_date")))


def stock_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily stock rows per (entity, item): open lines stand for counted stock."""
    l = t(spark, sf_dir, "lineitem").where(F.col("l_linestatus") == "O")
    return l.select((F.col("l_suppkey") % DEPOT_MOD).alias("id_entity"), F.lit("company").alias("entity_type"),
                    F.concat(F.lit("ART"), F.col("l_partkey").cast("string")).alias("product_code"),
                    F.col("l_partkey").alias("product_id"),
                    F.col("l_shipdate").cast("date").alias("date_system"),
                    F.when(F.col("l_returnflag") == "R", F.lit(0.0)).otherwise(F.col("l_quantity")).alias("stock_at_date"),
                    F.when(F.col("l_discount") > 0, F.col("l_extendedprice") / F.col("l_quantity")).alias("dpa"),
                    "l_orderkey", "l_linenumber", "l_extendedprice")


def supply_on_order(spark: SparkSession, sf_dir: str, as_of) -> DataFrame:
    """Waiting supplier orders (status P) started in the last 60 days, by destination depot."""
    from fieldops.plans.supply import remap_col
    l, o = t(spark, sf_dir, "lineitem"), t(spark, sf_dir, "orders")
    j = l.join(o, l.l_orderkey == o.o_orderkey).where(
        (F.col("o_orderstatus") == "P") & (F.col("o_orderdate").cast("date") >= F.date_sub(F.lit(str(as_of)).cast("date"), 60)))
    j = j.select((F.col("l_suppkey") % DEPOT_MOD).alias("company_id"), F.col("l_partkey").alias("product_id"), "l_quantity")
    return (j.select(remap_col("company_id", DEPOT_REMAP).alias("company_id"), "product_id", "l_quantity")
            .groupBy("company_id", "product_id").agg(F.sum("l_quantity").alias("encours_fournisseur")))
