"""Dimension queries K01–K04b."""
from __future__ import annotations

from pyspark.sql import functions as F

from fieldops.catalog import register
from fieldops.catalog.fixtures import t
from fieldops.catalog.ledger_q import FAMILIES as LABEL_FAMILIES, LABELS, _rows
from fieldops.plans import dims

FAMILIES = {"REGION": "region", "SECTEUR": "sector", "ISACTIVE": "is_active", "KA": "key_account"}


def _eav(spark, d):
    c, n = t(spark, d, "customer"), t(spark, d, "nation")
    ents = c.select(F.col("c_custkey").alias("entity_id"), F.col("c_name").alias("entity_name"))
    cn = c.join(n, c.c_nationkey == n.n_nationkey)
    k = F.col("c_custkey")
    # labels as (entity, label code, family id); ids built from family + code
    longf = (cn.select(k.alias("entity_id"), F.col("n_name").alias("code"), F.lit(1).alias("idlabel_family"))
             .unionByName(c.select(k.alias("entity_id"), F.col("c_mktsegment").alias("code"), F.lit(2).alias("idlabel_family")))
             .unionByName(c.where(k % 5 == 0).select(k.alias("entity_id"), F.lit("ZZZ").alias("code"), F.lit(2).alias("idlabel_family")))
             .unionByName(c.select(k.alias("entity_id"), F.when(F.col("c_acctbal") > 0, "YES").otherwise("no").alias("code"),
                                   F.lit(3).alias("idlabel_family")))
             .unionByName(c.where("c_acctbal > 9000").select(k.alias("entity_id"), F.lit("KA1").alias("code"),
                                                             F.lit(4).alias("idlabel_family"))))
    longf = longf.withColumn("idlabel", F.concat_ws(":", F.col("idlabel_family").cast("string"), "code"))
    labels = longf.select("idlabel", "code", "idlabel_family").distinct()
    links = longf.select("entity_id", "idlabel")
    fams = spark.createDataFrame([(1, "REGION"), (2, "SECTEUR"), (3, "ISACTIVE"), (4, "KA")], "idlabel_family int, code string")
    return dims.label_dimension(ents, links, labels, fams, FAMILIES)


@register("k01_label_dimension", sql="""
with lf as (
  select c_custkey as entity_id, n_name as code, 'REGION' as fam from customer join nation on c_nationkey = n_nationkey
  union all select c_custkey, c_mktsegment, 'SECTEUR' from customer
  union all select c_custkey, 'ZZZ', 'SECTEUR' from customer where c_custkey % 5 = 0
  union all select c_custkey, case when c_acctbal > 0 then 'YES' else 'no' end, 'ISACTIVE' from customer
  union all select c_custkey, 'KA1', 'KA' from customer where c_acctbal > 9000)
select c.c_custkey as entity_id, c.c_name as entity_name,
  max(case when fam = 'REGION' then code end) as region, max(case when fam = 'SECTEUR' then code end) as sector,
  coalesce(lower(max(case when fam = 'ISACTIVE' then code end)) = 'yes', false) as is_active,
  max(case when fam = 'KA' then code end) as key_account
from customer c left join lf on c.c_custkey = lf.entity_id group by 1, 2""")
def k01(spark, d):
    return _eav(spark, d)


def _rules():
    return [
    (F.col("p_type") == "SMALL", {"famille": "BOISSON", "sous_famille": "CAFE", "format": "DOSE"}),
    (F.col("p_name").like("%bolt%"), {"famille": "PIECE", "sous_famille": "VISSERIE", "format": "UNITE"}),
    ((F.col("p_type") == "LARGE") & (F.col("p_size") > 25), {"famille": "MATERIEL", "sous_famille": "GRAND", "format": "UNITE"}),
    (F.col("p_brand").like("Brand#1%"), {"famille": "SNACK", "sous_famille": "SUCRE", "format": "SACHET"}),
    ]


@register("k02_product_typology", sql="""
select p_partkey, p_name, p_brand, p_type, p_size, p_retailprice,
  case when p_type = 'SMALL' then 'BOISSON' when p_name like '%bolt%' then 'PIECE'
       when p_type = 'LARGE' and p_size > 25 then 'MATERIEL' when p_brand like 'Brand#1%' then 'SNACK' else 'INDEFINI' end as famille,
  case when p_type = 'SMALL' then 'CAFE' when p_name like '%bolt%' then 'VISSERIE'
       when p_type = 'LARGE' and p_size > 25 then 'GRAND' when p_brand like 'Brand#1%' then 'SUCRE' else 'INDEFINI' end as sous_famille,
  case when p_type = 'SMALL' then 'DOSE' when p_name like '%bolt%' then 'UNITE'
       when p_type = 'LARGE' and p_size > 25 then 'UNITE' when p_brand like 'Brand#1%' then 'SACHET' else 'INDEFINI' end as format
from part""")
def k02(spark, d):
    return dims.ordered_typology(t(spark, d, "part"), _rules(), ["famille", "sous_famille", "format"])


@register("k03_one_contract_per_company", sql="""
with k as (select o_orderkey as contract_id, o_custkey as company_id, o_orderstatus = 'O' as is_active,
             cast(o_orderdate as date) as start_date,
             case when o_orderstatus = 'F' then cast(o_orderdate as date) + interval 365 day end as end_date from orders)
select contract_id, company_id, is_active, start_date, cast(end_date as date) as end_date from k
qualify row_number() over (partition by company_id order by is_active desc, end_date desc nulls last,
                           start_date desc nulls last, contract_id) = 1""")
def k03(spark, d):
    o = t(spark, d, "orders")
    k = o.select(F.col("o_orderkey").alias("contract_id"), F.col("o_custkey").alias("company_id"),
                 (F.col("o_orderstatus") == "O").alias("is_active"), F.col("o_orderdate").cast("date").alias("start_date"),
                 F.when(F.col("o_orderstatus") == "F", F.date_add(F.col("o_orderdate").cast("date"), 365)).alias("end_date"))
    return dims.one_contract_per_company(k)


@register("k04b_technician_dimension_self_join", sql="""
select s.s_suppkey as technician_id, s.s_name as technician_name, n.n_name as nation, r.r_name as region,
       m.s_suppkey as manager_id, m.s_name as manager_name
from supplier s left join nation n on s.s_nationkey = n.n_nationkey left join region r on n.n_regionkey = r.r_regionkey
left join supplier m on m.s_suppkey = s.s_suppkey % 10""")
def k04b(spark, d):
    s, n, r = t(spark, d, "supplier"), t(spark, d, "nation"), t(spark, d, "region")
    m = s.select(F.col("s_suppkey").alias("manager_id"), F.col("s_name").alias("manager_name"))
    return (s.join(n, s.s_nationkey == n.n_nationkey, "left")
            .join(r, n.n_regionkey == r.r_regionkey, "left")
            .join(m, (s.s_suppkey % 10) == m.manager_id, "left")
            .select(F.col("s_suppkey").alias("technician_id"), F.col("s_name").alias("technician_name"),
                    F.col("n_name").alias("nation"), F.col("r_name").alias("region"), "manager_id", "manager_name"))


@register("k04_device_history_dimension", sql="""
with h as (
  select c_custkey, c_mktsegment, case when c_custkey % 3 = 0 then null else c_acctbal end as c_acctbal,
         timestamp '2024-01-01 00:00:00' as dbt_valid_from,
         case when c_custkey % 7 = 0 then timestamp '2024-02-01 00:00:00' end as dbt_valid_to
  from customer
  union all
  select c_custkey, 'MOVED', c_acctbal, timestamp '2024-02-01 00:00:00', null from customer where c_custkey % 7 = 0)
select c_custkey, c_mktsegment,
  coalesce(c_acctbal, first_value(c_acctbal ignore nulls) over (partition by c_custkey order by dbt_valid_from
           rows between unbounded preceding and unbounded following)) as c_acctbal,
  dbt_valid_from, dbt_valid_to,
  case when dbt_valid_from = min(dbt_valid_from) over (partition by c_custkey) then timestamp '2000-01-01 00:00:00'
       else dbt_valid_from end as valid_from,
  coalesce(dbt_valid_to, timestamp '9999-12-31 00:00:00') as valid_to, dbt_valid_to is null as is_current
from h""")
def k04(spark, d):
    c = t(spark, d, "customer")
    k = F.col("c_custkey")
    v1 = c.select("c_custkey", "c_mktsegment", F.when(k % 3 == 0, F.lit(None)).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
                  F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("dbt_valid_from"),
                  F.when(k % 7 == 0, F.lit("2024-02-01 00:00:00")).cast("timestamp_ntz").alias("dbt_valid_to"))
    v2 = c.where(k % 7 == 0).select("c_custkey", F.lit("MOVED").alias("c_mktsegment"), "c_acctbal",
                                    F.lit("2024-02-01 00:00:00").cast("timestamp_ntz").alias("dbt_valid_from"),
                                    F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"))
    return dims.device_history(v1.unionByName(v2), ["c_custkey"], ["c_acctbal"])


@register("k04c_client_external_ids", sql="""
with u as (
  select try_cast(nullif(regexp_extract(raw, 'FR_(\\d+)', 1), '') as bigint) as third, ext as third_c4c_id, reference_date from (
    select case when o_orderkey % 13 = 0 then null else 'FR_' || cast(o_custkey as varchar) end as raw, o_orderkey as ext,
           case when o_orderkey % 17 = 0 then null else o_orderdate end as reference_date from orders) where raw is not null
  union all
  select try_cast(nullif(regexp_extract(raw, 'FR_(\\d+)', 1), '') as bigint), ext, reference_date from (
    select 'FR_' || cast(l_suppkey * 15 as varchar) as raw, l_partkey as ext, l_shipdate as reference_date from lineitem)),
latest as (select * from u where third is not null
           qualify row_number() over (partition by third order by reference_date desc nulls last, third_c4c_id desc) = 1)
select c.c_custkey as third, c.c_name as third_name, c.c_mktsegment as secteur, n.n_name as region,
  'CAT' || cast(c.c_nationkey % 3 as varchar) as categorie, l.third_c4c_id,
  case when c.c_mktsegment like '%ING%' then upper(n.n_name) else 'RS ' || 'CAT' || cast(c.c_nationkey % 3 as varchar) end as third_groupe
from customer c join nation n on c.c_nationkey = n.n_nationkey left join latest l on c.c_custkey = l.third""")
def k04c(spark, d):
    c, n, o, l = (t(spark, d, x) for x in ("customer", "nation", "orders", "lineitem"))
    clients = c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("third"), F.col("c_name").alias("third_name"), F.col("c_mktsegment").alias("secteur"),
        F.col("n_name").alias("region"), F.concat(F.lit("CAT"), (F.col("c_nationkey") % 3).cast("string")).alias("categorie"))
    s1 = o.select(F.when(F.col("o_orderkey") % 13 == 0, F.lit(None)).otherwise(F.concat(F.lit("FR_"), F.col("o_custkey").cast("string")))
                  .alias("raw_account_ref"), F.col("o_orderkey").alias("external_id"),
                  F.when(F.col("o_orderkey") % 17 == 0, F.lit(None)).otherwise(F.col("o_orderdate")).alias("reference_date"))
    s2 = l.select(F.concat(F.lit("FR_"), (F.col("l_suppkey") * 15).cast("string")).alias("raw_account_ref"),
                  F.col("l_partkey").alias("external_id"), F.col("l_shipdate").alias("reference_date"))
    return dims.client_external_ids(clients, [s1, s2], group_like="%ING%")


@register("k04d_vehicle_cost_code", sql="""
with v as (select case when o_orderkey % 9 = 0 then '#' || cast(o_custkey % 700 as varchar)
                       else 'AB-' || cast(o_custkey % 700 as varchar) end as plate,
                  case when o_orderkey % 11 = 0 then null else o_orderpriority end as code_analytique,
                  o_orderdate as effective_date, o_orderkey as contract_id from orders)
select plate, code_analytique from v where plate is not null and not starts_with(plate, '#') and code_analytique is not null
qualify row_number() over (partition by plate order by effective_date desc, contract_id desc) = 1""")
def k04d(spark, d):
    o = t(spark, d, "orders")
    v = o.select(F.when(F.col("o_orderkey") % 9 == 0, F.concat(F.lit("#"), (F.col("o_custkey") % 700).cast("string")))
                 .otherwise(F.concat(F.lit("AB-"), (F.col("o_custkey") % 700).cast("string"))).alias("plate"),
                 F.when(F.col("o_orderkey") % 11 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("code_analytique"),
                 F.col("o_orderdate").alias("effective_date"), F.col("o_orderkey").alias("contract_id"))
    return dims.vehicle_cost_codes(v)


# ---------------------------------------------------------------- one function, five dimensions
# columns (label families are those of the task ledger's fixture), defaults, flags, types and the tables they read
DIMENSIONS = {
    "company": dict(
        table="customer", key="c_custkey", name="c_name", types=("type_id", (1, 2, 4)), located=True,
        columns={"region": "SALE_SOURCE", "status": "SEND_CAUSE", "sector": "MISSION", "kind": "CALL_CATEGORY"}, defaults={"sector": "none"},
        flags={"is_active": [("status", "yes", "send_cause_1")], "is_depot": [("type_id", "is", 4)],
               "is_client": [("code", "like", "E__1"), ("kind", "is", "CALL_CATEGORY_2")]}),
    "device": dict(
        table="customer", key="c_custkey", name="c_mktsegment", types=None, located=True,
        columns={"model": "VISIT_STATE", "owner": "CANCEL_REASON"}, defaults={"owner": "own"},
        flags={"is_active": [("model", "is", "VISIT_STATE_0"), ("model", "is", "VISIT_STATE_3")]}),
    "resource": dict(
        table="supplier", key="s_suppkey", name="s_name", types=("type_id", (2, 3)), located=False,
        columns={"team": "DAY", "zone": "MISSION"}, defaults={}, flags={"is_person": [("type_id", "is", 2)], "is_vehicle": [("type_id", "is", 3)]}),
    "product": dict(
        table="part", key="p_partkey", name="p_name", types=None, located=False,
        columns={"family": "SALE_SOURCE", "brand": "LOAD", "season": "DAY"}, defaults={"family": "undefined", "brand": "undefined"},
        flags={"is_sold": [("family", "like", "SALE%")], "is_bio": [("code", "like", "%7"), ("season", "is", "START_DAY")]}),
    "contract": dict(
        table="orders", key="o_orderkey", name="o_orderpriority", types=("type_id", (0, 1, 5)), located=False,
        columns={"engagement": "DELIVERY_STATE", "billing": "CALL_CATEGORY"}, defaults={"billing": "monthly"},
        flags={"is_firm": [("engagement", "is", "DELIVERED")]}),
}


def _dimension(kind):
    r = DIMENSIONS[kind]
    links = (f"(select id, unnest([((id * 7 + j * 3) % 10) * 10 + (id + j) % 4 for j in range(0, id % 4)]) as idlabel from ent)")
    pick = [f"(select max(l.code) from lk join label l using (idlabel) where lk.id = ent.id and l.fam = {LABEL_FAMILIES.index(f)})" for f in r["columns"].values()]
    how = {"is": lambda c, v: f"{c} = {v!r}", "yes": lambda c, v: f"lower({c}) = {v!r}", "like": lambda c, v: f"{c} like {v!r}"}
    flags = [f"coalesce({' or '.join(f'coalesce({how[h](c, v)}, false)' for c, h, v in rule)}, false) as {name}" for name, rule in r["flags"].items()]
    cols = [f"coalesce({e}, '{r['defaults'][c]}') as {c}" if c in r["defaults"] else f"{e} as {c}" for c, e in zip(r["columns"], pick)]
    where = f"where type_id in {tuple(r['types'][1])}" if r["types"] else ""
    place = (", if(id % 4 = 0, null, n_nationkey) as idlocation, if(id % 4 = 0, null, n_name) as city" if r["located"] else "")
    join = "left join nation on n_nationkey = id % 25" if r["located"] else ""
    sql = f"""with ent as (select {r['key']} as id, {r['name']} as name, 'E' || {r['key']} as code, {r['key']} % 6 as type_id from {r['table']}),
label as (select * from (values {_rows(LABELS)}) v(idlabel, fam, code)), lk as {links},
d as (select ent.*, {', '.join(cols)}{place} from ent {join} {where})
select *, {', '.join(flags)}, code || ' - ' || name as label from d"""

    @register(f"k01_{kind}_dimension", sql=sql)
    def query(spark, d):
        key = F.col(r["key"])
        ents = t(spark, d, r["table"]).select(key.alias("id"), F.col(r["name"]).alias("name"), F.concat(F.lit("E"), key.cast("string")).alias("code"),
                                              (key % 6).alias("type_id"))
        i, j = F.col("id"), F.col("j")
        links = (ents.where("id % 4 > 0").select("id", F.explode(F.sequence(F.lit(0), (i % 4 - 1).cast("int"))).alias("j"))
                 .select("id", (((i * 7 + j * 3) % 10) * 10 + (i + j) % 4).alias("idlabel")))
        labels = spark.createDataFrame(LABELS, "idlabel int, idlabel_family int, code string")
        families = spark.createDataFrame(list(enumerate(LABEL_FAMILIES)), "idlabel_family int, code string")
        places = None
        if r["located"]:  # several places of either type each
            n = t(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("idlocation"), F.col("n_name").alias("city"))
            at = ents.select("id", F.explode(F.array(i % 25, i % 25 + 25, i % 25)).alias("idlocation"),
                             F.when(i % 4 == 0, 2).otherwise(1).alias("idlocation_type"))
            places = (at, n)
        return dims.dimension(ents, "id", links, labels, families, r["columns"], r["defaults"], r["flags"], r["types"], places,
                              label_column=("code", "name"))


for _kind in DIMENSIONS:
    _dimension(_kind)


@register("k02b_product_purchase_unit", sql="""
select p_partkey as product_id, p_name as product_name,
  (select max(l_linenumber * 6) from lineitem where l_partkey = p_partkey and l_linenumber % 2 = 1 and l_suppkey % 3 > 0) as purchase_unit_coeff,
  (select max('U' || l_suppkey) from lineitem where l_partkey = p_partkey and l_linenumber % 2 = 1 and l_suppkey % 3 > 0) as purchase_unit_code
from part""")
def k02b(spark, d):
    l, p = t(spark, d, "lineitem"), t(spark, d, "part")
    units = l.select(F.col("l_partkey").alias("idproduct"), F.when(F.col("l_linenumber") % 2 == 1, 1).otherwise(2).alias("idunit_type"),
                     (F.col("l_suppkey") % 3 > 0).cast("int").alias("isactive"), (F.col("l_linenumber") * 6).alias("coeff_multi"),
                     F.concat(F.lit("U"), F.col("l_suppkey").cast("string")).alias("code"))
    return (p.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"))
            .join(dims.purchase_units(units).withColumnRenamed("idproduct", "product_id"), "product_id", "left"))


@register("k04e_installed_base", sql="""
select o_orderkey as material_id, o_orderpriority as material_name, 'B' || o_orderkey % 7 as material_brand, 'SN' || o_orderkey as material_serial_number,
  r_name as category_name, o_orderdate as material_in_service_date, o_orderstatus <> 'P' as material_is_active, n_nationkey as client_id,
  if(n_nationkey is null, null, 'C' || n_nationkey) as client_code, n_name || ' street' as client_address, n_name as client_name,
  if(n_nationkey is null, null, 'partner ' || n_nationkey % 3) as partner_name, if(o_orderkey % 23 = 0, null, o_custkey) as site_id,
  c_name || ' road' as site_address, c_name as site_name, if(c_custkey is null, null, lpad(c_custkey::varchar, 5, '0')) as site_postal_code
from orders left join customer on c_custkey = o_custkey and o_orderkey % 23 <> 0
left join nation on n_nationkey = c_nationkey and n_nationkey < 20 left join region on r_regionkey = o_orderkey % 6""")
def k04e(spark, d):
    o, c, n, r = (t(spark, d, x) for x in ("orders", "customer", "nation", "region"))
    k = F.col("o_orderkey")
    materials = o.select(k.alias("material_id"), F.col("o_orderpriority").alias("material_name"),
                         F.concat(F.lit("B"), (k % 7).cast("string")).alias("material_brand"),
                         F.concat(F.lit("SN"), k.cast("string")).alias("material_serial_number"), F.col("o_orderdate").alias("material_in_service_date"),
                         (F.col("o_orderstatus") != "P").alias("material_is_active"), F.when(k % 23 != 0, F.col("o_custkey")).alias("site_id"),
                         (k % 6).alias("category_id"))
    ck, nk = F.col("c_custkey"), F.col("n_nationkey")
    sites = c.select(ck.alias("site_id"), F.when(F.col("c_nationkey") < 20, F.col("c_nationkey")).alias("client_id"), F.col("c_name").alias("site_name"),
                     F.concat("c_name", F.lit(" road")).alias("site_address"), F.lpad(ck.cast("string"), 5, "0").alias("site_postal_code"))
    clients = n.select(nk.alias("client_id"), F.concat(F.lit("C"), nk.cast("string")).alias("client_code"), F.col("n_name").alias("client_name"),
                       F.concat("n_name", F.lit(" street")).alias("client_address"),
                       F.concat(F.lit("partner "), (nk % 3).cast("string")).alias("partner_name"))
    return dims.installed_base(materials, sites, clients, r.select(F.col("r_regionkey").alias("category_id"), F.col("r_name").alias("category_name")))
