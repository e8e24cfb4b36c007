"""U — task-ledger queries: orders are task headers of 17 kinds, lines are task products.

Labels hang on tasks through a bridge made of the lines (several per task and family, repeated ones
included), typed ends point to companies, resources and devices or nowhere.  Family and label codes are
invented; the operators take them as parameters.
"""
from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import functions as F

from fieldops.catalog import register
from fieldops.catalog.fixtures import t
from fieldops.operators import ledger as L

#: task types in the order in which orders take them
KINDS = (3, 11, 13, 30, 32, 101, 120, 121, 130, 131, 132, 161, 162, 163, 194, 296, 297)
STATUSES = ((1, "FAIT"), (2, "ENCOURS"), (3, "ANNULE"), (4, "VALIDE"), (5, "ANOMALIE"), (6, "PREVU"))
STATUS_CYCLE = (1, 4, 3, 5, 2, 6, 1)
SOURCE_TYPES = ("COMPANY", "COMPANY", "RESOURCES", "DEVICE")
DESTINATION_TYPES = ("COMPANY", "RESOURCES", "COMPANY", "COMPANY", "DEVICE")
FAMILIES = ("SALE_SOURCE", "SEND_CAUSE", "DELIVERY_STATE", "CALL_CATEGORY", "VISIT_STATE", "VISIT_OBJECT",
            "CANCEL_REASON", "MISSION", "LOAD", "DAY")
NAMED = {20: "DELIVERED", 80: "LOADING", 81: "REMOVING", 90: "START_DAY", 91: "END_DAY"}
LABELS = tuple((10 * f + k, f, NAMED.get(10 * f + k, f"{name}_{k}")) for f, name in enumerate(FAMILIES) for k in range(4))
CATEGORIES = tuple((f"CALL_CATEGORY_{k}", name) for k, name in enumerate(("breakdown", "payment", "cleaning")))
TENDERS = {"amount_coins": "COIN", "amount_notes": "NOTE", "amount_vouchers": "VOUCHER"}
WANTED_OBJECT = "VISIT_OBJECT_2"


def _pick(values, index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _tables(spark, d) -> SimpleNamespace:
    o, l, p, c, s = (t(spark, d, x) for x in ("orders", "lineitem", "part", "customer", "supplier"))
    key, cust, turn = F.col("o_orderkey"), F.col("o_custkey"), F.expr("o_orderkey div 17")
    start = F.when(key % 97 != 0, F.col("o_orderdate") + F.make_dt_interval(hours=(key % 24).cast("int")))
    minutes = F.make_dt_interval(mins=(cust % 300).cast("int"))
    src, dst = _pick(SOURCE_TYPES, turn % 4), _pick(DESTINATION_TYPES, turn % 5)
    far = F.when(key % 13 == 0, cust + 1000000)

    def end(kind, company):
        return F.when(key % 29 != 0, F.coalesce(far, F.when(kind == "COMPANY", company).when(kind == "RESOURCES", cust % 10).otherwise(cust % 50)))

    task = o.select(
        key.alias("idtask"), _pick(KINDS, key % 17).alias("idtask_type"), _pick(STATUS_CYCLE, turn % 7).alias("idtask_status"),
        F.when(key % 50 == 0, "0").otherwise("1").alias("code_status_record"), start.alias("real_start_date"),
        F.when(key % 23 != 0, start + minutes).alias("real_end_date"), cust.alias("idcompany_peer"), (cust % 50).alias("iddevice"),
        F.when(key % 19 != 0, cust).alias("parent_id"), end(src, cust).alias("idproduct_source"), src.alias("type_product_source"),
        end(dst, (cust * 7 + 3) % 150).alias("idproduct_destination"), dst.alias("type_product_destination"),
        (F.col("o_orderdate") + F.expr("interval 1 day")).alias("updated_at"), F.col("o_orderdate").alias("created_at"))
    price, tax = F.col("l_extendedprice").cast("decimal(18,2)"), F.col("l_tax").cast("decimal(4,2)")
    lines = l.select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("idtask_has_product"), F.col("l_orderkey").alias("idtask"),
        F.col("l_partkey").alias("idproduct"), _pick(("COIN", "NOTE", "VOUCHER", "TOKEN"), F.col("l_partkey") % 4).alias("code"),
        F.when(F.col("l_partkey") % 9 == 0, -F.col("l_quantity")).otherwise(F.col("l_quantity")).alias("real_quantity"),
        F.col("l_linenumber").alias("unit_coeff_multi"), F.lit(1).alias("unit_coeff_div"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("net_price"), price.alias("sale_amount_net"),
        (price * (1 + tax)).alias("sale_amount_net_tax"))
    return SimpleNamespace(
        task=task, lines=lines,
        products=p.select(F.col("p_partkey").alias("idproduct"), F.concat(F.lit("ART"), F.col("p_partkey").cast("string")).alias("code"),
                          F.col("p_retailprice").alias("purchase_unit_price")),
        statuses=spark.createDataFrame(STATUSES, "idtask_status int, code string"),
        companies=c.select(F.col("c_custkey").alias("idcompany"), F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("code")),
        devices=c.where("c_custkey < 50").select(F.col("c_custkey").alias("iddevice"),
                                                 F.concat(F.lit("D"), F.col("c_custkey").cast("string")).alias("code")),
        resources=s.select(F.col("s_suppkey").alias("idresources"),
                           F.when(F.col("s_suppkey") % 2 == 0, 2).otherwise(3).alias("idresources_type"),
                           F.concat(F.lit("R"), F.col("s_suppkey").cast("string")).alias("code"), F.col("s_name").alias("name")),
        line_resources=l.select(F.col("l_orderkey").alias("idtask"), F.col("l_suppkey").alias("idresources")).distinct(),
        task_resources=l.where("l_linenumber >= 2").select(F.col("l_orderkey").alias("idtask"), F.col("l_suppkey").alias("idresources")).distinct(),
        links=l.select(F.col("l_orderkey").alias("idtask"), ((F.col("l_partkey") % 10) * 10 + F.col("l_linenumber") % 4).alias("idlabel")),
        labels=spark.createDataFrame(LABELS, "idlabel int, idlabel_family int, code string"),
        families=spark.createDataFrame(list(enumerate(FAMILIES)), "idlabel_family int, code string"),
        amounts=l.where("l_linenumber <= 2").select(F.col("l_orderkey").alias("idtask"), price.alias("amount_without_tax"),
                                                    (price * tax).alias("tax_amount")))


def _directory(x, devices: bool = False):
    kinds = {"COMPANY": (x.companies, "idcompany"), "RESOURCES": (x.resources, "idresources")}
    return L.typed_directory({**kinds, "DEVICE": (x.devices, "iddevice")} if devices else kinds)


def _labels(x, prefer=None, **pivots):
    return L.task_labels(x.links, x.labels, x.families, pivots, prefer)


def _lines(x, tasks, **kw):
    return L.line_facts(tasks, x.lines, x.products, x.statuses, x.companies, **kw)


def _rows(values) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in values)


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


SQL_BASE = f"""
raw as (select *, o_orderkey // 17 as turn, {_list(SOURCE_TYPES)}[(o_orderkey // 17) % 4 + 1] as st,
   {_list(DESTINATION_TYPES)}[(o_orderkey // 17) % 5 + 1] as dt,
   case when o_orderkey % 97 <> 0 then o_orderdate + to_hours(o_orderkey % 24) end as start from orders),
task as (select o_orderkey as idtask, {_list(KINDS)}[o_orderkey % 17 + 1] as idtask_type, {_list(STATUS_CYCLE)}[turn % 7 + 1] as idtask_status,
   o_orderkey % 50 <> 0 as live, start as real_start_date,
   case when o_orderkey % 23 <> 0 then start + to_minutes(o_custkey % 300) end as real_end_date, o_custkey as idcompany_peer,
   o_custkey % 50 as iddevice, case when o_orderkey % 19 <> 0 then o_custkey end as parent_id, st as type_product_source, dt as type_product_destination,
   case when o_orderkey % 29 = 0 then null when o_orderkey % 13 = 0 then o_custkey + 1000000 when st = 'COMPANY' then o_custkey
        when st = 'RESOURCES' then o_custkey % 10 else o_custkey % 50 end as idproduct_source,
   case when o_orderkey % 29 = 0 then null when o_orderkey % 13 = 0 then o_custkey + 1000000 when dt = 'COMPANY' then (o_custkey * 7 + 3) % 150
        when dt = 'RESOURCES' then o_custkey % 10 else o_custkey % 50 end as idproduct_destination,
   o_orderdate + interval 1 day as updated_at, o_orderdate as created_at from raw),
lines as (select l_orderkey * 100 + l_linenumber as idtask_has_product, l_orderkey as idtask, l_partkey as idproduct,
   ['COIN', 'NOTE', 'VOUCHER', 'TOKEN'][l_partkey % 4 + 1] as code, case when l_partkey % 9 = 0 then -l_quantity else l_quantity end as real_quantity,
   l_linenumber as unit_coeff_multi, 1 as unit_coeff_div, l_extendedprice / l_quantity as net_price,
   l_extendedprice::decimal(18,2) as amt, l_extendedprice::decimal(18,2) * (1 + l_tax::decimal(4,2)) as amt_tax from lineitem),
codes as (select idtask_status, code from (values {_rows(STATUSES)}) v(idtask_status, code)),
ends as (select 'COMPANY' as kind, c_custkey as id, concat('C', c_custkey) as code from customer
   union all select 'RESOURCES', s_suppkey, concat('R', s_suppkey) from supplier),
label as (select * from (values {_rows(LABELS)}) v(idlabel, fam, code)),
carried as (select l_orderkey as idtask, label.fam, label.code from lineitem, label
   where label.idlabel = (l_partkey % 10) * 10 + l_linenumber % 4),
crew as (select distinct l_orderkey as idtask, l_suppkey as id, s_suppkey % 2 = 0 as person from lineitem
   join supplier on s_suppkey = l_suppkey where l_linenumber >= 2)"""


def _code(family: str, preferred: str | None = None) -> str:
    """The label code of a task in a family, from the list of all it carries."""
    codes = f"(select list(code) from carried x where x.idtask = task.idtask and x.fam = {FAMILIES.index(family)})"
    if preferred:
        return f"case when list_contains({codes}, '{preferred}') then '{preferred}' else list_min({codes}) end"
    return f"list_max({codes})"


def _end(end: str, kinds=("COMPANY", "RESOURCES")) -> str:
    return (f"(select e.code from ends e where e.kind = task.type_product_{end} and e.id = task.idproduct_{end} "
            f"and e.kind in ({', '.join(repr(k) for k in kinds)}))")


def sql_tasks(types, statuses=L.DONE_STATUSES, need_start=True, **more) -> str:
    """Headers of one kind; more: column → expression over ``task``."""
    types = [types] if isinstance(types, int) else list(types)
    where = [f"list_contains({_list(types)}, idtask_type)", "live"] + ["real_start_date is not null"] * need_start
    if statuses is not None:
        where.append(f"list_contains({_list(statuses)}, idtask_status)")
    columns = "".join(f", {e} as {c}" for c, e in more.items())
    return f"select task.*{columns} from task where {' and '.join(where)}"


def sql_lines(tasks: str, one=False, extra=(), where="true") -> str:
    q = "1.0::double" if one else "(l.real_quantity * l.unit_coeff_multi / l.unit_coeff_div)"
    price = "(select p_retailprice from part where p_partkey = l.idproduct)"
    return f"""select l.idtask_has_product as task_product_id, l.idproduct as product_id, h.idtask as task_id,
  h.idcompany_peer as company_id, h.idproduct_source as product_source_id, h.idproduct_destination as product_destination_id,
  h.type_product_source as product_source_type, h.type_product_destination as product_destination_type,
  h.real_start_date as task_start_date, h.updated_at, h.created_at{''.join(f', h.{c}' for c in extra)},
  (select concat('C', c_custkey) from customer where c_custkey = h.idcompany_peer) as company_code,
  (select concat('ART', p_partkey) from part where p_partkey = l.idproduct) as product_code,
  (select code from codes where codes.idtask_status = h.idtask_status) as task_status_code, l.unit_coeff_multi, l.unit_coeff_div,
  l.real_quantity as base_unit_quantity, l.net_price as product_unit_price_task, {price} as product_unit_price_latest,
  {q} as quantity, {q}::decimal(18,4) * {price}::decimal(18,2) as valuation
from ({tasks}) h, lines l where l.idtask = h.idtask and {where}"""


def _with(*parts: str) -> str:
    return f"with {SQL_BASE}, {', '.join(parts[:-1])} {parts[-1]}" if len(parts) > 1 else f"with {SQL_BASE} {parts[0]}"


# ---------------------------------------------------------------- kinds with labels

_SALE = {"telemetry_source": _code("SALE_SOURCE"), "telemetry_send_cause": _code("SEND_CAUSE")}


@register("u01_telemetry_sale", sql=_with(
    f"f as ({sql_lines(sql_tasks(3, L.REALISED_STATUSES, **_SALE), one=True, extra=_SALE, where='h.telemetry_source is not null')})",
    """select f.*, x.amt as sale_amount_net, x.amt_tax as sale_amount_net_tax
from f, lines x where x.idtask_has_product = f.task_product_id"""))
def u01(spark, d):
    """Sales that carry a source label; cause and amounts beside it; one unit a line."""
    x = _tables(spark, d)
    lab = _labels(x, telemetry_source="SALE_SOURCE", telemetry_send_cause="SEND_CAUSE")
    tasks = L.with_labels(L.select_tasks(x.task, 3, L.REALISED_STATUSES), lab, required="telemetry_source")
    amounts = x.lines.select(F.col("idtask").alias("task_id"), F.col("idtask_has_product").alias("task_product_id"),
                             "sale_amount_net", "sale_amount_net_tax")
    f = _lines(x, tasks, quantity_mode="one", extra=("telemetry_source", "telemetry_send_cause"))
    return f.join(amounts, ["task_id", "task_product_id"])


@register("u03_machine_load_direction", sql=_with(
    f"f as ({sql_lines(sql_tasks(13))})",
    """n as (select f.*, (select count(*) from carried x where x.idtask = f.task_id and x.code = 'LOADING') as up,
  (select count(*) from carried x where x.idtask = f.task_id and x.code = 'REMOVING') as down from f)""",
    """select * exclude (up, down), case when up > 0 and (down = 0 or base_unit_quantity >= 0) then 'LOADING'
  when down > 0 then 'REMOVING' end as direction from n"""))
def u03(spark, d):
    """By label; the sign decides where a task carries both."""
    x = _tables(spark, d)
    flags = L.label_flags(x.links, x.labels, {"has_loading": "LOADING", "has_removing": "REMOVING"})
    f = _lines(x, L.with_labels(L.select_tasks(x.task, 13), flags), extra=("has_loading", "has_removing"))
    return L.load_direction(f, "has_loading", "has_removing").drop("has_loading", "has_removing")


@register("u03b_machine_load_by_sign", sql=_with(
    f"f as ({sql_lines(sql_tasks(13))})", "select *, if(base_unit_quantity < 0, 'REMOVING', 'LOADING') as direction from f"))
def u03b(spark, d):
    x = _tables(spark, d)
    return L.load_direction(_lines(x, L.select_tasks(x.task, 13)))


_ORDER = {"source_code": _end("source", ["COMPANY"]), "destination_code": _end("destination", ["COMPANY"]),
          "delivery_status_code": _code("DELIVERY_STATE")}


@register("u07_supplier_order", sql=_with(sql_lines(
    sql_tasks(120, None, **_ORDER), extra=_ORDER, where="h.source_code is not null and h.destination_code is not null")))
def u07(spark, d):
    """Orders between companies, of any status, with their delivery status where they carry one."""
    x = _tables(spark, d)
    tasks = L.resolve_ends(L.select_tasks(x.task, 120, None), _directory(x), {"source": True, "destination": True}, ["COMPANY"])
    return _lines(x, L.with_labels(tasks, _labels(x, delivery_status_code="DELIVERY_STATE")), extra=tuple(_ORDER))


@register("u09_service_call", sql=_with(
    f"h as ({sql_tasks(130, None, False, call_category_code=_code('CALL_CATEGORY'))})",
    f"""select idtask as task_id, idcompany_peer as company_id, iddevice as device_id,
  (select min(id) from (select l_orderkey as idtask, l_suppkey as id from lineitem where l_linenumber >= 2) r where r.idtask = h.idtask) as resources_id,
  (select concat('C', c_custkey) from customer where c_custkey = idcompany_peer) as company_code, concat('D', iddevice) as device_code,
  (select code from codes where codes.idtask_status = h.idtask_status) as task_status_code, call_category_code,
  (select c.name from (values {_rows(CATEGORIES)}) c(code, name) where c.code = call_category_code) as call_category_label,
  real_start_date as task_start_date, real_end_date as task_end_date from h"""))
def u09(spark, d):
    """Calls of any status and date, one row each: category by label and lookup, first resource."""
    x = _tables(spark, d)
    tasks = L.with_labels(L.select_tasks(x.task, 130, None, need_start=False), _labels(x, call_category_code="CALL_CATEGORY"))
    cats = spark.createDataFrame(CATEGORIES, "call_category_code string, call_category_label string")
    return (tasks.join(L.first_resource(x.task_resources), "idtask", "left").join(cats, "call_category_code", "left")
            .join(x.statuses.select("idtask_status", F.col("code").alias("task_status_code")), "idtask_status", "left")
            .join(x.companies.select(F.col("idcompany").alias("idcompany_peer"), F.col("code").alias("company_code")), "idcompany_peer", "left")
            .join(x.devices.select("iddevice", F.col("code").alias("device_code")), "iddevice", "left")
            .select(F.col("idtask").alias("task_id"), F.col("idcompany_peer").alias("company_id"), F.col("iddevice").alias("device_id"),
                    "resources_id", "company_code", "device_code", "task_status_code", "call_category_code", "call_category_label",
                    F.col("real_start_date").alias("task_start_date"), F.col("real_end_date").alias("task_end_date")))


_VISIT = {"visit_state": "VISIT_STATE", "visit_object": "VISIT_OBJECT", "mission": "MISSION", "cancel_reason": "CANCEL_REASON"}


@register("u10_technical_intervention_having_label", sql=_with(
    f"h as ({sql_tasks(131, **{c: _code(f) for c, f in _VISIT.items()})})",
    f"""select distinct h.idtask as task_id, idcompany_peer as company_id, l.idproduct as product_id, visit_state, visit_object, mission,
  cancel_reason, real_start_date as task_start_date, real_end_date as task_end_date,
  (select code from codes where codes.idtask_status = h.idtask_status) as task_status_code
from h left join lines l on l.idtask = h.idtask where visit_object = '{WANTED_OBJECT}'"""))
def u10(spark, d):
    """Interventions whose object label is the wanted one, a row per task and product."""
    x = _tables(spark, d)
    tasks = L.with_labels(L.select_tasks(x.task, 131), _labels(x, **_VISIT), having={"visit_object": WANTED_OBJECT})
    used = x.lines.select("idtask", F.col("idproduct").alias("product_id")).distinct()
    return (tasks.join(used, "idtask", "left")
            .join(x.statuses.select("idtask_status", F.col("code").alias("task_status_code")), "idtask_status", "left")
            .select(F.col("idtask").alias("task_id"), F.col("idcompany_peer").alias("company_id"), "product_id", *_VISIT,
                    F.col("real_start_date").alias("task_start_date"), F.col("real_end_date").alias("task_end_date"), "task_status_code"))


@register("u10b_technical_intervention_person", sql=_with(
    f"h as ({sql_tasks(131, None, **{c: _code(f) for c, f in _VISIT.items() if c != 'mission'})})",
    """select h.idtask as task_id, idcompany_peer as company_id, iddevice as device_id, min(crew.id) as resources_id,
  any_value(visit_state) as visit_state, any_value(visit_object) as visit_object, any_value(cancel_reason) as cancel_reason,
  any_value(real_start_date) as task_start_date from h join crew on crew.idtask = h.idtask and crew.person group by all"""))
def u10b(spark, d):
    """The other ERP: interventions of any status with a person (required, the first one)."""
    x = _tables(spark, d)
    pivots = {c: f for c, f in _VISIT.items() if c != "mission"}
    people = L.task_people(x.task_resources, x.resources, 2).select("idtask", F.col("resource_id").alias("resources_id"))
    return (L.with_labels(L.select_tasks(x.task, 131, None), _labels(x, **pivots)).join(people, "idtask")
            .select(F.col("idtask").alias("task_id"), F.col("idcompany_peer").alias("company_id"), F.col("iddevice").alias("device_id"),
                    "resources_id", *pivots, F.col("real_start_date").alias("task_start_date")))


_INTERNAL = {"source_code": _end("source"), "destination_code": _end("destination"), "label_code": _code("DELIVERY_STATE", "DELIVERED")}


@register("u11_internal_order_dedupe", sql=_with(sql_lines(
    sql_tasks(132, **_INTERNAL), extra=_INTERNAL,
    where="h.source_code is not null and h.destination_code is not null and h.label_code is not null")))
def u11(spark, d):
    """Orders between typed ends that carry a delivery label: the delivered one first, one row per line."""
    x = _tables(spark, d)
    tasks = L.resolve_ends(L.select_tasks(x.task, 132), _directory(x), {"source": True, "destination": True})
    lab = _labels(x, {"label_code": "DELIVERED"}, label_code="DELIVERY_STATE")
    return _lines(x, L.with_labels(tasks, lab, required="label_code"), extra=tuple(_INTERNAL))


@register("u15_clock_in_out", sql=_with(
    f"h as ({sql_tasks(194, None, False)})",
    """select h.idtask as task_id, idcompany_peer as company_id, r.id as person_id, r.code as person_code, x.code as label_code,
  (select code from codes where codes.idtask_status = h.idtask_status) as task_status_code,
  real_start_date as clocked_at, real_start_date::date as clocked_day
from h join (select distinct idtask, code from carried where code in ('START_DAY', 'END_DAY')) x on x.idtask = h.idtask
join (select idtask, min(id) as id, min(concat('R', id)) as code from crew where person group by 1) r on r.idtask = h.idtask"""))
def u15(spark, d):
    """Clock events by label id, a row per task and label; the person is required."""
    x = _tables(spark, d)
    clock = x.labels.where(F.col("idlabel").isin(90, 91)).select("idlabel", F.col("code").alias("label_code"))
    marks = x.links.join(clock, "idlabel").select("idtask", "label_code").distinct()
    people = L.task_people(x.task_resources, x.resources, 2).select(
        "idtask", F.col("resource_id").alias("person_id"), F.col("resource_code").alias("person_code"))
    return (L.select_tasks(x.task, 194, None, need_start=False).join(marks, "idtask").join(people, "idtask")
            .join(x.statuses.select("idtask_status", F.col("code").alias("task_status_code")), "idtask_status", "left")
            .select(F.col("idtask").alias("task_id"), F.col("idcompany_peer").alias("company_id"), "person_id", "person_code", "label_code",
                    "task_status_code", F.col("real_start_date").alias("clocked_at"), F.col("real_start_date").cast("date").alias("clocked_day")))


# ---------------------------------------------------------------- kinds with typed ends

def _vehicles(x):
    return L.task_people(x.task_resources, x.resources, 3).select(
        F.col("idtask").alias("task_id"), F.col("resource_id").alias("vehicle_id"), F.col("resource_code").alias("vehicle_code"))


@register("u02_unsold", sql=_with(
    f"""f as ({sql_lines(sql_tasks(11, destination_code=_end('destination')), extra=['destination_code'], where='h.destination_code is not null')})""",
    """v as (select idtask, min(id) as vehicle_id, min(concat('R', id)) as vehicle_code from crew where not person group by 1)""",
    "select f.*, vehicle_id, vehicle_code from f left join v on v.idtask = f.task_id"))
def u02(spark, d):
    """Returns whose destination, a company or a resource, exists; with the vehicle."""
    x = _tables(spark, d)
    tasks = L.resolve_ends(L.select_tasks(x.task, 11), _directory(x), {"destination": True})
    return _lines(x, tasks, extra=("destination_code",)).join(_vehicles(x), "task_id", "left")


@register("u02b_unsold_realised", sql=_with(sql_lines(sql_tasks(11, L.REALISED_STATUSES))))
def u02b(spark, d):
    """The other ERP: only realised returns, wherever they go."""
    x = _tables(spark, d)
    return _lines(x, L.select_tasks(x.task, 11, L.REALISED_STATUSES))


def _two_ends(name, types, statuses, kinds=("COMPANY", "RESOURCES"), ends=("source", "destination"), kind_column=False):
    columns = {f"{e}_code": _end(e, kinds) for e in ends}
    if kind_column:
        columns["idtask_type"] = None
    extra = tuple(columns)
    sql = sql_lines(sql_tasks(types, statuses, **{c: e for c, e in columns.items() if e}), extra=extra,
                    where=" and ".join(f"h.{e}_code is not null" for e in ends))

    @register(name, sql=_with(sql))
    def query(spark, d):
        x = _tables(spark, d)
        tasks = L.resolve_ends(L.select_tasks(x.task, types, statuses), _directory(x), dict.fromkeys(ends, True), kinds)
        return _lines(x, tasks, extra=extra)


_two_ends("u12_internal_delivery", 161, L.DONE_STATUSES)
_two_ends("u13_inventory", 162, L.DONE_STATUSES, ends=("source",))
_two_ends("u14_inventory_gap", 163, L.DONE_STATUSES, ends=("source",))
# production in (296) and out (297): companies at both ends, of any status
_two_ends("u16_production_in_out", (296, 297), None, kinds=("COMPANY",), kind_column=True)

_ALL_ENDS = _end("source", ["COMPANY", "RESOURCES", "DEVICE"]).replace(
    "from ends e", "from (select * from ends union all select 'DEVICE', c_custkey, concat('D', c_custkey) from customer where c_custkey < 50) e")


@register("u18_optional_ends_of_all_kinds", sql=_with(
    f"""select idtask as task_id, idtask_type, type_product_source as product_source_type, idproduct_source as product_source_id,
  {_ALL_ENDS} as source_code, {_ALL_ENDS.replace('source', 'destination')} as destination_code from task where live"""))
def u18(spark, d):
    """The resolver with optional ends over companies, resources and devices: no task is lost."""
    x = _tables(spark, d)
    tasks = L.select_tasks(x.task, KINDS, None, need_start=False)
    out = L.resolve_ends(tasks, _directory(x, devices=True), {"source": False, "destination": False})
    return out.select(F.col("idtask").alias("task_id"), "idtask_type", F.col("type_product_source").alias("product_source_type"),
                      F.col("idproduct_source").alias("product_source_id"), "source_code", "destination_code")


# ---------------------------------------------------------------- the plain shape, receipts, people, amounts, visits

@register("u06_customer_delivery", sql=_with(sql_lines(sql_tasks(101))))
def u06(spark, d):
    x = _tables(spark, d)
    return _lines(x, L.select_tasks(x.task, 101))


@register("u08_receipt_lead_time", sql=_with(
    f"r as ({sql_lines(sql_tasks(121, destination_code=_end('destination', ['COMPANY'])), extra=['parent_id', 'destination_code'])})",
    """select r.*, date_diff('day', o.first::date, r.task_start_date::date) as delivery_lead_time_days,
  coalesce(r.task_start_date >= o.first, false) as is_lead_time_valid
from r left join lateral (select min(real_start_date) as first from task where idtask_type = 120 and live and task.parent_id = r.parent_id) o on true"""))
def u08(spark, d):
    """Receipts against the first order, of any status, of the same parent document."""
    x = _tables(spark, d)
    tasks = L.resolve_ends(L.select_tasks(x.task, 121), _directory(x), {"destination": False}, ["COMPANY"])
    orders = L.select_tasks(x.task, 120, None, need_start=False).where("parent_id is not null")
    return L.receipt_lead_time(_lines(x, tasks, extra=("parent_id", "destination_code")), orders, order_date="real_start_date")


@register("u17_task_person_vehicle", sql="""
select idtask, min(s_suppkey) as resource_id, min(concat('R', s_suppkey)) as resource_code, min(s_suppkey) as pair_resource_id,
  concat('R', min(s_suppkey)) as pair_resource_code, count(*) as n_resources
from (select distinct l_orderkey as idtask, l_suppkey from lineitem) join supplier on s_suppkey = l_suppkey
where s_suppkey % 2 = 0 group by 1""")
def u17(spark, d):
    """The people of every line, the first one's included."""
    x = _tables(spark, d)
    return L.task_people(x.line_resources, x.resources, 2)


_CASH = ", ".join(f"coalesce(sum(amt) filter (code = '{code}'), 0) as {column}" for column, code in TENDERS.items())


@register("u04_cash_count_by_tender", sql=_with(
    f"h as ({sql_tasks(30, None)})",
    f"""paid as (select idtask, {_CASH}, sum(amt) as amount_cash from lines where code <> 'TOKEN' group by 1)""",
    """select h.idtask as task_id, h.iddevice as device_id, h.idcompany_peer as company_id, h.real_start_date as task_start_date,
  paid.* exclude (idtask), (select sum(l_extendedprice::decimal(18,2)) from lineitem where l_orderkey = h.idtask and l_linenumber <= 2) as amount_net,
  (select sum(l_extendedprice::decimal(18,2) * l_tax::decimal(4,2)) from lineitem where l_orderkey = h.idtask and l_linenumber <= 2) as amount_tax
from h, paid where paid.idtask = h.idtask"""))
def u04(spark, d):
    x = _tables(spark, d)
    out = L.cash_counts(L.select_tasks(x.task, 30, None), x.lines, x.amounts, TENDERS)
    return out.select(F.col("idtask").alias("task_id"), F.col("iddevice").alias("device_id"), F.col("idcompany_peer").alias("company_id"),
                      F.col("real_start_date").alias("task_start_date"), *TENDERS, "amount_cash", "amount_net", "amount_tax")


def _visits(name, anomaly_is_planned):
    planned = [*L.PLANNED_CODES, *["ANOMALIE"] * anomaly_is_planned]
    spent = "case when s.code = 'FAIT' then date_diff('second', real_start_date, real_end_date) end"

    @register(name, sql=_with(
        f"h as ({sql_tasks(32, None)})",
        f"""select h.idtask as task_id, iddevice as device_id, idcompany_peer as company_id, r.id as person_id, r.code as person_code,
  if(s.code = 'ENCOURS', 'FAIT', s.code) as task_status_code, (s.code in ('FAIT', 'ENCOURS'))::int as is_done,
  list_contains({_list(planned)}, s.code)::int as is_planned, (s.code = 'ANOMALIE')::int as is_anomaly,
  real_start_date as task_start_date, real_end_date as task_end_date, real_start_date::date as start_date_day,
  {spent} / 60.0 as passage_duration_min, {spent} / 3600.0 as passage_duration_hours
from h join codes s on s.idtask_status = h.idtask_status
join (select idtask, min(id) as id, min(concat('R', id)) as code from crew where person group by 1) r on r.idtask = h.idtask"""))
    def query(spark, d):
        x = _tables(spark, d)
        out = L.visit_facts(L.select_tasks(x.task, 32, None), x.statuses, L.task_people(x.task_resources, x.resources, 2), anomaly_is_planned)
        return out.select(
            F.col("idtask").alias("task_id"), F.col("iddevice").alias("device_id"), F.col("idcompany_peer").alias("company_id"), "person_id",
            "person_code", "task_status_code", "is_done", "is_planned", "is_anomaly", F.col("real_start_date").alias("task_start_date"),
            F.col("real_end_date").alias("task_end_date"), "start_date_day", "passage_duration_min", "passage_duration_hours")


_visits("u05_replenishment_visit", True)
_visits("u05b_replenishment_visit_anomaly_unplanned", False)
