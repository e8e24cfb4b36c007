"""U — the task ledger: headers, product lines, labels, typed ends and people of one generic task table.

Every event kind (deliveries, loads, receipts, inventories, clock-ins …) is built from the same steps, in
this order, so that tasks are reduced before their lines are joined:

1. ``select_tasks`` filters headers by type, active record, start date and status;
2. ``task_labels`` / ``label_flags`` bring the many-to-many labels to one row per task (no fan-out), and
   ``with_labels`` joins them, required ones as a filter;
3. ``resolve_ends`` looks up what the typed ids of source and destination stand for, required ends as
   a filter;
4. ``line_facts`` joins the product lines and values them.

People, amounts and lead times are tables of their own grain and are reduced before they are joined.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Status ids counted as done (1 FAIT), validated (4 VALIDE), cancelled (3), anomaly (5).
DONE_STATUSES = (1, 4, 3, 5)
REALISED_STATUSES = (1, 4)
# Status codes of a visit that has taken place, and those that were planned.
DONE_CODES = ("FAIT", "ENCOURS")
PLANNED_CODES = ("PREVU", "FAIT", "ENCOURS")


def select_tasks(task: DataFrame, task_types: int | Sequence[int], status_ids: Sequence[int] | None = DONE_STATUSES,
                 need_start: bool = True) -> DataFrame:
    """Active headers of one kind (or several); ``status_ids=None``: of any status."""
    types = [task_types] if isinstance(task_types, int) else list(task_types)
    t = task.where(F.col("idtask_type").isin(*types) & (F.col("code_status_record") == "1"))
    if need_start:
        t = t.where(F.col("real_start_date").isNotNull())
    return t if status_ids is None else t.where(F.col("idtask_status").isin(*status_ids))


# ---------------------------------------------------------------- labels

def task_labels(links: DataFrame, labels: DataFrame, families: DataFrame, pivots: Mapping[str, str],
                prefer: Mapping[str, str] | None = None) -> DataFrame:
    """One row per task that carries a label of any of the families: a column per family.

    links: idtask, idlabel (many to many, may repeat); labels: idlabel, idlabel_family, code; families:
    idlabel_family, code; pivots: column → family code.  Of several labels of a family the greatest code
    stands, or the code that ``prefer`` names for the column if the task has it, else the least.
    Families are reduced to the wanted ones first, so the bridge only carries their links."""
    prefer = prefer or {}
    f = families.where(F.col("code").isin(*pivots.values())).select("idlabel_family", F.col("code").alias("_family"))
    wanted = labels.join(f, "idlabel_family").select("idlabel", "_family", F.col("code").alias("_code"))
    found = []
    for column, family in pivots.items():
        own = F.when(F.col("_family") == family, F.col("_code"))
        if column in prefer:
            best = F.min(F.when(own.isNotNull(), F.struct((own != prefer[column]).alias("later"), own.alias("code"))))
            found.append(best["code"].alias(column))
        else:
            found.append(F.max(own).alias(column))
    return links.join(wanted, "idlabel").groupBy("idtask").agg(*found)


def label_flags(links: DataFrame, labels: DataFrame, flags: Mapping[str, str]) -> DataFrame:
    """One row per task that carries any of the label codes: a boolean column per code (column → code)."""
    wanted = labels.where(F.col("code").isin(*flags.values())).select("idlabel", F.col("code").alias("_code"))
    return links.join(wanted, "idlabel").groupBy("idtask").agg(
        *[F.coalesce(F.bool_or(F.col("_code") == code), F.lit(False)).alias(column) for column, code in flags.items()])


def with_labels(tasks: DataFrame, labels: DataFrame, required: str | None = None,
                having: Mapping[str, str] | None = None) -> DataFrame:
    """Tasks with their label columns.  ``required``: only tasks that carry a label in that column;
    ``having``: only those with these codes."""
    keep = labels
    if required:
        keep = keep.where(F.col(required).isNotNull())
    for column, code in (having or {}).items():
        keep = keep.where(F.col(column) == code)
    return tasks.join(keep, "idtask", "inner" if required or having else "left")


# ---------------------------------------------------------------- typed ends

def typed_directory(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(end_type, end_id, end_code) of all things that a typed id can point to: type → (table, id column)."""
    parts = [df.select(F.lit(kind).alias("end_type"), F.col(key).cast("long").alias("end_id"), F.col("code").alias("end_code"))
             for kind, (df, key) in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def resolve_ends(tasks: DataFrame, directory: DataFrame, ends: Mapping[str, bool],
                 types: Sequence[str] | None = None) -> DataFrame:
    """``source_code`` / ``destination_code`` of the typed ends: end → required.

    One equal join on (type, id) per end, whatever the number of types.  A required end that points nowhere,
    or to a type that is not among ``types``, takes its task away; an optional one gives NULL."""
    d = directory if types is None else directory.where(F.col("end_type").isin(*types))
    for end, required in ends.items():
        own = d.select(F.col("end_type").alias(f"type_product_{end}"), F.col("end_id").alias(f"idproduct_{end}"),
                       F.col("end_code").alias(f"{end}_code"))
        tasks = tasks.join(own, [f"type_product_{end}", f"idproduct_{end}"], "inner" if required else "left")
        if required:
            tasks = tasks.where(F.col(f"{end}_code").isNotNull())
    return tasks


# ---------------------------------------------------------------- lines

HEADER = {"idtask": "task_id", "idcompany_peer": "company_id", "idproduct_source": "product_source_id",
          "idproduct_destination": "product_destination_id", "type_product_source": "product_source_type",
          "type_product_destination": "product_destination_type", "real_start_date": "task_start_date",
          "updated_at": "updated_at", "created_at": "created_at"}


def line_facts(tasks: DataFrame, lines: DataFrame, products: DataFrame, statuses: DataFrame, companies: DataFrame,
               quantity_mode: str = "lines", extra: Sequence[str] = ()) -> DataFrame:
    """One row per task line with quantity and valuation; ``extra``: header columns (labels, ends) to keep.

    lines: idtask_has_product, idtask, idproduct, real_quantity, unit_coeff_multi, unit_coeff_div, net_price;
    products: idproduct, code, purchase_unit_price; statuses: idtask_status, code; companies: idcompany, code.
    quantity_mode ``one``: one unit per task line (telemetry sales).  Repeated rows of a line add up, before
    the lookups, in the partitioning that the join on the task leaves."""
    base_q = (F.lit(1.0) if quantity_mode == "one"
              else F.col("real_quantity") * F.col("unit_coeff_multi") / F.col("unit_coeff_div"))
    kept = [c for c in [*HEADER, "idtask_status", *extra] if c != "idtask"]
    own = ["idtask", "idtask_has_product", "idproduct", "unit_coeff_multi", "unit_coeff_div", "real_quantity", "net_price"]
    g = tasks.select("idtask", *kept).join(lines.select(*own), "idtask").groupBy(*own, *kept).agg(F.sum(base_q).alias("quantity"))
    p = products.select("idproduct", F.col("code").alias("product_code"),
                        F.col("purchase_unit_price").alias("product_unit_price_latest"))
    st = statuses.select("idtask_status", F.col("code").alias("task_status_code"))
    co = companies.select(F.col("idcompany").alias("idcompany_peer"), F.col("code").alias("company_code"))
    j = g.join(st, "idtask_status", "left").join(co, "idcompany_peer", "left").join(p, "idproduct", "left")
    # valuation at the LATEST purchase price, not the price at the time (as the source does)
    value = F.col("quantity").cast("decimal(18,4)") * F.col("product_unit_price_latest").cast("decimal(18,2)")
    return j.select(
        F.col("idtask_has_product").alias("task_product_id"), F.col("idproduct").alias("product_id"),
        *[F.col(c).alias(name) for c, name in HEADER.items()], *extra, "company_code", "product_code", "task_status_code",
        "unit_coeff_multi", "unit_coeff_div", F.col("real_quantity").alias("base_unit_quantity"),
        F.col("net_price").alias("product_unit_price_task"), "product_unit_price_latest", "quantity", value.alias("valuation"))


# ---------------------------------------------------------------- people, amounts, clocks

def task_people(task_resources: DataFrame, resources: DataFrame, resource_type: int = 2) -> DataFrame:
    """U17 — person (type 2) or vehicle (type 3) of a task: ``min(id)`` and ``min(code)`` taken
    independently, as the source does (they may belong to two different people), plus the
    consistent pair ``min(struct(id, code))``."""
    r = resources.where(F.col("idresources_type") == resource_type).select("idresources", "code", "name")
    j = task_resources.join(r, "idresources")
    return j.groupBy("idtask").agg(F.min("idresources").alias("resource_id"), F.min("code").alias("resource_code"),
                                   F.min(F.struct("idresources", "code")).alias("_pair"),
                                   F.count(F.lit(1)).alias("n_resources")).select(
        "idtask", "resource_id", "resource_code", F.col("_pair.idresources").alias("pair_resource_id"),
        F.col("_pair.code").alias("pair_resource_code"), "n_resources")


def load_direction(facts: DataFrame, loading: str | None = None, removing: str | None = None) -> DataFrame:
    """U03 — LOADING / REMOVING: from the task's label flags, by the sign of the quantity where a task has both,
    NULL where it has none.  Without flags (the other ERP's rule) always by the sign."""
    sign = F.when(F.col("base_unit_quantity") < 0, "REMOVING").otherwise("LOADING")
    if not loading or not removing:
        return facts.withColumn("direction", F.when(F.col("base_unit_quantity").isNotNull(), sign))
    has_l, has_r = F.coalesce(F.col(loading), F.lit(False)), F.coalesce(F.col(removing), F.lit(False))
    return facts.withColumn("direction", F.when(has_l & has_r, sign).when(has_r, "REMOVING").when(has_l, "LOADING"))


def cash_counts(tasks: DataFrame, lines: DataFrame, amounts: DataFrame, tenders: Mapping[str, str]) -> DataFrame:
    """U04 — one row per counting task that has a tender line: amount per tender (column → line code), their sum,
    and net and tax from the amounts table.

    lines: idtask, code, sale_amount_net; amounts: idtask, amount_without_tax, tax_amount.  Lines and amounts
    have different grains: each is reduced to the task before they meet, so neither is counted twice.  Codes
    that are no tender count nowhere."""
    wanted = lines.where(F.col("code").isin(*tenders.values()))
    paid = wanted.groupBy("idtask").agg(
        *[F.sum(F.when(F.col("code") == code, F.col("sale_amount_net")).otherwise(F.lit(0).cast("decimal(18,2)"))).alias(column)
          for column, code in tenders.items()], F.sum("sale_amount_net").alias("amount_cash"))
    split = amounts.groupBy("idtask").agg(F.sum("amount_without_tax").alias("amount_net"), F.sum("tax_amount").alias("amount_tax"))
    return tasks.join(paid, "idtask").join(split, "idtask", "left")


def visit_facts(tasks: DataFrame, statuses: DataFrame, people: DataFrame, anomaly_is_planned: bool = True) -> DataFrame:
    """U05 — replenishment visits with the person who made them (required).

    A visit under way counts as done; ``is_planned`` includes anomalies in one ERP only; the duration is that
    of visits whose own status is done, not of promoted ones."""
    st = statuses.select("idtask_status", F.col("code").alias("_raw"))
    raw, planned = F.col("_raw"), [*PLANNED_CODES, *["ANOMALIE"] * anomaly_is_planned]
    seconds = (F.unix_timestamp(F.col("real_end_date").cast("timestamp"))
               - F.unix_timestamp(F.col("real_start_date").cast("timestamp")))
    spent = F.when(raw == "FAIT", seconds)  # NULL if an end is missing
    who = people.select("idtask", F.col("resource_id").alias("person_id"), F.col("resource_code").alias("person_code"))

    def flag(c: Column) -> Column:
        return F.coalesce(c, F.lit(False)).cast("int")

    return (tasks.join(who, "idtask").join(st, "idtask_status", "left")
            .withColumn("task_status_code", F.when(raw.isin(*DONE_CODES), "FAIT").otherwise(raw))
            .withColumn("is_done", flag(raw.isin(*DONE_CODES)))
            .withColumn("is_planned", flag(raw.isin(*planned)))
            .withColumn("is_anomaly", flag(raw == "ANOMALIE"))
            .withColumn("start_date_day", F.col("real_start_date").cast("date"))
            .withColumn("passage_duration_min", spent / 60.0)
            .withColumn("passage_duration_hours", spent / 3600.0).drop("_raw", "idtask_status"))


def first_resource(task_resources: DataFrame) -> DataFrame:
    """U09 — the task's first resource of any type: least id, as an aggregate."""
    return task_resources.groupBy("idtask").agg(F.min("idresources").alias("resources_id"))


def receipt_lead_time(receipts: DataFrame, orders: DataFrame, parent: str = "parent_id",
                      receipt_date: str = "task_start_date", order_date: str = "task_start_date") -> DataFrame:
    """U08 — lead time = receipt date − min(order date of the same parent document); valid if the
    receipt is not before that order (by the clock, so a receipt earlier on the order's day is not valid).
    The order side is aggregated to one row per parent first (no fan-out)."""
    o = orders.groupBy(parent).agg(F.min(order_date).alias("_first_order"))
    lead = F.datediff(F.col(receipt_date).cast("date"), F.col("_first_order").cast("date"))
    return (receipts.join(o, parent, "left").withColumn("delivery_lead_time_days", lead)
            .withColumn("is_lead_time_valid", F.coalesce(F.col(receipt_date) >= F.col("_first_order"), F.lit(False))).drop("_first_order"))
