"""K01–K04d — dimensions: EAV label pivots, product typology, one contract per company, history."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldops.operators.aggs import pivot_labels
from fieldops.operators.history import backfill_leading_nulls, history_view
from fieldops.operators.ledger import task_labels
from fieldops.operators.windows import top1


def label_dimension(entities: DataFrame, links: DataFrame, labels: DataFrame, families: DataFrame,
                    family_columns: Mapping[str, str], key: str = "entity_id",
                    active_family_col: str | None = "is_active") -> DataFrame:
    """K01 — entity dimension from entity ↔ label ↔ label-family links.

    The links are resolved and pivoted at the entity grain first (one hash aggregate with a fixed
    family list), then joined once to the entity table: no fan-out of entity rows by labels.
    ``max`` picks one label when a family holds several; ``is_active`` = lower(label) = 'yes'.
    links: key, idlabel;  labels: idlabel, code, idlabel_family;  families: idlabel_family, code
    """
    lab = (links.where(F.col("idlabel").isNotNull())
           .join(labels.select("idlabel", F.col("code").alias("label_code"), "idlabel_family"), "idlabel")
           .join(families.select("idlabel_family", F.col("code").alias("family_code")), "idlabel_family"))
    wide = pivot_labels(lab, [key], "family_code", "label_code", list(family_columns))
    for fam, colname in family_columns.items():
        wide = wide.withColumnRenamed(fam, colname)
    out = entities.join(wide, key, "left")
    if active_family_col and active_family_col in family_columns.values():
        out = out.withColumn(active_family_col, F.coalesce(F.lower(F.col(active_family_col)) == "yes", F.lit(False)))
    return out


def flag(rule: Sequence[tuple[str, str, object]]) -> Column:
    """A boolean from a list of conditions, any of which suffices: (column, how, value), how being ``is`` (exactly), ``yes`` (the
    value in any case) or ``like``.  NULL is False."""
    out = F.lit(False)
    for column, how, value in rule:
        c = F.col(column)
        one = {"is": lambda: c == F.lit(value), "yes": lambda: F.lower(c) == str(value).lower(), "like": lambda: c.like(value)}[how]()
        out = out | F.coalesce(one, F.lit(False))
    return out


def dimension(entities: DataFrame, key: str, links: DataFrame, labels: DataFrame, families: DataFrame, columns: Mapping[str, str],
              defaults: Mapping[str, str] | None = None, flags: Mapping[str, Sequence[tuple[str, str, object]]] | None = None,
              types: tuple[str, Sequence[int]] | None = None, locations: tuple[DataFrame, DataFrame] | None = None,
              location_type: int = 1, label_column: tuple[str, str] | None = None) -> DataFrame:
    """K01 — any labelled entity as a dimension, from rules: one row per entity, whatever the number of its labels.

    entities: key, code, name …;  links: key, idlabel;  labels: idlabel, idlabel_family, code;  families: idlabel_family, code
    columns: output column → family code (of several labels of a family the greatest code); defaults: output column →
    value where the entity has none;  flags: output column → conditions on any column, see ``flag``;
    types: (column, values) that an entity must have;  locations: (links: key, idlocation, idlocation_type;  table: idlocation …),
    the least location of ``location_type`` counts;  label_column: (code column, name column) → ``label`` 'code - name'.
    Labels are reduced to the entity by the task ledger's bridge, which reads only the wanted families."""
    if types:
        entities = entities.where(F.col(types[0]).isin(*types[1]))
    pivot = task_labels(links.withColumnRenamed(key, "idtask"), labels, families, columns).withColumnRenamed("idtask", key)
    out = entities.join(pivot, key, "left")
    if defaults:
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
    if locations:
        at, table = locations
        first = at.where(F.col("idlocation_type") == location_type).groupBy(key).agg(F.min("idlocation").alias("idlocation"))
        out = out.join(first, key, "left").join(table, "idlocation", "left")
    if flags:
        out = out.withColumns({c: flag(rule) for c, rule in flags.items()})
    if label_column:
        out = out.withColumn("label", F.concat(F.col(label_column[0]), F.lit(" - "), F.col(label_column[1])))
    return out


def purchase_units(units: DataFrame, unit_type: int = 1) -> DataFrame:
    """K02 — the purchase unit of each product: its active unit of the type; of several the greatest coefficient and code,
    taken independently, as the source does.  units: idproduct, idunit_type, isactive, coeff_multi, code"""
    return (units.where((F.col("idunit_type") == unit_type) & (F.col("isactive") == 1)).groupBy("idproduct")
            .agg(F.max("coeff_multi").alias("purchase_unit_coeff"), F.max("code").alias("purchase_unit_code")))


def installed_base(materials: DataFrame, sites: DataFrame, clients: DataFrame, categories: DataFrame) -> DataFrame:
    """K04b — machines with category, site and the site's client; machines whose site or client is unknown stay."""
    s = sites.select("site_id", "client_id", "site_name", "site_address", "site_postal_code")
    c = clients.select("client_id", "client_code", "client_name", "client_address", "partner_name")
    return (materials.join(s, "site_id", "left").join(c, "client_id", "left")
            .join(categories.select("category_id", "category_name"), "category_id", "left")
            .select("material_id", "material_name", "material_brand", "material_serial_number", "category_name", "material_in_service_date",
                    "material_is_active", "client_id", "client_code", "client_address", "client_name", "partner_name", "site_id",
                    "site_address", "site_name", "site_postal_code"))


def ordered_typology(df: DataFrame, rules: Sequence[tuple[Column, Mapping[str, str]]], columns: Sequence[str],
                     undefined: str = "INDEFINI") -> DataFrame:
    """K02 — the first matching rule sets every attribute; no match forces ``undefined`` in all of them
    (a CASE per attribute with the same rule order)."""
    out = df
    for c in columns:
        expr = F.lit(undefined)
        for cond, values in reversed(list(rules)):
            expr = F.when(cond, F.lit(values.get(c, undefined))).otherwise(expr)
        out = out.withColumn(c, expr)
    return out


def one_contract_per_company(contracts: DataFrame) -> DataFrame:
    """K03 — active first, then latest end, latest start, smallest id (a total order)."""
    return top1(contracts, ["company_id"], [F.col("is_active").desc(), F.col("end_date").desc_nulls_last(),
                                           F.col("start_date").desc_nulls_last(), F.col("contract_id")])


def device_history(history: DataFrame, keys: Sequence[str], backfill: Sequence[str]) -> DataFrame:
    """K04 — SCD2 versions as a dimension: half-open validity, floored first version, open end,
    is_current, and leading NULLs of ``backfill`` columns filled with the first known value."""
    v = history_view(history, keys)
    return backfill_leading_nulls(v, keys, ["dbt_valid_from"], backfill)


def client_external_ids(clients: DataFrame, sources: list[DataFrame], id_pattern: str = r"FR_(\d+)",
                        group_like: str = "%FID%") -> DataFrame:
    """K04c — clients enriched with the external id last seen for them across several sources.

    sources: (raw_account_ref, external_id, reference_date) each; the client number is the digits
    captured by ``id_pattern``.  Latest reference date wins (NULL dates last, id as tie-break).
    """
    from fieldops.functions.scalar import regex_first
    from fieldops.operators.aggs import keep_latest
    u = None
    for s in sources:
        x = s.where(F.col("raw_account_ref").isNotNull()).select(
            regex_first("raw_account_ref", id_pattern, 1).try_cast("long").alias("third"),
            F.col("external_id").try_cast("long").alias("third_c4c_id"), "reference_date")
        u = x if u is None else u.unionByName(x)
    latest = keep_latest(u.where(F.col("third").isNotNull()), ["third"], ["reference_date", "third_c4c_id"])
    grp = F.when(F.col("secteur").like(group_like), F.upper("region")).otherwise(F.concat(F.lit("RS "), F.col("categorie")))
    return (clients.join(latest.select("third", "third_c4c_id"), "third", "left")
            .withColumn("third_groupe", grp))


def vehicle_cost_codes(contracts: DataFrame) -> DataFrame:
    """K04d — cost code of each plate from its latest contract; masked plates ('#…') dropped."""
    c = contracts.where(F.col("plate").isNotNull() & ~F.startswith(F.col("plate"), F.lit("#"))
                        & F.col("code_analytique").isNotNull())
    return top1(c, ["plate"], [F.col("effective_date").desc(), F.col("contract_id").desc()]).select("plate", "code_analytique")
