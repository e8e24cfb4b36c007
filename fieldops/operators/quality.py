"""Q — data-quality checks as one result table (check, table, column, severity, failures, status).

All row-predicate checks on a table (not null, accepted values, expression, range, recency, row
count) are folded into ONE aggregate pass over that table; key checks (unique, unique combination)
are one grouped aggregation each; foreign keys are one anti-join each.  Nothing is collected: the
result is a DataFrame, written or shown like any other.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT_COLS = ["check_name", "table_name", "column_name", "severity", "failures", "status"]


@dataclass
class Check:
    name: str
    kind: str            # not_null | unique | unique_combination | accepted_values | relationships |
                         # expression | range | row_count | recency | freshness | assertion
    table: str
    column: str | None = None
    severity: str = "error"
    params: dict = field(default_factory=dict)
    warn_if: str = ">0"  # Q11 thresholds, dbt style
    error_if: str = ">0"
    parents: Sequence[str] = ()   # Q16: tables this check reads (defaults to ``table``)


def _threshold(failures: Column, spec: str) -> Column:
    op, num = spec[:2] if spec[1] in "=" else spec[:1], spec[2:] if spec[1] in "=" else spec[1:]
    n = F.lit(int(num))
    return {">": failures > n, ">=": failures >= n, "<": failures < n, "<=": failures <= n,
            "=": failures == n, "!=": failures != n}[op]


def _status(ck: Check, failures: Column) -> Column:
    if ck.severity == "warn":
        return F.when(_threshold(failures, ck.warn_if), "warn").otherwise("pass")
    return (F.when(_threshold(failures, ck.error_if), "error")
             .when(_threshold(failures, ck.warn_if), "warn").otherwise("pass"))


def _row_predicate_failures(ck: Check, as_of: dt.datetime | None) -> Column | None:
    """Failing-row count for checks that are a predicate over single rows (one shared pass)."""
    c = F.col(ck.column) if ck.column else None
    p = ck.params
    if ck.kind == "not_null":
        return F.count_if(c.isNull())
    if ck.kind == "accepted_values":          # NULLs pass, as in dbt
        return F.count_if(c.isNotNull() & ~c.isin(*p["values"]))
    if ck.kind == "expression":               # Q06/Q17: rows where the expression is not true
        return F.count_if(~F.coalesce(F.expr(p["expr"]), F.lit(False)))
    if ck.kind == "range":                    # Q07: values outside [min, max]; NULLs pass
        cond = F.lit(False)
        if p.get("min") is not None:
            cond = cond | (c < F.lit(p["min"]))
        if p.get("max") is not None:
            cond = cond | (c > F.lit(p["max"]))
        return F.count_if(c.isNotNull() & cond)
    if ck.kind == "row_count":                # Q08: 1 failure if the count is outside bounds
        n = F.count(F.lit(1))
        bad = F.lit(False)
        if p.get("min") is not None:
            bad = bad | (n < p["min"])
        if p.get("max") is not None:
            bad = bad | (n > p["max"])
        return F.when(bad, 1).otherwise(0)
    if ck.kind == "recency":                  # Q09: newest row older than N days/hours → 1 failure
        newest = F.max(c)
        limit = F.lit(as_of).cast("timestamp") - F.expr(f"interval {int(p['interval'])} {p.get('datepart', 'day')}")
        return F.when(newest.isNull() | (newest.cast("timestamp") < limit), 1).otherwise(0)
    return None


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check], as_of: dt.datetime | None = None,
               run_tables: Iterable[str] | None = None,
               assertions: Mapping[str, Callable[[], DataFrame]] | None = None) -> DataFrame:
    """Evaluate ``checks``; with ``run_tables`` only checks whose parents all belong to the run
    are evaluated (Q16 "cautious" boundary).  Returns one row per check."""
    checks = list(checks)
    if run_tables is not None:
        keep = set(run_tables)
        checks = [c for c in checks if set(c.parents or [c.table]) <= keep]
    parts: list[DataFrame] = []
    by_table: dict[str, list[tuple[Check, Column]]] = {}
    for ck in checks:
        expr = _row_predicate_failures(ck, as_of)
        if expr is not None:
            by_table.setdefault(ck.table, []).append((ck, expr))
    for tname, items in by_table.items():
        agg = tables[tname].agg(*[e.cast("long").alias(f"_f{i}") for i, (_, e) in enumerate(items)])
        rows = F.inline(F.array(*[F.struct(F.lit(ck.name).alias("check_name"), F.lit(tname).alias("table_name"),
                                           F.lit(ck.column).cast("string").alias("column_name"),
                                           F.lit(ck.severity).alias("severity"),
                                           F.col(f"_f{i}").alias("failures"),
                                           _status(ck, F.col(f"_f{i}")).alias("status"))
                                  for i, (ck, _) in enumerate(items)]))
        parts.append(agg.select(rows))
    for ck in checks:
        if ck.kind in ("unique", "unique_combination"):
            cols = [ck.column] if ck.kind == "unique" else list(ck.params["columns"])
            df = tables[ck.table]
            nn = df
            if ck.kind == "unique":
                nn = df.where(F.col(ck.column).isNotNull())
            dup = nn.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
            f = dup.agg(F.count(F.lit(1)).cast("long").alias("failures"))
        elif ck.kind == "relationships":      # Q05: child keys (non-NULL) without a parent row
            child = tables[ck.table].where(F.col(ck.column).isNotNull())
            parent = tables[ck.params["to"]].select(F.col(ck.params["field"]).alias("_pk"))
            f = (child.join(parent, child[ck.column] == parent["_pk"], "left_anti")
                 .agg(F.count(F.lit(1)).cast("long").alias("failures")))
        elif ck.kind == "freshness":          # Q10: age of the newest load → warn/error tiers
            age_h = (F.unix_timestamp(F.lit(as_of).cast("timestamp"))
                     - F.unix_timestamp(F.max(F.col(ck.column)).cast("timestamp"))) / 3600
            f = tables[ck.table].agg(
                F.when(age_h > ck.params["error_after_hours"], 2).when(age_h > ck.params["warn_after_hours"], 1)
                 .otherwise(0).cast("long").alias("failures"))
            parts.append(f.select(F.lit(ck.name).alias("check_name"), F.lit(ck.table).alias("table_name"),
                                  F.lit(ck.column).cast("string").alias("column_name"), F.lit(ck.severity).alias("severity"),
                                  "failures", F.when(F.col("failures") == 2, "error")
                                  .when(F.col("failures") == 1, "warn").otherwise("pass").alias("status")))
            continue
        elif ck.kind == "assertion":          # Q12–Q15: a query whose rows are the failures
            f = (assertions or {})[ck.name]().agg(F.count(F.lit(1)).cast("long").alias("failures"))
        else:
            continue
        parts.append(f.select(F.lit(ck.name).alias("check_name"), F.lit(ck.table).alias("table_name"),
                              F.lit(ck.column).cast("string").alias("column_name"),
                              F.lit(ck.severity).alias("severity"), "failures",
                              _status(ck, F.col("failures")).alias("status")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
