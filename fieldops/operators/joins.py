"""D — join shapes the planner cannot pick on its own.

Rules of the module:
* no join is forced to broadcast: the planner and AQE choose from the sizes they see;
* range and between-events joins never run as nested loops: both sides get a bucket key so the join
  is an equi-join (hash/sort-merge, AQE skew-split capable) plus a residual predicate;
* top-1 choices always end with a total order.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def disjoint_periods(periods: DataFrame, keys: Sequence[str], valid_from: str, valid_to: str,
                     prefer: Sequence[Column]) -> DataFrame:
    """Periods cut at all bounds of their key, with one row for each piece: the first by ``prefer``
    of those that cover it.  Pieces are (_from, _until), the end exclusive, NULL for open."""
    bounds = periods.select(*keys, F.col(valid_from).cast("date").alias("_from")).unionByName(
        periods.select(*keys, F.date_add(F.col(valid_to).cast("date"), 1).alias("_from"))).where("_from is not null").distinct()
    pieces = bounds.withColumn("_until", F.lead("_from").over(Window.partitionBy(*keys).orderBy("_from")))
    pieces = pieces.select(*[F.col(k).alias(f"_p_{k}") for k in keys], "_from", "_until")
    on = [periods[k] == F.col(f"_p_{k}") for k in keys]
    on += [F.col(valid_from).cast("date") <= F.col("_from"),
           F.col(valid_to).isNull() | (F.col(valid_to).cast("date") >= F.col("_from"))]
    best = Window.partitionBy(*[f"_p_{k}" for k in keys], "_from").orderBy(*prefer)
    held = pieces.join(periods, on).withColumn("_rn", F.row_number().over(best)).where("_rn = 1")
    return held.drop("_rn", *keys)


def effective_dated_join(facts: DataFrame, periods: DataFrame, keys: Sequence[str], fact_date: str,
                         valid_from: str = "valid_from", valid_to: str = "valid_to",
                         prefer: Sequence[Column] = (), how: str = "left") -> DataFrame:
    """D09 — key equality + ``valid_from <= date <= valid_to`` (NULL end = open); when periods
    overlap the first row by ``prefer`` wins (e.g. latest ``valid_from``).

    Overlaps are resolved in the lookup, so each fact meets one period at most: no top-1 over the
    facts, and equal facts all stay.
    """
    order = list(prefer) or [F.col(valid_from).desc_nulls_last()]
    p = disjoint_periods(periods, keys, valid_from, valid_to, order)
    d = facts[fact_date].cast("date")
    on = [facts[k] == p[f"_p_{k}"] for k in keys]
    on += [d >= p["_from"], p["_until"].isNull() | (d < p["_until"])]
    return facts.join(p, on, how).drop("_from", "_until", *[f"_p_{k}" for k in keys])


def interval_join(intervals: DataFrame, points: DataFrame, keys: Sequence[str], start: str, end: str,
                  point: str, bucket_days: int = 7, start_inclusive: bool = True,
                  end_inclusive: bool = True, how: str = "inner",
                  interval_id: Sequence[str] = ()) -> DataFrame:
    """D10 / D11 / D12 — attach points to the intervals that contain them, per key.

    Each interval is exploded into the ``bucket_days`` buckets it overlaps (bounded by its length),
    points get the bucket they fall in, and the join is an equi-join on (keys, bucket) plus the exact
    residual.  A key holding a third of the rows is spread over its buckets instead of one task;
    AQE's skew handling can split the rest.  Intervals must not be open-ended (cap ``end`` first).
    A point sits in exactly one bucket, so the inner join emits each (interval, point) pair once.
    ``how="left"`` keeps intervals without points; it needs ``interval_id`` (unique columns).
    """
    def bucket(c: Column) -> Column:
        return F.floor(F.unix_date(c.cast("date")) / bucket_days).cast("long")

    iv = intervals.withColumn(
        "_b", F.explode(F.sequence(bucket(F.col(start)),
                                   F.greatest(bucket(F.col(start)), bucket(F.col(end))))))
    pt = points.select(*[F.col(c).alias(f"_pk_{c}") if c in keys else F.col(c) for c in points.columns],
                       bucket(F.col(point)).alias("_pb"))
    pcol, s, e = pt[point], iv[start], iv[end]
    lo = (pcol >= s) if start_inclusive else (pcol > s)
    hi = (pcol <= e) if end_inclusive else (pcol < e)
    cond = [iv[k] == pt[f"_pk_{k}"] for k in keys] + [iv["_b"] == pt["_pb"], lo, hi]
    c = cond[0]
    for x in cond[1:]:
        c = c & x
    inner = iv.join(pt, c, "inner").drop("_b", "_pb", *[f"_pk_{k}" for k in keys])
    if how == "inner":
        return inner
    if how != "left" or not interval_id:
        raise ValueError("interval_join supports how='inner', or how='left' with interval_id")
    extra = [x for x in inner.columns if x not in intervals.columns or x in interval_id]
    return intervals.join(inner.select(*extra), list(interval_id), "left")


def explode_months(df: DataFrame, month_col: str, back: int, forward: int = 0,
                   out: str = "_month") -> DataFrame:
    """D12 / T08 — one row per month in [month − back, month + forward] (exact equi-join key)."""
    return df.withColumn(out, F.explode(F.transform(F.sequence(F.lit(-back), F.lit(forward)),
                                                    lambda k: F.add_months(F.col(month_col), k))))


def wildcard_rule_match(facts: DataFrame, rules: Sequence[dict], attrs: Sequence[tuple[str, str, int]],
                        order: Sequence[str] = ()) -> DataFrame:
    """D13 — rules whose None attributes match anything; the most specific rule wins.

    ``attrs`` = (fact column, rule field, weight).  A rule's score is the sum of the weights of its set
    attributes, so the rules are sorted once, by score and then by the fields of ``order``, and a fact takes
    the first that fits: a search in a literal, without join, shuffle or fact key.  ``rules`` are maintained
    by hand and sent with the plan.  The fields of the rule and ``_score`` are added; they are NULL and 0 for
    a fact that no rule fits.  A NULL in a fact fits only rules that leave the attribute open.
    """
    fields = list(dict.fromkeys([*[rf for _, rf, _ in attrs], *[k for r in rules for k in r]]))
    types = {rf: facts.schema[fc].dataType for fc, rf, _ in attrs}
    score = lambda r: sum(w for _, rf, w in attrs if r.get(rf) is not None)
    ranked = sorted(rules, key=lambda r: (-score(r), *[r[k] for k in order]))

    def value(r, k):
        v = F.lit(r.get(k))
        return v.cast(types[k]) if k in types else v if any(x.get(k) is not None for x in rules) else v.cast("string")

    lit = F.array(*[F.struct(*[value(r, k).alias(k) for k in fields], F.lit(score(r)).alias("_score")) for r in ranked or [{}]])
    if not ranked:
        lit = F.slice(lit, 1, 0)

    def fits(r):
        out = F.lit(True)
        for fc, rf, _ in attrs:
            out = out & (r[rf].isNull() | F.coalesce(r[rf] == facts[fc], F.lit(False)))
        return out

    won = facts.withColumn("_rule", F.get(F.filter(lit, fits), F.lit(0)))
    return won.select("*", *[F.col("_rule")[k].alias(k) for k in fields],
                      F.coalesce(F.col("_rule")["_score"], F.lit(0)).alias("_score")).drop("_rule")


def typed_key_join(left: DataFrame, right: DataFrame, left_type: str, left_id: str,
                   right_type: str, right_id: str, how: str = "left") -> DataFrame:
    """D16 — an OR join over two id spaces rewritten as an equi-join on (type, id)."""
    return left.join(right, (left[left_type] == right[right_type]) & (left[left_id] == right[right_id]),
                     how)


def fallback_lookup(df: DataFrame, first: DataFrame, second: DataFrame, first_key: str,
                    second_key: str, value: str, out: str) -> DataFrame:
    """D18 — attribute from the direct parent, else via another path (two left joins + coalesce)."""
    a = first.select(F.col(first_key).alias("_fk1"), F.col(value).alias("_v1"))
    b = second.select(F.col(second_key).alias("_fk2"), F.col(value).alias("_v2"))
    return (df.join(a, df[first_key] == a["_fk1"], "left")
              .join(b, df[second_key] == b["_fk2"], "left")
              .withColumn(out, F.coalesce("_v1", "_v2"))
              .drop("_fk1", "_v1", "_fk2", "_v2"))


def _lit_value(v):
    return F.lit(v)


def rule_flags(df: DataFrame, rules: Sequence[dict], match: dict[str, str],
               date_col: str | None = None, flags: Sequence[str] = (),
               claimed: str = "is_claimed") -> DataFrame:
    """D14 — wildcard override rules folded into per-row flags without any join.

    ``rules`` is a small seed (list of dicts).  ``match`` maps a rule field to the row column it
    must equal; a NULL rule field matches anything.  Rules with ``date_from``/``date_to`` apply on the
    half-open window [from, to).  For each row: ``claimed`` = any rule matches; each name in
    ``flags`` = any matching rule with that boolean field true.  The rules become an array-of-struct
    literal evaluated by ``exists`` inside codegen: no cross join, no shuffle, no row expansion.
    """
    fields = list(match) + (["date_from", "date_to"] if date_col else []) + list(flags)
    arr = F.array(*[F.struct(*[
        (F.lit(r.get(f)).cast("date") if f in ("date_from", "date_to") else F.lit(r.get(f))).alias(f)
        for f in fields]) for r in rules])

    def matches(r):
        cond = F.lit(True)
        for f, c in match.items():
            cond = cond & (r[f].isNull() | (r[f] == F.col(c)))
        if date_col:
            d = F.col(date_col).cast("date")
            cond = cond & (d >= r["date_from"]) & (r["date_to"].isNull() | (d < r["date_to"]))
        return cond

    def flag_pred(fl):
        return lambda r: matches(r) & F.coalesce(r[fl], F.lit(False))

    out = df.withColumn(claimed, F.exists(arr, matches))
    for fl in flags:
        out = out.withColumn(fl, F.exists(arr, flag_pred(fl)))
    return out


def explode_days(df: DataFrame, start: str, end: str, out: str = "day") -> DataFrame:
    """D20 — one row per calendar day in [start, end]; empty when start > end (no backwards
    sequence).  Only for short spans; long spans use the cumulative calendar (T02)."""
    a, b = F.col(start).cast("date"), F.col(end).cast("date")
    days = F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<date>"))
    return df.withColumn(out, F.explode(days))
