"""E — aggregation helpers: label pivots, unpivot, ordered string aggregation, arg-max, keep-latest."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_labels(df: DataFrame, keys: Sequence[str], family_col: str, value_col: str,
                 families: Sequence[str], prefix: str = "") -> DataFrame:
    """E10/E11 — long (entity, family, value) → one column per family with ``max(value)``.

    The value list is given, so Spark needs no extra job to discover it, and the pivot is a single
    hash aggregate on the entity keys (partial aggregation on the map side).
    """
    out = df.groupBy(*keys).pivot(family_col, list(families)).agg(F.max(value_col))
    if prefix:
        for f in families:
            out = out.withColumnRenamed(f, f"{prefix}{f}".lower())
    return out


def unpivot_multi(df: DataFrame, ids: Sequence[str], groups: dict[str, Sequence[str]],
                  label_col: str, value_cols: Sequence[str], drop_all_null: bool = True) -> DataFrame:
    """E12 — multi-column UNPIVOT: ``groups`` maps a label to the columns that fill ``value_cols``.

    Implemented as ``inline(array(struct…))``: a generator in the same stage, no shuffle.
    """
    stacked = F.inline(F.array(*[
        F.struct(F.lit(label).alias(label_col),
                 *[F.col(c).alias(v) for c, v in zip(cols, value_cols)])
        for label, cols in groups.items()]))
    out = df.select(*ids, stacked)
    if drop_all_null:
        cond = None
        for v in value_cols:
            c = F.col(v).isNotNull()
            cond = c if cond is None else (cond | c)
        out = out.where(cond)
    return out


def string_agg_distinct(c, sep: str = ", ") -> Column:
    """E14 — ``string_agg(distinct x, sep order by x)``."""
    x = F.col(c) if isinstance(c, str) else c
    return F.array_join(F.array_sort(F.collect_set(x)), sep)


def arg_max(value, *order) -> Column:
    """E08 — value at the max of ``order`` (a struct orders lexicographically = built-in tie-break)."""
    v = F.col(value) if isinstance(value, str) else value
    o = [F.col(c) if isinstance(c, str) else c for c in order]
    return F.max_by(v, F.struct(*o) if len(o) > 1 else o[0])


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """C14 — one row per key, the one with the greatest ``order`` tuple (NULLs lose).

    ``max_by`` over a struct of the whole row is a partial aggregate: each map task reduces a hot
    key to one row before the shuffle, so a key holding a third of the data costs no more than any
    other.  (A ``row_number()`` window would sort that third in one task.)
    """
    others = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*[F.col(c) for c in others]),
                    F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*keys).agg(best.alias("_b")).select(*keys, *[F.col(f"_b.{c}").alias(c)
                                                                 for c in others])
