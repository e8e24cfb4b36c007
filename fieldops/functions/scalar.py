"""S — scalar helpers whose reference semantics differ from Spark's defaults."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_date(d: dt.date | str) -> Column:
    return F.lit(str(d)).cast("date")


def month_diff(later, earlier) -> Column:
    """S15 — month boundaries crossed (12·Δyear + Δmonth), not ``months_between``."""
    a, b = col(later), col(earlier)
    return (F.year(a) - F.year(b)) * 12 + (F.month(a) - F.month(b))


def safe_div(num, den) -> Column:
    """S12 / E19 — NULL instead of an error when the denominator is 0 or NULL."""
    return F.try_divide(col(num), col(den))


def strict_greatest(*cols) -> Column:
    """S11 — NULL if any argument is NULL (Spark's greatest skips NULLs)."""
    cs = [col(c) for c in cols]
    any_null = cs[0].isNull()
    for c in cs[1:]:
        any_null = any_null | c.isNull()
    return F.when(any_null, F.lit(None)).otherwise(F.greatest(*cs))


def strict_least(*cols) -> Column:
    cs = [col(c) for c in cols]
    any_null = cs[0].isNull()
    for c in cs[1:]:
        any_null = any_null | c.isNull()
    return F.when(any_null, F.lit(None)).otherwise(F.least(*cs))


def nullif_blank(c) -> Column:
    """S05 — regexp_extract gives '' on no match; the reference expects NULL."""
    return F.nullif(col(c), F.lit(""))


def regex_first(c, pattern: str, group: int = 0) -> Column:
    return nullif_blank(F.regexp_extract(col(c), pattern, group))


def join_non_null(sep: str, *cols) -> Column:
    """S26 — join the non-NULL members; empty when all are NULL."""
    return F.concat_ws(sep, *[col(c) for c in cols])


def first_matching_token(text, token_pattern: str, keep) -> Column:
    """B14 / G02 — first token of ``text`` matching ``token_pattern`` that satisfies ``keep``.

    ``keep`` is a Python function Column -> Column evaluated inside a higher-order ``filter``
    (a JVM lambda, no Python UDF).  NULL when nothing qualifies.
    """
    toks = F.regexp_extract_all(col(text), F.lit(token_pattern), 0)
    return F.get(F.filter(toks, keep), 0)


def round_half_up(c, scale: int) -> Column:
    """S10 — round half away from zero on the decimal value, as a double.

    Going through decimal(38,10) first makes ties like 0.405 (stored as 0.40499999…) round the
    way the decimal reads, independently of the last bits an engine's float maths produced.
    """
    return F.round(col(c).cast("decimal(38,10)"), scale).cast("double")
