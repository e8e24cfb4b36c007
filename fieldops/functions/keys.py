"""E21 — surrogate keys: md5 over '-'-joined values with an explicit NULL token."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the token that stands in for NULL inside a surrogate key.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols) -> Column:
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_TOKEN))
             for c in cols]
    return F.md5(F.concat_ws("-", *parts))
