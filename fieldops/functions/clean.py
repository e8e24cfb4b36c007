"""C — staging clean-up as Column expressions (typed casts, sentinels, dates, codes, JSON, XML)."""
from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldops.functions.scalar import col, nullif_blank

# XML entities and their characters; '&amp;' must be restored last.
XML_ENTITIES = (("&apos;", "'"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"))


def cast_columns(df: DataFrame, schema: Mapping[str, str], safe: bool = True) -> DataFrame:
    """C01 — cast listed columns to their target type; ``safe`` = NULL on failure (try_cast)."""
    out = df
    for c, ty in schema.items():
        out = out.withColumn(c, F.col(c).try_cast(ty) if safe else F.col(c).cast(ty))
    return out


def null_if_sentinel(c, sentinels: Iterable[str] = ("nan", "nat", "#", ""), trim: bool = True,
                     lower_compare: bool = True) -> Column:
    """C02 — trimmed value, or NULL when it is one of the placeholders (case-insensitive)."""
    x = col(c).cast("string")
    v = F.trim(x) if trim else x
    key = F.lower(v) if lower_compare else v
    sent = [s.lower() for s in sentinels] if lower_compare else list(sentinels)
    return F.when(key.isin(*sent), F.lit(None)).otherwise(v)


def null_dates(c, placeholder: str = "1753-01-01") -> Column:
    """C03 — a placeholder date (e.g. 1753-01-01, 0001-01-01) becomes NULL."""
    x = col(c)
    return F.when(x.cast("date") == F.lit(placeholder).cast("date"), F.lit(None)).otherwise(x)


def parse_ts(c, formats: Sequence[str] = ("yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm", "dd/MM/yyyy"),
             repair_two_digit_years: bool = True) -> Column:
    """C04 — first format that parses wins; years written '00yy' are repaired to '20yy'."""
    x = F.trim(col(c).cast("string"))
    parsed = F.coalesce(*[F.try_to_timestamp(x, F.lit(f)) for f in formats])
    if repair_two_digit_years:
        parsed = F.when(F.year(parsed) < 100, F.try_add(parsed, F.make_interval(F.lit(2000)))
                        ).otherwise(parsed)
    return parsed


def clean_code(c, width: int = 5) -> Column:
    """C05 — strip a trailing '.0' from a number stored as text, left-pad to ``width``.

    Longer values are kept whole (``lpad`` alone would truncate them)."""
    x = F.regexp_replace(F.trim(col(c).cast("string")), r"\.0$", "")
    x = nullif_blank(x)
    return F.when(F.length(x) >= width, x).otherwise(F.lpad(x, width, "0"))


def parse_decimal(c) -> Column:
    """C06 — '1,5' → 1.5 (decimal comma), NULL when not a number."""
    return F.regexp_replace(F.trim(col(c).cast("string")), ",", ".").try_cast("double")


EAV_SCHEMA = T.ArrayType(T.StructType([T.StructField("name", T.StringType()),
                                       T.StructField("value", T.StringType())]))


def eav_value(c, name: str, schema: T.DataType = EAV_SCHEMA) -> Column:
    """C07 — value of the first {name, value} element called ``name`` in a JSON array.

    One pass with a higher-order ``filter`` (no explode, no join); duplicate names are tolerated
    (``map_from_entries`` would raise).  Missing name or bad JSON → NULL.
    """
    arr = F.from_json(col(c), schema)
    return F.get(F.filter(arr, lambda x: x["name"] == F.lit(name)), 0)["value"]


def eav_json_to_columns(df: DataFrame, c: str, names: Mapping[str, str],
                        schema: T.DataType = EAV_SCHEMA) -> DataFrame:
    """C07 — several custom fields at once (one parse of the array per column expression)."""
    out = df
    for n, alias in names.items():
        out = out.withColumn(alias, eav_value(F.col(c), n, schema))
    return out


def explode_json_lines(df: DataFrame, c: str, schema: T.DataType, outer: bool = False,
                       alias: str = "line") -> DataFrame:
    """C08 — header × lines: JSON array column → one row per element (NULL/empty → no row unless
    ``outer``).  A generator in the same stage: no shuffle."""
    arr = F.from_json(F.col(c), schema)
    gen = F.explode_outer(arr) if outer else F.explode(arr)
    return df.withColumn(alias, gen)


def json_value(c, path: str) -> Column:
    """C09 — scalar at a JSON path, as string."""
    return F.get_json_object(col(c), path)


def decode_xml_entities(c) -> Column:
    x = col(c)
    for ent, ch in XML_ENTITIES:
        x = F.replace(x, F.lit(ent), F.lit(ch))
    return x


def xml_field(c, tag: str) -> Column:
    """C10 — text of the first ``<tag>…</tag>`` (NULL when absent), entities decoded."""
    raw = nullif_blank(F.regexp_extract(col(c), f"<{tag}>([^<]*)</{tag}>", 1))
    return decode_xml_entities(raw)


def leading_int(c, zero_words: Sequence[str] = ("AUCUN",)) -> Column:
    """C11 — first run of digits/spaces in free text as an integer; listed words mean 0."""
    x = col(c)
    digits = F.regexp_replace(F.regexp_extract(x, r"[\d\s]+", 0), r"\s+", "")
    return (F.when(F.upper(F.trim(x)).isin(*[w.upper() for w in zero_words]), F.lit(0).cast("long"))
             .otherwise(nullif_blank(digits).try_cast("long")))


def hm_to_minutes(c) -> Column:
    """C12 — 'HH:MM hrs' → minutes; malformed parts give NULL."""
    parts = F.split(F.replace(col(c), F.lit(" hrs"), F.lit("")), ":")
    return F.get(parts, 0).try_cast("long") * 60 + F.get(parts, 1).try_cast("long")


def int_to_bool(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """C13 — 0/1 integers to booleans."""
    out = df
    for c in cols:
        out = out.withColumn(c, F.col(c).cast("boolean"))
    return out


def coalesce_updated(updated, created) -> Column:
    """C16 — modification date, else creation date."""
    return F.coalesce(col(updated), col(created))


def semi_filter(lines: DataFrame, headers: DataFrame, key: str, header_key: str | None = None) -> DataFrame:
    """C17 — keep lines whose header exists (left semi join: no header columns, no fan-out)."""
    hk = header_key or key
    return lines.join(headers, lines[key] == headers[hk], "left_semi")


def as_text(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """C18 — harmonise a polymorphic value to string."""
    out = df
    for c in cols:
        out = out.withColumn(c, F.col(c).cast("string"))
    return out


def norm_key(c, strip_pattern: str | None = None) -> Column:
    """C19 — upper(trim(x)) with an optional regex removed, for cross-system joins."""
    x = col(c).cast("string")
    if strip_pattern:
        x = F.regexp_replace(x, strip_pattern, "")
    return F.upper(F.trim(x))
