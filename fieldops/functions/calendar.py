"""T — calendar helpers: holiday seed by rule, business calendar, week/fortnight labels, cut-offs."""
from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldops.functions.scalar import col

# Metropolitan French public holidays (month, day, name) and the Easter offsets of
# the movable ones.
FIXED_HOLIDAYS = (
    (1, 1, "Jour de l'an"),
    (5, 1, "Fête du travail"),
    (5, 8, "Victoire 1945"),
    (7, 14, "Fête nationale"),
    (8, 15, "Assomption"),
    (11, 1, "Toussaint"),
    (11, 11, "Armistice 1918"),
    (12, 25, "Noël"),
)
EASTER_HOLIDAYS = ((1, "Lundi de Pâques"), (39, "Ascension"), (50, "Lundi de Pentecôte"))


def easter(year: int) -> dt.date:
    """Gregorian Easter Sunday (anonymous Gregorian algorithm)."""
    a, b, c = year % 19, year // 100, year % 100
    d, e = b // 4, b % 4
    f = (b + 8) // 25
    g = (b - f + 1) // 3
    h = (19 * a + b - d - g + 15) % 30
    i, k = c // 4, c % 4
    l_ = (32 + 2 * e + 2 * i - h - k) % 7
    m = (a + 11 * h + 22 * l_) // 451
    month = (h + l_ - 7 * m + 114) // 31
    day = ((h + l_ - 7 * m + 114) % 31) + 1
    return dt.date(year, month, day)


def holiday_rows(years: Iterable[int]) -> list[tuple[int, int, dt.date, str]]:
    """(annee, mois, date_ferie, nom_jour_ferie) for the given years, generated by rule."""
    out = []
    for y in years:
        days = [(dt.date(y, m, d), n) for m, d, n in FIXED_HOLIDAYS]
        e = easter(y)
        days += [(e + dt.timedelta(days=k), n) for k, n in EASTER_HOLIDAYS]
        out += [(y, d.month, d, n) for d, n in sorted(days)]
    return out


HOLIDAY_SCHEMA = T.StructType([
    T.StructField("annee", T.IntegerType()), T.StructField("mois", T.IntegerType()),
    T.StructField("date_ferie", T.DateType()), T.StructField("nom_jour_ferie", T.StringType())])


def holidays(spark: SparkSession, years: Iterable[int]) -> DataFrame:
    """T13 — holiday calendar (≈ 11 rows per year: always broadcast-sized)."""
    return spark.createDataFrame(holiday_rows(years), HOLIDAY_SCHEMA)


#: calendars made in this session, by years and holidays
_CALENDARS: dict[tuple, DataFrame] = {}


def business_calendar(spark: SparkSession, first_year: int, last_year: int,
                      holiday_dates: Iterable[dt.date] | None = None) -> DataFrame:
    """Day table with a running count of business days (Mon–Fri, not a holiday).

    Built by rule; one row per day, so its size is fixed by the year range (≤ 366 × years) and it
    is safe to broadcast, or to stand in an expression (operators/business_time.py).  ``cum_bd`` turns
    "business days in [a, b]" into two lookups instead of exploding every interval into days.
    """
    hol = frozenset(holiday_dates) if holiday_dates is not None else frozenset(
        r[2] for r in holiday_rows(range(first_year, last_year + 1)))
    made = (spark.sparkContext.applicationId, first_year, last_year, hol)
    if made in _CALENDARS:
        return _CALENDARS[made]
    d = dt.date(first_year, 1, 1) - dt.timedelta(days=1)  # spans from the first day look one day back
    end = dt.date(last_year, 12, 31)
    epoch = dt.date(1970, 1, 1)
    rows, cum, cum_sec = [], 0, 0
    while d <= end:
        bd = d.weekday() < 5 and d not in hol
        cum += int(bd)
        cum_sec += (d - epoch).days * 86400 if bd else 0
        rows.append((d, bd, cum, cum_sec))
        d += dt.timedelta(days=1)
    # cum_sec = Σ epoch seconds of the business-day midnights up to the day (for 24-hour clocks)
    df = spark.createDataFrame(rows, "day date, is_business_day boolean, cum_bd long, cum_sec long")
    df.counters = [(r[0], r[2], r[3]) for r in rows]  # for the clocks, which hold them as constants
    _CALENDARS[made] = df
    return df


def iso_week_label(c) -> Column:
    """T07 — 'WW.YYYY' with the ISO week and ISO year."""
    x = col(c)
    return F.format_string("%02d.%04d", F.weekofyear(x), F.extract(F.lit("YEAROFWEEK"), x))


def fortnight(c) -> Column:
    """T06 — floor((d − Monday of the week of Jan 1st) / 14) + 1."""
    x = col(c).cast("date")
    anchor = F.trunc(F.trunc(x, "YEAR"), "week")
    return (F.floor(F.datediff(x, anchor) / 14) + 1).cast("int")


def cutoff_shift(ts, cutoff: str = "16:00:00") -> Column:
    """T04 — created after the cut-off time → reference is the next day at 00:00."""
    x = col(ts)
    return F.when(F.date_format(x, "HH:mm:ss") > cutoff,
                  F.date_add(x.cast("date"), 1).cast("timestamp_ntz")).otherwise(x.cast("timestamp_ntz"))


def period_day(month_start, day) -> Column:
    """T12 — accounting date = first day of the period month + (day − 1)."""
    return F.date_add(col(month_start).cast("date"), (col(day) - 1).cast("int"))


def delay_bucket(days) -> Column:
    """T05 — J+0 … J+3, J++ from a number of business days."""
    x = col(days)
    return (F.when(x.isNull(), F.lit(None)).when(x <= 0, "J+0").when(x == 1, "J+1")
             .when(x == 2, "J+2").when(x == 3, "J+3").otherwise("J++"))


def month_spine(start, end) -> Column:
    """T08 — array of month starts from ``start`` to ``end`` (empty when start > end)."""
    s, e = F.trunc(col(start).cast("date"), "MM"), F.trunc(col(end).cast("date"), "MM")
    return F.when(s <= e, F.sequence(s, e, F.expr("interval 1 month"))).otherwise(F.array().cast("array<date>"))


def seasonal_window(as_of: dt.date) -> tuple[dt.date, dt.date, int]:
    """T10 — last year's window centred on this month: [month−12 − 1, month−12 + 2) and its days."""
    centre = dt.date(as_of.year - 1, as_of.month, 1)

    def add_months(d: dt.date, k: int) -> dt.date:
        n = d.year * 12 + d.month - 1 + k
        return dt.date(n // 12, n % 12 + 1, 1)

    start, end = add_months(centre, -1), add_months(centre, 2)
    return start, end, (end - start).days
