"""T01/T02 — business-time clocks without exploding intervals into days.

All use the rule-built ``business_calendar`` (day, is_business_day, cum_bd): "business days in [a, b]" =
cum_bd(b) − cum_bd(a − 1).  The counters (at most 366 a year) stand in the expression as a constant array, so a
clock is a column: no join, no per-day rows, no shuffle, and a ticket open for two years costs the same as one
open for an hour.
The calendar must hold every day asked for and the day before it; a missing day raises.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldops.functions.scalar import col


class Counters:
    """The calendar's running counts as constant arrays, looked up by day number."""

    def __init__(self, cal: DataFrame):
        rows = getattr(cal, "counters", None)
        if rows is None:  # a calendar of the caller's own: one row per day
            rows = [tuple(r) for r in cal.select("day", "cum_bd", "cum_sec").collect()]
        rows = sorted(rows)
        self.first, self.n = rows[0][0], len(rows)
        if (rows[-1][0] - self.first).days + 1 != self.n:
            raise ValueError("the business calendar has gaps")
        self._days, self._seconds = (self._array([r[i] for r in rows]) for i in (1, 2))

    @staticmethod
    def _array(values: list[int]) -> Column:
        """An array literal (folded when the query is optimised) without a node per entry."""
        return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")

    def _at(self, array: Column, day: Column) -> Column:
        number = F.datediff(day, F.lit(self.first)) + 1
        missing = F.raise_error(F.concat(F.lit("not in the business calendar: "), day.cast("string"))).cast("long")
        return F.when(number.between(1, self.n), F.element_at(array, number)).when(day.isNotNull(), missing)

    def days(self, day: Column) -> Column:
        """Business days up to and with this one; a day that the calendar does not hold is an error, not a NULL or 0."""
        return self._at(self._days, day)

    def seconds(self, day: Column) -> Column:
        return self._at(self._seconds, day)

    def is_business(self, day: Column) -> Column:
        return self.days(day) > self.days(F.date_sub(day, 1))


def business_days(df: DataFrame, start: str, end, cal: DataFrame,
                  out: str = "business_days") -> DataFrame:
    """T02 — (number of business days in [date(start), date(end)]) − 1; NULL when there is none.

    ``end`` is a column name, or a fixed date (e.g. "today")."""
    import datetime as _dt
    if isinstance(end, (_dt.date, _dt.datetime)):
        last = F.lit((end.date() if isinstance(end, _dt.datetime) else end).isoformat()).cast("date")
    else:
        last = F.col(end).cast("date")
    c = Counters(cal)
    x = df.withColumn("_n", c.days(last) - c.days(F.date_sub(F.col(start).cast("date"), 1)))
    return x.withColumn(out, F.when(F.col("_n") > 0, F.col("_n") - 1)).drop("_n")


def _local_instant(day: Column, hhmm: tuple[int, int], tz: str) -> Column:
    local = F.make_timestamp_ntz(F.year(day), F.month(day), F.dayofmonth(day),
                                 F.lit(hhmm[0]), F.lit(hhmm[1]), F.lit(0))
    return F.to_utc_timestamp(local, tz)


def business_minutes(df: DataFrame, start: str, end: str, cal: DataFrame,
                     tz: str = "Europe/Paris", open_at: tuple[int, int] = (9, 0),
                     close_at: tuple[int, int] = (17, 30), out: str = "business_minutes",
                     null_without_business_day: bool = False) -> DataFrame:
    """T01 — whole minutes between two UTC instants inside opening hours (local ``tz``), Mon–Fri,
    holidays excluded; each day clipped and floored at 0.  With ``null_without_business_day`` the
    result is NULL (not 0) when the span holds no business day at all (an inner-joined day list).

    First and last local day are clipped exactly; every business day strictly between contributes
    a full opening span (DST changes happen at night, so a full span is the same length all year).
    """
    s = col(start).cast("timestamp")
    e = col(end).cast("timestamp")
    d1 = F.to_date(F.from_utc_timestamp(s, tz))
    d2 = F.to_date(F.from_utc_timestamp(e, tz))
    span = (close_at[0] * 60 + close_at[1]) - (open_at[0] * 60 + open_at[1])

    c = Counters(cal)
    x = df.withColumns({"_s": s, "_e": e, "_d1": d1, "_d2": d2})
    x = x.withColumns({"_c0_cum": c.days(F.date_sub(F.col("_d1"), 1)), "_c1_cum": c.days(F.col("_d1")),
                       "_c2_cum": c.days(F.col("_d2")), "_c3_cum": c.days(F.date_sub(F.col("_d2"), 1))})

    def part(day: Column, bd: Column) -> Column:
        lo = F.greatest(_local_instant(day, open_at, tz), F.col("_s"))
        hi = F.least(_local_instant(day, close_at, tz), F.col("_e"))
        mins = F.greatest(F.timestamp_diff("MINUTE", lo, hi), F.lit(0))
        return F.when(F.coalesce(bd, F.lit(False)), mins).otherwise(0)

    first = part(F.col("_d1"), F.col("_c1_cum") > F.col("_c0_cum"))
    last = part(F.col("_d2"), F.col("_c2_cum") > F.col("_c3_cum"))
    between = F.greatest(F.col("_c3_cum") - F.col("_c1_cum"), F.lit(0)) * span
    total = (F.when(F.col("_d1") > F.col("_d2"), F.lit(0))
              .when(F.col("_d1") == F.col("_d2"), first)
              .otherwise(first + last + between))
    no_bd = (F.col("_d1") > F.col("_d2")) | ((F.col("_c2_cum") - F.col("_c0_cum")) <= 0)
    empty = F.lit(None) if null_without_business_day else F.lit(0)
    res = (F.when(F.col("_s").isNull() | F.col("_e").isNull(), empty)
            .when(no_bd, empty).otherwise(total))
    return x.withColumn(out, res.cast("long")).drop("_s", "_e", "_d1", "_d2", "_c0_cum", "_c1_cum", "_c2_cum", "_c3_cum")


def business_day_clock(df: DataFrame, ref: str, points: dict[str, str], end: str, cal: DataFrame) -> DataFrame:
    """T03 — 24-hour business clock: for each point X, over business days d from
    least(date(ref), date(X0)) to date(min(X, end)): days counted inclusively and hours =
    Σ (min(X, d+1) − max(ref, d)) / 3600 (negative contributions before ``ref`` kept, as the source).

    Closed form on the calendar's cumulative counters (no per-day rows):
      Σ_{d<eX} (d+1) + [eX business]·X − ref·#(d ≤ eR) − Σ_{d>eR} d.
    ``points`` maps an output prefix to its timestamp column; rows whose day range is empty get NULL.
    """
    first_point = list(points.values())[0]
    s = F.least(F.col(ref).cast("date"), F.col(first_point).cast("date"))
    e_end = F.col(end).cast("date")
    c = Counters(cal)
    out = df.withColumn("_s", s).withColumn("_eR", F.col(ref).cast("date"))

    def lk(frame, day_col, tag):
        return frame.withColumn(f"{tag}_n", c.days(F.col(day_col))).withColumn(f"{tag}_s", c.seconds(F.col(day_col)))

    def cnt(a, b):   # business days in [a, b] from the lookups tagged a/b (a is "day before start")
        return F.greatest(F.col(f"{b}_n") - F.col(f"{a}_n"), F.lit(0))

    def ssum(a, b):
        return F.when(F.col(f"{b}_n") > F.col(f"{a}_n"), F.col(f"{b}_s") - F.col(f"{a}_s")).otherwise(F.lit(0))

    out = out.withColumn("_sm1", F.date_sub("_s", 1))
    out = lk(out, "_sm1", "_a")
    sec = lambda x: F.unix_seconds(F.col(x).cast("timestamp"))
    drop = ["_s", "_eR", "_sm1", "_a_n", "_a_s"]
    for pfx, x in points.items():
        eX = f"_{pfx}_e"
        out = out.withColumn(eX, F.col(x).cast("date")).withColumn(f"_{pfx}_u", F.least(F.col(eX), e_end))
        out = out.withColumn(f"_{pfx}_u1", F.least(F.col(f"_{pfx}_u"), F.date_sub(F.col(eX), 1)))
        out = out.withColumn(f"_{pfx}_r", F.least(F.col(f"_{pfx}_u"), F.col("_eR")))
        out = out.withColumn(f"_{pfx}_r0", F.greatest(F.col("_s"), F.date_add(F.col("_eR"), 1)))
        out = out.withColumn(f"_{pfx}_r0m1", F.date_sub(F.col(f"_{pfx}_r0"), 1))
        for col_, tag in ((f"_{pfx}_u", "_U"), (f"_{pfx}_u1", "_U1"), (f"_{pfx}_r", "_R"), (f"_{pfx}_r0m1", "_R0")):
            out = lk(out, col_, f"{tag}{pfx}")
        u, u1, r, r0 = f"_U{pfx}", f"_U1{pfx}", f"_R{pfx}", f"_R0{pfx}"
        n_days = F.when(F.col(f"_{pfx}_u") >= F.col("_s"), cnt("_a", u))
        part1 = F.when(F.col(f"_{pfx}_u1") >= F.col("_s"), ssum("_a", u1) + 86400 * cnt("_a", u1)).otherwise(0)
        ex_in = (F.col(eX) <= F.col(f"_{pfx}_u")) & (F.col(eX) >= F.col("_s"))
        part2 = F.when(ex_in & c.is_business(F.col(eX)) & (F.col(eX) == F.col(f"_{pfx}_u")), sec(x)).otherwise(0)
        part3 = F.when(F.col(f"_{pfx}_r") >= F.col("_s"), sec(ref) * cnt("_a", r)).otherwise(0)
        part4 = F.when(F.col(f"_{pfx}_u") >= F.col(f"_{pfx}_r0"), ssum(r0, u)).otherwise(0)
        hours = F.when(F.col(f"_{pfx}_u") >= F.col("_s"), (part1 + part2 - part3 - part4) / 3600.0)
        out = out.withColumn(f"delai_jours_{pfx}", n_days).withColumn(f"delai_heures_{pfx}", hours)
        drop += [eX, f"_{pfx}_u", f"_{pfx}_u1", f"_{pfx}_r", f"_{pfx}_r0", f"_{pfx}_r0m1"]
        drop += [f"{t}_{k}" for t in (u, u1, r, r0) for k in ("n", "s")]
    return out.drop(*drop)
