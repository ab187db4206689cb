"""Date expressions: partial dates, intervals, spines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = {m: i + 1 for i, m in enumerate(("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"))}


def partial_date(x: Column, today: str, first_year: int = 1000) -> Column:
    """struct(date, year, month) with what the text is precise to; years outside first_year..today + 5 are refused."""
    t = F.trim(x)
    full = F.coalesce(*(F.to_date(F.try_to_timestamp(t, F.lit(f))) for f in ("yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ssX", "yyyy-MM-dd'T'HH:mm:ss.SSSX")))
    year = F.regexp_extract(t, r"^(\d{4})(?:\D|$)", 1).try_cast("int")
    month = F.when(t.rlike(r"^\d{4}-\d{2}$"), F.substring(t, 6, 2).try_cast("int"))
    ok = year.between(F.lit(first_year), F.year(F.lit(today).cast("date")) + 5) & (full.isNotNull() | t.rlike(r"^\d{4}$") | month.between(1, 12))
    return F.when(ok, F.struct(full.alias("date"), year.alias("year"), F.when(month.between(1, 12), month).alias("month")))


def month_number(x: Column) -> Column:
    low = F.substring(F.lower(F.trim(x)), 1, 3)
    table = F.create_map(*[F.lit(v) for kv in MONTHS.items() for v in kv])
    return F.coalesce(F.trim(x).try_cast("int"), table[low])


def medline_year(x: Column) -> Column:
    return F.substring(F.trim(x), 1, 4).try_cast("int")


def parts_date(parts: Column) -> Column:
    """Of [year, month, day]; incomplete or impossible ones are NULL."""
    text = F.format_string("%04d-%02d-%02d", parts[0], parts[1], parts[2])
    return F.when(F.size(parts) == 3, F.to_date(F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))))


UNITS = {"minute": "MINUTE", "hour": "HOUR", "day": "DAY", "month": "MONTH"}


def intervals(start: Column, end: Column, unit: str) -> Column:
    """array<struct<start,end>> of calendar units: the first starts at `start`, each ends with its unit, the last too."""
    first = F.date_trunc(UNITS[unit], start)
    step = F.expr(f"INTERVAL 1 {UNITS[unit]}")
    last = F.date_trunc(UNITS[unit], end - F.expr("INTERVAL 1 MICROSECOND"))
    marks = F.when(end > start, F.sequence(first, last, step)).otherwise(F.array().cast("array<timestamp>"))
    return F.transform(marks, lambda t: F.struct(F.greatest(t, start).alias("start"), (t + step - F.expr("INTERVAL 1 SECOND")).alias("end")))


def week_intervals(start: Column, end: Column, weeks: int = 1) -> Column:
    """As `intervals`, by weeks that begin on Sunday."""
    day = F.expr("INTERVAL 1 DAY")
    sunday = F.date_trunc("WEEK", start + day) - day
    step = F.expr(f"INTERVAL {7 * weeks} DAY")
    marks = F.when(end > start, F.sequence(sunday, end - F.expr("INTERVAL 1 MICROSECOND"), step)).otherwise(F.array().cast("array<timestamp>"))
    return F.transform(marks, lambda t: F.struct(F.greatest(t, start).alias("start"), (t + step - F.expr("INTERVAL 1 SECOND")).alias("end")))


def epoch_date(seconds: Column) -> Column:
    return F.to_date(F.timestamp_seconds(seconds))
