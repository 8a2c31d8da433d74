"""Gregorian dates to Jalali text, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.functions import fixed


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, where a long expression would be repeated."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def jalali(date: Column) -> Column:
    """``YYYY/MM/DD`` of a Gregorian date after 1600; null for others.

    Days count from the first day of year 979. A cycle of 33 years has 12,053 days; within it a year has 365.25 days,
    rounded up at its start. The first six months have 31 days, the others 30.
    """
    div = lambda a, b: F.floor(a / F.lit(b))
    days = F.datediff(date, F.to_date(F.lit("1600-03-20"))).cast("long")
    in_cycle = days % 12053
    year = div(4 * in_cycle, 1461)
    day = in_cycle - div(1461 * year + 3, 4)
    month = F.when(day < 186, 1 + div(day, 31)).otherwise(7 + div(day - 186, 30))
    in_month = F.when(day < 186, 1 + day % 31).otherwise(1 + (day - 186) % 30)
    full_year = 979 + 33 * div(days, 12053) + year
    text = F.format_string("%04d/%02d/%02d", full_year.cast("int"), month.cast("int"), in_month.cast("int"))
    return F.when(F.year(date) > 1600, text)


def safe_jalali(text: Column, default: str = fixed.DEFAULT_DATE) -> Column:
    """The first date in a text, year first; a year before 1600 is Jalali already; ``default`` where there is none."""
    part = lambda i: F.regexp_extract(text, r"(\d{4})[-/](\d{1,2})[-/](\d{1,2})", i)
    own = F.format_string("%04d/%02d/%02d", *[part(i).cast("int") for i in (1, 2, 3)])
    date = F.try_to_timestamp(F.concat_ws("-", part(1), part(2), part(3)), F.lit("yyyy-M-d"))
    known = F.when(part(1) == "", None).when(part(1).cast("int") < 1600, own).otherwise(jalali(date.cast("date")))
    return F.coalesce(known, F.lit(default))


def sent_line(line: Column) -> Column:
    """A ``Sent:`` line with its date in Jalali; other lines, and dates in no known form, stay as they are."""
    months = "|".join(m.replace("اردیبهشت", r"اردی\s*بهشت") for m in fixed.PERSIAN_MONTHS)
    pattern = rf"(\d{{1,2}})\s+({months})\s+(\d{{4}})"

    def persian(raw: Column) -> Column:
        name = F.regexp_replace(F.regexp_extract(raw, pattern, 2), r"\s+", "")
        number = F.array_position(F.array(*[F.lit(m) for m in fixed.PERSIAN_MONTHS]), name).cast("int")
        year, day = (F.regexp_extract(raw, pattern, i).cast("int") for i in (3, 1))
        return F.format_string("Sent: %04d/%02d/%02d", year, number, day)

    def other(raw: Column) -> Column:
        bare = F.regexp_replace(raw, r"^[A-Za-z]+[,،]\s*", "")
        date = let(bare, lambda x: F.coalesce(*[F.try_to_timestamp(x, F.lit(f)) for f in fixed.SENT_FORMATS]))
        return F.concat(F.lit("Sent: "), let(date.cast("date"), jalali))

    def whole(x: Column) -> Column:
        raw = F.trim(F.regexp_extract(x, fixed.SENT_LINE, 1))
        made = let(raw, lambda r: F.when(r.rlike(pattern), persian(r)).otherwise(other(r)))
        return F.when(x.rlike(fixed.SENT_LINE), F.coalesce(made, x)).otherwise(x)

    return let(line, whole)
