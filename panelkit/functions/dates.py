"""Month and era column functions."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.config import DEFAULTS, MONTHS_ES
from panelkit.functions.scalars import col

MONTH_TEXT = r"^\d{4}-\d{1,2}$"


def month_number(c, names: Mapping[str, int] = MONTHS_ES, on_unmapped: str = "null") -> Column:
    """Number of a month name; an unknown name gives null or, with ``on_unmapped='raise'``, fails the job."""
    c = col(c)
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    number = table[c]
    if on_unmapped == "raise":
        message = F.concat(F.lit("unmapped month: "), F.coalesce(c, F.lit("null")))
        number = F.coalesce(number, F.raise_error(message).cast("int"))
    return number


def month_name(c, names: Mapping[str, int] = MONTHS_ES) -> Column:
    ordered = sorted(names, key=names.get)
    return F.element_at(F.array(*[F.lit(n) for n in ordered]), col(c))


def month_date(year, month, strict: bool = True) -> Column:
    """First day of a month; impossible input fails the job when strict, gives null otherwise."""
    if strict:
        return F.make_date(col(year).cast("int"), col(month).cast("int"), F.lit(1))
    y, m = col(year).try_cast("int"), col(month).try_cast("int")
    # One lookup that is null outside 1..12, so that the month expression is evaluated once.
    months = (y - 1970) * 12 + F.get(F.array(*[F.lit(i) for i in range(12)]), m - 1)
    return F.when(y.between(1, 9999), F.add_months(F.lit(date(1970, 1, 1)), months))


def month_start(c) -> Column:
    return F.trunc(col(c), "MM")


def month_index(c) -> Column:
    """Months since year 0: consecutive months differ by one."""
    return F.year(col(c)) * 12 + F.month(col(c))


def in_ranges(c, ranges: Iterable = DEFAULTS.first_year_ranges) -> Column:
    """Whether the date lies in any of the closed ranges."""
    out = F.lit(False)
    for _, low, high in ranges:
        out = out | col(c).between(F.lit(low), F.lit(high))
    return out


def relative_month(c, start) -> Column:
    """Month number inside an era whose first day is ``start``, in steps of 30 days."""
    return (F.floor(F.datediff(col(c), col(start)) / 30) + 1).cast("int")


def label_era(c, cutoff=DEFAULTS.era_cutoff, before=DEFAULTS.era_before, after=DEFAULTS.era_after) -> Column:
    return F.when(col(c) < F.lit(cutoff), F.lit(before)).when(col(c).isNotNull(), F.lit(after))


def label_ranges(c, ranges: Iterable = DEFAULTS.first_year_ranges) -> Column:
    """Label of the first closed range that holds the date, null outside all of them."""
    out = F.lit(None).cast("string")
    for label, low, high in reversed(list(ranges)):
        out = F.when(col(c).between(F.lit(low), F.lit(high)), F.lit(label)).otherwise(out)
    return out


def range_start(c, ranges: Iterable = DEFAULTS.first_year_ranges) -> Column:
    """First day of the range that carries the label in ``c``."""
    out = F.lit(None).cast("date")
    for label, low, _ in ranges:
        out = F.when(col(c) == F.lit(label), F.lit(low)).otherwise(out)
    return out


def seasonality(c, period: int = 12) -> tuple[Column, Column]:
    """Sine and cosine of the month of the year."""
    angle = F.month(col(c)) * (2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def split_label(c, holdout_start, last_observed) -> Column:
    """``train`` before the hold-out start, ``test`` up to the last observed month, ``forecast`` after it."""
    return (
        F.when(col(c) < F.lit(holdout_start), F.lit("train"))
        .when(col(c) <= last_observed, F.lit("test"))
        .otherwise(F.lit("forecast"))
    )


def between_dates(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows inside a closed date range. Compared in the column's own type, so that the scan can use it."""
    dtype = dict(df.dtypes)[column]
    return df.where(F.col(column).between(F.lit(low).cast(dtype), F.lit(high).cast(dtype)))


def months_in_ranges(df: DataFrame, column: str, ranges: Iterable) -> DataFrame:
    """Rows whose month begins inside one of the closed ranges, by a raw date or time column.

    The bounds are moved to months and compared in the column's own type, before anything is derived from it, so that the scan
    can use them.
    """
    dtype = dict(df.dtypes)[column]
    keep = F.lit(False)
    for _, low, high in ranges:
        first = low if low.day == 1 else _next_month(low)
        keep = keep | ((F.col(column) >= F.lit(first).cast(dtype)) & (F.col(column) < F.lit(_next_month(high)).cast(dtype)))
    return df.where(keep)


def _next_month(day: date) -> date:
    return date(day.year + day.month // 12, day.month % 12 + 1, 1)


def _parse(c: Column, patterns: Sequence[str]) -> Column:
    """Date by the first pattern that fits; a time of day after a space or ``T`` is left out."""
    day = F.regexp_replace(F.trim(c), "[ T].*$", "")
    return F.coalesce(*[F.try_to_date(day, p) for p in patterns])


def resolve_date(df: DataFrame, out: str = "fecha", year: str = "ciclo", month: str = "mes",
                 month_num: str = "mes_num", period: str = "periodo_inicio", max_null: float = 0.2,
                 formats: Sequence[str] = ("yyyy-M-d", "yyyy/M/d", "M/d/yyyy"),
                 day_first: Sequence[str] = ("yyyy-M-d", "yyyy/M/d", "d/M/yyyy", "d-M-yyyy")) -> DataFrame:
    """Month start from whatever date columns exist; rows without one are dropped.

    An existing text ``out`` column is parsed month-first; when more than ``max_null`` of all rows fail, dates with
    slashes or dashes are read day-first instead, and what only the first reading understands keeps it. When no row can
    be read the query fails. Otherwise year + month, otherwise ``YYYY-MM`` text.
    """
    columns = set(df.columns)
    if out in columns:
        if dict(df.dtypes)[out] == "string":
            first = _parse(F.col(out), formats)
            second = F.coalesce(_parse(F.col(out), day_first), first)
            failed = df.agg(F.avg(first.isNull().cast("double"))).scalar()
            lost = df.agg(F.avg(second.isNull().cast("double"))).scalar()
            parsed = (F.when(lost == 1, F.raise_error(F.lit(f"no date of column {out} can be read")).cast("date"))
                      .when(failed > max_null, second).otherwise(first))
        else:
            parsed = F.col(out).cast("date")
    elif year in columns and month_num in columns:
        parsed = month_date(year, month_num, strict=False)
    elif year in columns and month in columns:
        parsed = month_date(year, month_number(month), strict=False)
    elif period in columns:
        c = F.col(period)
        parsed = F.when(c.rlike(MONTH_TEXT), F.try_to_date(F.concat(c, F.lit("-01")), "yyyy-M-dd"))
    else:
        raise ValueError(f"no date columns: need {out}, or {year} with {month}/{month_num}, or {period}")
    return df.withColumn(out, month_start(parsed)).where(F.col(out).isNotNull())
