"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..model import DATE_PATTERN

# Fixed value: the first storable day.
EPOCH = "1970-01-01"
BLANKS = " \t\r\n"


def stripped(col: Column) -> Column:
    return F.btrim(col, F.lit(BLANKS))


def is_day_text(col: Column) -> Column:
    """Eight digits that name a real calendar day; NULL counts as no."""
    good = col.rlike(DATE_PATTERN) & F.try_to_date(col, "yyyyMMdd").isNotNull()
    return F.coalesce(good, F.lit(False))


def parse_day(col: Column) -> Column:
    """Date from YYYY, YYYYMM, YYYYMMDD or a longer text that starts with a day; else NULL.

    The digits of the first ten characters, filled up with "01", name the day of every accepted spelling.
    The "no date" texts are no exception: none of them has digits of a real day.
    """
    text = stripped(col)
    digits = F.translate(F.substring(text, 1, 10), "-/", "")
    accepted = F.when(F.length(text) >= 10, digits.rlike("^[0-9]{8}")).otherwise(text.rlike("^[0-9]{4}([0-9]{2}){0,2}$"))
    return F.when(accepted, F.try_to_date(F.rpad(digits, 8, "01"), "yyyyMMdd"))


def parse_moment(col: Column) -> Column:
    """Timestamp without zone from YYYYMMDD or from day and time with one kind of separator; else NULL.
    An ISO text may carry T and Z."""
    text = stripped(col)
    spelled = text.rlike(r"^[0-9]{4}([-/])[0-9]{1,2}\1[0-9]{1,2}[ T][0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}")
    plain = F.translate(F.substring(text, 1, 19), "/TZ", "- ")
    return (
        F.when(text.rlike(DATE_PATTERN), F.try_to_timestamp(text, F.lit("yyyyMMdd")))
        .when(spelled, F.try_to_timestamp(plain, F.lit("yyyy-M-d H:m:s")))
        .cast("timestamp_ntz")
    )


def not_before_epoch(col: Column, nullable: bool) -> Column:
    """Days before 1970 become NULL in a nullable column and the epoch day in a required one."""
    epoch = F.lit(EPOCH).cast("date")
    return F.when(col < epoch, F.lit(None) if nullable else epoch).otherwise(col)


def day_text(col: Column) -> Column:
    return F.date_format(col, "yyyyMMdd")


def month_text(col: Column) -> Column:
    return F.date_format(col, "yyyyMM")


def month_number(col: Column) -> Column:
    return (F.year(col) * 100 + F.month(col)).cast("int")


def quarter_end(col: Column) -> Column:
    return F.last_day(F.add_months(F.trunc(col, "quarter"), 2))


def quarter_ends(start: Column, end: Column) -> Column:
    """Array of the quarter-end days inside [start, end]."""
    ends = F.transform(
        F.sequence(F.trunc(start, "quarter"), F.trunc(end, "quarter"), F.expr("interval 3 month")),
        lambda first: F.last_day(F.add_months(first, 2)),
    )
    return F.when(start <= end, F.filter(ends, lambda d: (d >= start) & (d <= end))).otherwise(
        F.array().cast("array<date>")
    )


def months_between(start: Column, end: Column) -> Column:
    """Array of the first days of every month touched by [start, end]."""
    return F.when(
        start <= end,
        F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("interval 1 month")),
    ).otherwise(F.array().cast("array<date>"))
