"""Date expressions. Days only: no time of day and no wall clock inside an operator."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import whole
from .text import _col

DAY_FORMAT = "dd/MM/yyyy"


def as_of_date(value: dt.date | str | None) -> Column:
    """Reporting date: a given day, or today when none is given."""
    if value is None:
        return F.current_date()
    return F.lit(str(value)).cast("date")


def parse_date(c: Column | str) -> Column:
    """Day-first text or ISO text to a date; anything else is null."""
    text = F.trim(_col(c).cast("string"))
    day_first = F.regexp_extract(text, r"^([0-9]{1,2}/[0-9]{1,2}/[0-9]{4})", 1)
    iso = F.regexp_extract(text, r"^([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})", 1)
    return F.coalesce(F.try_to_date(day_first, "d/M/yyyy"), F.try_to_date(iso, "yyyy-M-d"))


def date_text(c: Column | str) -> Column:
    return F.date_format(_col(c), DAY_FORMAT)


def day_gap(a: Column | str, b: Column | str) -> Column:
    return F.abs(F.datediff(_col(a), _col(b)))


def same_month(c: Column | str, as_of: Column) -> Column:
    return F.trunc(_col(c), "MM") == F.trunc(as_of, "MM")


def compact_date(c: Column | str) -> Column:
    """``YYYYMMDD`` text; anything that is no number becomes ``'0'``."""
    return F.coalesce(whole(c), F.lit(0).cast("bigint")).cast("string")


def not_before(due: Column | str, opened: Column | str) -> Column:
    """The later of two ``YYYYMMDD`` texts."""
    return F.greatest(_col(due), _col(opened))
