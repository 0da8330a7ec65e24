"""Validity rules for contact fields: an invalid value becomes empty text or a default."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, contains_any, digits_only

# Marks of placeholder e-mail addresses, and the accepted form.
EMAIL_PLACEHOLDERS = ["CORREGIR", "PENDIENTE", "NOTIENE", "SINC", "NN@", "AAA@"]
EMAIL_FORM = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"

# Default place, and the texts that stand for "no place".
DEFAULT_CITY = "POPAYAN"
DEFAULT_DEPARTMENT = "CAUCA"
NO_PLACE = ["", "0", "NAN", "NONE"]
NO_CITY_SHORT = ["", "0", "N/A"]


def valid_phone(c: Column | str, *, landline: bool = True) -> Column:
    """Digits of a mobile (10, starting with 3) or a landline (7); otherwise empty text."""
    digits = digits_only(F.coalesce(_col(c).cast("string"), F.lit("")))
    good = (F.length(digits) == 10) & digits.startswith("3")
    if landline:
        good = good | (F.length(digits) == 7)
    return F.when(good, digits).otherwise(F.lit(""))


def valid_email(c: Column | str) -> Column:
    text = F.trim(F.coalesce(_col(c), F.lit("")))
    good = text.rlike(EMAIL_FORM) & ~contains_any(text, EMAIL_PLACEHOLDERS)
    return F.when(good, text).otherwise(F.lit(""))


def place_or_default(c: Column | str, default: str) -> Column:
    """Trimmed upper-case place; nulls, placeholders and all-digit text give the default."""
    place = F.upper(F.trim(F.coalesce(_col(c), F.lit(""))))
    bad = place.isin(NO_PLACE) | place.rlike("^[0-9]+$")
    return F.when(bad, F.lit(default)).otherwise(place)


def city_or_default(c: Column | str, default: str = DEFAULT_CITY) -> Column:
    """The place as given; nulls, blanks, ``0`` and ``N/A`` give the default."""
    place = F.coalesce(_col(c), F.lit(""))
    bad = F.upper(F.trim(place)).isin(NO_CITY_SHORT)
    return F.when(bad, F.lit(default)).otherwise(place)
