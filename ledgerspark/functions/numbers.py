"""Number expressions. Unusable input becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col

MONEY = "decimal(18,2)"

NUMBER_FORM = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _numeric_text(c: Column | str) -> Column:
    # The guard keeps out spellings such as '1d', which a Java parser accepts.
    text = _col(c).cast("string")
    return F.when(text.rlike(NUMBER_FORM), F.trim(text))


def number(c: Column | str) -> Column:
    return _numeric_text(c).try_cast("double")


def money(c: Column | str) -> Column:
    return _numeric_text(c).try_cast(MONEY)


def whole(c: Column | str) -> Column:
    """Integer part: digits are read exactly, other spellings are cut toward zero."""
    text = _col(c).cast("string")
    return F.coalesce(text.try_cast("bigint"), number(text).try_cast("bigint"))


def code_text(c: Column | str) -> Column:
    """Numeric code as integer text (``'12.0'`` -> ``'12'``); null when it is no number."""
    return whole(c).cast("string")


def reference_text(c: Column | str) -> Column:
    """Numbers lose their fraction, other text stays, null becomes empty text."""
    return F.coalesce(code_text(c), _col(c).cast("string"), F.lit(""))


def thousands(c: Column | str) -> Column:
    """Amount in thousands, cut toward zero."""
    return (_col(c) / F.lit(1000)).cast("bigint")


def zero_below(c: Column | str, limit: int, *, inclusive: bool) -> Column:
    """Null and amounts under ``limit`` (or up to it) become 0; the rest is cut to an integer."""
    amount = _col(c)
    keep = amount > limit if inclusive else amount >= limit
    return F.when(keep, amount.cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def last_two_digits_over_100(c: Column | str) -> Column:
    value = _col(c)
    return F.when(value > 100, value % 100).otherwise(value)


def _scaled(value: Column) -> Column:
    return F.when(value > 1, value / 100).otherwise(value)


def percent_ratio(c: Column | str) -> Column:
    """``'19%'``, ``'19'`` and ``'0.19'`` all give 0.19; ``'1'`` stays 1; unusable gives 0."""
    cleaned = F.replace(_col(c).cast("string"), F.lit("%"), F.lit(""))
    return F.coalesce(_scaled(number(cleaned)), F.lit(0.0))


def percent_text(c: Column | str) -> Column:
    """Ratio as whole percent text, rounded half to even."""
    ratio = F.bround(_scaled(_col(c).cast("double")), 4)
    return F.concat(F.bround(ratio * 100, 0).cast("int").cast("string"), F.lit("%"))


def amount_text(c: Column | str) -> Column:
    """Amount with at least one decimal place: ``1234.0``, ``1234.5``, ``1234.56``."""
    return F.regexp_replace(_col(c).cast(MONEY).cast("string"), r"0$", "")


def credit_key(kind: Column | str, value: Column | str) -> Column:
    """``' df '`` and ``12.0`` give ``DF-12``; an unusable number leaves ``DF-``."""
    digits = F.coalesce(whole(value).cast("string"), F.lit(""))
    return F.concat(F.upper(F.trim(_col(kind).cast("string"))), F.lit("-"), digits)
