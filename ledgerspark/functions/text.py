"""Text expressions: every helper maps a Column to a Column and stays inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters folded to a plain capital, in matching positions.
FOLD_FROM = "ÑÁÉÍÓÚÜŸÂÃš©ñáéíóúüÿâã"
FOLD_TO = "NAEIOUUYAASCNAEIOUUYAA"

# Symbols deleted from text fields.
REMOVED_SYMBOLS = "@°|¬¡“#$%&/()=‘\\¿+~´[{^-_.:,;<>Æ±"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse_spaces(c: Column | str) -> Column:
    """Runs of white space become one blank; both ends are trimmed."""
    return F.trim(F.regexp_replace(_col(c), r"\s+", " "))


def digits_only(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"[^0-9]", "")


def drop_spaces(c: Column | str) -> Column:
    return F.replace(_col(c).cast("string"), F.lit(" "), F.lit(""))


def prefix(c: Column | str, width: int) -> Column:
    return F.substring(_col(c), 1, width)


def zero_pad(c: Column | str, width: int) -> Column:
    """Left-pad with zeros after an optional sign. Longer text is returned as it is.

    ``lpad`` alone cuts longer text and would put the zeros before the sign.
    """
    text = _col(c).cast("string")
    signed = text.startswith("-") | text.startswith("+")
    body = F.substr(text, F.lit(2))
    return F.when(
        signed, F.concat(F.left(text, F.lit(1)), _filled(body, width - 1))
    ).otherwise(_filled(text, width))


def _filled(text: Column, width: int) -> Column:
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def space_pad(c: Column | str, width: int) -> Column:
    """Right-pad with blanks. Longer text is returned as it is."""
    text = _col(c).cast("string")
    return F.rpad(text, F.greatest(F.lit(width), F.length(text)), F.lit(" "))


def plain_text(c: Column | str) -> Column:
    """Fold accented letters and delete symbols, in one pass over the text."""
    return F.translate(_col(c), FOLD_FROM + REMOVED_SYMBOLS, FOLD_TO)


def invoice_key(c: Column | str) -> Column:
    """``a,b,FA,12`` -> ``FA-12``; text without a comma has no key."""
    last_two = F.substring_index(_col(c), ",", -2)
    return F.when(last_two.contains(","), F.replace(last_two, F.lit(","), F.lit("-")))


def canonical_id(c: Column | str) -> Column:
    """Identifier text without outer blanks and without a trailing ``.0``; blank is null."""
    text = F.regexp_replace(F.trim(_col(c).cast("string")), r"\.0$", "")
    return F.when(text != "", text)


def account_key(kind: Column | str, number: Column | str) -> Column:
    return F.concat(drop_spaces(kind), drop_spaces(number))


def contains_any(c: Column | str, words: list[str]) -> Column:
    """True where the text holds one of the words, in any case; null text holds none."""
    upper = F.upper(_col(c))
    found = F.lit(False)
    for word in words:
        found = found | upper.contains(word.upper())
    return F.coalesce(found, F.lit(False))


def trimmed(c: Column | str) -> Column:
    """Text without outer blanks; null becomes empty text."""
    return F.trim(F.coalesce(_col(c).cast("string"), F.lit("")))


def scrub_null_text(c: Column | str) -> Column:
    """Trim; null and the word ``nan`` in any case become empty text."""
    return no_nan(trimmed(c))


def no_nan(c: Column | str) -> Column:
    text = _col(c)
    return F.when(F.lower(text) == "nan", F.lit("")).otherwise(text)
