"""Which kind of extract a file is, told by its name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import FILE_TYPES

LOADED, SKIPPED, FAILED = "loaded", "skipped", "failed"


def _base_name(path: Column) -> Column:
    name = F.element_at(F.split(path, "/"), -1)
    return F.replace(F.upper(F.element_at(F.split(name, r"\."), 1)), F.lit(" "), F.lit("_"))


def file_type(path: Column | str, types: Sequence[str] = FILE_TYPES) -> Column:
    """Type of the file at ``path``, null if unknown.

    The longest type is tried first. A type fits if the base name starts with it or holds
    all of its words.
    """
    base = _base_name(F.col(path) if isinstance(path, str) else path)
    words = F.split(base, "_")
    found = F.lit(None).cast("string")
    for kind in reversed(sorted(types, key=len, reverse=True)):
        key = kind.upper().replace(" ", "_")
        has_words = F.lit(True)
        for word in key.split("_"):
            has_words = has_words & F.array_contains(words, word)
        found = F.when(base.startswith(key) | has_words, F.lit(kind)).otherwise(found)
    return found


def load_report(files: DataFrame, path: str = "path") -> DataFrame:
    """One row per file: path, type, status and reason. A column ``error`` marks failures."""
    kind = file_type(path)
    error = F.col("error") if "error" in files.columns else F.lit(None).cast("string")
    return files.select(
        F.col(path).alias("path"),
        kind.alias("type"),
        F.when(kind.isNull(), SKIPPED).when(error.isNotNull(), FAILED).otherwise(LOADED)
        .alias("status"),
        F.when(kind.isNull(), "unknown type").otherwise(error).alias("reason"),
    )


def type_of_name(name: str, types: Sequence[str] = FILE_TYPES) -> str | None:
    """The same rule for one file name, used while a set of paths is sorted into scans."""
    base = name.rstrip("/").rsplit("/", 1)[-1].split(".")[0].upper().replace(" ", "_")
    words = set(base.split("_"))
    for kind in sorted(types, key=len, reverse=True):
        key = kind.upper().replace(" ", "_")
        if base.startswith(key) or set(key.split("_")) <= words:
            return kind
    return None
