"""Extract tables: projection, names and types by declaration, never by inference."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parse_date
from ..functions.numbers import MONEY, credit_key, money, whole
from ..functions.text import canonical_id
from ..schemas import MONTHLY, Table
from .routing import load_report, type_of_name

KIND_TYPES = {"id": "string", "text": "string", "key": "string", "long": "bigint",
              "money": MONEY, "date": "date"}
ORDINAL = "_ord"


def _typed(column: Column, kind: str, source: T.DataType) -> Column:
    if kind == "id":
        return canonical_id(column)
    if kind == "key":
        return F.trim(column.cast("string"))
    if kind == "long":
        return column.cast("bigint") if isinstance(source, T.IntegralType) else whole(column)
    if kind == "money":
        return column.cast(MONEY) if isinstance(source, T.NumericType) else money(column)
    if kind == "date":
        plain = isinstance(source, (T.DateType, T.TimestampType, T.TimestampNTZType))
        return column.cast("date") if plain else parse_date(column)
    return column.cast("string")


def conform(df: DataFrame, table: Table, *, strict: bool = False, extra: Sequence[str] = ()
            ) -> DataFrame:
    """Selects, renames and types the declared columns in one projection.

    Headers are stripped. A column that is not there becomes a typed null, or with
    ``strict`` an error. All names change at once, so two columns may trade names.
    """
    present: dict[str, list[str]] = {}
    for name in df.columns:
        present.setdefault(name.strip(), []).append(name)
    missing = [s for s, _, _ in table.columns if s not in present]
    if strict and missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    out = []
    for source, name, kind in table.columns:
        if source in present:
            # Files of one scan may spell a header with and without blanks.
            value = F.coalesce(*[_typed(F.col(f"`{c}`"), kind, df.schema[c].dataType)
                                 for c in present[source]])
        else:
            value = F.lit(None).cast(KIND_TYPES[kind])
        out.append(value.alias(name))
    done = df.select(*out, *extra)
    return fill_blanks(done, table.fill) if table.fill else done


def fill_blanks(df: DataFrame, label: str, *, keep: Sequence[str] = ("Cedula_Cliente", ORDINAL)
                ) -> DataFrame:
    """Nulls and single dots become ``label``; identifiers are left alone."""
    return df.withColumns({
        c: F.when(F.col(c).isNull() | (F.col(c) == "."), F.lit(label)).otherwise(F.col(c))
        for c in df.columns if c not in keep
    })


def positional(df: DataFrame, table: Table, order: str) -> DataFrame:
    """Header-less table: names by position. ``order`` numbers the rows from 0."""
    return by_position(df.where(F.col(order) >= table.skip_rows), table, order)


def by_position(df: DataFrame, table: Table, order: str) -> DataFrame:
    names = [c for c in df.columns if c != order]
    picked = [F.col(f"`{c}`").cast("string").alias(n) for c, n in zip(names, table.names())]
    return df.select(*picked, order)


def with_file_order(df: DataFrame) -> DataFrame:
    """Adds the row's place in its file as ordinal, for keep-first and keep-last rules."""
    place = F.struct(F.col("_metadata.file_path").alias("path"),
                     F.col("_metadata.row_index").alias("row"))
    return df.withColumn(ORDINAL, place)


def with_credit_key(df: DataFrame) -> DataFrame:
    """Adds ``Credito`` and upper-cases the type; nothing changes without these columns."""
    if not {"Tipo_Credito", "Numero_Credito"} <= set(df.columns):
        return df
    return df.withColumns({
        "Tipo_Credito": F.upper(F.trim("Tipo_Credito")),
        "Credito": credit_key("Tipo_Credito", "Numero_Credito"),
    })


def union_all(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows of tables of one type; columns that one lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def empty(spark: SparkSession, table: Table) -> DataFrame:
    fields = ", ".join(f"`{name}` {KIND_TYPES[kind]}" for _, name, kind in table.columns)
    return with_credit_key(spark.createDataFrame([], fields)).withColumn(
        ORDINAL, F.struct(F.lit("").alias("path"), F.lit(0).cast("bigint").alias("row")))


def require_tables(found: Mapping[str, DataFrame], wanted: Mapping[str, Table]) -> None:
    missing = [name for name in wanted if name not in found]
    if missing:
        raise ValueError(f"missing tables: {', '.join(missing)}")


def conform_all(
    found: Mapping[str, DataFrame], wanted: Mapping[str, Table], *, extra: Sequence[str] = (ORDINAL,)
) -> dict[str, DataFrame]:
    """Every required table, strictly projected; a missing table or column is an error."""
    require_tables(found, wanted)
    return {name: conform(found[name], table, strict=True, extra=extra)
            for name, table in wanted.items()}


def load_extracts(spark: SparkSession, paths: Sequence[str]
                  ) -> tuple[dict[str, DataFrame], DataFrame]:
    """Reads Parquet extracts, sorted into types by file name, and reports on every path.

    All paths of a type are one scan, or one per schema where their schemas do not go
    together, so the plan does not grow with the number of files. Sheets of a workbook arrive
    as sub-folders named like the sheet; an absent sheet is skipped. A path that cannot be
    read is reported and left out as a whole, with all its sheets; the others are read.
    """
    kinds = {path: type_of_name(path) for path in paths}
    wanted: dict[str, dict[str, str]] = {}
    for path, kind in kinds.items():
        for name, folder in _tables_of(kind, path) if kind else ():
            wanted.setdefault(name, {})[folder] = path
    opened = {name: open_scans(spark, list(folders), merge=not MONTHLY[name].positional)
              for name, folders in wanted.items()}
    errors: dict[str, str] = {}
    for name, (_, problems) in opened.items():
        for folder, problem in problems.items():
            path = wanted[name][folder]
            if not (problem == ABSENT and folder != path and _exists(spark, path)):
                errors.setdefault(path, problem)
    report = load_report(spark.createDataFrame(
        [(path, errors.get(path)) for path in paths], "path string, error string"))

    loaded = {}
    for name, table in MONTHLY.items():
        parts = []
        for schema, folders in opened.get(name, ([], {}))[0]:
            good = [f for f in folders if wanted[name][f] not in errors]
            if good:
                scan = with_file_order(spark.read.schema(schema).parquet(*good))
                parts.append(_shaped(scan, table))
        loaded[name] = with_credit_key(union_all(parts)) if parts else empty(spark, table)
    return loaded, report


ABSENT = "not found"


def open_scans(
    spark: SparkSession, folders: Sequence[str], *, merge: bool = True
) -> tuple[list[tuple[T.StructType, list[str]]], dict[str, str]]:
    """Schemas with the folders that one scan can read under them, and unreadable folders.

    With ``merge`` columns that some files lack are null there. All footers are looked at in
    one job; only if that fails, or files must not be merged, folder by folder.
    """
    reader = spark.read.option("mergeSchema", True)
    if merge:
        try:
            return [(reader.parquet(*folders).schema, list(folders))], {}
        except (PySparkException, Py4JJavaError):
            pass

    def look(folder: str) -> tuple[T.StructType | None, str | None]:
        try:
            return reader.parquet(folder).schema, None
        except (PySparkException, Py4JJavaError) as problem:
            absent = isinstance(problem, AnalysisException) and "PATH_NOT_FOUND" in str(problem)
            return None, ABSENT if absent else str(problem).splitlines()[0]

    with ThreadPoolExecutor(FOOTER_THREADS) as pool:
        seen = dict(zip(folders, pool.map(look, folders)))
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for folder, (schema, _) in seen.items():
        if schema is not None:
            groups.setdefault(schema.json(), (schema, []))[1].append(folder)
    return list(groups.values()), {f: p for f, (_, p) in seen.items() if p is not None}


#: Folders whose footers are looked at at a time.
FOOTER_THREADS = 16


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException:
        return False
    return True


def _tables_of(kind: str, path: str) -> list[tuple[str, str]]:
    if MONTHLY[kind].sheet is None:
        return [(kind, path)]
    names = [kind, "CENTRO_COSTOS"] if kind == "ASESORES" else [kind]
    return [(name, f"{path.rstrip('/')}/{MONTHLY[name].sheet}") for name in names]


def _shaped(raw: DataFrame, table: Table) -> DataFrame:
    if not table.positional:
        return conform(raw, table, extra=(ORDINAL,))
    if table.skip_rows:
        raw = skip_first_rows(raw, table.skip_rows)
    return by_position(raw, table, ORDINAL)


def skip_first_rows(raw: DataFrame, rows: int) -> DataFrame:
    """Leaves out the first rows of every sheet in the scan, counted over its part files.

    A sheet is a folder of part files or one file of any other name. Only rows that come
    first in some file are looked at, so what is sent to all tasks is a few rows per file.
    """
    path = F.col(f"{ORDINAL}.path")
    name = F.element_at(F.split(path, "/"), -1)
    sheet = F.when(name.startswith("part-"), F.regexp_replace(path, "/[^/]*$", "")).otherwise(path)
    first = raw.where(F.col(f"{ORDINAL}.row") < rows).groupBy(sheet.alias("sheet")).agg(
        F.slice(F.array_sort(F.collect_list(ORDINAL)), 1, rows).alias("rows"))
    return raw.join(F.broadcast(first.select(F.explode("rows").alias(ORDINAL))), ORDINAL, "left_anti")
