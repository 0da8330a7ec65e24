"""Publishing reports: each publication is a version of its own, and one row switches to it.

``<folder>/data/<version>/<table>`` holds the rows; ``<folder>/published`` has one row per
publication. That row is written last, by a job that adds a single file, so readers see the old
tables until all new ones are whole, and a write that fails midway changes nothing for them.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REPORT = "report"
_PUBLISHED = "version string, at long, tables array<struct<name:string,schema:string,rows:long>>, format string"


def publish_tables(
    spark: SparkSession, tables: Mapping[str, DataFrame], folder: str, *, fmt: str = "parquet",
    may_be_empty: Sequence[str] = (),
) -> list[str]:
    """Writes the tables once each and publishes them together; returns the published names.

    Tables without rows are not published unless named in ``may_be_empty``, and nothing is if
    none is left: then the publication before stays. Rows are counted while they are written.
    """
    version, done = uuid.uuid4().hex, []
    for name, table in tables.items():
        counted = Observation()
        table.observe(counted, F.count(F.lit(1)).alias("rows")).write.format(fmt).option(
            "header", True).save(_place(folder, version, name))
        done.append(Row(name=name, schema=table.schema.json(), rows=counted.get["rows"]))
    shown = [t for t in done if t.rows or t.name in may_be_empty]
    if not any(t.rows or set(tables) <= set(may_be_empty) for t in shown):
        raise ValueError("no rows to publish; what was published before is kept")
    row = spark.createDataFrame([(version, time.time_ns(), shown, fmt)], _PUBLISHED)
    row.coalesce(1).write.mode("append").parquet(f"{folder}/published")
    return [t.name for t in shown]


def write_report(
    report: DataFrame, path: str, *, fmt: str = "parquet", allow_empty: bool = False
) -> None:
    """Publishes one table; an empty one is refused and the report before it stays."""
    publish_tables(report.sparkSession, {REPORT: report}, path, fmt=fmt,
                   may_be_empty=[REPORT] if allow_empty else ())


def publications(spark: SparkSession, folder: str) -> DataFrame:
    """One row per publication, with the rows of its tables."""
    return spark.read.schema(_PUBLISHED).parquet(f"{folder}/published")


def _latest(spark: SparkSession, folder: str) -> Row:
    return publications(spark, folder).agg(
        F.max_by(F.struct("version", "tables", "format"), F.struct("at", "version")).alias("now")
    ).first().now


def read_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables that are published now. They stay readable until ``forget`` drops them."""
    now = _latest(spark, folder)
    return {
        t.name: spark.read.format(now.format).option("header", True)
        .schema(_schema(t.schema))
        .load(_place(folder, now.version, t.name))
        for t in now.tables
    }


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return read_tables(spark, path)[REPORT]


def forget(spark: SparkSession, folder: str, *, keep: int = 2) -> int:
    """Empties the tables of all but the last ``keep`` publications; returns how many."""
    rows = publications(spark, folder).orderBy(F.desc("at"), F.desc("version")).collect()
    for old in rows[keep:]:
        for t in old.tables:
            empty = spark.createDataFrame([], _schema(t.schema))
            empty.write.format(old.format).mode("overwrite").save(
                _place(folder, old.version, t.name))
    return len(rows[keep:])


def _schema(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


def _place(folder: str, version: str, name: str) -> str:
    return f"{folder.rstrip('/')}/data/{version}/{name}"
