"""Session settings for tests and single-machine runs. A cluster brings its own session."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, name: str = "ledgerspark") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder from ``spark.checkpoint.dir``.

    Only on a local master that does not set it (tests, one machine) a fresh temporary folder is
    used; elsewhere executors would not see it, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return _own_folder()


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def short_batches(spark: SparkSession, most: str = "4m", rows: int = 512) -> None:
    """Python workers get at most ``most`` of rows at a time; a session's own limit stays.

    The usual 10,000 rows of whole texts are tens of megabytes, which the JVM and the worker of
    every running task hold several times over. Operators work through slices of a megabyte anyway.
    Parquet's reader, too, holds its batch of whole texts in arrays that double: ``rows`` at a time
    instead of 4,096, unless the session says otherwise.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(name, spark.conf.get(name, most))
    name = "spark.sql.parquet.columnarReaderBatchSize"
    if spark.conf.get(name) == "4096":
        spark.conf.set(name, rows)


def own_folder(spark: SparkSession, kind: str) -> str:
    """A new place in the shared folder, for files of one kind."""
    return f"{shared_folder(spark).rstrip('/')}/{kind}/{uuid.uuid4().hex}"


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting that holds for a while."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def written(df: DataFrame, **options: object) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back.

    For a table that several outputs need: it is computed once, and a lost executor costs a
    read instead of the whole lineage. The shuffle files of the write go as soon as it ends, not
    when the driver happens to collect its garbage. ``options`` go to the writer.
    """
    spark = df.sparkSession
    place = own_folder(spark, "tables")
    with _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.options(**options).parquet(place)
    table = spark.read.schema(df.schema).parquet(place)
    table.written_to = place
    return table


def release(*tables: DataFrame) -> None:
    """Frees the disk of written tables that nothing will read any more.

    Call it once all that was derived from them is itself written or collected. Tables that
    were not written hold no disk.
    """
    for table in tables:
        if "written_to" not in vars(table):
            continue
        empty = table.sparkSession.createDataFrame([], table.schema)
        empty.write.mode("overwrite").parquet(table.written_to)
