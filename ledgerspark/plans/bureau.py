"""Bureau files: record file plus corrections to cleaned, padded records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators.bureau import Corrections, clean_bureau_a, clean_bureau_b, split_by_id
from ..schemas import CORRECTIONS, LAYOUT_A, LAYOUT_B, id_type_columns
from ..session import written
from ..sources.fixed_width import read_records
from ..sources.sinks import publish_tables, write_report
from ..sources.tables import ORDINAL, conform

CODE_A, CODE_B = "CODIGO DATA", "CODIGO CIFIN"


def corrections(found: Mapping[str, DataFrame], code: str) -> Corrections:
    """The corrections bundle from its tables, each with a row order; ``code`` picks the type."""
    def table(name: str) -> DataFrame:
        return conform(found[name], CORRECTIONS[name], strict=True, extra=(ORDINAL,))

    return Corrections(
        bad_ids=table("Cedulas a corregir"),
        master=table("Vinculado"),
        id_types=conform(found["Tipos de identificacion"], id_type_columns(code), strict=True,
                         extra=(ORDINAL,)),
        opening=table("FNZ001"),
        payments=table("R05"),
        names=table("names"),
    )


def run_bureau_a(
    spark: SparkSession, path: str, found: Mapping[str, DataFrame], out: str
) -> None:
    """Publishes the cleaned records. The file is parsed once; what follows reads columns."""
    records = written(read_records(spark, path, LAYOUT_A))
    write_report(clean_bureau_a(records, corrections(found, CODE_A)), out)


RECORDS, REJECTS = "records", "rejects"


def run_bureau_b(
    spark: SparkSession, path: str, found: Mapping[str, DataFrame], out: str
) -> list[str]:
    """Publishes the cleaned records and the raw records whose identifier is no number, at once.

    There need not be any rejects.
    """
    good, bad = split_by_id(written(read_records(spark, path, LAYOUT_B)))
    tables = {RECORDS: clean_bureau_b(good, corrections(found, CODE_B)), REJECTS: bad.drop(ORDINAL)}
    return publish_tables(spark, tables, out, may_be_empty=[REJECTS])
