"""Row marks of the published tables: data columns where a spreadsheet would use colours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import labels as L
from ..session import written
from .keyed import collapsed, expanded, flag_repeats, packed_counts


def flag_payments(payments: DataFrame) -> DataFrame:
    """Adds ``marca``: employee, else repeated document, else client with several accounts."""
    document = F.when(F.col("FACTURA FINAL") != L.NO_PORTFOLIO, F.col("FACTURA FINAL"))
    marked = flag_repeats(payments.withColumn("_doc", document), "_doc", "_again")
    a, b = F.col("CANTIDAD CUENTAS ARP"), F.col("CANTIDAD CUENTAS FS")
    return marked.withColumn(
        "marca",
        F.when(F.upper(F.trim("EMPLEADO")) == L.EMPLOYEE, F.lit("empleado"))
        .when(F.col("_again"), F.lit("documento repetido"))
        .when((a >= 2) | (b >= 2) | ((a >= 1) & (b >= 1)), F.lit("varias carteras"))
        .otherwise(F.lit("")),
    ).drop("_doc", "_again")


def flag_advances(table: DataFrame) -> DataFrame:
    """Adds ``marca`` for the remark, and flags for a repeated client and repeated documents.

    Equal rows are counted once for all three flags and written as one row each, so ``table`` -
    a client's accounts times its advances - is made once and never stored in full.
    """
    packed = written(collapsed(table))
    out, told = packed, packed.columns
    for column in ("CEDULA", "FACTURA_FS", "FACTURA_ARP"):
        if column in table.columns:
            out = flag_repeats(out, column, f"{column}_repetida", rows=told,
                               counts=packed_counts(packed, [column]))
    return expanded(out).withColumn(
        "marca",
        F.when(F.col("OBSERVACIONES") == L.TWO_LENDERS, F.lit("dos carteras"))
        .when(F.col("OBSERVACIONES") == L.ADVANCE_PAID, F.lit("pago total"))
        .otherwise(F.lit("")),
    )
