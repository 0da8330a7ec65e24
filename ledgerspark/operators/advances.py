"""Advances received online, classified by the lender that holds the client's portfolio."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import labels as L
from ..functions.text import canonical_id
from .keyed import count_per_key, spread_join

# Columns of the three published tables.
ONLINE_COLUMNS = ["TIPO_RECIBO", "No", "CEDULA", "NOMBRE", "VALOR"]
LENDER_B_ORDER = [
    "ITEM", "TIPO_RECIBO", "No", "CEDULA", "NOMBRE", "CENTRO_COSTO_FS", "VALOR", "FACTURA_FS",
    "ZONA_COBRADOR_FS", "OBSERVACIONES", "CUENTAS_FS", "ULTIMO_SALDO_FS", "VALOR_POSITIVO",
    "RESTA_SALDO",
]
LENDER_A_ORDER = [
    "ITEM", "TIPO_RECIBO", "No", "CEDULA", "NOMBRE", "CENTRO_COSTO_ARP", "VALOR", "FACTURA_ARP",
    "ZONA_COBRADOR_ARP", "OBSERVACIONES", "CUENTAS_ARP", "ULTIMO_SALDO_ARP", "VALOR_POSITIVO",
    "RESTA_SALDO",
]
NO_PORTFOLIO_ORDER = [*ONLINE_COLUMNS, "CUENTAS_FS", "CUENTAS_ARP", "OBSERVACIONES"]


def match_accounts(online: DataFrame, lender_a: DataFrame, lender_b: DataFrame) -> DataFrame:
    """Every advance with each of its client's accounts at both lenders, and their counts.

    A client's accounts repeat its advances: that is the published result, not a by-product.
    All four tables meet on the client in one placement of the advances; a client with very
    many rows in the result is cut along its advances and along its accounts at either lender.
    """
    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn("CEDULA", canonical_id("CEDULA"))

    left, a, b = keyed(online), keyed(lender_a), keyed(lender_b)
    joined = spread_join(
        left,
        [count_per_key(b, ["CEDULA"], "CUENTAS_FS"), count_per_key(a, ["CEDULA"], "CUENTAS_ARP")],
        ["CEDULA"],
        many=[b, a],
    )
    return joined.withColumns({
        c: F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in ("CUENTAS_FS", "CUENTAS_ARP")
    })


def classify_advance(matched: DataFrame) -> DataFrame:
    """Amount, what is left of the balance, and the remark; the first remark that fits counts."""
    value = F.abs("VALOR")
    rest = F.coalesce(F.col("ULTIMO_SALDO_FS") - value, F.col("ULTIMO_SALDO_ARP") - value)
    at_b, at_a = F.col("FACTURA_FS").isNotNull(), F.col("FACTURA_ARP").isNotNull()
    several = F.col("OBSERVACIONES") == L.TWO_LENDERS

    def document(name: str) -> Column:
        return F.when(several, F.lit(L.SEVERAL_DOCUMENTS)).otherwise(F.col(name))

    return (
        matched.withColumns({"VALOR_POSITIVO": value, "RESTA_SALDO": rest})
        .withColumn(
            "OBSERVACIONES",
            F.when(at_b & at_a, L.TWO_LENDERS)
            .when(F.col("RESTA_SALDO") <= 0, L.ADVANCE_PAID)
            .when(at_b, L.AT_LENDER_B)
            .when(at_a, L.AT_LENDER_A)
            .otherwise(L.CHECK_GUARANTOR),
        )
        .withColumns({c: document(c) for c in ("FACTURA_FS", "FACTURA_ARP")})
    )


def _columns(df: DataFrame, order: list[str]) -> DataFrame:
    missing = F.lit(None).cast("string")
    return df.select(*[(F.col(c) if c in df.columns else missing).alias(c) for c in order])


def split_advances(classified: DataFrame) -> dict[str, DataFrame]:
    """The three published tables; an advance with both lenders is in two of them."""
    at_b, at_a = F.col("FACTURA_FS").isNotNull(), F.col("FACTURA_ARP").isNotNull()
    return {
        L.LENDER_B: _columns(classified.where(at_b), LENDER_B_ORDER),
        L.LENDER_A: _columns(classified.where(at_a), LENDER_A_ORDER),
        L.NO_PORTFOLIO: _columns(classified.where(~at_b & ~at_a), NO_PORTFOLIO_ORDER),
    }
