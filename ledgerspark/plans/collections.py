"""Collections: payments through a bank and a cash network, matched to portfolios."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.flags import flag_payments
from ..operators.payments import (
    BANK_ORDER, CASH_ORDER, apply_payment, classify_novelty, format_payments, lender_of_document,
    resolve_portfolio,
)
from ..schemas import COLLECTIONS
from ..session import written
from ..sources.sinks import publish_tables
from ..sources.tables import ORDINAL, conform_all


@dataclass(frozen=True)
class Channel:
    """A payment table, the column that names its client, and the published columns."""

    table: str
    client: str
    order: tuple[str, ...]
    title: str


BANK = Channel("PAGOS BANCOLOMBIA", "Referencia 1", tuple(BANK_ORDER), "Bancolombia")
CASH = Channel("PAGOS EFECTY", "Identificación", tuple(CASH_ORDER), "Efecty")


def collections(
    tables: Mapping[str, DataFrame], channel: Channel, *, order: Sequence[str] = (ORDINAL,)
) -> DataFrame:
    """Payments of one channel with portfolio, amounts applied, remark and lender."""
    matched = resolve_portfolio(
        tables[channel.table].drop(*order),
        channel.client,
        lender_a=tables["AC ARP"],
        lender_b=tables["AC FS"],
        employees=tables["EMPLEADOS ACTUALES"],
        agencies=tables["CASA DE COBRANZA"],
        guarantors=tables["CODEUDORES"],
        order=order,
    )
    return lender_of_document(classify_novelty(apply_payment(matched)))


def run_collections(spark: SparkSession, found: Mapping[str, DataFrame], folder: str) -> list[str]:
    """Publishes both payment reports at once, each row with its mark."""
    tables = conform_all(found, COLLECTIONS)
    reports = {}
    for channel in (BANK, CASH):
        # Marks compare every payment with the counts over all, so the payments are needed twice.
        payments = written(collections(tables, channel))
        marked = flag_payments(payments)
        reports[channel.title] = format_payments(marked, [*channel.order, "marca"])
    return publish_tables(spark, reports, folder)
