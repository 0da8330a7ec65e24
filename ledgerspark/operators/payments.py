"""Payments received through a bank or a cash network, matched to portfolios."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import labels as L
from ..functions.dates import date_text
from ..functions.numbers import MONEY, amount_text, reference_text
from .keyed import first_per_key, spread_join

ACCOUNT_COLUMNS = ["CEDULA", "FACTURA", "SALDO", "CENTRO_COSTO"]


def client_accounts(lender_a: DataFrame, lender_b: DataFrame, *, order: Sequence[str]) -> DataFrame:
    """One row per client: accounts with each lender, and the document a payment goes to.

    The document is lender B's first one if there is any, else lender A's first one; a
    client with more than one account gets the label of several portfolios instead. The
    counting happens before any payment is looked at, so accounts never multiply payments.
    """
    both = _tagged(lender_a, lender_b).dropna(subset=["CEDULA"])
    is_b = F.col("at") == 0
    rank = F.struct(*order)

    def count(which: Column) -> Column:
        return F.count(F.when(which, 1))

    grouped = both.groupBy("CEDULA").agg(
        count(is_b).alias("CANTIDAD CUENTAS FS"),
        count(~is_b).alias("CANTIDAD CUENTAS ARP"),
        F.min_by("FACTURA", F.when(is_b, rank)).alias("b"),
        F.min_by("FACTURA", F.when(~is_b, rank)).alias("a"),
    )
    several = F.col("CANTIDAD CUENTAS FS") + F.col("CANTIDAD CUENTAS ARP") > 1
    return grouped.withColumn(
        "FACTURA FINAL",
        F.when(several, F.lit(L.SEVERAL_PORTFOLIOS)).otherwise(F.coalesce("b", "a")),
    ).drop("a", "b")


def _tagged(lender_a: DataFrame, lender_b: DataFrame) -> DataFrame:
    return lender_b.withColumn("at", F.lit(0)).unionByName(lender_a.withColumn("at", F.lit(1)))


def document_balances(
    lender_a: DataFrame, lender_b: DataFrame, *, order: Sequence[str]
) -> DataFrame:
    """Balance and cost centre by document over both lenders, lender B's rows first."""
    both = _tagged(lender_a, lender_b)
    return first_per_key(
        both, ["FACTURA"], ["at", *order], keep=["SALDO", "CENTRO_COSTO"]
    ).toDF("FACTURA FINAL", "SALDOS", "CENTRO COSTO")


def portfolio_of_client(
    lender_a: DataFrame, lender_b: DataFrame, agencies: DataFrame, *, order: Sequence[str]
) -> DataFrame:
    """Document, balance, cost centre and collection agency of each client with an account."""
    accounts = client_accounts(lender_a, lender_b, order=order)
    agency = first_per_key(agencies, ["FACTURA"], order, keep=["CASA COBRANZA"])
    # The label of several portfolios is no document: it looks nothing up, so it must not
    # gather its clients in one place either. A null key is spread freely.
    shown = F.col("FACTURA FINAL")
    keyed = accounts.withColumns({
        "shown": shown, "FACTURA FINAL": F.when(shown != L.SEVERAL_PORTFOLIOS, shown),
    })
    found = spread_join(
        keyed,
        [document_balances(lender_a, lender_b, order=order),
         agency.withColumnRenamed("FACTURA", "FACTURA FINAL")],
        ["FACTURA FINAL"],
        rows=["CEDULA"],
    )
    return found.drop("FACTURA FINAL").withColumnRenamed("shown", "FACTURA FINAL")


def distinct_payments(payments: DataFrame, *, row_id: Sequence[str] = ()) -> DataFrame:
    """Identical payments collapse into one; with ``row_id`` columns every payment stays."""
    return payments.dropDuplicates(list(row_id)) if row_id else payments.distinct()


def resolve_portfolio(
    payments: DataFrame,
    client: str,
    *,
    lender_a: DataFrame,
    lender_b: DataFrame,
    employees: DataFrame,
    agencies: DataFrame,
    guarantors: DataFrame,
    order: Sequence[str],
    row_id: Sequence[str] = (),
) -> DataFrame:
    """Attaches employee state, portfolio and guarantor to every distinct payment.

    Identical payments collapse into one unless ``row_id`` tells them apart. Several guarantor rows of a client repeat its
    payments. All tables are keyed by client, so payments are shuffled once, with the
    payments of a heavy client, and its guarantors, spread over many tasks.
    """
    distinct = distinct_payments(payments, row_id=row_id)
    people = first_per_key(employees, ["vincedula"], order, keep=["ESTADO_EMPLEADO"])
    portfolio = portfolio_of_client(lender_a, lender_b, agencies, order=order)
    backed = guarantors.select("DOCUMENTO_CODEUDOR", "CODEUDOR")
    joined = spread_join(
        distinct,
        [people.withColumnRenamed("vincedula", client),
         portfolio.withColumnRenamed("CEDULA", client)],
        [client],
        many=[backed.withColumnRenamed("DOCUMENTO_CODEUDOR", client)],
        rows=row_id or payments.columns,
    )
    none = F.lit(0).cast("bigint")
    return joined.withColumns({
        "CANTIDAD CUENTAS FS": F.coalesce("CANTIDAD CUENTAS FS", none),
        "CANTIDAD CUENTAS ARP": F.coalesce("CANTIDAD CUENTAS ARP", none),
        "FACTURA FINAL": F.coalesce("FACTURA FINAL", F.lit(L.NO_PORTFOLIO)),
    })


def apply_payment(payments: DataFrame) -> DataFrame:
    """How much of each payment is applied, written off as surplus, or held as an advance."""
    zero = F.lit(0).cast(MONEY)
    several = F.col("FACTURA FINAL") == L.SEVERAL_PORTFOLIOS
    based = payments.withColumns({
        "SALDOS": F.when(several, zero).otherwise(F.coalesce(F.col("SALDOS").cast(MONEY), zero)),
        "Valor": F.coalesce(F.col("Valor").cast(MONEY), zero),
    })
    balance, value = F.col("SALDOS"), F.col("Valor")
    total = balance - value <= 0
    applied = F.when(total & (balance != 0), balance).otherwise(value)
    over = value - balance
    rest = value - applied
    return based.withColumns({
        "VALIDACION ULTIMO SALDO": F.when(total, F.lit(L.PAID_IN_FULL)).otherwise(
            amount_text(balance - value)),
        "Valor Aplicar": applied,
        "Valor Aprovechamientos": F.when((over > 0) & (over <= L.SURPLUS_LIMIT), over)
        .otherwise(zero).cast(MONEY),
        "Valor Anticipos": F.when(rest >= L.SURPLUS_LIMIT, rest).otherwise(zero).cast(MONEY),
    })


def classify_novelty(payments: DataFrame) -> DataFrame:
    """Adds ``Novedad``, and fills employee state, agency and guarantor with their labels."""
    filled = payments.withColumns({
        "EMPLEADO": F.coalesce("ESTADO_EMPLEADO", F.lit(L.NO_EMPLOYEE)),
        "CASA COBRANZA": F.coalesce("CASA COBRANZA", F.lit(L.NO_AGENCY)),
        "CODEUDOR": F.coalesce("CODEUDOR", F.lit(L.NO_GUARANTOR)),
    })
    return filled.withColumn(
        "Novedad",
        F.when(F.col("CASA COBRANZA") != L.NO_AGENCY, F.col("CASA COBRANZA"))
        .when(F.col("CODEUDOR") != L.NO_GUARANTOR,
              F.concat(F.lit(L.GUARANTOR_PREFIX), F.col("CODEUDOR")))
        .when(F.col("VALIDACION ULTIMO SALDO") == L.PAID_IN_FULL, F.lit(L.NOVELTY_PAID))
        .otherwise(F.lit(L.NOVELTY_NONE)),
    )


def lender_of_document(payments: DataFrame) -> DataFrame:
    """Adds ``Empresa`` from the document or, without a portfolio, the guarantor's document."""
    has_guarantor = F.col("CODEUDOR") != L.NO_GUARANTOR
    source = F.when(F.col("FACTURA FINAL") != L.NO_PORTFOLIO, F.col("FACTURA FINAL")).when(
        has_guarantor, F.col("CODEUDOR"))
    return payments.withColumn(
        "Empresa",
        F.when(source.startswith(L.LENDER_B_TYPE), F.lit(L.LENDER_B_TITLE))
        .when(source.isNotNull(), F.lit(L.LENDER_A_TITLE))
        .otherwise(F.lit("")),
    )


# Published names, and the column order of the two payment reports.
PAYMENT_TITLES = {
    "FACTURA FINAL": "Documento Cartera",
    "CENTRO COSTO": "C. Costo",
    "CASA COBRANZA": "Casa cobranza",
    "EMPLEADO": "Empleado",
    "CANTIDAD CUENTAS ARP": "Cuentas ARP",
    "CANTIDAD CUENTAS FS": "Cuentas FS",
}
CASH_ORDER = [
    "No", "Identificación", "Valor", "N° de Autorización", "Fecha", "Documento Cartera",
    "C. Costo", "Empresa", "Valor Aplicar", "Valor Anticipos", "Valor Aprovechamientos",
    "Casa cobranza", "Empleado", "Novedad", "Cuentas ARP", "Cuentas FS", "SALDOS",
    "VALIDACION ULTIMO SALDO",
]
BANK_ORDER = [
    "No.", "Fecha", "Detalle 1", "Detalle 2", "Referencia 1", "Referencia 2", "Valor",
    "Documento Cartera", "C. Costo", "Empresa", "Valor Aplicar", "Valor Anticipos",
    "Valor Aprovechamientos", "Casa cobranza", "Empleado", "Novedad", "Cuentas ARP",
    "Cuentas FS", "SALDOS", "VALIDACION ULTIMO SALDO",
]


def format_payments(payments: DataFrame, order: Sequence[str]) -> DataFrame:
    """Published form: dates as text, clean references, titles, and exactly ``order``.

    ``No`` becomes ``No.`` where the order asks for it; a column that does not exist is null.
    """
    titles = {old: new for old, new in PAYMENT_TITLES.items() if new in order}
    if "No." in order:
        titles["No"] = "No."
    source = {titles.get(c, c): F.col(f"`{c}`") for c in payments.columns}
    source["Fecha"] = date_text("Fecha") if "Fecha" in payments.columns else None
    for name in ("Referencia 1", "Referencia 2"):
        if name in source:
            source[name] = reference_text(name)
    missing = F.lit(None).cast("string")
    return payments.select(
        *[(source[c] if source.get(c) is not None else missing).alias(c) for c in order]
    )
