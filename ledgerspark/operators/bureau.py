"""Corrections and cleaning of bureau records.

Records are wide, corrections are narrow. So everything a record needs from the corrections
is first composed per raw identifier and per account; the wide records are then shuffled
once for each of these two keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import labels as L
from ..functions.numbers import MONEY, NUMBER_FORM, number, thousands, whole, zero_below
from ..functions.dates import compact_date, not_before
from ..functions.text import (
    account_key, canonical_id, collapse_spaces, contains_any, drop_spaces, plain_text, prefix,
    no_nan, space_pad, trimmed, zero_pad,
)
from ..functions.validity import (
    DEFAULT_CITY, DEFAULT_DEPARTMENT, city_or_default, place_or_default, valid_email, valid_phone,
)
from .keyed import (
    first_per_key, last_per_key, lookup, row_counts_of, spread_join, sum_per_key,
    with_key_variants,
)


@dataclass(frozen=True)
class Corrections:
    """The corrections bundle; every table has an ``_ord`` column that gives its row order.

    ``bad_ids(bad, good)``, ``master(id, name, address, email, phone)``, ``id_types(id, code)``,
    ``opening(kind, number, amount)``, ``payments(kind, number, amount)``, ``names(id, full_name)``
    """

    bad_ids: DataFrame
    master: DataFrame
    id_types: DataFrame
    opening: DataFrame
    payments: DataFrame
    names: DataFrame


CONTACTS = ["name", "address", "email", "phone"]
_ORD = ["_ord"]


def id_text(c: Column | str) -> Column:
    """Identifier of a record: digits lose leading zeros, other text is only trimmed."""
    text = canonical_id(c)
    return F.when(text.rlike("^0+[0-9]"), F.regexp_replace(text, "^0+(?=[0-9])", "")).otherwise(text)


def corrected_ids(bad_ids: DataFrame) -> DataFrame:
    """``id`` -> ``good``; the last correction of an identifier counts."""
    pairs = bad_ids.select(id_text("bad").alias("id"), id_text("good").alias("good"), *_ORD)
    return last_per_key(pairs, ["id"], _ORD, keep=["good"])


def correct_ids(
    records: DataFrame, column: str, bad_ids: DataFrame, *, rows: Sequence[str] | None = None
) -> DataFrame:
    """Replaces identifiers that have a correction; the others stay."""
    table = corrected_ids(bad_ids).withColumnRenamed("id", column)
    found = lookup(records, table, [column], rows=rows)
    return found.withColumn(column, F.coalesce("good", column)).drop("good")


def contact_master(master: DataFrame) -> DataFrame:
    """One row of contact data per identifier, the first if there are several."""
    return first_per_key(master.withColumn("id", id_text("id")), ["id"], _ORD, keep=CONTACTS)


def id_type_table(id_types: DataFrame) -> DataFrame:
    return last_per_key(id_types.withColumn("id", id_text("id")), ["id"], _ORD, keep=["code"])


def name_table(names: DataFrame) -> DataFrame:
    return last_per_key(names.withColumn("id", id_text("id")), ["id"], _ORD, keep=["full_name"])


def person_table(fixes: Corrections) -> DataFrame:
    """Everything known about a raw identifier: the corrected one, contacts, type, name.

    Built from the corrections alone, so it needs no pass over the records. Raw identifiers are
    distinct, but many wrong ones may lead to one person, hence the spread join.
    """
    pairs = corrected_ids(fixes.bad_ids)
    contacts = contact_master(fixes.master).withColumn("in_master", F.lit(True))
    types, names = id_type_table(fixes.id_types), name_table(fixes.names)
    known = pairs.select("id")
    for table in (contacts, types, names):
        known = known.unionByName(table.select("id"))
    people = known.distinct().join(pairs, "id", "left").select(
        F.col("id").alias("raw"), F.coalesce("good", "id").alias("id")
    )
    return spread_join(people, [contacts, types, names], ["id"], rows=["raw"])


def repair_contact(current: str, replacement: str) -> Column:
    """A field that asks for a correction takes the master's value, null if there is none."""
    return F.when(contains_any(current, [L.TO_CORRECT]), F.col(replacement)).otherwise(
        F.col(current))


def with_person(
    records: DataFrame, id_column: str, fixes: Corrections, *, rows: Sequence[str] | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Adds the person columns by raw identifier and puts the corrected identifier in place."""
    table = person_table(fixes).withColumnRenamed("id", "good").withColumnRenamed("raw", id_column)
    return (
        lookup(records, table, [id_column], rows=rows, counts=counts)
        .withColumn(id_column, F.coalesce("good", id_column))
        .drop("good", "in_master")
    )


def repair_contacts(records: DataFrame, fields: dict[str, str]) -> DataFrame:
    """``fields`` maps a record's column to the person column that can replace it."""
    return records.withColumns({c: repair_contact(c, p) for c, p in fields.items()})


def opening_values(opening: DataFrame, *, width: int | None = None, strip_only: bool = False
                   ) -> DataFrame:
    """``account`` -> opening amount in thousands, for an account and its two suffixed spellings.

    With ``width`` the keys are zero-padded, as that file's accounts are.
    """
    key = F.concat(F.trim("kind"), F.trim("number")) if strip_only else account_key("kind", "number")
    amount = thousands(F.coalesce(F.col("amount").cast(MONEY), F.lit(0).cast(MONEY)))
    table = opening.select(key.alias("account"), amount.alias("opening"), *_ORD)
    return with_key_variants(table, "account", "opening", _ORD, width=width)


def payments_received(
    payments: DataFrame, *, width: int | None = None, strip_only: bool = False,
    in_thousands: bool = True,
) -> DataFrame:
    """``account`` -> amount paid; amounts are summed before any division.

    Bureau B's file has thousands and accounts without any blanks, bureau A's whole amounts
    and accounts whose parts are only stripped.
    """
    key = F.concat(F.trim("kind"), F.trim("number")) if strip_only else account_key("kind", "number")
    amount = F.coalesce(F.col("amount"), F.lit(0).cast(MONEY))
    summed = sum_per_key(
        payments.select(key.alias("account"), F.col("amount").cast(MONEY).alias("amount")),
        ["account"], {"amount": F.col("amount")},
    ).select("account", (thousands(amount) if in_thousands else amount.cast(MONEY)).alias("paid"))
    # An account has one sum, so only padding can make two of them one key.
    return with_key_variants(summed, "account", "paid", ["account"] if width else [], width=width)


def id_type_text(code: str = "code", *, width: int | None = None) -> Column:
    """Identifier type as text, 1 where none is known; with ``width`` cut and zero-padded."""
    text = F.coalesce(whole(code), F.lit(1)).cast("string")
    return text if width is None else zero_pad(F.substring(text, 1, width), width)


def pad_fields(records: DataFrame, *, zeros: dict[str, int], blanks: dict[str, int]) -> DataFrame:
    """Fields in their published widths: numbers with zeros in front, texts with blanks behind."""
    return records.withColumns(
        {c: zero_pad(F.coalesce(c, F.lit("")), w) for c, w in zeros.items()}
        | {c: space_pad(F.coalesce(c, F.lit("")), w) for c, w in blanks.items()})


def override_name(id_column: str, name_column: str) -> Column:
    """Upper-cased name with single blanks, or the name the corrections give by identifier."""
    return F.coalesce(F.col("full_name"), F.upper(collapse_spaces(name_column)))


# ---------------------------------------------------------------------------------------------
# Bureau A
# ---------------------------------------------------------------------------------------------

A_ID = "NUMERO DE IDENTIFICACION"
A_NAME = "NOMBRE COMPLETO"
A_ADDRESS = "DIRECCION DE CORRESPONDENCIA"
A_EMAIL = "CORREO ELECTRONICO"
A_PHONE = "CELULAR"
A_CITY = "CIUDAD CORRESPONDENCIA"
A_ACCOUNT = "NUMERO DE LA CUENTA U OBLIGACION"
A_OPENING = "VALOR INICIAL"
A_AVAILABLE = "VALOR DISPONIBLE"
A_AMOUNTS = [A_OPENING, "VALOR SALDO DEUDA", A_AVAILABLE, "V CUOTA MENSUAL", "VALOR SALDO MORA"]
A_DATES = ["FECHA APERTURA", "FECHA VENCIMIENTO", "FECHA DE PAGO"]
A_SMALL = 10_000

# Widths of the published fields, and the constant ones.
A_ZERO_WIDTHS = {
    A_ID: 11, A_PHONE: 12, "RESPONSABLE": 2, "NOVEDAD": 2, "TOTAL CUOTAS": 3,
    "CUOTAS CANCELADAS": 3, "CUOTAS EN MORA": 3, "EDAD DE MORA": 3, "ESTADO DE LA CUENTA": 2,
    "FECHA DE ADJETIVO": 8, "CLAUSULA DE PERMANENCIA": 3, "FECHA CLAUSULA DE PERMANENCIA": 8,
}
A_BLANK_WIDTHS = {A_NAME: 45, A_ADDRESS: 60, A_CITY: 20, A_EMAIL: 60}
A_CONSTANTS = {"ESTADO ORIGEN DE LA CUENTA": "0", "SITUACION DEL TITULAR": "0", "ADJETIVO": "0"}
A_ACCOUNT_WIDTH = 18


def record_columns(records: DataFrame) -> tuple[list[str], list[str] | None]:
    """The fields of the records, and the column that tells equal records apart, if any."""
    known = _ORD if _ORD[0] in records.columns else None
    return [c for c in records.columns if c not in _ORD], known


def floor_amounts(columns: Sequence[str], limit: int, *, inclusive: bool) -> dict[str, Column]:
    return {c: zero_below(number(c), limit, inclusive=inclusive) for c in columns}


def clean_bureau_a(records: DataFrame, fixes: Corrections, *, apply_payments: bool = False
                   ) -> DataFrame:
    """Corrected and padded records of bureau A, from trimmed text fields.

    ``apply_payments`` also writes payments received into the arrears value, which the
    published file does not do: its account keys can never meet. ``_ord`` is a record's place
    in its file, where it is known.
    """
    columns, rows = record_columns(records)
    account = zero_pad(F.coalesce(drop_spaces(A_ACCOUNT), F.lit("")), A_ACCOUNT_WIDTH)
    keyed = records.withColumns({A_ID: id_text(A_ID), A_ACCOUNT: account})
    of_id, of_account = row_counts_of(keyed, [A_ID], [A_ACCOUNT])
    person = with_person(keyed, A_ID, fixes, rows=rows, counts=of_id)
    fixed = repair_contacts(person, {A_NAME: "name", A_ADDRESS: "address", A_EMAIL: "email",
                                     A_PHONE: "phone"})

    tables = [opening_values(fixes.opening, width=A_ACCOUNT_WIDTH, strip_only=True)]
    if apply_payments:
        tables.append(payments_received(fixes.payments, width=A_ACCOUNT_WIDTH, strip_only=True,
                                        in_thousands=False))
    valued = spread_join(
        fixed, [t.withColumnRenamed("account", A_ACCOUNT) for t in tables], [A_ACCOUNT],
        rows=rows, counts=of_account,
    )
    amounts = {A_OPENING: F.coalesce(F.col("opening").cast("string"), F.col(A_OPENING))}
    if apply_payments:
        amounts["VALOR SALDO MORA"] = F.coalesce(
            F.col("paid").cast("string"), F.col("VALOR SALDO MORA"))
    valued = valued.withColumns(amounts)

    # Amounts are numbers by then; every text but the e-mail loses its symbols, also dates and
    # the identifier, after it has been looked up.
    texts = [c for c in columns if c not in (A_EMAIL, *A_AMOUNTS)]
    plain = valued.withColumns({c: plain_text(F.coalesce(c, F.lit(""))) for c in texts})
    opened, due, paid_on = (compact_date(c) for c in A_DATES)
    kept = [c for c in A_AMOUNTS if c != A_AVAILABLE]
    checked = plain.withColumns(
        {
            A_DATES[0]: opened,
            A_DATES[1]: not_before(due, opened),
            A_DATES[2]: F.when(paid_on == "0", L.EMPTY_DATE).otherwise(paid_on),
            A_AVAILABLE: F.lit(0).cast("bigint"),
            A_NAME: override_name(A_ID, A_NAME),
            A_CITY: city_or_default(A_CITY, DEFAULT_CITY),
            A_PHONE: valid_phone(A_PHONE),
            A_EMAIL: valid_email(A_EMAIL),
            "TIPO DE IDENTIFICACION": id_type_text(),
        }
        | floor_amounts(kept, A_SMALL, inclusive=False)
    )
    padded = pad_fields(checked, zeros=A_ZERO_WIDTHS, blanks=A_BLANK_WIDTHS)
    return padded.withColumns({c: F.lit(v) for c, v in A_CONSTANTS.items()}).select(*columns)


# ---------------------------------------------------------------------------------------------
# Bureau B
# ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class BureauBColumns:
    """Physical names of the fields that bureau B's cleaning touches (fixed values)."""

    id_number: str = "NUMERO DE IDENTIFICACION"
    id_type: str = "tipo_identificacion"
    full_name: str = "nombre_tercero"
    address: str = "direccion_casa"
    email: str = "correo_electronico"
    phone: str = "numero_celular"
    home_phone: str = "telefono_casa"
    company_phone: str = "telefono_empresa"
    account_number: str = "numero_obligacion"
    initial_value: str = "valor_inicial"
    open_date: str = "fecha_inicio"
    due_date: str = "fecha_terminacion"
    city: str = "ciudad_casa"
    department: str = "departamento_casa"
    balance_due: str = "valor_saldo"
    available_value: str = "cargo_fijo"
    monthly_fee: str = "valor_cuota"
    arrears_value: str = "valor_mora"
    arrears_age: str = "edad_mora"
    periodicity: str = "periodicidad"
    actual_value_paid: str = "valor_real_pagado"

    def amounts(self) -> list[str]:
        return [self.initial_value, self.balance_due, self.available_value, self.monthly_fee,
                self.arrears_value]

    def widths(self) -> dict[str, int]:
        return {self.full_name: 60, self.account_number: 20, self.address: 60, self.city: 20,
                self.department: 20, self.email: 60, self.phone: 60, self.home_phone: 20,
                self.company_phone: 20}


B = BureauBColumns()
B_SMALL = 10
B_ACCOUNT_WIDTH = 20


def split_by_id(records: DataFrame, id_column: str = B.id_number) -> tuple[DataFrame, DataFrame]:
    """Records with a numeric identifier, written without leading zeros, and the rejects."""
    numeric = F.coalesce(F.col(id_column).rlike(NUMBER_FORM), F.lit(False))
    good = records.where(numeric).withColumn(id_column, whole(id_column).cast("string"))
    return good, records.where(~numeric)


def clean_bureau_b(records: DataFrame, fixes: Corrections, names: BureauBColumns = B) -> DataFrame:
    """Corrected and padded records of bureau B, from trimmed text fields with numeric ids."""
    columns, rows = record_columns(records)
    account = prefix(F.coalesce(drop_spaces(names.account_number), F.lit("")), B_ACCOUNT_WIDTH)
    keyed = records.withColumn(names.account_number, account)
    of_id, of_account = row_counts_of(keyed, [names.id_number], [names.account_number])
    person = with_person(keyed, names.id_number, fixes, rows=rows, counts=of_id)
    fixed = repair_contacts(person, {names.full_name: "name", names.address: "address",
                                     names.email: "email", names.phone: "phone"})
    valued = spread_join(
        fixed,
        [t.withColumnRenamed("account", names.account_number)
         for t in (opening_values(fixes.opening), payments_received(fixes.payments))],
        [names.account_number],
        rows=rows, counts=of_account,
    )

    untouched = (names.email, names.actual_value_paid, names.id_number)
    texts = [c for c in columns if c not in untouched]
    plain = valued.withColumns({c: plain_text(F.coalesce(c, F.lit(""))) for c in texts})

    opened, due = compact_date(names.open_date), compact_date(names.due_date)
    amounts = floor_amounts(names.amounts(), B_SMALL, inclusive=True)
    amounts[names.initial_value] = zero_below(
        F.coalesce(F.col("opening").cast("double"), number(names.initial_value)), B_SMALL,
        inclusive=True)
    checked = plain.withColumns(
        amounts
        | {
            names.open_date: opened,
            names.due_date: not_before(due, opened),
            names.actual_value_paid: F.coalesce("paid", F.lit(0).cast("bigint")),
            names.id_type: id_type_text(width=2),
            names.city: place_or_default(names.city, DEFAULT_CITY),
            names.department: place_or_default(names.department, DEFAULT_DEPARTMENT),
            names.full_name: override_name(names.id_number, names.full_name),
            names.home_phone: valid_phone(names.home_phone),
            names.company_phone: valid_phone(names.company_phone),
            names.phone: valid_phone(names.phone, landline=False),
            names.email: valid_email(names.email),
            names.periodicity: F.lit(L.PERIODICITY),
        }
    )

    numeric = {*names.amounts(), names.actual_value_paid}
    texts = [c for c in columns if c not in numeric]
    # Two steps, so that the trimmed text is not computed twice for every field.
    clean = checked.withColumns({c: trimmed(c) for c in texts}).withColumns(
        {c: no_nan(c) for c in texts})
    padded = clean.withColumns(
        {c: space_pad(c, w) for c, w in names.widths().items()}
        | {names.arrears_age: zero_pad(names.arrears_age, 2),
           names.id_number: zero_pad(names.id_number, 15)}
    )
    return padded.select(*columns)
