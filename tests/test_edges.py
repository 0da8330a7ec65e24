"""Edge cases on literal rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerspark.functions import dates, numbers, text, validity
from ledgerspark.operators import (
    advances, arrears, bureau, flags, goals, installments, invoices, items, keyed, payments, report,
    sellers,
)

D = dt.date


def values(spark, data, expression, kind="string"):
    """Results of ``expression('v')`` for each value."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [r[0] for r in df.coalesce(1).orderBy("i").select(expression("v")).collect()]


@pytest.mark.parametrize(("kind", "number", "want"), [
    (" df ", "12.0", "DF-12"), ("fa", "abc", "FA-"), ("FA", None, "FA-"), ("cr", "7.9", "CR-7"),
    ("cr", "1d", "CR-")])
def test_credit_key(spark, kind, number, want):
    df = spark.createDataFrame([(kind, number)], "k string, n string")
    assert df.select(numbers.credit_key("k", "n")).first()[0] == want


def test_invoice_key(spark):
    got = values(spark, ["a,b,FA,12", "x", None, "FA,3"], text.invoice_key)
    assert got == ["FA-12", None, None, "FA-3"]


def test_padding(spark):
    got = values(spark, ["7", "1234", "12345", "-5", "+5", ""], lambda c: text.zero_pad(c, 4))
    assert got == ["0007", "1234", "12345", "-005", "+005", "0000"]
    assert values(spark, ["a", "abcd", "abcde"], lambda c: text.space_pad(c, 4)) == [
        "a   ", "abcd", "abcde"]


def test_plain_text_folds_and_removes_everything(spark):
    got = values(spark, [text.FOLD_FROM, text.REMOVED_SYMBOLS, "Peña #1"], text.plain_text)
    assert got == [text.FOLD_TO, "", "PeNa 1"]
    assert len(text.FOLD_FROM) == len(text.FOLD_TO) == 22 and len(set(text.REMOVED_SYMBOLS)) == 33
    again = values(spark, got, text.plain_text)
    assert again == got


def test_ids_and_codes(spark):
    assert values(spark, [" 12.0 ", "012", "", None, "A1"], text.canonical_id) == [
        "12", "012", None, None, "A1"]
    assert values(spark, ["12.0", "012", "abc", None], numbers.code_text) == ["12", "12", None, None]
    assert values(spark, ["123.9", "REF", None, ""], numbers.reference_text) == ["123", "REF", "", ""]
    assert values(spark, ["007", "0", "X1"], bureau.id_text) == ["7", "0", "X1"]


def test_percent(spark):
    got = values(spark, ["19%", "19", "0.19", "1", None, "x", "12.5%"], numbers.percent_ratio)
    assert got == [0.19, 0.19, 0.19, 1.0, 0.0, 0.0, 0.125]
    assert values(spark, [0.19, 0.125, 0.135, 1.0, 19.0], numbers.percent_text, "double") == [
        "19%", "12%", "14%", "100%", "19%"]


def test_amount_text(spark):
    got = values(spark, [Decimal("5"), Decimal("5.5"), Decimal("12345678.25")], numbers.amount_text,
                 "decimal(18,2)")
    assert got == ["5.0", "5.5", "12345678.25"]


def test_dates(spark):
    got = values(spark, ["31/01/2024", "2024-01-31 10:00:00", "1/2/2024", "31/02/2024", "x", None],
                 dates.parse_date)
    assert got == [D(2024, 1, 31), D(2024, 1, 31), D(2024, 2, 1), None, None, None]
    assert values(spark, ["20240131.0", "nan", None, "0"], dates.compact_date) == [
        "20240131", "0", "0", "0"]


def test_phones(spark):
    raw = ["8221234", "3101234567", "6101234567", "310-123 4567", "", None]
    assert values(spark, raw, validity.valid_phone) == [
        "8221234", "3101234567", "", "3101234567", "", ""]
    assert values(spark, raw, lambda c: validity.valid_phone(c, landline=False))[0] == ""


def test_emails(spark):
    raw = ["a.b@x.co", "CORREGIR@x.co", "pendiente@x.co", "notiene@x.co", "sinc@x.co", "nn@x.co",
           "aaa@x.co", "a@b", None, " ok@x.com "]
    assert values(spark, raw, validity.valid_email) == [
        "a.b@x.co", "", "", "", "", "", "", "", "", "ok@x.com"]


def test_places(spark):
    got = values(spark, ["", "0", "nan", "None", "19001", None, " cali "],
                 lambda c: validity.place_or_default(c, "POPAYAN"))
    assert got == ["POPAYAN"] * 6 + ["CALI"]
    assert values(spark, ["n/a ", "0", None, "Cali "], validity.city_or_default) == [
        "POPAYAN", "POPAYAN", "POPAYAN", "Cali "]


def summary(spark, rows, as_of="2024-06-15"):
    df = spark.createDataFrame(
        rows, "Credito string, Fecha_Cuota_Vigente date, Cuota_Vigente bigint, v double, ord int"
    ).withColumn("Valor_Cuota_Vigente", F.col("v").cast("decimal(18,2)"))
    got = installments.installment_summary(df, as_of, order=["ord"])
    return {r.Credito: r for r in got.collect()}


def test_installment_summary(spark):
    got = summary(spark, [
        ("today", D(2024, 6, 15), 1, 10.0, 1),
        ("before", D(2024, 6, 14), 1, 10.0, 1),
        ("edges", D(2024, 6, 1), 1, 10.0, 1), ("edges", D(2024, 6, 30), 2, 20.0, 2),
        ("tie", D(2024, 5, 1), 7, 1.0, 2), ("tie", D(2024, 5, 1), 8, 2.0, 1),
        ("tie", D(2024, 6, 20), 9, 3.0, 4), ("tie", D(2024, 6, 20), 10, 4.0, 3),
        ("null", None, 1, 10.0, 1), (None, D(2024, 6, 1), 1, 10.0, 1),
        ("future", D(2024, 7, 1), 1, 10.0, 1),
        ("no amount", D(2024, 5, 1), 1, None, 1)])
    assert set(got) == {"today", "before", "edges", "tie", "future", "no amount"}
    assert got["today"].Valor_Vencido is None and got["today"].Cuota_Vigente == 1
    assert got["before"].Valor_Vencido == 10 and got["before"].Primera_Cuota_Mora == 1
    assert got["edges"].Cuota_Vigente == 2 and got["edges"].Primera_Cuota_Mora == 1
    assert got["tie"].Primera_Cuota_Mora == 8 and got["tie"].Cuota_Vigente == 10
    assert got["tie"].Valor_Vencido == 3
    assert got["future"].Fecha_Cuota_Vigente is None and got["future"].Valor_Vencido is None
    assert got["no amount"].Valor_Vencido == 0


def sales(spark, rows):
    return spark.createDataFrame(
        rows, "Credito string, Cedula_Cliente string, Fecha_Facturada date, ord int")


def test_invoice_window(spark):
    got = {r[0]: r[1] for r in invoices.invoice_of_credit(sales(spark, [
        ("DF-1", "a", D(2024, 3, 31), 1), ("FA-1", "a", D(2024, 3, 1), 2),
        ("FA-9", "a", D(2024, 5, 1), 3),
        ("DF-2", "b", D(2024, 3, 31), 4), ("FA-2", "b", D(2024, 4, 30), 5),
        ("DF-3", "c", D(2024, 3, 31), 6), ("FA-3", "c", D(2024, 5, 1), 7),
        ("DF-4", "d", D(2024, 3, 10), 8), ("FA-5", "d", D(2024, 3, 12), 9),
        ("FA-4", "d", D(2024, 3, 8), 10),
        ("DF-6", "e", D(2024, 3, 10), 11),
        ("DF-7", None, D(2024, 3, 10), 12), ("FA-7", None, D(2024, 3, 10), 13),
        ("DF-8", "f", D(2024, 3, 1), 14), ("DF-8", "f", D(2024, 3, 9), 15),
        ("FA-8", "f", D(2024, 3, 10), 16), ("FA-6", "f", D(2024, 2, 1), 17)]),
        order=["ord"]).collect()}
    assert got == {"DF-1": "FA-1", "DF-2": "FA-2", "DF-4": "FA-5", "DF-8": "FA-8"}


@pytest.mark.parametrize(("day", "label"), [(D(2024, 1, 1), "NO ASIGNADA"), (None, "ERROR DE FECHA")])
def test_invoice_labels(spark, day, label):
    table = sales(spark, [("FA-1", "a", day, 1)])
    credits = spark.createDataFrame([("DF-1", "FINANSUEÑOS"), ("FA-1", "ARPESOD")],
                                    "Credito string, Empresa string")
    got = {r.Credito: r.Factura_Venta
           for r in invoices.assign_invoice(credits, table, order=["ord"]).collect()}
    assert got == {"DF-1": label, "FA-1": "FA-1"}
    for absent in (None, table.where("false")):
        got = {r.Credito: r.Factura_Venta
               for r in invoices.assign_invoice(credits, absent, order=["ord"]).collect()}
        assert got["DF-1"] == "NO DISPONIBLE"


def test_items(spark):
    df = spark.createDataFrame([
        ("FA-1", "tv", "6000.01", "1", 3), ("FA-1", "mug", "6000", "2", 1), ("FA-1", "x", None, "9", 2),
        ("FA-1", "tv", "9000", "1.5", 0), ("FA-1", None, "7000", "1", 4), ("FA-2", None, "7000", "1", 5)],
        "Credito string, Nombre_Producto string, t string, c string, ord int").select(
        "*", F.col("t").cast("decimal(18,2)").alias("Total_Venta"),
        F.col("c").cast("decimal(18,2)").alias("Cantidad_Item"))
    got = {r.Credito: r for r in items.item_summary(df, order=["ord"]).collect()}
    assert got["FA-1"].Nombre_Producto == "tv" and got["FA-1"].Obsequio == "mug"
    assert got["FA-1"].Cantidad_Producto == 3 and got["FA-1"].Cantidad_Obsequio == 2
    assert got["FA-2"].Nombre_Producto is None and got["FA-2"].Cantidad_Producto == 1


def test_repair_and_band(spark):
    assert values(spark, [99, 100, 101, 200, None], numbers.last_two_digits_over_100, "int") == [
        99, 100, 1, 0, None]
    assert values(spark, [-1, 0, 1, 30, 31, 90, 91, 361, None], arrears.arrears_band, "int") == [
        "SIN INFO", "AL DIA", "1 A 30", "1 A 30", "31 A 90", "31 A 90", "91 A 360", "91 A 360",
        "SIN INFO"]


def test_goal_metrics(spark):
    days = [0, 30, 31, 180, 181, 360, 361, None]
    rows = spark.createDataFrame([(d, "Z ") for d in days], "Dias_Atraso int, Zona string").select(
        "*", F.lit("FINANSUEÑOS").alias("Empresa"), F.lit(100).cast("bigint").alias("Saldo_Capital"),
        F.lit(10).cast("bigint").alias("Saldo_Avales"),
        F.lit(1).cast("bigint").alias("Saldo_Interes_Corriente"),
        F.lit(1).cast("decimal(18,2)").alias("Meta_DC_Al_Dia"),
        F.lit(None).cast("decimal(18,2)").alias("Meta_DC_Atraso"),
        F.lit(2).cast("decimal(18,2)").alias("Meta_Atraso"))
    goal = spark.createDataFrame([("Z", "19%", "19", "0.19", "1", "50")], [
        "Zona", "Meta_1_A_30", "Meta_31_A_90", "Meta_91_A_180", "Meta_181_A_360", "Total_Recaudo"])
    got = {r.Dias_Atraso: r for r in goals.goal_metrics(rows, goal).collect()}
    assert [got[d]["Meta_%"] for d in days] == [0, 0.19, 0.19, 0.19, 1.0, 1.0, 0, 0]
    assert got[30]["Meta_General"] == 3 and got[30]["Meta_TR_$"] == 55.5
    empty = goals.goal_metrics(rows, None).first()
    assert empty["Meta_%"] is None and empty["Meta_General"] == 3


def test_clear_arrears(spark):
    df = spark.createDataFrame([(0, 5, 9.0), (None, 5, 9.0), (5, 5, 9.0)],
                               "Dias_Atraso int, Primera_Cuota_Mora int, v double").withColumn(
        "Valor_Vencido", F.col("v").cast("decimal(18,2)"))
    got = {r.Dias_Atraso: (r.Primera_Cuota_Mora, float(r.Valor_Vencido))
           for r in installments.clear_arrears(df).collect()}
    assert got == {0: (None, 0.0), None: (None, 0.0), 5: (5, 9.0)}


def test_sellers(spark):
    base = spark.createDataFrame([("12.0", "1"), ("abc", "x"), (None, "2")],
                                 "Codigo_Vendedor string, Codigo_Centro_Costos string")
    people = spark.createDataFrame([("12", "Ana", 1), ("12", "Eva", 2), ("abc", "Leo", 3)],
                                   "Codigo_Vendedor string, Jefe_ventas string, ord int")
    centers = spark.createDataFrame([("1.0", "Sur", 1)],
                                    "Codigo_Centro_Costos string, Regional_Venta string, ord int")
    got = sorted((r.Vendedor_Activo, r.Jefe_ventas or "", r.Regional_Venta or "") for r in
                 sellers.sellers_and_centers(base, people, centers, order=["ord"]).collect())
    assert got == [("INACTIVO", "", ""), ("SI", "", ""), ("SI", "Ana", "Sur")]


def test_date_filter(spark):
    df = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 1, 31),), (D(2024, 2, 1),), (None,)],
                               "Fecha_Cuota_Vigente date")
    assert report.date_filter(df, "01/01/2024", "31/01/2024").count() == 2
    for bounds in ((None, "31/01/2024"), ("01/01/2024", ""), ("2024-01-01", "31/01/2024")):
        assert report.date_filter(df, *bounds).count() == 4


def test_report_keeps_overdue_total(spark):
    """Only temporary suffixes are dropped, never a column that merely contains one."""
    df = spark.createDataFrame([(1,)], "Valor_Vencido int").select(
        F.col("Valor_Vencido").cast("decimal(18,2)"), F.lit(1).alias("Zona_Venc"),
        *[F.lit(None).cast(t).alias(c) for c, t in (
            ("Fecha_Cuota_Vigente", "date"), ("Cuota_Vigente", "int"), ("Valor_Cuota_Vigente", "int"),
            ("Fecha_Cuota_Atraso", "date"), ("Primera_Cuota_Mora", "int"),
            ("Valor_Cuota_Atraso", "decimal(18,2)"))])
    out = report.finalize_report(df, ["Valor_Vencido"])
    assert out.columns[0] == "Valor_Vencido" and "Zona_Venc" not in out.columns
    assert out.first().Cuota_Vigente == "VIGENCIA EXPIRADA"


ACCOUNT = "CEDULA string, FACTURA string, SALDO decimal(18,2), CENTRO_COSTO string, ord int"


def test_resolve_portfolio(spark):
    money = Decimal
    b = spark.createDataFrame([("one", "DF-1", money(50), "c1", 1), ("both", "DF-2", money(5), "c", 2),
                               (None, "DF-9", money(5), "c", 3)], ACCOUNT)
    a = spark.createDataFrame([("both", "FA-1", money(5), "c", 1), ("two", "FA-2", money(5), "c", 2),
                               ("two", "FA-3", money(5), "c", 3), ("a", "FA-4", money(7), "c4", 4)], ACCOUNT)
    pays = spark.createDataFrame([("one", 10), ("one", 10), ("both", 1), ("two", 1), ("a", 1),
                                  ("none", 1), (None, 1)], "Referencia string, Valor int")
    people = spark.createDataFrame([("one", "SI", 1), ("one", "NO", 2)],
                                   "vincedula string, ESTADO_EMPLEADO string, ord int")
    agency = spark.createDataFrame([("FA-4", "X", 1), ("FA-4", "Y", 2)],
                                   "FACTURA string, `CASA COBRANZA` string, ord int")
    backers = spark.createDataFrame([("none", "DF-7"), ("none", "FA-8")],
                                    "DOCUMENTO_CODEUDOR string, CODEUDOR string")
    got = payments.resolve_portfolio(
        pays, "Referencia", lender_a=a, lender_b=b, employees=people, agencies=agency,
        guarantors=backers, order=["ord"]).collect()
    seen = {}
    for r in got:
        seen.setdefault(r.Referencia, []).append(r)
    assert {k: len(v) for k, v in seen.items()} == {
        "one": 1, "both": 1, "two": 1, "a": 1, "none": 2, None: 1}
    assert seen["one"][0]["FACTURA FINAL"] == "DF-1" and seen["one"][0]["SALDOS"] == 50
    assert seen["one"][0]["ESTADO_EMPLEADO"] == "SI"
    assert seen["both"][0]["FACTURA FINAL"] == seen["two"][0]["FACTURA FINAL"] == "Mas de una cartera"
    assert seen["a"][0]["CASA COBRANZA"] == "X" and seen["a"][0]["CENTRO COSTO"] == "c4"
    assert seen["none"][0]["FACTURA FINAL"] == seen[None][0]["FACTURA FINAL"] == "SIN CARTERA"


@pytest.mark.parametrize(("balance", "value", "state", "applied", "surplus", "advance"), [
    (100, 40, "60.0", 40, 0, 0), (100, 100, "pago total", 100, 0, 0),
    (100, 101, "pago total", 100, 1, 0), (100, 10100, "pago total", 100, 10000, 10000),
    (100, 10101, "pago total", 100, 0, 10001), (None, 70, "pago total", 70, 70, 0)])
def test_apply_payment(spark, balance, value, state, applied, surplus, advance):
    df = spark.createDataFrame([(balance, value, "FA-1")],
                               "SALDOS int, Valor int, `FACTURA FINAL` string")
    r = payments.apply_payment(df).first()
    assert r["VALIDACION ULTIMO SALDO"] == state
    assert (r["Valor Aplicar"], r["Valor Aprovechamientos"], r["Valor Anticipos"]) == (
        applied, surplus, advance)


def test_classify_advance(spark):
    cols = "n string, VALOR int, FACTURA_FS string, FACTURA_ARP string, ULTIMO_SALDO_FS int, ULTIMO_SALDO_ARP int"
    df = spark.createDataFrame([
        ("two", -10, "DF-1", "FA-1", 10, 10), ("paid", -10, "DF-1", None, 10, None),
        ("b", -10, "DF-1", None, 11, None), ("a", 10, None, "FA-1", None, 11),
        ("none", -10, None, None, None, None)], cols)
    got = {r.n: r for r in advances.classify_advance(df).collect()}
    assert {k: r.OBSERVACIONES for k, r in got.items()} == {
        "two": "REVISAR TIENE 2 CARTERAS", "paid": "PAGO TOTAL", "b": "CARTERA EN FINANSUEÑOS",
        "a": "CARTERA EN ARPESOD", "none": "REVISAR SI ES CODEUDOR"}
    assert got["two"].FACTURA_FS == got["two"].FACTURA_ARP == "MAS DE UNA CARTERA"
    assert got["b"].VALOR_POSITIVO == 10 and got["b"].RESTA_SALDO == 1


def test_payment_marks(spark):
    df = spark.createDataFrame([
        ("SI", "FA-1", 0, 1), ("no", "FA-1", 0, 1), ("NO", "SIN CARTERA", 0, 0),
        ("NO", "SIN CARTERA", 1, 1), ("NO", "FA-2", 2, 0)],
        "EMPLEADO string, `FACTURA FINAL` string, `CANTIDAD CUENTAS FS` int, `CANTIDAD CUENTAS ARP` int")
    got = sorted(r.marca for r in flags.flag_payments(df).collect())
    assert got == ["", "documento repetido", "empleado", "varias carteras", "varias carteras"]


def test_first_and_last_per_key(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), (None, 3, 3)], "k string, v int, ord int")
    assert [tuple(r) for r in keyed.first_per_key(df, ["k"], ["ord"], keep=["v"]).collect()] == [("a", 1)]
    assert [tuple(r) for r in keyed.last_per_key(df, ["k"], ["ord"], keep=["v"]).collect()] == [("a", 2)]


def test_key_variants_last_spelling_wins(spark):
    df = spark.createDataFrame([("X", 1, 1), ("XC1", 2, 2), ("X", 3, 3)], "k string, v int, ord int")
    got = dict(map(tuple, keyed.with_key_variants(df, "k", "v", ["ord"]).collect()))
    assert got["X"] == 3 and got["XC1"] == 3 and got["XC1C2"] == 2


def test_opening_value_is_not_scaled_by_text(spark):
    df = spark.createDataFrame([("DF", "1", Decimal("1234999"), 1)],
                               "kind string, number string, amount decimal(18,2), _ord int")
    got = dict(map(tuple, bureau.opening_values(df).collect()))
    assert got == {"DF1": 1234, "DF1C1": 1234, "DF1C2": 1234}


def test_bureau_a_loses_symbols_in_identifier_and_dates(spark):
    from ledgerspark.operators import bureau
    from ledgerspark.schemas import LAYOUT_A

    cells = {bureau.A_ID: "900.123-4", "FECHA APERTURA": "2024-01-05", "FECHA VENCIMIENTO": "2024/03/01",
             "FECHA DE PAGO": "x", bureau.A_ACCOUNT: "FA 1", "VALOR SALDO MORA": "25000", bureau.A_EMAIL: "a.b@mail.co"}
    schema = ", ".join(f"`{n}` string" for n, _, _ in LAYOUT_A)
    records = spark.createDataFrame([tuple(cells.get(n) for n, _, _ in LAYOUT_A)], schema)

    def table(ddl, *rows):
        return spark.createDataFrame(list(rows), ddl)

    fixes = bureau.Corrections(
        bad_ids=table("bad string, good string, _ord int"),
        master=table("id string, name string, address string, email string, phone string, _ord int"),
        id_types=table("id string, code string, _ord int", ("900.123-4", "31", 0)),
        opening=table("kind string, number string, amount decimal(18,2), _ord int"),
        payments=table("kind string, number string, amount double, _ord int", (" FA", "1 ", 30000.0, 0), ("FA", "1", 4500.0, 1)),
        names=table("id string, full_name string, _ord int"))
    row = bureau.clean_bureau_a(records, fixes).first()
    assert row[bureau.A_ID] == "00009001234" and row["TIPO DE IDENTIFICACION"] == "31"
    assert (row["FECHA APERTURA"], row["FECHA VENCIMIENTO"], row["FECHA DE PAGO"]) == ("20240105", "20240301", "00000000")
    assert row[bureau.A_EMAIL].strip() == "a.b@mail.co" and row["VALOR SALDO MORA"] == 25000
    paid = bureau.clean_bureau_a(records, fixes, apply_payments=True).first()
    assert paid["VALOR SALDO MORA"] == 34500


def test_payments_with_a_row_id_stay_apart(spark):
    from ledgerspark.operators.payments import distinct_payments

    df = spark.createDataFrame([(1, "a", 5), (2, "a", 5), (2, "a", 5)], "id int, client string, amount int")
    assert distinct_payments(df).count() == 2
    assert distinct_payments(df.drop("id")).count() == 1
    assert distinct_payments(df, row_id=["id"]).count() == 2


def test_a_report_without_installment_columns_gets_them(spark):
    from ledgerspark.operators.report import finalize_report

    done = finalize_report(spark.createDataFrame([("FA-1",)], "Credito string"), ["Credito", "Valor_Vencido"])
    row = done.first()
    assert row.Valor_Vencido == 0 and row.Cuota_Vigente == "VIGENCIA EXPIRADA" and row.Fecha_Cuota_Atraso == "SIN MORA"
