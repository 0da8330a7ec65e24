"""Queries on the bureau files: records are orders written as fixed-width lines and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.functions.text import plain_text
from ledgerspark.operators import bureau
from ledgerspark.operators.keyed import lookup
from ledgerspark.plans import bureau as bureau_plan
from ledgerspark.schemas import LAYOUT_A, LAYOUT_B
from ledgerspark.session import own_folder, written
from ledgerspark.sources.fixed_width import (
    lines_and_rejects, parse_fields, read_records, write_record_files,
)
from ledgerspark.sources.tables import ORDINAL, union_all

from .extracts import LINES, ORDERS, lines, orders
from .registry import query, shown, table

# One raw value per line field as a Spark expression and the same in SQL; other fields are blank.
_COMMON = {
    "id": ("lpad(o_custkey, 11, '0')", "lpad(CAST(o_custkey AS VARCHAR), 11, '0')"),
    "name": (
        "CASE WHEN c_mktsegment = 'BUILDING' THEN 'por corregir' ELSE concat('Peña   ', c_name) END",
        "CASE WHEN c_mktsegment = 'BUILDING' THEN 'por corregir' ELSE 'Peña   ' || c_name END"),
    "account": (
        "concat(Tipo_Credito, ' ', o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'C1' ELSE '' END)",
        "tipo || ' ' || o_orderkey || CASE WHEN o_orderstatus = 'P' THEN 'C1' ELSE '' END"),
    "opened": ("date_format(dia, 'yyyyMMdd')", "strftime(dia, '%Y%m%d')"),
    "due": (
        "CASE o_orderstatus WHEN 'F' THEN '' WHEN 'P' THEN date_format(dia - INTERVAL 40 DAYS, 'yyyyMMdd')"
        " ELSE date_format(dia + INTERVAL 40 DAYS, 'yyyyMMdd') END",
        "CASE o_orderstatus WHEN 'F' THEN '' WHEN 'P' THEN strftime(dia - INTERVAL 40 DAYS, '%Y%m%d')"
        " ELSE strftime(dia + INTERVAL 40 DAYS, '%Y%m%d') END"),
    "paid_on": (
        "CASE WHEN o_orderstatus = 'F' THEN date_format(dia, 'yyyyMMdd') ELSE '00000000' END",
        "CASE WHEN o_orderstatus = 'F' THEN strftime(dia, '%Y%m%d') ELSE '00000000' END"),
    "price": ("CAST(floor(o_totalprice) AS BIGINT)", "CAST(floor(o_totalprice) AS BIGINT)"),
    "fee": ("CAST(floor(o_totalprice / 20) AS BIGINT)", "CAST(floor(o_totalprice / 20) AS BIGINT)"),
    "tiny": ("CAST(floor(o_totalprice / 40000) AS BIGINT)",
             "CAST(floor(o_totalprice / 40000) AS BIGINT)"),
    "arrears": ("CASE WHEN o_orderstatus = 'O' THEN '' ELSE '25000' END",
                "CASE WHEN o_orderstatus = 'O' THEN '' ELSE '25000' END"),
    "city": (
        "CASE WHEN c_nationkey = 0 THEN '' WHEN c_nationkey = 1 THEN 'N/A' WHEN c_nationkey = 2 THEN '0'"
        " WHEN c_nationkey = 3 THEN '19001' ELSE concat('Villa ', c_nationkey) END",
        "CASE WHEN c_nationkey = 0 THEN '' WHEN c_nationkey = 1 THEN 'N/A' WHEN c_nationkey = 2 THEN '0'"
        " WHEN c_nationkey = 3 THEN '19001' ELSE 'Villa ' || c_nationkey END"),
    "address": (
        "CASE WHEN c_acctbal > 9000 THEN 'CORREGIR' ELSE concat('Cra. 5 # 3-', o_custkey, ' ¿Barrio Ñ?') END",
        "CASE WHEN c_acctbal > 9000 THEN 'CORREGIR' ELSE 'Cra. 5 # 3-' || o_custkey || ' ¿Barrio Ñ?' END"),
    "email": (
        "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'NoTiene@x.co' WHEN c_mktsegment = 'FURNITURE' THEN 'corregir'"
        " WHEN c_acctbal < 0 THEN 'sin arroba' ELSE concat('c', o_custkey, '@mail.co') END",
        "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'NoTiene@x.co' WHEN c_mktsegment = 'FURNITURE' THEN 'corregir'"
        " WHEN c_acctbal < 0 THEN 'sin arroba' ELSE 'c' || o_custkey || '@mail.co' END"),
    "phone": (
        "CASE o_orderstatus WHEN 'F' THEN concat('3', lpad(o_custkey, 9, '0')) WHEN 'P' THEN"
        " concat('82 ', lpad(o_custkey, 5, '0')) ELSE 'CORREGIR' END",
        "CASE o_orderstatus WHEN 'F' THEN '3' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') WHEN 'P' THEN"
        " '82 ' || lpad(CAST(o_custkey AS VARCHAR), 5, '0') ELSE 'CORREGIR' END"),
    "month": ("month(dia)", "month(dia)"),
    "blank": ("''", "''"),
    "word": ("o_orderpriority", "o_orderpriority"),
}

FIELDS_A = {
    "TIPO DE IDENTIFICACION": "blank", "NUMERO DE IDENTIFICACION": "id", "NOMBRE COMPLETO": "name",
    "NUMERO DE LA CUENTA U OBLIGACION": "account", "FECHA APERTURA": "opened",
    "FECHA VENCIMIENTO": "due", "RESPONSABLE": "blank", "NOVEDAD": "month",
    "VALOR INICIAL": "price", "VALOR SALDO DEUDA": "fee", "VALOR DISPONIBLE": "price",
    "V CUOTA MENSUAL": "fee", "VALOR SALDO MORA": "arrears", "TOTAL CUOTAS": "month",
    "CUOTAS CANCELADAS": "month", "FECHA LIMITE DE PAGO": "opened", "FECHA DE PAGO": "paid_on",
    "CIUDAD CORRESPONDENCIA": "city", "DIRECCION DE CORRESPONDENCIA": "address",
    "CORREO ELECTRONICO": "email", "CELULAR": "phone", "EDAD DE MORA": "month",
    "ESTADO DE LA CUENTA": "month", "FECHA DE ADJETIVO": "month",
}

FIELDS_B = {
    "NUMERO DE IDENTIFICACION": "id", "nombre_tercero": "name", "numero_obligacion": "account",
    "fecha_inicio": "opened", "fecha_terminacion": "due", "fecha_pago": "paid_on",
    "edad_mora": "month", "valor_inicial": "price", "valor_saldo": "fee", "valor_cuota": "tiny",
    "valor_mora": "arrears", "cargo_fijo": "tiny", "ciudad_casa": "city",
    "departamento_casa": "city", "direccion_casa": "address", "correo_electronico": "email",
    "numero_celular": "phone", "telefono_casa": "phone", "telefono_empresa": "phone",
    "nombre_empresa": "address", "fecha_limite_pago": "opened", "plazo": "month",
}


def _clients(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return orders(spark, d).join(c, "o_custkey")


def record_lines(spark: SparkSession, d: str, layout, fields: dict[str, str]) -> DataFrame:
    """One line per order as its record file has it, with the order's key as row order."""
    raw = _clients(spark, d).select(F.col("o_orderkey").alias(ORDINAL), *[
        F.expr(_COMMON[fields.get(name, "blank")][0]).cast("string").alias(name)
        for name, _, _ in layout])
    return written(lines_and_rejects(raw, layout, keep=[ORDINAL]).select(ORDINAL, "line"))


def corrections(spark: SparkSession, d: str) -> bureau.Corrections:
    c, s, o = table(spark, d, "customer"), table(spark, d, "supplier"), orders(spark, d)
    key = F.col("c_custkey")
    return bureau.Corrections(
        bad_ids=c.where("c_acctbal < 0").select(
            F.concat(F.lit(" "), key.cast("string")).alias("bad"),
            (key + 1).cast("string").alias("good"), key.alias("_ord")),
        master=c.where("c_mktsegment <> 'HOUSEHOLD'").select(
            key.cast("string").alias("id"), F.concat(F.lit("Núñez "), "c_name").alias("name"),
            F.concat(F.lit("Calle "), "c_custkey").alias("address"),
            F.concat(F.lit("m"), "c_custkey", F.lit("@mail.com")).alias("email"),
            F.concat(F.lit("31"), F.lpad(key.cast("string"), 8, "0")).alias("phone"),
            key.alias("_ord")),
        id_types=s.select(F.col("s_suppkey").cast("string").alias("id"),
                          F.col("s_nationkey").alias("code"), F.col("s_suppkey").alias("_ord")),
        opening=o.where("o_orderpriority <> '5-LOW'").select(
            F.col("Tipo_Credito").alias("kind"), F.col("o_orderkey").cast("string").alias("number"),
            (F.col("valor") * 100).cast("decimal(18,2)").alias("amount"),
            F.col("o_orderkey").alias("_ord")),
        payments=lines(spark, d).where("l_returnflag <> 'N'").select(
            F.split("Credito", "-")[0].alias("kind"), F.col("l_orderkey").cast("string").alias("number"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
            F.col("l_orderkey").alias("_ord")),
        names=s.where("s_nationkey < 5").select(
            F.col("s_suppkey").cast("string").alias("id"), F.upper("s_name").alias("full_name"),
            F.col("s_suppkey").alias("_ord")),
    )


_PLAIN = ("'ÑÁÉÍÓÚÜŸÂÃš©ñáéíóúüÿâã@°|¬¡“#$%&/()=‘\\¿+~´[{^-_.:,;<>Æ±', 'NAEIOUUYAASCNAEIOUUYAA'")


def _plain(x: str) -> str:
    return f"translate(coalesce({x}, ''), {_PLAIN})"


def _zeros(x: str, n: int) -> str:
    return f"CASE WHEN length({x}) >= {n} THEN {x} ELSE lpad({x}, {n}, '0') END"


def _blanks(x: str, n: int) -> str:
    return f"CASE WHEN length({x}) >= {n} THEN {x} ELSE rpad({x}, {n}, ' ') END"


def _phone(x: str, landline: bool = True) -> str:
    digits = f"regexp_replace(coalesce({x}, ''), '[^0-9]', '', 'g')"
    good = f"(length({digits}) = 10 AND {digits} LIKE '3%')"
    if landline:
        good = f"({good} OR length({digits}) = 7)"
    return f"CASE WHEN {good} THEN {digits} ELSE '' END"


def _email(x: str) -> str:
    return (f"CASE WHEN regexp_matches(trim(coalesce({x}, '')), '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{{2,}}$')"
            f" AND NOT regexp_matches(upper({x}), 'CORREGIR|PENDIENTE|NOTIENE|SINC|NN@|AAA@')"
            f" THEN trim({x}) ELSE '' END")


def _raw_sql() -> str:
    """Raw values, corrected identifier and everything looked up, one row per order."""
    cut = ",\n         ".join(
        f"CASE WHEN trim(CAST({sql} AS VARCHAR)) NOT IN ('', 'N/A') THEN trim(CAST({sql} AS VARCHAR)) END AS r_{k}"
        for k, (_, sql) in _COMMON.items())
    fixed = ", ".join(
        f"CASE WHEN contains(upper(r_{k}), 'CORREGIR') THEN {new} ELSE r_{k} END AS {k}"
        for k, new in (("name", "'Núñez ' || m.c_name"), ("address", "'Calle ' || m.c_custkey"),
                       ("email", "'m' || m.c_custkey || '@mail.com'"),
                       ("phone", "'31' || lpad(CAST(m.c_custkey AS VARCHAR), 8, '0')")))
    return f"""
{ORDERS}, {LINES},
crudo AS (
  SELECT o_orderkey, o_orderstatus, tipo,
         CASE WHEN c_acctbal < 0 THEN o_custkey + 1 ELSE o_custkey END AS idn,
         {cut}
  FROM ord JOIN customer ON o_custkey = c_custkey),
aperturas AS (SELECT tipo || o_orderkey AS k, CAST(trunc(valor * 100 / 1000) AS BIGINT) AS apertura
              FROM ord WHERE o_orderpriority <> '5-LOW'),
abonos AS (SELECT split_part(credito, '-', 1) || l_orderkey AS k,
                  CAST(trunc(sum(importe) / 1000) AS BIGINT) AS abono
           FROM lin WHERE l_returnflag <> 'N' GROUP BY 1),
limpio AS (
  SELECT r.*, CAST(idn AS VARCHAR) AS idt, {fixed}, apertura, abono, s.s_nationkey AS codigo,
         CASE WHEN s.s_nationkey < 5 THEN upper(s.s_name) END AS nombre_fijo,
         replace(r_account, ' ', '') AS cuenta
  FROM crudo r LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'HOUSEHOLD') m ON m.c_custkey = idn
  LEFT JOIN aperturas a ON a.k = r.tipo || r.o_orderkey
  LEFT JOIN abonos b ON b.k = r.tipo || r.o_orderkey
  LEFT JOIN supplier s ON s.s_suppkey = idn)"""


_NAME = f"coalesce(nombre_fijo, upper(trim(regexp_replace({_plain('name')}, '\\s+', ' ', 'g'))))"


def _floor_a(x: str) -> str:
    return f"CASE WHEN coalesce(CAST({x} AS BIGINT), 0) < 10000 THEN 0 ELSE CAST({x} AS BIGINT) END"


def _floor_b(x: str) -> str:
    return f"CASE WHEN coalesce(CAST({x} AS BIGINT), 0) <= 10 THEN 0 ELSE CAST({x} AS BIGINT) END"


def _due(x: str = "r_due") -> str:
    return f"CASE WHEN coalesce({x}, '0') < r_opened THEN r_opened ELSE {x} END"


def _final_a() -> str:
    out = {
        "TIPO DE IDENTIFICACION": "CAST(coalesce(codigo, 1) AS VARCHAR)",
        "NUMERO DE IDENTIFICACION": _zeros("idt", 11),
        "NOMBRE COMPLETO": _blanks(_NAME, 45),
        "NUMERO DE LA CUENTA U OBLIGACION": _zeros("cuenta", 18),
        "FECHA APERTURA": "r_opened", "FECHA VENCIMIENTO": _due(),
        "FECHA DE PAGO": "CASE WHEN r_paid_on = '00000000' THEN '00000000' ELSE r_paid_on END",
        "VALOR INICIAL": _floor_a("coalesce(apertura, CAST(r_price AS BIGINT))"),
        "VALOR SALDO DEUDA": _floor_a("r_fee"), "V CUOTA MENSUAL": _floor_a("r_fee"),
        "VALOR SALDO MORA": _floor_a("r_arrears"), "VALOR DISPONIBLE": "CAST(0 AS BIGINT)",
        "RESPONSABLE": "'00'", "NOVEDAD": _zeros("r_month", 2), "TOTAL CUOTAS": _zeros("r_month", 3),
        "CUOTAS CANCELADAS": _zeros("r_month", 3), "CUOTAS EN MORA": "'000'",
        "EDAD DE MORA": _zeros("r_month", 3), "ESTADO DE LA CUENTA": _zeros("r_month", 2),
        "FECHA DE ADJETIVO": _zeros("r_month", 8), "CLAUSULA DE PERMANENCIA": "'000'",
        "FECHA CLAUSULA DE PERMANENCIA": "'00000000'", "FECHA LIMITE DE PAGO": "r_opened",
        "CIUDAD CORRESPONDENCIA": _blanks(
            f"CASE WHEN {_plain('r_city')} IN ('', '0') THEN 'POPAYAN' ELSE {_plain('r_city')} END", 20),
        "DIRECCION DE CORRESPONDENCIA": _blanks(_plain("address"), 60),
        "CORREO ELECTRONICO": _blanks(_email("email"), 60),
        "CELULAR": _zeros(_phone("phone"), 12),
        "ESTADO ORIGEN DE LA CUENTA": "'0'", "SITUACION DEL TITULAR": "'0'", "ADJETIVO": "'0'",
    }
    return ", ".join(f"({out.get(n, chr(39) * 2)}) AS \"{n}\"" for n, _, _ in LAYOUT_A)


def _place_b(default: str) -> str:
    city = f"upper({_plain('r_city')})"
    return (f"CASE WHEN {city} IN ('', '0') OR regexp_matches({city}, '^[0-9]+$') THEN '{default}'"
            f" ELSE {city} END")


def _final_b() -> str:
    out = {
        "tipo_identificacion": _zeros("substr(CAST(coalesce(codigo, 1) AS VARCHAR), 1, 2)", 2),
        "NUMERO DE IDENTIFICACION": _zeros("idt", 15),
        "nombre_tercero": _blanks(_NAME, 60),
        "fecha_limite_pago": "r_opened",
        "numero_obligacion": _blanks("substr(cuenta, 1, 20)", 20),
        "edad_mora": _zeros("r_month", 2),
        "fecha_inicio": "r_opened", "fecha_terminacion": _due(), "fecha_pago": "r_paid_on",
        "periodicidad": "'05'",
        "valor_inicial": _floor_b("coalesce(apertura, CAST(r_price AS BIGINT))"),
        "valor_saldo": _floor_b("r_fee"), "valor_cuota": _floor_b("r_tiny"),
        "valor_mora": _floor_b("r_arrears"), "cargo_fijo": _floor_b("r_tiny"),
        "valor_real_pagado": "coalesce(abono, 0)",
        "plazo": "r_month",
        "direccion_casa": _blanks(_plain("address"), 60),
        "nombre_empresa": f"trim({_plain('r_address')})",
        "telefono_casa": _blanks(_phone("r_phone"), 20),
        "telefono_empresa": _blanks(_phone("r_phone"), 20),
        "numero_celular": _blanks(_phone("phone", False), 60),
        "ciudad_casa": _blanks(_place_b("POPAYAN"), 20),
        "departamento_casa": _blanks(_place_b("CAUCA"), 20),
        "correo_electronico": _blanks(_email("email"), 60),
    }
    return ", ".join(f"({out.get(n, chr(39) * 2)}) AS \"{n}\"" for n, _, _ in LAYOUT_B)


@query("bureau_a", f"WITH {_raw_sql()} SELECT {_final_a()} FROM limpio")
def q_bureau_a(spark: SparkSession, d: str) -> DataFrame:
    records = parse_fields(record_lines(spark, d, LAYOUT_A, FIELDS_A), LAYOUT_A, keep=[ORDINAL])
    return bureau.clean_bureau_a(records, corrections(spark, d))


@query("bureau_b", f"WITH {_raw_sql()} SELECT {_final_b()} FROM limpio")
def q_bureau_b(spark: SparkSession, d: str) -> DataFrame:
    records = parse_fields(record_lines(spark, d, LAYOUT_B, FIELDS_B), LAYOUT_B, keep=[ORDINAL])
    good, _ = bureau.split_by_id(records)
    return bureau.clean_bureau_b(good, corrections(spark, d))


def _fields_sql(layout, fields: dict[str, str]) -> str:
    def one(name: str) -> str:
        key = fields.get(name, "blank")
        return f"r_{key} AS \"{name}\""

    return ", ".join(one(name) for name, _, _ in layout)


@query("fixed_width_roundtrip_a",
       f"WITH {_raw_sql()} SELECT {_fields_sql(LAYOUT_A, FIELDS_A)} FROM crudo")
def q_roundtrip_a(spark: SparkSession, d: str) -> DataFrame:
    return parse_fields(record_lines(spark, d, LAYOUT_A, FIELDS_A), LAYOUT_A)


@query("fixed_width_roundtrip_b",
       f"WITH {_raw_sql()} SELECT {_fields_sql(LAYOUT_B, FIELDS_B)} FROM crudo")
def q_roundtrip_b(spark: SparkSession, d: str) -> DataFrame:
    return parse_fields(record_lines(spark, d, LAYOUT_B, FIELDS_B), LAYOUT_B)


@query("reject_ids", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS id
FROM customer""")
def q_reject_ids(spark: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_name")).otherwise(
        F.lpad(F.col("c_custkey").cast("string"), 15, "0"))
    good, bad = bureau.split_by_id(table(spark, d, "customer").select("c_custkey", raw.alias("id")), "id")
    return good.unionByName(bad.withColumn("id", F.lit(None).cast("string")))


@query("correct_ids", """
SELECT o_orderkey, CASE WHEN c_acctbal < 0 THEN CAST(o_custkey + 1 AS VARCHAR) ELSE CAST(o_custkey AS VARCHAR) END AS id
FROM orders JOIN customer ON o_custkey = c_custkey""")
def q_correct_ids(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("id"))
    return bureau.correct_ids(o, "id", corrections(spark, d).bad_ids)


@query("repair_contacts", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN
         CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'Núñez ' || c_name END ELSE o_orderpriority END AS nombre,
       CASE WHEN o_orderpriority = '1-URGENT' THEN
         CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'Calle ' || c_custkey END ELSE 'x' END AS direccion
FROM orders JOIN customer ON o_custkey = c_custkey""")
def q_repair_contacts(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("id"),
        F.when(F.col("o_orderstatus") == "P", F.lit("nombre por Corregir"))
        .otherwise(F.col("o_orderpriority")).alias("nombre"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("CORREGIR")).otherwise("x").alias("direccion"))
    master = bureau.contact_master(corrections(spark, d).master)
    fixed = bureau.repair_contacts(lookup(o, master, ["id"]), {"nombre": "name", "direccion": "address"})
    return fixed.select("o_orderkey", "nombre", "direccion")


@query("id_type", """
SELECT c_custkey, CAST(coalesce(s_nationkey, 1) AS VARCHAR) AS tipo_a,
       lpad(CAST(coalesce(s_nationkey, 1) AS VARCHAR), 2, '0') AS tipo_b
FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""")
def q_id_type(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("id"))
    found = lookup(c, bureau.id_type_table(corrections(spark, d).id_types), ["id"])
    return found.select("c_custkey", bureau.id_type_text().alias("tipo_a"),
                        bureau.id_type_text(width=2).alias("tipo_b"))


@query("override_names", r"""
SELECT c_custkey, CASE WHEN s_nationkey < 5 THEN upper(s_name)
       ELSE upper(trim(regexp_replace('  ' || replace(c_name, '#', '   '), '\s+', ' ', 'g'))) END AS nombre
FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""")
def q_override_names(spark: SparkSession, d: str) -> DataFrame:
    spaced = F.concat(F.lit("  "), F.replace("c_name", F.lit("#"), F.lit("   ")))
    c = table(spark, d, "customer").select(
        "c_custkey", F.col("c_custkey").cast("string").alias("id"), spaced.alias("nombre"))
    found = lookup(c, bureau.name_table(corrections(spark, d).names), ["id"])
    return found.select("c_custkey", bureau.override_name("id", "nombre").alias("nombre"))


@query("person_table", """
WITH ids AS (SELECT CAST(c_custkey AS VARCHAR) AS raw, c_custkey AS k, c_acctbal FROM customer
             WHERE c_acctbal < 0 OR c_mktsegment <> 'HOUSEHOLD'
             UNION SELECT CAST(s_suppkey AS VARCHAR), s_suppkey, c_acctbal
             FROM supplier LEFT JOIN customer ON c_custkey = s_suppkey)
SELECT raw, CAST(k2 AS VARCHAR) AS id, 'Núñez ' || c_name AS name, s_nationkey AS code
FROM (SELECT raw, CASE WHEN c_acctbal < 0 THEN k + 1 ELSE k END AS k2 FROM ids)
LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'HOUSEHOLD') ON c_custkey = k2
LEFT JOIN supplier ON s_suppkey = k2""")
def q_person_table(spark: SparkSession, d: str) -> DataFrame:
    return bureau.person_table(corrections(spark, d)).select("raw", "id", "name", "code")


@query("padded_record_text", f"""
WITH {_raw_sql()}
SELECT o_orderkey, {_zeros("idt", 11)} || {_blanks(_plain("name"), 45)} || {_zeros("r_month", 3)} AS linea
FROM limpio""")
def q_padded_record_text(spark: SparkSession, d: str) -> DataFrame:
    fixes = corrections(spark, d)
    raw = _clients(spark, d).select(
        "o_orderkey", *[F.trim(F.expr(_COMMON[k][0]).cast("string")).alias(k)
                        for k in ("id", "name", "month")])
    found = bureau.with_person(
        raw.select("o_orderkey", bureau.id_text("id").alias("num"), F.col("name").alias("nombre"), "month"),
        "num", fixes)
    fixed = bureau.repair_contacts(found, {"nombre": "name"}).withColumn(
        "nombre", plain_text(F.coalesce("nombre", F.lit(""))))
    padded = bureau.pad_fields(fixed, zeros={"num": 11, "month": 3}, blanks={"nombre": 45})
    layout = [("num", 0, 11), ("nombre", 11, 56), ("month", 56, 59)]
    return lines_and_rejects(padded, layout, keep=["o_orderkey"]).select(
        "o_orderkey", F.col("line").alias("linea"))


# Names and segments of very different lengths, some in characters that the file cannot hold.
_EXPORT = [("cliente", 0, 11), ("segmento", 12, 20), ("nombre", 22, 42), ("saldo", 42, 50)]


@query("export_records", """
WITH c AS (
  SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS cliente, c_mktsegment AS segmento,
         CASE c_nationkey % 3 WHEN 0 THEN 'Peña “' || c_name || '”' WHEN 1 THEN '名 ' || c_name ELSE c_name END AS nombre,
         CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS saldo FROM customer),
j AS (
  SELECT *, CASE WHEN length(segmento) > 8 THEN 'segmento' WHEN length(nombre) > 20 THEN 'nombre'
                 WHEN nombre LIKE '名%' THEN 'nombre' END AS campo FROM c)
SELECT c_custkey, CASE WHEN campo IS NULL THEN rpad(cliente, 11, ' ') || ' ' || rpad(segmento, 8, ' ') || '  '
         || rpad(nombre, 20, ' ') || rpad(saldo, 8, ' ') END AS line,
       campo AS field, CASE WHEN campo IS NULL THEN NULL WHEN campo = 'nombre' AND length(nombre) <= 20
         THEN 'no such character' ELSE 'too long' END AS reason,
       CASE campo WHEN 'segmento' THEN segmento WHEN 'nombre' THEN nombre END AS value
FROM j""")
def q_export_records(spark: SparkSession, d: str) -> DataFrame:
    nation = F.col("c_nationkey") % 3
    name = (F.when(nation == 0, F.concat(F.lit("Peña “"), "c_name", F.lit("”")))
            .when(nation == 1, F.concat(F.lit("名 "), "c_name")).otherwise(F.col("c_name")))
    rows = table(spark, d, "customer").select(
        "c_custkey", F.col("c_custkey").cast("string").alias("cliente"),
        F.col("c_mktsegment").alias("segmento"), name.alias("nombre"),
        F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("saldo"))
    return lines_and_rejects(rows, _EXPORT, keep=["c_custkey"])


@query("record_file_read",
       f"WITH {_raw_sql()} SELECT {_fields_sql(LAYOUT_A, FIELDS_A)} FROM crudo")
def q_record_file_read(spark: SparkSession, d: str) -> DataFrame:
    """The lines as Windows-1252 text files with header and trailer, read back as records."""
    raw = _clients(spark, d).select("o_orderkey", *[
        F.expr(_COMMON[FIELDS_A.get(name, "blank")][0]).cast("string").alias(name)
        for name, _, _ in LAYOUT_A])
    lines_ = lines_and_rejects(raw, LAYOUT_A, keep=["o_orderkey"])
    folder = own_folder(spark, "records")
    write_record_files(lines_, folder, files=7, order=["o_orderkey"])
    return read_records(spark, folder, LAYOUT_A).drop(ORDINAL)


@query("corrections_bundle", """
WITH c AS (SELECT *, CAST(c_custkey AS VARCHAR) AS id FROM customer)
SELECT 'bad_ids' AS tabla, id, CAST(c_custkey + 1 AS VARCHAR) AS valor FROM c WHERE c_acctbal < 0
UNION ALL SELECT 'master', id, c_name FROM c WHERE c_mktsegment <> 'HOUSEHOLD'
UNION ALL SELECT 'id_types', CAST(s_suppkey AS VARCHAR), CAST(s_nationkey AS VARCHAR) FROM supplier
UNION ALL SELECT 'opening', CAST(o_orderkey AS VARCHAR), CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) FROM orders
UNION ALL SELECT 'payments', CAST(l_orderkey AS VARCHAR), CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) FROM lineitem
UNION ALL SELECT 'names', CAST(s_suppkey AS VARCHAR), s_name FROM supplier WHERE s_nationkey < 5""")
def q_corrections_bundle(spark: SparkSession, d: str) -> DataFrame:
    """All five sheets and the names, under the headers that they have in their files."""
    c, s = table(spark, d, "customer"), table(spark, d, "supplier")
    o, li = table(spark, d, "orders"), table(spark, d, "lineitem")
    key = F.col("c_custkey")

    def sheet(df: DataFrame, **columns: Column) -> DataFrame:
        return df.select(*[v.alias(k.replace("_", " ") if k.startswith("CEDULA") else k)
                           for k, v in columns.items()], F.lit(0).alias("_ord"))

    bundle = bureau_plan.corrections({
        "Cedulas a corregir": sheet(c.where("c_acctbal < 0"), CEDULA_MAL=key, CEDULA_CORRECTA=key + 1),
        "Vinculado": sheet(c.where("c_mktsegment <> 'HOUSEHOLD'"), CODIGO=key, NOMBRE=F.col("c_name"),
                           DIRECCI=F.lit("d"), VINEMAIL=F.lit("e"), TELEFONO=F.lit("t")),
        "Tipos de identificacion": sheet(s, CEDULA_CORRECTA=F.col("s_suppkey"),
                                         CODIGO=F.col("s_nationkey")).withColumnRenamed("CODIGO", "CODIGO DATA"),
        "FNZ001": sheet(o, DSM_TP=F.lit("FA"), DSM_NUM=F.col("o_orderkey").cast("double"),
                        VLR_FNZ=F.col("o_totalprice")),
        "R05": sheet(li, MCNTIPCRU2=F.lit("FA"), MCNNUMCRU2=F.col("l_orderkey").cast("double"),
                     ABONO=F.col("l_extendedprice")),
        "names": sheet(s.where("s_nationkey < 5"), id=F.col("s_suppkey"), full_name=F.col("s_name")),
    }, bureau_plan.CODE_A)
    shown_by = {"bad_ids": ("bad", "good"), "master": ("id", "name"), "id_types": ("id", "code"),
                "opening": ("number", "amount"), "payments": ("number", "amount"), "names": ("id", "full_name")}
    parts = []
    for name, (by, value) in shown_by.items():
        parts.append(getattr(bundle, name).select(F.lit(name).alias("tabla"), F.col(by).cast("string").alias("id"),
                               F.col(value).cast("string").alias("valor")))
    return union_all(parts)
