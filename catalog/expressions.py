"""Queries on the column expressions and the sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.functions import dates, numbers, text, validity
from ledgerspark.operators import report
from ledgerspark.operators.invoices import lender_of_type
from ledgerspark.schemas import Table
from ledgerspark.session import own_folder
from ledgerspark.sources import routing, sinks, tables

from .extracts import LINES, ORDERS, kind_of_order, lines, orders
from .registry import query, shown, table


@query("credit_key", """
SELECT o_orderkey,
       upper(trim('  ' || lower(o_orderpriority) || ' ')) || '-' || CAST(o_orderkey AS VARCHAR) AS credito,
       upper(trim(o_orderstatus)) || '-' AS credito_sin_numero
FROM orders""")
def q_credit_key(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    padded = F.concat(F.lit("  "), F.lower("o_orderpriority"), F.lit(" "))
    return o.select(
        "o_orderkey",
        numbers.credit_key(padded, F.concat(F.col("o_orderkey").cast("string"), F.lit(".0")))
        .alias("credito"),
        numbers.credit_key("o_orderstatus", "o_orderpriority").alias("credito_sin_numero"),
    )


@query("invoice_key_split", """
SELECT p_partkey, p_type || '-' || p_brand AS clave,
       CASE WHEN contains(p_name, ',') THEN 'x' END AS sin_clave
FROM part""")
def q_invoice_key_split(spark: SparkSession, d: str) -> DataFrame:
    joined = F.concat_ws(",", "p_name", F.lit("x"), "p_type", "p_brand")
    return table(spark, d, "part").select(
        "p_partkey", text.invoice_key(joined).alias("clave"),
        text.invoice_key("p_name").alias("sin_clave"))


@query("normalize_text", """
SELECT doc_id, md5(translate(text, 'ÑÁÉÍÓÚÜŸÂÃš©ñáéíóúüÿâã@°|¬¡“#$%&/()=‘\\¿+~´[{^-_.:,;<>Æ±',
                             'NAEIOUUYAASCNAEIOUUYAA')) AS limpio
FROM documents""")
def q_normalize_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(
        "doc_id", F.md5(text.plain_text("text")).alias("limpio"))


@query("collapse_spaces", r"""
SELECT doc_id, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS limpio,
       regexp_replace(text, '[^0-9]', '', 'g') AS digitos,
       md5(replace(text, ' ', '')) AS sin_espacios
FROM documents""")
def q_collapse_spaces(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(
        "doc_id", F.md5(text.collapse_spaces("text")).alias("limpio"),
        text.digits_only("text").alias("digitos"),
        F.md5(text.drop_spaces("text")).alias("sin_espacios"))


@query("padding", """
SELECT o_orderkey,
       CASE WHEN length(k) >= 4 THEN k ELSE lpad(k, 4, '0') END AS ceros,
       '-' || CASE WHEN length(k) >= 3 THEN k ELSE lpad(k, 3, '0') END AS con_signo,
       CASE WHEN length(o_orderpriority) >= 8 THEN o_orderpriority
            ELSE rpad(o_orderpriority, 8, ' ') END || '|' AS espacios,
       substr(o_orderpriority, 1, 2) AS prefijo
FROM (SELECT *, CAST(o_orderkey AS VARCHAR) AS k FROM orders)""")
def q_padding(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    return table(spark, d, "orders").select(
        "o_orderkey", text.zero_pad(key, 4).alias("ceros"),
        text.zero_pad(F.concat(F.lit("-"), key), 4).alias("con_signo"),
        F.concat(text.space_pad("o_orderpriority", 8), F.lit("|")).alias("espacios"),
        text.prefix("o_orderpriority", 2).alias("prefijo"))


@query("canonical_id", """
SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS entero,
       regexp_replace(CAST(c_acctbal AS VARCHAR), '\\.0$', '') AS saldo,
       CAST(CAST(trunc(c_acctbal) AS BIGINT) AS VARCHAR) AS codigo,
       c_name AS referencia, '' AS vacio
FROM customer""")
def q_canonical_id(spark: SparkSession, d: str) -> DataFrame:
    spaced = F.concat(F.lit(" "), F.col("c_custkey").cast("string"), F.lit(".0 "))
    return table(spark, d, "customer").select(
        "c_custkey", text.canonical_id(spaced).alias("entero"),
        text.canonical_id(F.col("c_acctbal")).alias("saldo"),
        numbers.code_text(F.col("c_acctbal")).alias("codigo"),
        numbers.reference_text("c_name").alias("referencia"),
        numbers.reference_text(F.lit(None).cast("string")).alias("vacio"))


@query("account_key", """
SELECT o_orderkey, replace(o_orderpriority, ' ', '') || CAST(o_custkey AS VARCHAR) AS cuenta,
       'Codeudor:' || CAST(o_custkey AS VARCHAR) AS rotulo
FROM orders""")
def q_account_key(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        "o_orderkey", text.account_key("o_orderpriority", "o_custkey").alias("cuenta"),
        F.concat(F.lit("Codeudor:"), F.col("o_custkey").cast("string")).alias("rotulo"))


_WORDS = """
palabras AS (
  SELECT doc_id, unnest(string_split(regexp_replace(text, '\\s+', ' ', 'g'), ' ')) AS w
  FROM documents)"""


def _words(spark: SparkSession, d: str) -> DataFrame:
    """Every word of every text."""
    return table(spark, d, "documents").select(
        "doc_id", F.explode(F.split(F.regexp_replace("text", r"\s+", " "), " ")).alias("w"))


@query("validate_email", f"""
WITH {_WORDS}
SELECT doc_id, w,
       CASE WHEN regexp_matches(w, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{{2,}}$')
             AND NOT regexp_matches(upper(w), 'CORREGIR|PENDIENTE|NOTIENE|SINC|NN@|AAA@')
            THEN w ELSE '' END AS correo
FROM palabras""")
def q_validate_email(spark: SparkSession, d: str) -> DataFrame:
    return _words(spark, d).select(
        "doc_id", "w", validity.valid_email("w").alias("correo"))


@query("validate_phone", f"""
WITH {_WORDS},
numeros AS (
  SELECT 'd' || doc_id AS id, w FROM palabras
  UNION ALL
  SELECT 'o' || o_orderkey,
         CASE o_orderstatus WHEN 'P' THEN '3' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')
              WHEN 'F' THEN '82-' || lpad(CAST(o_custkey AS VARCHAR), 5, '0')
              ELSE CAST(o_orderkey AS VARCHAR) END
  FROM orders)
SELECT id, w, CASE WHEN fijo OR movil THEN n ELSE '' END AS telefono,
       CASE WHEN movil THEN n ELSE '' END AS celular
FROM (SELECT *, length(n) = 7 AS fijo, length(n) = 10 AND n LIKE '3%' AS movil
      FROM (SELECT *, regexp_replace(w, '[^0-9]', '', 'g') AS n FROM numeros))""")
def q_validate_phone(spark: SparkSession, d: str) -> DataFrame:
    words = _words(spark, d).select(F.concat(F.lit("d"), "doc_id").alias("id"), "w")
    client = F.col("o_custkey").cast("string")
    made = (
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("3"), F.lpad(client, 9, "0")))
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit("82-"), F.lpad(client, 5, "0")))
        .otherwise(F.col("o_orderkey").cast("string"))
    )
    both = words.unionByName(table(spark, d, "orders").select(
        F.concat(F.lit("o"), "o_orderkey").alias("id"), made.alias("w")))
    return both.select("id", "w", validity.valid_phone("w").alias("telefono"),
                       validity.valid_phone("w", landline=False).alias("celular"))


@query("default_places", """
SELECT c_custkey,
       CASE WHEN c_mktsegment = 'BUILDING' OR c_acctbal < 0 OR c_nationkey < 10 THEN 'POPAYAN'
            ELSE n_name END AS ciudad,
       CASE WHEN c_nationkey = 0 OR c_acctbal < 0 THEN 'POPAYAN' ELSE n_name || ' ' END AS ciudad_corta
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def q_default_places(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").join(
        table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    raw = (
        F.when(F.col("c_acctbal") < 0, F.lit(None))
        .when(F.col("c_mktsegment") == "BUILDING", F.lit(" nan "))
        .when(F.col("c_nationkey") < 10, F.col("c_nationkey").cast("string"))
        .otherwise(F.concat(F.lit(" "), F.lower("n_name")))
    )
    short = (
        F.when(F.col("c_acctbal") < 0, F.lit(" n/a"))
        .when(F.col("c_nationkey") == 0, F.lit("0"))
        .otherwise(F.concat("n_name", F.lit(" ")))
    )
    return c.select("c_custkey", validity.place_or_default(raw, "POPAYAN").alias("ciudad"),
                    validity.city_or_default(short).alias("ciudad_corta"))


@query("scrub_nulls", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 OR c_mktsegment = 'BUILDING' THEN '' ELSE c_name END AS nombre,
       CASE WHEN contains(upper(c_mktsegment), 'HOLD') OR contains(upper(c_mktsegment), 'MOB')
            THEN 1 ELSE 0 END AS contiene
FROM customer""")
def q_scrub_nulls(spark: SparkSession, d: str) -> DataFrame:
    raw = (
        F.when(F.col("c_acctbal") < 0, F.lit(" NaN "))
        .when(F.col("c_mktsegment") == "BUILDING", F.lit(None))
        .otherwise(F.concat(F.lit(" "), "c_name"))
    )
    return table(spark, d, "customer").select(
        "c_custkey", text.scrub_null_text(raw).alias("nombre"),
        text.contains_any("c_mktsegment", ["hold", "mob"]).cast("int").alias("contiene"))


@query("percent_parse_format", """
SELECT p_partkey, razon, CAST(CAST(round_even(round_even(CASE WHEN razon > 1 THEN razon / 100 ELSE razon END, 4)
       * 100, 0) AS INT) AS VARCHAR) || '%' AS texto
FROM (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN
                (CASE WHEN p_size > 1 THEN CAST(p_size AS DOUBLE) / 100 ELSE p_size END)
             WHEN p_size % 3 = 1 THEN CAST(p_size AS DOUBLE) / 1000 ELSE 0.0 END AS razon FROM part)""")
def q_percent(spark: SparkSession, d: str) -> DataFrame:
    size = F.col("p_size")
    raw = (
        F.when(size % 3 == 0, F.concat(size.cast("string"), F.lit("%")))
        .when(size % 3 == 1, (size.cast("double") / 1000).cast("string"))
        .otherwise(F.lit("sin dato"))
    )
    ratio = numbers.percent_ratio(raw)
    return table(spark, d, "part").select(
        "p_partkey", ratio.alias("razon"), numbers.percent_text(ratio).alias("texto"))


@query("numeric_rules", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(trunc(l_extendedprice / 1000) AS BIGINT) AS miles,
       CASE WHEN l_quantity <= 10 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS piso_10,
       CASE WHEN l_extendedprice < 10000 THEN 0 ELSE CAST(trunc(l_extendedprice) AS BIGINT) END AS piso_10000,
       CAST(abs(l_discount - l_tax) AS DOUBLE) AS diferencia
FROM lineitem""")
def q_numeric_rules(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        numbers.thousands("l_extendedprice").alias("miles"),
        numbers.zero_below("l_quantity", 10, inclusive=True).alias("piso_10"),
        numbers.zero_below("l_extendedprice", 10_000, inclusive=False).alias("piso_10000"),
        F.abs(F.col("l_discount") - F.col("l_tax")).alias("diferencia"))


@query("floor_amounts", """
SELECT o_orderkey, CASE WHEN o_totalprice < 10000 THEN 0 ELSE CAST(trunc(o_totalprice) AS BIGINT) END AS a,
       CASE WHEN o_totalprice / 10000 <= 10 THEN 0 ELSE CAST(trunc(o_totalprice / 10000) AS BIGINT) END AS b,
       0 AS disponible
FROM orders""")
def q_floor_amounts(spark: SparkSession, d: str) -> DataFrame:
    as_text = F.concat(F.lit(" "), F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    return table(spark, d, "orders").select(
        "o_orderkey",
        numbers.zero_below(numbers.number(as_text), 10_000, inclusive=False).alias("a"),
        numbers.zero_below(F.col("o_totalprice") / 10_000, 10, inclusive=True).alias("b"),
        F.lit(0).alias("disponible"))


@query("repair_dates", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, apertura,
       CASE WHEN vence < apertura THEN apertura ELSE vence END AS vence,
       CASE WHEN pago = '0' THEN '00000000' ELSE pago END AS pago
FROM (SELECT *, CASE WHEN l_returnflag = 'A' THEN '0' ELSE strftime(o_orderdate, '%Y%m%d') END AS vence,
             strftime(l_shipdate, '%Y%m%d') AS apertura,
             CASE WHEN l_linestatus = 'O' THEN '0' ELSE strftime(o_orderdate, '%Y%m%d') END AS pago
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""")
def q_repair_dates(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "lineitem").join(
        table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    ordered = F.date_format("o_orderdate", "yyyyMMdd")
    due = F.when(F.col("l_returnflag") == "A", F.lit("nan")).otherwise(F.concat(ordered, F.lit(".0")))
    paid = dates.compact_date(F.when(F.col("l_linestatus") != "O", ordered))
    opened = dates.compact_date(F.date_format("l_shipdate", "yyyyMMdd"))
    return j.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", opened.alias("apertura"),
        dates.not_before(dates.compact_date(due), opened).alias("vence"),
        F.when(paid == "0", "00000000").otherwise(paid).alias("pago"))


@query("date_parsing", """
SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS dia,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS leida,
       abs(date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-06-15')) AS distancia,
       CASE WHEN strftime(o_orderdate, '%Y%m') = '199806' THEN 1 ELSE 0 END AS mismo_mes
FROM orders""")
def q_date_parsing(spark: SparkSession, d: str) -> DataFrame:
    raw = (
        F.when(F.col("o_orderstatus") == "P", F.lit("31/02/1998"))
        .when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "d/M/yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    )
    as_of = dates.as_of_date("1998-06-15")
    return shown(table(spark, d, "orders").select(
        "o_orderkey", dates.date_text("o_orderdate").alias("dia"),
        dates.parse_date(raw).alias("leida"),
        dates.day_gap(F.to_date("o_orderdate"), as_of).cast("bigint").alias("distancia"),
        dates.same_month("o_orderdate", as_of).alias("mismo_mes")))


@query("format_reference", """
SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS fecha, CAST(o_custkey AS VARCHAR) AS referencia,
       o_orderpriority AS texto
FROM orders""")
def q_format_reference(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        "o_orderkey", dates.date_text("o_orderdate").alias("fecha"),
        numbers.reference_text(F.concat(F.col("o_custkey").cast("string"), F.lit(".75")))
        .alias("referencia"),
        numbers.reference_text("o_orderpriority").alias("texto"))


# ---------------------------------------------------------------------------------------------
# Sources
# ---------------------------------------------------------------------------------------------

_NAMES = """
archivos AS (
  SELECT p_partkey,
         CASE p_type WHEN 'ECONOMY' THEN 'r91 ' || p_name WHEN 'SMALL' THEN p_name || ' analisis'
              WHEN 'STANDARD' THEN 'franjas metas ' || p_name WHEN 'PROMO' THEN p_name
              WHEN 'LARGE' THEN 'informe matriz cartera' ELSE 'sc04' END || '.xlsx' AS ruta,
         CASE p_type WHEN 'ECONOMY' THEN 'R91' WHEN 'SMALL' THEN 'ANALISIS'
              WHEN 'STANDARD' THEN 'METAS_FRANJAS' WHEN 'PROMO' THEN NULL
              WHEN 'LARGE' THEN 'MATRIZ_CARTERA' ELSE 'SC04' END AS tipo
  FROM part)"""


def _files(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("p_type")
    name = (
        F.when(kind == "ECONOMY", F.concat(F.lit("r91 "), "p_name"))
        .when(kind == "SMALL", F.concat("p_name", F.lit(" analisis")))
        .when(kind == "STANDARD", F.concat(F.lit("franjas metas "), "p_name"))
        .when(kind == "PROMO", F.col("p_name"))
        .when(kind == "LARGE", F.lit("informe matriz cartera"))
        .otherwise(F.lit("sc04"))
    )
    return table(spark, d, "part").select(
        "p_partkey", F.concat(F.lit("/entrada/"), name, F.lit(".xlsx")).alias("path"))


@query("route_file_type", f"WITH {_NAMES} SELECT p_partkey, '/entrada/' || ruta AS path, tipo FROM archivos")
def q_route_file_type(spark: SparkSession, d: str) -> DataFrame:
    return _files(spark, d).withColumn("tipo", routing.file_type("path"))


@query("load_report", f"""
WITH {_NAMES}
SELECT '/entrada/' || ruta AS path, tipo AS "type",
       CASE WHEN tipo IS NULL THEN 'skipped' ELSE 'loaded' END AS status,
       CASE WHEN tipo IS NULL THEN 'unknown type' END AS reason, count(*) AS n
FROM archivos GROUP BY ALL""")
def q_load_report(spark: SparkSession, d: str) -> DataFrame:
    report = routing.load_report(_files(spark, d))
    return report.groupBy(*report.columns).agg(F.count(F.lit(1)).alias("n"))


CUSTOMERS = Table((
    ("c_custkey", "Cedula", "id"),
    ("c_name", "Nombre", "text"),
    ("c_mktsegment", "Zona", "key"),
    ("c_acctbal", "Saldo", "money"),
    ("c_since", "Desde", "date"),
))


@query("multi_table_scan", """
SELECT CAST(c_custkey AS VARCHAR) AS "Cedula", c_name AS "Nombre", c_mktsegment AS "Zona",
       c_acctbal AS "Saldo", CAST(NULL AS VARCHAR) AS "Desde"
FROM customer""")
def q_multi_table_scan(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "customer").withColumnRenamed("c_name", " c_name ")
    return shown(tables.conform(raw, CUSTOMERS))


SWAPPED = Table((("c_name", "c_mktsegment", "text"), ("c_mktsegment", "c_name", "text"),
                 ("c_custkey", "id", "id")))


@query("strict_rename_swap", """
SELECT c_name AS c_mktsegment, c_mktsegment AS c_name, CAST(c_custkey AS VARCHAR) AS id FROM customer""")
def q_strict_rename_swap(spark: SparkSession, d: str) -> DataFrame:
    return tables.conform(table(spark, d, "customer"), SWAPPED, strict=True)


@query("positional_scan", """
SELECT CAST(o_custkey AS VARCHAR) AS cliente, o_orderpriority AS prioridad, o_orderkey AS fila
FROM orders WHERE o_orderkey >= 2""")
def q_positional_scan(spark: SparkSession, d: str) -> DataFrame:
    layout = Table((("", "cliente", "text"), ("", "prioridad", "text")), skip_rows=2, positional=True)
    raw = table(spark, d, "orders").select("o_custkey", "o_orderpriority",
                                           F.col("o_orderkey").alias("fila"))
    return tables.positional(raw, layout, "fila")


@query("union_sources", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS o_totalprice
FROM orders""")
def q_union_sources(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    full = o.where("o_orderstatus <> 'P'").select("o_orderkey", "o_custkey", "o_totalprice")
    part = o.where("o_orderstatus = 'P'").select("o_custkey", "o_orderkey")
    return tables.union_all([full, part])


@query("placeholder_fill", """
SELECT CAST(c_custkey AS VARCHAR) AS "Cedula_Cliente",
       CASE WHEN c_acctbal < 0 OR c_mktsegment = 'BUILDING' THEN 'SIN CODEUDOR' ELSE c_name END AS "Codeudor1"
FROM customer""")
def q_placeholder_fill(spark: SparkSession, d: str) -> DataFrame:
    name = (
        F.when(F.col("c_acctbal") < 0, F.lit("."))
        .when(F.col("c_mktsegment") == "BUILDING", F.lit(None))
        .otherwise(F.col("c_name"))
    )
    raw = table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("Cedula_Cliente"), name.alias("Codeudor1"))
    return tables.fill_blanks(raw, "SIN CODEUDOR")


@query("lender_of_credit", f"""
WITH {ORDERS}
SELECT o_orderkey, credito, empresa FROM ord""")
def q_lender(spark: SparkSession, d: str) -> DataFrame:
    return orders(spark, d).select(
        "o_orderkey", F.col("Credito").alias("credito"),
        lender_of_type(kind_of_order()).alias("empresa"))


# ---------------------------------------------------------------------------------------------
# Files in, files out
# ---------------------------------------------------------------------------------------------

FILES = 200


@query("load_many_files", f"""
WITH {ORDERS}, {LINES}
SELECT credito AS "Credito", cedula AS "Cedula_Cliente", CAST(l_linenumber AS BIGINT) AS "Cuota_Vigente",
       CAST(importe AS DOUBLE) AS "Valor_Cuota_Vigente", strftime(l_shipdate, '%Y-%m-%d') AS "Fecha_Cuota_Vigente",
       CAST({FILES} AS BIGINT) AS archivos
FROM lin""")
def q_load_many_files(spark: SparkSession, d: str) -> DataFrame:
    """Installments as 200 extracts of one type, loaded by path."""
    folder = own_folder(spark, "extracts")
    lines(spark, d).select(
        F.split("Credito", "-")[0].alias("MCNTIPCRU1"), F.col("l_orderkey").cast("string").alias(" MCNNUMCRU1 "),
        F.col("Cedula_Cliente").alias("MCNVINCULA"), F.col("l_linenumber").alias("MCNCUOCRU1"),
        F.date_format("l_shipdate", "dd/MM/yyyy").alias("VENCE"),
        F.col("l_extendedprice").alias("SALDODOC"),
        F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(FILES)).cast("int").alias("VENCIMIENTOS_lote"),
    ).repartition("VENCIMIENTOS_lote").write.partitionBy("VENCIMIENTOS_lote").parquet(folder)
    loaded, found = tables.load_extracts(
        spark, [f"{folder}/VENCIMIENTOS_lote={i}" for i in range(FILES)])
    read = found.where(F.col("status") == routing.LOADED).agg(F.count(F.lit(1)).alias("n")).scalar()
    return shown(loaded["VENCIMIENTOS"].select(
        "Credito", "Cedula_Cliente", "Cuota_Vigente", "Valor_Cuota_Vigente", "Fecha_Cuota_Vigente",
        read.alias("archivos")))


@query("publish_report", """
SELECT o_orderkey, o_totalprice, CAST(2 AS BIGINT) AS publicaciones FROM orders""")
def q_publish_report(spark: SparkSession, d: str) -> DataFrame:
    """A report takes the place of an older one; both publications are known."""
    folder = own_folder(spark, "reports")
    sinks.write_report(table(spark, d, "customer"), folder)
    sinks.write_report(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), folder)
    known = sinks.publications(spark, folder).agg(F.count(F.lit(1)).alias("n")).scalar()
    return sinks.read_report(spark, folder).withColumn("publicaciones", known)


@query("ensure_column", """
SELECT c_custkey, 'SIN MORA' AS "Primera_Cuota_Mora", CAST(0 AS DOUBLE) AS "Valor_Vencido",
       CASE WHEN c_acctbal < 0 THEN 5.0 ELSE c_acctbal END AS "Saldo", CAST(NULL AS BIGINT) AS "Cuotas"
FROM customer""")
def q_ensure_column(spark: SparkSession, d: str) -> DataFrame:
    """Columns that a report lacks are created, those it has are filled."""
    rows = table(spark, d, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("Saldo"))
    filled = report.ensure_columns(rows, {
        "Primera_Cuota_Mora": ("string", "SIN MORA"), "Valor_Vencido": (numbers.MONEY, 0),
        "Saldo": ("double", 5)})
    return shown(report.pad_columns(filled, {"Cuotas": "bigint"}))
