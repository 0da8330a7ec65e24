"""Queries on the monthly base and its operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark import labels as L
from ledgerspark.functions.dates import parse_date
from ledgerspark.operators import (
    arrears, balances, details, goals, installments, invoices, items, report, sellers,
)
from ledgerspark.metrics import StepCounts
from ledgerspark.plans.monthly_base import monthly_base
from ledgerspark.schemas import MONTHLY_ORDER
from ledgerspark.session import written

from .extracts import AS_OF, LINE_ORDER, LINES, ORDERS, SALES, installments_of, lines, orders, sales_of
from .extracts import sales as sales_rows
from .registry import query, shown, table

INSTALLMENT_ORDER = LINE_ORDER[1:]


def summary_sql(as_of: str, source: str = "lin", key: str = "credito") -> str:
    """SELECT giving one summary row per credit."""
    order = "l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice"
    return f"""
  SELECT {key} AS credito,
         CASE WHEN count(*) FILTER (WHERE vencida) > 0
              THEN sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE vencida) END AS vencido,
         min(CASE WHEN rn_v = 1 AND vencida THEN f END) AS f_atraso,
         min(CASE WHEN rn_v = 1 AND vencida THEN l_linenumber END) AS n_atraso,
         min(CASE WHEN rn_v = 1 AND vencida THEN l_extendedprice END) AS v_atraso,
         min(CASE WHEN rn_a = 1 AND actual THEN f END) AS f_vigente,
         min(CASE WHEN rn_a = 1 AND actual THEN l_linenumber END) AS n_vigente,
         min(CASE WHEN rn_a = 1 AND actual THEN l_extendedprice END) AS v_vigente
  FROM (SELECT *, row_number() OVER (PARTITION BY {key}, vencida ORDER BY {order}) AS rn_v,
               row_number() OVER (PARTITION BY {key}, actual
                 ORDER BY f DESC, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn_a
        FROM (SELECT *, CAST(l_shipdate AS DATE) AS f,
                     CAST(l_shipdate AS DATE) < DATE '{as_of}' AS vencida,
                     date_trunc('month', l_shipdate) = date_trunc('month', DATE '{as_of}') AS actual
              FROM {source}))
  GROUP BY {key}"""


def _summary_query_sql(as_of: str, where: str = "") -> str:
    return f"""
WITH resumen AS ({summary_sql(as_of, "lineitem", "CAST(l_orderkey AS VARCHAR)")})
SELECT credito AS "Credito", CAST(vencido AS DOUBLE) AS "Valor_Vencido",
       strftime(f_atraso, '%Y-%m-%d') AS "Fecha_Cuota_Atraso",
       CAST(n_atraso AS BIGINT) AS "Primera_Cuota_Mora", v_atraso AS "Valor_Cuota_Atraso",
       strftime(f_vigente, '%Y-%m-%d') AS "Fecha_Cuota_Vigente",
       CAST(n_vigente AS BIGINT) AS "Cuota_Vigente", v_vigente AS "Valor_Cuota_Vigente"
FROM resumen {where}"""


def _line_summary(spark: SparkSession, d: str, as_of: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("Credito"),
        F.to_date("l_shipdate").alias("Fecha_Cuota_Vigente"),
        F.col("l_linenumber").cast("bigint").alias("Cuota_Vigente"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("Valor_Cuota_Vigente"),
        *INSTALLMENT_ORDER,
    )
    return installments.installment_summary(rows, as_of, order=INSTALLMENT_ORDER)


@query("installment_summary", _summary_query_sql(AS_OF))
def q_installment_summary(spark: SparkSession, d: str) -> DataFrame:
    return shown(_line_summary(spark, d, AS_OF))


@query("installment_summary_late_asof", _summary_query_sql("2002-01-01"))
def q_installment_summary_late(spark: SparkSession, d: str) -> DataFrame:
    return shown(_line_summary(spark, d, "2002-01-01"))


@query("date_filter", _summary_query_sql(
    AS_OF, "WHERE f_vigente BETWEEN DATE '1998-06-05' AND DATE '1998-06-20'"))
def q_date_filter(spark: SparkSession, d: str) -> DataFrame:
    return shown(report.date_filter(_line_summary(spark, d, AS_OF), "05/06/1998", "20/06/1998"))


def _invoice_map_sql(source: str, days: int) -> str:
    """SELECT credito, factura: nearest other document of the client for each DF document."""
    return f"""
  SELECT credito, factura FROM (
    SELECT c.credito, f.credito AS factura,
           row_number() OVER (PARTITION BY c.credito
             ORDER BY abs(date_diff('day', c.dia, f.dia)), c.ord, f.ord, f.credito) AS rn
    FROM {source} c JOIN {source} f ON c.cedula = f.cedula
    WHERE c.credito LIKE 'DF%' AND f.credito NOT LIKE 'DF%'
      AND abs(date_diff('day', c.dia, f.dia)) <= {days}) WHERE rn = 1"""


def _assign_sql(days: int) -> str:
    return f"""
WITH {ORDERS},
docs AS (SELECT credito, cedula, dia, o_orderkey AS ord FROM ord),
mapa AS ({_invoice_map_sql("docs", days)})
SELECT o.credito AS "Credito",
       CASE WHEN empresa = 'ARPESOD' THEN o.credito ELSE coalesce(factura, 'NO ASIGNADA') END AS "Factura_Venta"
FROM ord o LEFT JOIN mapa m ON m.credito = o.credito"""


def _assign(spark: SparkSession, d: str, days: int) -> DataFrame:
    o = orders(spark, d)
    documents = o.select("Credito", "Cedula_Cliente", F.col("dia").alias("Fecha_Facturada"),
                         F.col("o_orderkey").alias("ord"))
    return invoices.assign_invoice(
        o.select("Credito", "Empresa"), documents, days=days, order=["ord"]
    ).select("Credito", "Factura_Venta")


@query("assign_invoice", _assign_sql(30))
def q_assign_invoice(spark: SparkSession, d: str) -> DataFrame:
    return _assign(spark, d, 30)


@query("assign_invoice_edge_window", _assign_sql(0))
def q_assign_invoice_edge(spark: SparkSession, d: str) -> DataFrame:
    return _assign(spark, d, 0)


ITEMS = """
nombres AS (
  SELECT credito, importe <= 6000 AS obsequio, p_name, min(pos) AS pos, sum(cantidad) AS q
  FROM ventas WHERE importe IS NOT NULL GROUP BY ALL),
articulos AS (
  SELECT credito,
         string_agg(p_name, ', ' ORDER BY pos) FILTER (WHERE NOT obsequio) AS productos,
         string_agg(p_name, ', ' ORDER BY pos) FILTER (WHERE obsequio) AS obsequios,
         CAST(sum(q) FILTER (WHERE NOT obsequio) AS BIGINT) AS n_productos,
         CAST(sum(q) FILTER (WHERE obsequio) AS BIGINT) AS n_obsequios
  FROM nombres GROUP BY credito)"""

SALES_MAP = f"""
docs AS (SELECT credito, cedula, dia, min(fila) AS ord FROM ventas GROUP BY ALL),
facturas AS ({_invoice_map_sql("docs", 30)}),
articulos_credito AS (
  SELECT * FROM articulos WHERE credito NOT LIKE 'DF-%'
  UNION ALL
  SELECT f.credito, productos, obsequios, n_productos, n_obsequios
  FROM facturas f LEFT JOIN articulos a ON a.credito = f.factura)"""


@query("item_summary", f"""
WITH {ORDERS}, {LINES}, {SALES}, {ITEMS}
SELECT credito AS "Credito", productos AS "Nombre_Producto", obsequios AS "Obsequio",
       n_productos AS "Cantidad_Producto", n_obsequios AS "Cantidad_Obsequio" FROM articulos""")
def q_item_summary(spark: SparkSession, d: str) -> DataFrame:
    return items.item_summary(sales_rows(spark, d), order=LINE_ORDER)


@query("products_and_gifts", f"""
WITH {ORDERS}, {LINES}, {SALES}, {ITEMS}, {SALES_MAP}
SELECT o.credito AS "Credito", coalesce(productos, 'NO APLICA') AS "Nombre_Producto",
       coalesce(obsequios, 'NO APLICA') AS "Obsequio",
       coalesce(n_productos, 0) AS "Cantidad_Producto", coalesce(n_obsequios, 0) AS "Cantidad_Obsequio",
       coalesce(n_productos, 0) + coalesce(n_obsequios, 0) AS "Cantidad_Total_Producto"
FROM ord o LEFT JOIN articulos_credito a ON a.credito = o.credito""")
def q_products_and_gifts(spark: SparkSession, d: str) -> DataFrame:
    sold = written(sales_rows(spark, d))  # looked up, listed and counted: joined once, then read
    found = written(invoices.invoice_of_credit(sold, order=LINE_ORDER))
    return items.products_and_gifts(
        orders(spark, d).select("Credito"), sold, found, order=LINE_ORDER)


def _contracts(rows: DataFrame) -> DataFrame:
    """Contracts of lender A: an order and each line of it gives one, the last counts."""
    return rows.select(
        F.concat(F.lit("x,"), F.regexp_replace("Credito", "-", ",")).alias("Factura_Venta"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("Valor_Cuota"),
        F.col("l_linenumber").cast("bigint").alias("Total_Cuotas"),
        *LINE_ORDER,
    )


def _disbursements(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.concat(F.lit(" "), F.lower("Credito")).alias("Credito"),
        F.col("l_linenumber").cast("bigint").alias("Total_Cuotas"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("Valor_Cuota"),
        (F.col("l_extendedprice") + F.col("l_quantity")).cast("decimal(18,2)").alias("Valor_Desembolso"),
        *LINE_ORDER,
    )


TERMS = """
condiciones AS (
  SELECT credito, l_linenumber AS cuotas, l_extendedprice AS cuota,
         CASE WHEN credito LIKE 'DF-%'
              THEN CAST(importe + CAST(l_quantity AS DECIMAL(18,2)) AS DOUBLE)
              ELSE CAST(importe * l_linenumber AS DOUBLE) END AS desembolso
  FROM (SELECT *, row_number() OVER (PARTITION BY credito ORDER BY l_shipdate DESC, l_linenumber DESC,
              l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lin) WHERE rn = 1)"""


@query("credit_details", f"""
WITH {ORDERS}, {LINES}, {TERMS}
SELECT o.credito AS "Credito", CAST(cuotas AS BIGINT) AS "Total_Cuotas", cuota AS "Valor_Cuota",
       desembolso AS "Valor_Desembolso"
FROM ord o LEFT JOIN condiciones c ON c.credito = o.credito""")
def q_credit_details(spark: SparkSession, d: str) -> DataFrame:
    return shown(details.credit_details(
        orders(spark, d).select("Credito"), _contracts(lines(spark, d)), _disbursements(lines(spark, d)),
        order=LINE_ORDER))


@query("repair_installment_no", """
SELECT p_partkey, CASE WHEN p_size * 10 > 100 THEN p_size * 10 % 100 ELSE p_size * 10 END AS "Cuota_Vigente",
       p_size * 25 AS otra
FROM part""")
def q_repair_installment_no(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select(
        "p_partkey", (F.col("p_size") * 10).alias("Cuota_Vigente"), (F.col("p_size") * 25).alias("otra"))
    return installments.repair_installment_numbers(p)


_DAYS = """
dias AS (SELECT *, CASE WHEN o_orderstatus = 'P' THEN NULL
                ELSE greatest(date_diff('day', dia, DATE '1998-06-15'), 0) END AS d FROM ord)"""

_BAND = """CASE WHEN d = 0 THEN 'AL DIA' WHEN d BETWEEN 1 AND 30 THEN '1 A 30'
            WHEN d BETWEEN 31 AND 90 THEN '31 A 90' WHEN d > 90 THEN '91 A 360' ELSE 'SIN INFO' END"""


def with_days(o: DataFrame) -> DataFrame:
    late = F.greatest(F.datediff(F.lit(AS_OF).cast("date"), "dia"), F.lit(0)).cast("bigint")
    return o.withColumn("Dias_Atraso", F.when(F.col("o_orderstatus") != "P", late))


@query("arrears_band", f"""
WITH {ORDERS}, {_DAYS} SELECT o_orderkey, d AS "Dias_Atraso", {_BAND} AS "Franja_Mora" FROM dias""")
def q_arrears_band(spark: SparkSession, d: str) -> DataFrame:
    return with_days(orders(spark, d)).select(
        "o_orderkey", "Dias_Atraso", arrears.arrears_band().alias("Franja_Mora"))


def _matrix(nation: DataFrame) -> DataFrame:
    """Zones: one per nation, with a collector and the call centres of each band."""
    n = nation
    columns = {
        "Zona": F.concat(F.lit(" Z"), "n_nationkey"),
        "Cobrador": F.col("n_name"),
        "Telefono_Cobrador": F.col("n_regionkey").cast("string"),
        "Regional_Cobro": F.concat(F.lit("R"), "n_regionkey"),
        "Gestor": F.concat(F.lit("G"), "n_name"),
        "Telefono_Gestor": F.lit("3"),
    }
    for group in arrears.CALL_CENTER_COLUMNS.values():
        for c in group:
            columns[c] = F.concat(F.lit(c + " "), "n_nationkey")
    return n.select(*[v.alias(c) for c, v in columns.items()], F.col("n_nationkey").alias("orden"))


def _route_sql(at: int, band: str) -> str:
    names = [group[at] for group in arrears.CALL_CENTER_COLUMNS.values()]
    cases = " ".join(f"WHEN '{b}' THEN '{n} ' || c_nationkey"
                     for b, n in zip(arrears.CALL_CENTER_COLUMNS, names))
    return f"CASE {band} {cases} END"


@query("call_center_routing", f"""
WITH {ORDERS}, {_DAYS}
SELECT o_orderkey, d AS "Dias_Atraso", franja AS "Franja_Mora",
       {_route_sql(0, "franja")} AS "Call_Center_Apoyo", {_route_sql(1, "franja")} AS "Nombre_Call_Center",
       {_route_sql(2, "franja")} AS "Telefono_Call_Center"
FROM (SELECT *, {_BAND} AS franja FROM dias) JOIN customer ON o_custkey = c_custkey""")
def q_call_center_routing(spark: SparkSession, d: str) -> DataFrame:
    centers = [c for g in arrears.CALL_CENTER_COLUMNS.values() for c in g]
    zones = _matrix(table(spark, d, "nation")).select(F.col("orden").alias("c_nationkey"), *centers)
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    rows = with_days(orders(spark, d)).select("o_orderkey", "o_custkey", "Dias_Atraso")
    joined = rows.join(c, "o_custkey").join(zones, "c_nationkey").drop("o_custkey", "c_nationkey")
    return arrears.route_call_center(joined)


def _concepts(rows: DataFrame) -> DataFrame:
    concept = (
        F.when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O"), "ABONO DIF TASA")
        .when(F.col("l_returnflag") == "A", "CAPITAL")
        .when(F.col("l_returnflag") == "N", "AVAL")
        .otherwise("INTERES CORRIENTE")
    )
    return rows.select(
        "Credito", concept.alias("Concepto"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("Saldo"))


CONCEPTS = """
conceptos AS (
  SELECT credito, sum(importe) FILTER (WHERE l_returnflag = 'A') AS capital,
         sum(importe) FILTER (WHERE l_returnflag = 'N') AS aval,
         sum(importe) FILTER (WHERE l_returnflag = 'R') AS interes
  FROM lin GROUP BY credito)"""

_BALANCES = """
       CAST(trunc(coalesce(capital, CASE WHEN empresa = 'ARPESOD' THEN valor END, 0)) AS BIGINT) AS capital_n,
       CASE WHEN empresa = 'FINANSUEÑOS' THEN CAST(trunc(coalesce(aval, 0)) AS BIGINT) END AS aval_n,
       CASE WHEN empresa = 'FINANSUEÑOS' THEN CAST(trunc(coalesce(interes, 0)) AS BIGINT) END AS interes_n"""


@query("concept_balances", f"""
WITH {ORDERS}, {LINES}, {CONCEPTS}
SELECT o.credito AS "Credito", capital_n AS "Saldo_Capital",
       coalesce(CAST(aval_n AS VARCHAR), 'NO APLICA') AS "Saldo_Avales",
       coalesce(CAST(interes_n AS VARCHAR), 'NO APLICA') AS "Saldo_Interes_Corriente"
FROM (SELECT o.*, {_BALANCES} FROM ord o LEFT JOIN conceptos c ON c.credito = o.credito) o""")
def q_concept_balances(spark: SparkSession, d: str) -> DataFrame:
    o = orders(spark, d).select("Credito", "Empresa", F.col("valor").alias("Saldo_Factura"))
    done = balances.balances(o, _concepts(lines(spark, d)))
    return done.select(
        "Credito", "Saldo_Capital", balances.balance_label("Saldo_Avales").alias("Saldo_Avales"),
        balances.balance_label("Saldo_Interes_Corriente").alias("Saldo_Interes_Corriente"))


def _goals(nation: DataFrame) -> DataFrame:
    """Goals of the zones; zones of one region have two rows, zones of another none."""
    n = nation.where("n_regionkey <> 4")
    key = F.col("n_nationkey")
    goal = n.select(
        F.concat(F.lit("Z"), key).alias("Zona"),
        F.concat(key.cast("string"), F.lit("%")).alias("Meta_1_A_30"),
        F.concat(key.cast("string"), F.lit(" %")).alias("Meta_31_A_90"),
        (key.cast("double") / 100).cast("string").alias("Meta_91_A_180"),
        (key + 20).cast("string").alias("Meta_181_A_360"),
        (key.cast("double") / 1000).cast("string").alias("Total_Recaudo"),
        "n_regionkey",
    )
    again = goal.where("n_regionkey = 3").withColumn("Total_Recaudo", F.lit("50%"))
    return goal.unionByName(again).drop("n_regionkey")


def _ratio(value: str) -> str:
    return f"CASE WHEN {value} > 1 THEN {value} / 100 ELSE {value} END"


GOALS = f"""
metas AS (
  SELECT n_nationkey, {_ratio("k")} AS m1, {_ratio("k")} AS m2, {_ratio("(k / 100)")} AS m3,
         {_ratio("(k + 20)")} AS m4, {_ratio("tr")} AS tr
  FROM (SELECT n_nationkey, CAST(n_nationkey AS DOUBLE) AS k, CAST(n_nationkey AS DOUBLE) / 1000 AS tr
        FROM nation WHERE n_regionkey <> 4
        UNION ALL SELECT n_nationkey, CAST(n_nationkey AS DOUBLE), 50.0 FROM nation WHERE n_regionkey = 3))"""

_GOAL_COLUMNS = """
       CASE WHEN d BETWEEN 1 AND 30 THEN coalesce(m1, 0) WHEN d BETWEEN 31 AND 90 THEN coalesce(m2, 0)
            WHEN d BETWEEN 91 AND 180 THEN coalesce(m3, 0) WHEN d BETWEEN 181 AND 360 THEN coalesce(m4, 0)
            ELSE 0.0 END AS meta_p,
       CAST(valor + CASE WHEN o_orderstatus = 'F' THEN 0 ELSE valor END
            + CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS general,
       coalesce(tr, 0.0) AS tr_p"""


@query("goal_metrics", f"""
WITH {ORDERS}, {LINES}, {CONCEPTS}, {_DAYS}, {GOALS},
saldos AS (SELECT o.*, c_nationkey, c_acctbal, {_BALANCES}
           FROM dias o JOIN customer ON o_custkey = c_custkey
           LEFT JOIN conceptos c ON c.credito = o.credito)
SELECT credito AS "Credito", general AS "Meta_General", meta_p AS "Meta_%", general * meta_p AS "Meta_$",
       tr_p AS "Meta_TR_%",
       CAST(CASE WHEN empresa = 'FINANSUEÑOS' THEN capital_n + aval_n + interes_n ELSE capital_n END AS DOUBLE)
         * tr_p AS "Meta_TR_$",
       CAST(CAST(round_even(round_even(meta_p, 4) * 100, 0) AS INT) AS VARCHAR) || '%' AS meta_texto
FROM (SELECT *, {_GOAL_COLUMNS} FROM saldos s LEFT JOIN metas m ON m.n_nationkey = s.c_nationkey)""")
def q_goal_metrics(spark: SparkSession, d: str) -> DataFrame:
    from ledgerspark.functions.numbers import percent_text

    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey",
                                           "c_acctbal")
    rows = with_days(orders(spark, d)).join(c, "o_custkey").select(
        "Credito", "Empresa", "Dias_Atraso", F.col("valor").alias("Saldo_Factura"),
        F.concat(F.lit("Z"), "c_nationkey", F.lit(" ")).alias("Zona"),
        F.col("valor").alias("Meta_DC_Al_Dia"),
        F.when(F.col("o_orderstatus") != "F", F.col("valor")).alias("Meta_DC_Atraso"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("Meta_Atraso"),
    )
    done = goals.goal_metrics(balances.balances(rows, _concepts(lines(spark, d))), _goals(table(spark, d, "nation")))
    return shown(done.select(
        "Credito", "Meta_General", "Meta_%", "Meta_$", "Meta_TR_%", "Meta_TR_$",
        percent_text("Meta_%").alias("meta_texto")))


@query("goal_metrics_empty", f"""
WITH {ORDERS}
SELECT credito AS "Credito", CAST(o_totalprice AS DOUBLE) AS "Meta_General", CAST(NULL AS DOUBLE) AS "Meta_%",
       CAST(NULL AS DOUBLE) AS "Meta_$", CAST(NULL AS DOUBLE) AS "Meta_TR_%", CAST(NULL AS DOUBLE) AS "Meta_TR_$"
FROM ord""")
def q_goal_metrics_empty(spark: SparkSession, d: str) -> DataFrame:
    """A goal table that has no rows for any zone at all."""
    rows = orders(spark, d).select(
        "Credito", "Empresa", F.lit("Z").alias("Zona"), F.lit(10).alias("Dias_Atraso"),
        F.lit(1).alias("Saldo_Capital"), F.lit(1).alias("Saldo_Avales"),
        F.lit(1).alias("Saldo_Interes_Corriente"), F.col("valor").alias("Meta_DC_Al_Dia"),
        F.lit(None).cast("decimal(18,2)").alias("Meta_DC_Atraso"),
        F.lit(0).cast("decimal(18,2)").alias("Meta_Atraso"))
    none = _goals(table(spark, d, "nation")).where("Zona IS NULL")
    return shown(goals.goal_metrics(rows, none).select(
        "Credito", "Meta_General", "Meta_%", "Meta_$", "Meta_TR_%", "Meta_TR_$"))


@query("assign_invoice_labels", f"""
WITH {ORDERS}
SELECT caso, credito AS "Credito", CASE WHEN empresa = 'ARPESOD' THEN credito ELSE etiqueta END AS "Factura_Venta"
FROM ord, (VALUES ('sin tabla', 'NO DISPONIBLE'), ('sin filas', 'NO DISPONIBLE'), ('sin fechas', 'ERROR DE FECHA'))
     t(caso, etiqueta)""")
def q_assign_invoice_labels(spark: SparkSession, d: str) -> DataFrame:
    """What credits show where the sales table is absent, empty, or without a readable date."""
    o = orders(spark, d)
    sales = o.select("Credito", "Cedula_Cliente", parse_date(F.col("o_orderpriority")).alias("Fecha_Facturada"),
                     F.col("o_orderkey").alias("ord"))
    cases = {"sin tabla": None, "sin filas": sales.where("ord < 0"), "sin fechas": sales}
    parts = [invoices.assign_invoice(o.select("Credito", "Empresa"), found, order=["ord"]).select(
        F.lit(name).alias("caso"), "Credito", "Factura_Venta") for name, found in cases.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("clear_arrears", f"""
WITH {ORDERS}, {_DAYS}
SELECT o_orderkey, CASE WHEN coalesce(d, 0) = 0 THEN 'SIN MORA' ELSE CAST(o_custkey AS VARCHAR) END
         AS "Primera_Cuota_Mora_label",
       CASE WHEN coalesce(d, 0) = 0 THEN 0 ELSE o_totalprice END AS "Valor_Vencido",
       CASE WHEN coalesce(d, 0) = 0 THEN NULL ELSE strftime(dia, '%Y-%m-%d') END AS "Fecha_Cuota_Atraso"
FROM dias""")
def q_clear_arrears(spark: SparkSession, d: str) -> DataFrame:
    rows = with_days(orders(spark, d)).select(
        "o_orderkey", "Dias_Atraso", F.col("o_custkey").alias("Primera_Cuota_Mora"),
        F.col("valor").alias("Valor_Vencido"), F.col("dia").alias("Fecha_Cuota_Atraso"))
    done = installments.arrears_label(installments.clear_arrears(rows), "Primera_Cuota_Mora")
    return shown(done.select(
        "o_orderkey", "Primera_Cuota_Mora_label", "Valor_Vencido", "Fecha_Cuota_Atraso"))


@query("seller_status", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, CAST(l_suppkey AS VARCHAR) AS "Codigo_Vendedor",
       CASE WHEN s_acctbal > 0 THEN 'SI' ELSE 'INACTIVO' END AS "Vendedor_Activo",
       CASE WHEN s_acctbal > 0 THEN s_name END AS "Jefe_ventas", n_name AS "Regional_Venta",
       CAST(s_nationkey AS VARCHAR) AS "Codigo_Centro_Costos"
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""")
def q_seller_status(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    centers = table(spark, d, "nation").select(
        F.concat("n_nationkey", F.lit(".0")).alias("Codigo_Centro_Costos"),
        F.col("n_name").alias("Regional_Venta"), F.col("n_nationkey").alias("orden"))
    active = s.where("s_acctbal > 0").select(
        F.concat(F.lit(" "), "s_suppkey", F.lit(".0")).alias("Codigo_Vendedor"),
        F.col("s_name").alias("Jefe_ventas"), F.col("s_suppkey").alias("orden"))
    nations = s.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    rows = table(spark, d, "lineitem").join(nations, "l_suppkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        F.col("l_suppkey").cast("string").alias("Codigo_Vendedor"),
        F.col("s_nationkey").cast("string").alias("Codigo_Centro_Costos"))
    return sellers.sellers_and_centers(rows, active, centers, order=["orden"])


@query("finalize_report", f"""
WITH {ORDERS}, {_DAYS}
SELECT empresa AS "Empresa", credito AS "Credito", strftime(dia, '%d/%m/%Y') AS "Fecha_Facturada",
       CASE WHEN d > 90 THEN strftime(dia, '%d/%m/%Y') ELSE 'VIGENCIA EXPIRADA' END AS "Fecha_Cuota_Vigente",
       CASE WHEN d > 90 THEN CAST(o_custkey AS VARCHAR) ELSE 'VIGENCIA EXPIRADA' END AS "Cuota_Vigente",
       CASE WHEN d > 90 THEN CAST(valor AS VARCHAR) ELSE 'VIGENCIA EXPIRADA' END AS "Valor_Cuota_Vigente",
       CASE WHEN d > 0 THEN strftime(dia, '%d/%m/%Y') ELSE 'SIN MORA' END AS "Fecha_Cuota_Atraso",
       CASE WHEN d > 0 THEN CAST(o_custkey AS VARCHAR) ELSE 'SIN MORA' END AS "Primera_Cuota_Mora",
       CASE WHEN d > 0 THEN o_totalprice ELSE 0 END AS "Valor_Cuota_Atraso",
       CASE WHEN d > 0 THEN o_totalprice ELSE 0 END AS "Valor_Vencido", o_orderkey AS extra
FROM dias""")
def q_finalize_report(spark: SparkSession, d: str) -> DataFrame:
    o = with_days(orders(spark, d))
    late, old = F.col("Dias_Atraso") > 0, F.col("Dias_Atraso") > 90
    rows = o.select(
        F.col("o_orderkey").alias("extra"), "Credito", "Empresa", "Tipo_Credito",
        F.lit(1).alias("x_R03"), F.col("dia").alias("Fecha_Facturada"),
        F.when(old, F.col("dia")).alias("Fecha_Cuota_Vigente"),
        F.when(old, F.col("o_custkey")).alias("Cuota_Vigente"),
        F.when(old, F.col("valor")).alias("Valor_Cuota_Vigente"),
        F.when(late, F.col("dia")).alias("Fecha_Cuota_Atraso"),
        F.when(late, F.col("o_custkey")).alias("Primera_Cuota_Mora"),
        F.when(late, F.col("valor")).alias("Valor_Cuota_Atraso"),
        F.when(late, F.col("valor")).alias("Valor_Vencido"))
    return shown(report.finalize_report(rows, MONTHLY_ORDER))


# ---------------------------------------------------------------------------------------------
# The whole job
# ---------------------------------------------------------------------------------------------

KEEP = [*LINE_ORDER, "orden"]


def monthly_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """All extracts of the monthly base. ``KEEP`` holds their order columns."""
    o = orders(spark, d)
    # Five extracts come from the lines: joined once, then read.
    li = written(lines(spark, d, o).select(
        "Credito", "Cedula_Cliente", "dia", *LINE_ORDER, "l_quantity", "l_returnflag", "l_linestatus"))
    nation = table(spark, d, "nation")
    c = table(spark, d, "customer")
    client = c.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey", "c_acctbal")
    none = {k: F.lit(None) for k in KEEP}

    def ordered(df: DataFrame, **places: Column) -> DataFrame:
        types = {"l_shipdate": "timestamp_ntz", "l_linenumber": "int", "l_partkey": "bigint",
                 "l_suppkey": "bigint", "l_extendedprice": "double", "orden": "bigint"}
        have = {**none, **places}
        return df.select(
            *[x for x in df.columns if x not in KEEP],
            *[(F.col(k) if k in df.columns else have[k]).cast(types[k]).alias(k) for k in KEEP])

    base = o.join(client, "o_custkey").select(
        F.col("c_name").alias("Nombre_Cliente"), F.concat(F.lit("Z"), "c_nationkey").alias("Zona"),
        "Cedula_Cliente", "Numero_Credito", F.concat(F.lit("V "), "c_name").alias("Nombre_Vendedor"),
        "Tipo_Credito", F.concat("o_custkey", F.lit(".0")).alias("Codigo_Vendedor"),
        F.col("c_nationkey").cast("string").alias("Codigo_Centro_Costos"),
        F.col("o_orderstatus").alias("Zona_Cobro"), F.col("valor").alias("Meta_Intereses"),
        F.col("valor").alias("Meta_DC_Al_Dia"),
        F.when(F.col("o_orderstatus") != "F", F.col("valor")).alias("Meta_DC_Atraso"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("Meta_Atraso"), "Credito")
    analysis = with_days(o).select(
        F.col("o_orderpriority").alias("Direccion"), F.col("o_orderstatus").alias("Barrio"),
        F.lit("POPAYAN").alias("Nombre_Ciudad"), "Dias_Atraso",
        F.col("o_custkey").alias("Cuotas_Pagadas"), F.col("valor").alias("Saldo_Factura"), "Credito",
        F.col("o_orderkey").alias("orden"))
    backed = F.col("c_acctbal") >= 0
    guarantors = c.where("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").cast("string").alias("Cedula_Cliente"), F.col("c_custkey").alias("orden"),
        *[F.when(backed, F.concat(F.lit(f"{n} "), "c_name")).otherwise(L.NO_GUARANTOR).alias(n)
          for n in GUARANTOR_COLUMNS])
    own = table(spark, d, "supplier")
    return {
        "R91": ordered(base),
        "ANALISIS": ordered(analysis),
        "VENCIMIENTOS": ordered(installments_of(li)),
        "R03": ordered(guarantors),
        "SC04": ordered(_contracts(li)),
        "CRTMPCONSULTA1": ordered(sales_of(li, table(spark, d, "part"))),
        "FNZ003": ordered(_concepts(li)),
        "MATRIZ_CARTERA": ordered(_matrix(nation)),
        "METAS_FRANJAS": ordered(_goals(nation)),
        "ASESORES": ordered(own.where("s_acctbal > 0").select(
            F.col("s_suppkey").cast("string").alias("Codigo_Vendedor"),
            F.col("s_name").alias("Jefe_ventas"), F.lit("301").alias("Movil_Vendedor"),
            F.concat(F.lit("L"), "s_nationkey").alias("Lider_Zona"), F.lit("302").alias("Movil_Lider"),
            F.col("s_suppkey").alias("orden"))),
        "CENTRO_COSTOS": ordered(nation.select(
            F.col("n_nationkey").cast("string").alias("Codigo_Centro_Costos"),
            F.col("n_name").alias("Regional_Venta"), F.col("n_nationkey").alias("orden"))),
        "DESEMBOLSOS_FINANSUEÑOS": ordered(_disbursements(li)),
    }


GUARANTOR_COLUMNS = [
    "Codeudor1", "Nombre_Codeudor1", "Telefono_Codeudor1", "Ciudad_Codeudor1",
    "Codeudor2", "Nombre_Codeudor2", "Telefono_Codeudor2", "Ciudad_Codeudor2"]


def _pct(value: str) -> str:
    return (f"CAST(CAST(round_even(round_even(CASE WHEN {value} > 1 THEN {value} / 100 ELSE {value} END, 4)"
            f" * 100, 0) AS INT) AS VARCHAR) || '%'")


def _mod(value: str) -> str:
    return f"CASE WHEN {value} > 100 THEN {value} % 100 ELSE {value} END"


_GUARANTOR_SQL = ",\n       ".join(
    f"CASE WHEN c_mktsegment <> 'BUILDING' THEN CASE WHEN c_acctbal >= 0 THEN '{n} ' || c_name "
    f"ELSE 'SIN CODEUDOR' END END AS \"{n}\"" for n in GUARANTOR_COLUMNS)

MONTHLY_SQL = f"""
WITH {ORDERS}, {LINES}, {SALES}, {ITEMS}, {SALES_MAP}, {TERMS}, {CONCEPTS}, {_DAYS}, {GOALS},
resumen AS ({summary_sql(AS_OF)}),
todo AS (
  SELECT o.*, c_name, c_nationkey, c_acctbal, c_mktsegment, {_BALANCES},
         r.* EXCLUDE (credito), a.* EXCLUDE (credito), t.* EXCLUDE (credito), factura,
         {_BAND} AS franja, s_suppkey, s_name, s_nationkey, v.correo
  FROM dias o JOIN customer ON o_custkey = c_custkey
  LEFT JOIN conceptos k ON k.credito = o.credito
  LEFT JOIN resumen r ON r.credito = o.credito
  LEFT JOIN articulos_credito a ON a.credito = o.credito
  LEFT JOIN condiciones t ON t.credito = o.credito
  LEFT JOIN facturas f ON f.credito = o.credito
  LEFT JOIN (SELECT DISTINCT credito, 'c' || cedula || '@mail.co' AS correo FROM ventas) v ON v.credito = o.credito
  LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) ON s_suppkey = o_custkey),
final AS (
  SELECT *, {_GOAL_COLUMNS}, coalesce(d, 0) = 0 AS limpia
  FROM todo s LEFT JOIN metas m ON m.n_nationkey = s.c_nationkey)
SELECT empresa AS "Empresa", credito AS "Credito",
       CASE WHEN correo IS NULL THEN '' ELSE strftime(dia, '%d/%m/%Y') END AS "Fecha_Facturada",
       CASE WHEN empresa = 'ARPESOD' THEN credito ELSE coalesce(factura, 'NO ASIGNADA') END AS "Factura_Venta",
       coalesce(productos, 'NO APLICA') AS "Nombre_Producto", coalesce(n_productos, 0) AS "Cantidad_Producto",
       coalesce(obsequios, 'NO APLICA') AS "Obsequio", coalesce(n_obsequios, 0) AS "Cantidad_Obsequio",
       coalesce(n_productos, 0) + coalesce(n_obsequios, 0) AS "Cantidad_Total_Producto",
       cedula AS "Cedula_Cliente", c_name AS "Nombre_Cliente", correo AS "Correo",
       o_orderpriority AS "Direccion", o_orderstatus AS "Barrio", 'POPAYAN' AS "Nombre_Ciudad",
       'Z' || c_nationkey AS "Zona", z.n_name AS "Cobrador", CAST(z.n_regionkey AS VARCHAR) AS "Telefono_Cobrador",
       o_orderstatus AS "Zona_Cobro", {_route_sql(0, "franja")} AS "Call_Center_Apoyo",
       {_route_sql(1, "franja")} AS "Nombre_Call_Center", {_route_sql(2, "franja")} AS "Telefono_Call_Center",
       'R' || z.n_regionkey AS "Regional_Cobro", 'G' || z.n_name AS "Gestor", '3' AS "Telefono_Gestor",
       s_name AS "Jefe_ventas", CAST(o_custkey AS VARCHAR) AS "Codigo_Vendedor", 'V ' || c_name AS "Nombre_Vendedor",
       CASE WHEN s_suppkey IS NOT NULL THEN '301' END AS "Movil_Vendedor",
       CASE WHEN s_suppkey IS NOT NULL THEN 'SI' ELSE 'INACTIVO' END AS "Vendedor_Activo",
       'L' || s_nationkey AS "Lider_Zona", CASE WHEN s_suppkey IS NOT NULL THEN '302' END AS "Movil_Lider",
       CAST(c_nationkey AS VARCHAR) AS "Codigo_Centro_Costos", z.n_name AS "Regional_Venta",
       {_GUARANTOR_SQL},
       desembolso AS "Valor_Desembolso", CAST(cuotas AS BIGINT) AS "Total_Cuotas", cuota AS "Valor_Cuota",
       d AS "Dias_Atraso", franja AS "Franja_Mora", capital_n AS "Saldo_Capital",
       coalesce(CAST(interes_n AS VARCHAR), 'NO APLICA') AS "Saldo_Interes_Corriente",
       coalesce(CAST(aval_n AS VARCHAR), 'NO APLICA') AS "Saldo_Avales",
       o_totalprice AS "Meta_Intereses", general AS "Meta_General", {_pct("meta_p")} AS "Meta_%",
       general * meta_p AS "Meta_$", {_pct("tr_p")} AS "Meta_T.R_%",
       CAST(CASE WHEN empresa = 'FINANSUEÑOS' THEN capital_n + aval_n + interes_n ELSE capital_n END AS DOUBLE)
         * tr_p AS "Meta_T.R_$",
       {_mod("o_custkey")} AS "Cuotas_Pagadas",
       coalesce(CAST({_mod("n_vigente")} AS VARCHAR), 'VIGENCIA EXPIRADA') AS "Cuota_Vigente",
       coalesce(strftime(f_vigente, '%d/%m/%Y'), 'VIGENCIA EXPIRADA') AS "Fecha_Cuota_Vigente",
       coalesce(CAST(CAST(v_vigente AS DECIMAL(18,2)) AS VARCHAR), 'VIGENCIA EXPIRADA') AS "Valor_Cuota_Vigente",
       CASE WHEN limpia OR f_atraso IS NULL THEN 'SIN MORA' ELSE strftime(f_atraso, '%d/%m/%Y') END
         AS "Fecha_Cuota_Atraso",
       CASE WHEN limpia OR n_atraso IS NULL THEN 'SIN MORA' ELSE CAST({_mod("n_atraso")} AS VARCHAR) END
         AS "Primera_Cuota_Mora",
       CASE WHEN limpia THEN 0 ELSE coalesce(v_atraso, 0) END AS "Valor_Cuota_Atraso",
       CASE WHEN limpia THEN 0 ELSE coalesce(CAST(vencido AS DOUBLE), 0) END AS "Valor_Vencido",
       o_totalprice AS "Meta_DC_Al_Dia", CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_totalprice END AS "Meta_DC_Atraso",
       c_acctbal AS "Meta_Atraso"
FROM final JOIN nation z ON z.n_nationkey = c_nationkey"""


@query("monthly_base", MONTHLY_SQL)
def q_monthly_base(spark: SparkSession, d: str) -> DataFrame:
    return shown(monthly_base(monthly_tables(spark, d), as_of=AS_OF, order=KEEP))


@query("monthly_base_date_range", f"""
SELECT "Credito", "Fecha_Cuota_Vigente", "Empresa", "Valor_Vencido", "Factura_Venta" FROM ({MONTHLY_SQL})
WHERE "Fecha_Cuota_Vigente" BETWEEN '05/06/1998' AND '20/06/1998'
  AND "Fecha_Cuota_Vigente" LIKE '%/06/1998'""")
def q_monthly_base_date_range(spark: SparkSession, d: str) -> DataFrame:
    done = monthly_base(monthly_tables(spark, d), as_of=AS_OF, order=KEEP,
                        start="05/06/1998", end="20/06/1998")
    return shown(done.select(
        "Credito", "Fecha_Cuota_Vigente", "Empresa", "Valor_Vencido", "Factura_Venta"))


@query("monthly_base_counts", f"""
WITH todo AS ({MONTHLY_SQL.strip()}),
pasos AS (SELECT (SELECT count(*) FROM orders) AS base, count(*) AS metas,
                 count(*) FILTER (WHERE "Fecha_Cuota_Vigente" BETWEEN '05/06/1998' AND '20/06/1998'
                                  AND "Fecha_Cuota_Vigente" LIKE '%/06/1998') AS fin FROM todo)
SELECT place, step, 'rows' AS measure, CAST(value AS BIGINT) AS value FROM (
  SELECT 0 AS place, 'base' AS step, base AS value FROM pasos
  UNION ALL SELECT 1, 'credits and clients', base FROM pasos
  UNION ALL SELECT 2, 'sellers and zones', base FROM pasos
  UNION ALL SELECT 3, 'goals', metas FROM pasos
  UNION ALL SELECT 4, 'report', fin FROM pasos)""")
def q_monthly_base_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows of every step; goals of one zone may be several, and only some dates are reported."""
    counts = StepCounts()
    written(monthly_base(monthly_tables(spark, d), as_of=AS_OF, order=KEEP, start="05/06/1998",
                         end="20/06/1998", counts=counts))
    return counts.report(spark)
