"""Queries on payments, advances and their marks.

Lender B's accounts are the orders of type DF, lender A's all others; payments and advances are
orders as well, so a client has several of each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.operators import advances as adv
from ledgerspark.operators import flags, payments
from ledgerspark.operators.keyed import first_per_key
from ledgerspark.plans.advances import advances
from ledgerspark.plans.collections import BANK, CASH, collections
from ledgerspark.session import written

from .extracts import ORDERS, orders
from .registry import query, shown, table

ORDER = ["orden"]


def _accounts(o: DataFrame, lender: str) -> DataFrame:
    return o.where(F.col("Empresa") == lender).select(
        F.col("Cedula_Cliente").alias("CEDULA"), F.col("Credito").alias("FACTURA"),
        F.col("valor").alias("SALDO"), F.col("o_orderpriority").alias("CENTRO_COSTO"),
        F.col("o_orderkey").alias("orden"))


def payment_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The seven tables of the collections job."""
    o = orders(spark, d)
    c = table(spark, d, "customer")
    client = c.select(F.col("c_custkey").cast("string").alias("Cedula_Cliente"), "c_mktsegment",
                      "c_acctbal")
    lender_b, lender_a = _accounts(o, "FINANSUEÑOS"), _accounts(o, "ARPESOD")
    received = o
    agencies = lender_b.unionByName(lender_a).join(
        client, F.col("CEDULA") == F.col("Cedula_Cliente")).where("c_acctbal < 2000").select(
        "FACTURA", F.col("c_mktsegment").alias("CASA COBRANZA"), "orden", "c_acctbal")
    # Some documents went to a second agency later.
    again = agencies.where("c_acctbal < 0").withColumns({
        "CASA COBRANZA": F.concat(F.lit("2 "), "CASA COBRANZA"), "orden": F.col("orden") + 10**9})
    return {
        "AC FS": lender_b,
        "AC ARP": lender_a,
        "CODEUDORES": o.where("o_orderstatus = 'F' AND o_orderpriority = '5-LOW'").select(
            F.col("Cedula_Cliente").alias("DOCUMENTO_CODEUDOR"),
            F.concat(F.when(F.col("valor") > 250000, "DF-").otherwise("FA-"), "o_orderkey")
            .alias("CODEUDOR"),
            F.col("o_orderkey").alias("orden")),
        "CASA DE COBRANZA": again.unionByName(agencies).drop("c_acctbal"),
        "EMPLEADOS ACTUALES": c.where("c_mktsegment IN ('HOUSEHOLD', 'FURNITURE')").select(
            F.col("c_custkey").cast("string").alias("vincedula"),
            F.when(F.col("c_mktsegment") == "HOUSEHOLD", " si").otherwise("RETIRADO")
            .alias("ESTADO_EMPLEADO"),
            F.col("c_custkey").alias("orden")),
        "PAGOS BANCOLOMBIA": received.select(
            F.col("o_orderkey").alias("No"), F.col("dia").alias("Fecha"),
            F.col("o_orderpriority").alias("Detalle 1"), F.col("o_orderstatus").alias("Detalle 2"),
            F.col("Cedula_Cliente").alias("Referencia 1"),
            F.concat("Cedula_Cliente", F.lit(".5")).alias("Referencia 2"),
            F.col("valor").alias("Valor"), F.col("o_orderkey").alias("orden")),
        # Coarse enough that equal payments occur.
        "PAGOS EFECTY": received.select(
            F.year("dia").cast("bigint").alias("No"),
            F.col("Cedula_Cliente").alias("Identificación"),
            (F.floor(F.col("valor") / 100000) * 100000).cast("decimal(18,2)").alias("Valor"),
            F.col("o_orderstatus").alias("N° de Autorización"),
            F.trunc("dia", "year").alias("Fecha"), F.col("o_orderkey").alias("orden")),
    }


# The SQL joins first and removes the repeated rows afterwards, the other way round than the job.
def portfolio_sql(payments_sql: str, client: str, columns: str) -> str:
    return f"""
{ORDERS},
fs AS (SELECT cedula, credito AS factura, valor AS saldo, o_orderpriority AS centro, o_orderkey AS orden
       FROM ord WHERE tipo = 'DF'),
arp AS (SELECT cedula, credito AS factura, valor AS saldo, o_orderpriority AS centro, o_orderkey AS orden
       FROM ord WHERE tipo <> 'DF'),
codeudores AS (SELECT cedula, CASE WHEN valor > 250000 THEN 'DF-' ELSE 'FA-' END || o_orderkey AS codeudor
               FROM ord WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW'),
casas AS (SELECT factura, c_mktsegment AS casa
          FROM (SELECT * FROM fs UNION ALL SELECT * FROM arp) JOIN customer ON cedula = CAST(c_custkey AS VARCHAR)
          WHERE c_acctbal < 2000),
empleados AS (SELECT CAST(c_custkey AS VARCHAR) AS cedula,
                     CASE c_mktsegment WHEN 'HOUSEHOLD' THEN ' si' ELSE 'RETIRADO' END AS estado
              FROM customer WHERE c_mktsegment IN ('HOUSEHOLD', 'FURNITURE')),
pagos AS ({payments_sql}),
cuentas AS (
  SELECT {columns}, estado, fs.factura AS fs_factura, arp.factura AS arp_factura,
         coalesce(nfs, 0) AS n_fs, coalesce(narp, 0) AS n_arp,
         row_number() OVER (PARTITION BY {columns} ORDER BY fs.orden, arp.orden) AS rn
  FROM pagos p LEFT JOIN empleados e ON e.cedula = p.{client}
  LEFT JOIN fs ON fs.cedula = p.{client} LEFT JOIN arp ON arp.cedula = p.{client}
  LEFT JOIN (SELECT cedula, count(*) AS nfs FROM fs GROUP BY 1) x ON x.cedula = p.{client}
  LEFT JOIN (SELECT cedula, count(*) AS narp FROM arp GROUP BY 1) y ON y.cedula = p.{client}),
documentos AS (
  SELECT *, coalesce(CASE WHEN n_fs + n_arp > 1 THEN 'Mas de una cartera'
                          WHEN fs_factura IS NOT NULL THEN fs_factura ELSE arp_factura END,
                     'SIN CARTERA') AS documento
  FROM cuentas WHERE rn = 1),
saldos AS (SELECT * FROM fs UNION ALL SELECT * FROM arp),
cartera AS (
  SELECT d.*, s.saldo, s.centro, casa, codeudor
  FROM documentos d LEFT JOIN saldos s ON s.factura = d.documento
  LEFT JOIN casas c ON c.factura = d.documento
  LEFT JOIN codeudores k ON k.cedula = d.{client}),
base AS (
  SELECT * EXCLUDE (saldo), CASE WHEN documento = 'Mas de una cartera' THEN 0 ELSE coalesce(saldo, 0) END AS saldo
  FROM cartera),
aplicado AS (
  SELECT *, saldo - valor <= 0 AS total,
         CASE WHEN saldo - valor <= 0 AND saldo <> 0 THEN saldo ELSE valor END AS aplicar
  FROM base),
novedades AS (
  SELECT *,
         CASE WHEN total THEN 'pago total'
              ELSE regexp_replace(CAST(CAST(saldo - valor AS DECIMAL(18,2)) AS VARCHAR), '0$', '') END AS validacion,
         CASE WHEN valor - saldo > 0 AND valor - saldo <= 10000 THEN valor - saldo ELSE 0 END AS aprovecha,
         CASE WHEN valor - aplicar >= 10000 THEN valor - aplicar ELSE 0 END AS anticipo,
         coalesce(estado, 'NO') AS empleado, coalesce(casa, 'SIN CASA DE COBRANZA') AS casa_n,
         coalesce(codeudor, 'SIN CODEUDOR') AS codeudor_n,
         CASE WHEN casa IS NOT NULL THEN casa WHEN codeudor IS NOT NULL THEN 'Codeudor:' || codeudor
              WHEN total THEN 'Pago total' ELSE 'Sin novedad' END AS novedad,
         CASE WHEN documento <> 'SIN CARTERA' AND documento LIKE 'DF%' THEN 'Finansueños'
              WHEN documento <> 'SIN CARTERA' THEN 'Arpesod'
              WHEN codeudor LIKE 'DF%' THEN 'Finansueños' WHEN codeudor IS NOT NULL THEN 'Arpesod'
              ELSE '' END AS empresa_n
  FROM aplicado)"""


BANK_PAYMENTS = """
  SELECT o_orderkey AS no, dia AS fecha, o_orderpriority AS d1, o_orderstatus AS d2, cedula AS ref1,
         cedula || '.5' AS ref2, valor FROM ord"""
BANK_COLUMNS = "no, fecha, d1, d2, ref1, ref2, valor"
BANK_SQL = portfolio_sql(BANK_PAYMENTS, "ref1", BANK_COLUMNS)

CASH_PAYMENTS = """
  SELECT DISTINCT year(dia) AS no, cedula AS ident,
         CAST(floor(valor / 100000) * 100000 AS DECIMAL(18,2)) AS valor, o_orderstatus AS aut,
         date_trunc('year', dia) AS fecha FROM ord"""
CASH_COLUMNS = "no, ident, valor, aut, fecha"
CASH_SQL = portfolio_sql(CASH_PAYMENTS.replace("DISTINCT ", ""), "ident", CASH_COLUMNS)


def _resolved(spark: SparkSession, d: str) -> DataFrame:
    t = payment_tables(spark, d)
    return payments.resolve_portfolio(
        t[BANK.table].drop(*ORDER), BANK.client, lender_a=t["AC ARP"], lender_b=t["AC FS"],
        employees=t["EMPLEADOS ACTUALES"], agencies=t["CASA DE COBRANZA"],
        guarantors=t["CODEUDORES"], order=ORDER)


@query("resolve_portfolio", f"""
WITH {BANK_SQL}
SELECT no AS "No", documento AS "FACTURA FINAL", n_fs AS "CANTIDAD CUENTAS FS", n_arp AS "CANTIDAD CUENTAS ARP",
       CAST(CASE WHEN documento = 'Mas de una cartera' THEN NULL ELSE saldo END AS DOUBLE) AS "SALDOS",
       centro AS "CENTRO COSTO", casa AS "CASA COBRANZA", codeudor AS "CODEUDOR", estado AS "ESTADO_EMPLEADO"
FROM cartera""")
def q_resolve_portfolio(spark: SparkSession, d: str) -> DataFrame:
    return shown(_resolved(spark, d).select(
        "No", "FACTURA FINAL", "CANTIDAD CUENTAS FS", "CANTIDAD CUENTAS ARP", "SALDOS",
        "CENTRO COSTO", "CASA COBRANZA", "CODEUDOR", "ESTADO_EMPLEADO"))


@query("unified_balances", f"""
WITH {ORDERS}
SELECT credito AS "FACTURA FINAL", o_totalprice AS "SALDOS", o_orderpriority AS "CENTRO COSTO" FROM ord""")
def q_unified_balances(spark: SparkSession, d: str) -> DataFrame:
    t = payment_tables(spark, d)
    return shown(payments.document_balances(t["AC ARP"], t["AC FS"], order=ORDER))


_APPLY_ROWS = """
FROM (SELECT o_orderkey, o_orderpriority, valor, suma AS saldo,
             CASE WHEN o_orderpriority = '5-LOW' THEN 'Mas de una cartera' ELSE credito END AS documento
      FROM ord LEFT JOIN (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS suma
                          FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)"""


def _apply_rows(spark: SparkSession, d: str) -> DataFrame:
    """Payments against the sum of the order's lines."""
    sums = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("SALDOS"))
    return orders(spark, d).join(sums, "o_orderkey", "left").select(
        "o_orderkey", "o_orderpriority", F.col("valor").alias("Valor"), "SALDOS",
        F.when(F.col("o_orderpriority") == "5-LOW", "Mas de una cartera")
        .otherwise(F.col("Credito")).alias("FACTURA FINAL"))


@query("apply_payment", f"""
WITH {ORDERS},
p AS (SELECT * EXCLUDE (saldo), CASE WHEN documento = 'Mas de una cartera' THEN 0 ELSE coalesce(saldo, 0) END AS saldo
      {_APPLY_ROWS}),
a AS (SELECT *, CASE WHEN saldo <= valor AND saldo <> 0 THEN saldo ELSE valor END AS aplicar FROM p)
SELECT o_orderkey, CAST(saldo AS DOUBLE) AS "SALDOS", CAST(aplicar AS DOUBLE) AS "Valor Aplicar",
       CASE WHEN saldo <= valor THEN 'pago total' ELSE
         regexp_replace(CAST(CAST(saldo - valor AS DECIMAL(18,2)) AS VARCHAR), '0$', '') END AS "VALIDACION ULTIMO SALDO",
       CAST(CASE WHEN valor - saldo > 0 AND valor - saldo <= 10000 THEN valor - saldo ELSE 0 END AS DOUBLE)
         AS "Valor Aprovechamientos",
       CAST(CASE WHEN valor - aplicar >= 10000 THEN valor - aplicar ELSE 0 END AS DOUBLE) AS "Valor Anticipos"
FROM a""")
def q_apply_payment(spark: SparkSession, d: str) -> DataFrame:
    done = payments.apply_payment(_apply_rows(spark, d))
    return shown(done.select("o_orderkey", "SALDOS", "Valor Aplicar", "VALIDACION ULTIMO SALDO",
                             "Valor Aprovechamientos", "Valor Anticipos"))


_NOVELTY_COLUMNS = """
SELECT no AS "No", novedad AS "Novedad", empleado AS "EMPLEADO", casa_n AS "CASA COBRANZA",
       codeudor_n AS "CODEUDOR" FROM novedades"""


@query("classify_novelty", f"WITH {BANK_SQL} {_NOVELTY_COLUMNS}")
def q_classify_novelty(spark: SparkSession, d: str) -> DataFrame:
    done = payments.classify_novelty(payments.apply_payment(_resolved(spark, d)))
    return done.select("No", "Novedad", "EMPLEADO", "CASA COBRANZA", "CODEUDOR")


@query("document_lender", f"""
WITH {BANK_SQL} SELECT no AS "No", documento, codeudor_n AS codeudor, empresa_n AS "Empresa" FROM novedades""")
def q_document_lender(spark: SparkSession, d: str) -> DataFrame:
    done = payments.lender_of_document(
        payments.classify_novelty(payments.apply_payment(_resolved(spark, d))))
    return done.select("No", F.col("FACTURA FINAL").alias("documento"),
                       F.col("CODEUDOR").alias("codeudor"), "Empresa")


_PUBLISHED = """documento AS "Documento Cartera", centro AS "C. Costo", empresa_n AS "Empresa",
       CAST(aplicar AS DOUBLE) AS "Valor Aplicar", CAST(anticipo AS DOUBLE) AS "Valor Anticipos",
       CAST(aprovecha AS DOUBLE) AS "Valor Aprovechamientos", casa_n AS "Casa cobranza", empleado AS "Empleado",
       novedad AS "Novedad", n_arp AS "Cuentas ARP", n_fs AS "Cuentas FS", CAST(saldo AS DOUBLE) AS "SALDOS",
       validacion AS "VALIDACION ULTIMO SALDO", CAST(valor AS DOUBLE) AS "Valor",
       strftime(fecha, '%d/%m/%Y') AS "Fecha" """


@query("collections_bank", f"""
WITH {BANK_SQL}
SELECT no AS "No.", d1 AS "Detalle 1", d2 AS "Detalle 2", ref1 AS "Referencia 1", ref1 AS "Referencia 2",
       {_PUBLISHED} FROM novedades""")
def q_collections_bank(spark: SparkSession, d: str) -> DataFrame:
    done = collections(payment_tables(spark, d), BANK, order=ORDER)
    return shown(payments.format_payments(done, BANK.order))


@query("collections_cash", f"""
WITH {CASH_SQL}
SELECT no AS "No", ident AS "Identificación", aut AS "N° de Autorización", {_PUBLISHED} FROM novedades""")
def q_collections_cash(spark: SparkSession, d: str) -> DataFrame:
    done = collections(payment_tables(spark, d), CASH, order=ORDER)
    return shown(payments.format_payments(done, CASH.order))


@query("payment_dedupe", """
SELECT DISTINCT o_custkey, year(o_orderdate) AS anio, o_orderstatus FROM orders""")
def q_payment_dedupe(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_custkey", F.year("o_orderdate").cast("bigint").alias("anio"),
                                            "o_orderstatus")
    return payments.distinct_payments(rows)


@query("format_payments", f"""
WITH {ORDERS}
SELECT o_orderkey AS "No.", strftime(dia, '%d/%m/%Y') AS "Fecha", o_orderpriority AS "Detalle 1",
       CAST(NULL AS VARCHAR) AS "Detalle 2", cedula AS "Referencia 1", o_orderstatus AS "Referencia 2",
       o_totalprice AS "Valor", credito AS "Documento Cartera",
       {", ".join(f'CAST(NULL AS VARCHAR) AS "{c}"' for c in payments.BANK_ORDER[8:])}
FROM ord""")
def q_format_payments(spark: SparkSession, d: str) -> DataFrame:
    rows = orders(spark, d).select(
        F.col("o_orderkey").alias("No"), F.col("dia").alias("Fecha"),
        F.col("o_orderpriority").alias("Detalle 1"),
        F.concat("Cedula_Cliente", F.lit(".0")).alias("Referencia 1"),
        F.col("o_orderstatus").alias("Referencia 2"), F.col("valor").alias("Valor"),
        F.col("Credito").alias("FACTURA FINAL"))
    return shown(payments.format_payments(rows, payments.BANK_ORDER))


@query("flag_payments", f"""
WITH {BANK_SQL}
SELECT no AS "No", codeudor_n AS "CODEUDOR",
       CASE WHEN upper(trim(empleado)) = 'SI' THEN 'empleado'
            WHEN documento <> 'SIN CARTERA' AND count(*) OVER (PARTITION BY documento) > 1 THEN 'documento repetido'
            WHEN n_arp >= 2 OR n_fs >= 2 OR (n_arp >= 1 AND n_fs >= 1) THEN 'varias carteras' ELSE '' END AS marca
FROM novedades""")
def q_flag_payments(spark: SparkSession, d: str) -> DataFrame:
    done = written(collections(payment_tables(spark, d), BANK, order=ORDER))
    return flags.flag_payments(done).select("No", "CODEUDOR", "marca")


@query("agency_dedupe", f"""
WITH {ORDERS}
SELECT credito AS "FACTURA", c_mktsegment AS "CASA COBRANZA"
FROM ord JOIN customer ON o_custkey = c_custkey WHERE c_acctbal < 2000""")
def q_agency_dedupe(spark: SparkSession, d: str) -> DataFrame:
    agencies = payment_tables(spark, d)["CASA DE COBRANZA"]
    return first_per_key(agencies, ["FACTURA"], ORDER, keep=["CASA COBRANZA"])


# ---------------------------------------------------------------------------------------------
# Advances
# ---------------------------------------------------------------------------------------------


def advance_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    o = orders(spark, d)

    def accounts(lender: str, end: str) -> DataFrame:
        return _accounts(o, lender).select(
            F.col("CENTRO_COSTO").alias(f"ZONA_COBRADOR_{end}"),
            F.col("CENTRO_COSTO").alias(f"CENTRO_COSTO_{end}"),
            F.col("FACTURA").alias(f"FACTURA_{end}"), "CEDULA",
            F.col("SALDO").alias(f"ULTIMO_SALDO_{end}"))

    return {
        "ONLINE": o.select(
            F.col("o_orderpriority").alias("TIPO_RECIBO"), F.col("o_orderkey").alias("No"),
            F.concat(F.lit(" "), "Cedula_Cliente").alias("CEDULA"),
            F.col("Credito").alias("NOMBRE"), (-F.col("valor")).alias("VALOR")),
        "AC FS": accounts("FINANSUEÑOS", "FS"),
        "AC ARP": accounts("ARPESOD", "ARP"),
    }


ADVANCE_SQL = f"""
{ORDERS},
fs AS (SELECT cedula, credito AS factura, valor AS saldo, o_orderpriority AS centro
       FROM ord WHERE tipo = 'DF'),
arp AS (SELECT cedula, credito AS factura, valor AS saldo, o_orderpriority AS centro
       FROM ord WHERE tipo <> 'DF'),
cruce AS (
  SELECT o_orderpriority, o_orderkey, o.cedula, credito, o.valor,
         coalesce(x.n, 0) AS n_fs, coalesce(y.n, 0) AS n_arp,
         fs.factura AS f_fs, fs.saldo AS s_fs, fs.centro AS c_fs,
         arp.factura AS f_arp, arp.saldo AS s_arp, arp.centro AS c_arp,
         coalesce(fs.saldo - o.valor, arp.saldo - o.valor) AS resta
  FROM ord o LEFT JOIN fs ON fs.cedula = o.cedula LEFT JOIN arp ON arp.cedula = o.cedula
  LEFT JOIN (SELECT cedula, count(*) AS n FROM fs GROUP BY 1) x ON x.cedula = o.cedula
  LEFT JOIN (SELECT cedula, count(*) AS n FROM arp GROUP BY 1) y ON y.cedula = o.cedula),
anticipos AS (
  SELECT * REPLACE (CASE WHEN obs = 'REVISAR TIENE 2 CARTERAS' THEN 'MAS DE UNA CARTERA' ELSE f_fs END AS f_fs,
                    CASE WHEN obs = 'REVISAR TIENE 2 CARTERAS' THEN 'MAS DE UNA CARTERA' ELSE f_arp END AS f_arp)
  FROM (SELECT *, CASE WHEN f_fs IS NOT NULL AND f_arp IS NOT NULL THEN 'REVISAR TIENE 2 CARTERAS'
                       WHEN resta <= 0 THEN 'PAGO TOTAL' WHEN f_fs IS NOT NULL THEN 'CARTERA EN FINANSUEÑOS'
                       WHEN f_arp IS NOT NULL THEN 'CARTERA EN ARPESOD' ELSE 'REVISAR SI ES CODEUDOR' END AS obs
        FROM cruce))"""

_ADVANCE_BASE = """o_orderpriority AS "TIPO_RECIBO", o_orderkey AS "No", cedula AS "CEDULA",
       credito AS "NOMBRE", CAST(-valor AS DOUBLE) AS "VALOR" """


def _advance_sql(end: str) -> str:
    e = end.lower()
    return f"""
WITH {ADVANCE_SQL}
SELECT CAST(NULL AS VARCHAR) AS "ITEM", {_ADVANCE_BASE}, c_{e} AS "CENTRO_COSTO_{end}", f_{e} AS "FACTURA_{end}",
       c_{e} AS "ZONA_COBRADOR_{end}", obs AS "OBSERVACIONES", n_{e} AS "CUENTAS_{end}",
       CAST(s_{e} AS DOUBLE) AS "ULTIMO_SALDO_{end}", CAST(valor AS DOUBLE) AS "VALOR_POSITIVO",
       CAST(resta AS DOUBLE) AS "RESTA_SALDO"
FROM anticipos WHERE f_{e} IS NOT NULL"""


def _split(spark: SparkSession, d: str, name: str) -> DataFrame:
    return adv.split_advances(advances(advance_tables(spark, d)))[name]


@query("classify_advance", f"""
WITH {ADVANCE_SQL}
SELECT {_ADVANCE_BASE}, obs AS "OBSERVACIONES", f_fs AS "FACTURA_FS", f_arp AS "FACTURA_ARP",
       CAST(resta AS DOUBLE) AS "RESTA_SALDO", n_fs AS "CUENTAS_FS", n_arp AS "CUENTAS_ARP",
       CAST(s_fs AS DOUBLE) AS "ULTIMO_SALDO_FS", CAST(s_arp AS DOUBLE) AS "ULTIMO_SALDO_ARP"
FROM anticipos""")
def q_classify_advance(spark: SparkSession, d: str) -> DataFrame:
    done = advances(advance_tables(spark, d))
    return shown(done.select(*adv.ONLINE_COLUMNS, "OBSERVACIONES", "FACTURA_FS", "FACTURA_ARP",
                             "RESTA_SALDO", "CUENTAS_FS", "CUENTAS_ARP", "ULTIMO_SALDO_FS",
                             "ULTIMO_SALDO_ARP"))


@query("split_advances_b", _advance_sql("FS"))
def q_split_advances_b(spark: SparkSession, d: str) -> DataFrame:
    return shown(_split(spark, d, "FINANSUEÑOS"))


@query("split_advances_a", _advance_sql("ARP"))
def q_split_advances_a(spark: SparkSession, d: str) -> DataFrame:
    return shown(_split(spark, d, "ARPESOD"))


@query("split_advances_none", f"""
WITH {ADVANCE_SQL}
SELECT {_ADVANCE_BASE}, n_fs AS "CUENTAS_FS", n_arp AS "CUENTAS_ARP", obs AS "OBSERVACIONES"
FROM anticipos WHERE f_fs IS NULL AND f_arp IS NULL""")
def q_split_advances_none(spark: SparkSession, d: str) -> DataFrame:
    return shown(_split(spark, d, "SIN CARTERA"))


@query("advances_all", f"""
WITH {ADVANCE_SQL},
hojas AS (SELECT 'FINANSUEÑOS' AS hoja, * FROM anticipos WHERE f_fs IS NOT NULL
          UNION ALL SELECT 'ARPESOD', * FROM anticipos WHERE f_arp IS NOT NULL
          UNION ALL SELECT 'SIN CARTERA', * FROM anticipos WHERE f_fs IS NULL AND f_arp IS NULL)
SELECT hoja, obs AS "OBSERVACIONES", count(*) AS n, CAST(sum(-valor) AS DOUBLE) AS total FROM hojas GROUP BY ALL""")
def q_advances_all(spark: SparkSession, d: str) -> DataFrame:
    parts = adv.split_advances(advances(advance_tables(spark, d)))
    rows = [t.select(F.lit(name).alias("hoja"), "OBSERVACIONES", "VALOR") for name, t in parts.items()]
    every = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return shown(every.groupBy("hoja", "OBSERVACIONES").agg(
        F.count(F.lit(1)).alias("n"), F.sum("VALOR").alias("total")))


@query("flag_advances", f"""
WITH {ADVANCE_SQL}
SELECT o_orderkey AS "No", f_fs AS "FACTURA_FS", CAST(s_fs AS DOUBLE) AS saldo,
       CASE obs WHEN 'REVISAR TIENE 2 CARTERAS' THEN 'dos carteras' WHEN 'PAGO TOTAL' THEN 'pago total' ELSE '' END
         AS marca,
       CASE WHEN count(*) OVER (PARTITION BY cedula) > 1 THEN 1 ELSE 0 END AS cliente,
       CASE WHEN count(*) OVER (PARTITION BY f_fs) > 1 THEN 1 ELSE 0 END AS factura
FROM anticipos WHERE f_fs IS NOT NULL""")
def q_flag_advances(spark: SparkSession, d: str) -> DataFrame:
    done = _split(spark, d, "FINANSUEÑOS")
    return shown(flags.flag_advances(done).select(
        "No", "FACTURA_FS", F.col("ULTIMO_SALDO_FS").alias("saldo"), "marca",
        F.col("CEDULA_repetida").alias("cliente"), F.col("FACTURA_FS_repetida").alias("factura")))
