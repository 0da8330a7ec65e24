"""The test tables in the shape of the jobs' inputs, as DataFrames and as SQL.

A credit is an order: its type follows the priority, its number is the order key, its client
the customer. Installments, items and balance concepts are lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.functions.numbers import credit_key

from .registry import table

AS_OF = "1998-06-15"
LINE_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def kind_of_order() -> Column:
    return (
        F.when(F.col("o_orderpriority") == "1-URGENT", "DF")
        .when(F.col("o_orderpriority") == "2-HIGH", "FA")
        .otherwise("CR")
    )


def orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders with type, credit key, client, day and amount."""
    return table(spark, d, "orders").select(
        "*",
        kind_of_order().alias("Tipo_Credito"),
        F.col("o_orderkey").alias("Numero_Credito"),
        credit_key(kind_of_order(), "o_orderkey").alias("Credito"),
        F.col("o_custkey").cast("string").alias("Cedula_Cliente"),
        F.to_date("o_orderdate").alias("dia"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("valor"),
        F.when(kind_of_order() == "DF", "FINANSUEÑOS").otherwise("ARPESOD").alias("Empresa"),
    )


ORDERS = """
ord AS (
  SELECT *, tipo || '-' || o_orderkey AS credito,
         CASE WHEN tipo = 'DF' THEN 'FINANSUEÑOS' ELSE 'ARPESOD' END AS empresa
  FROM (SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN 'DF' WHEN '2-HIGH' THEN 'FA'
                       ELSE 'CR' END AS tipo,
               CAST(o_custkey AS VARCHAR) AS cedula, CAST(o_orderdate AS DATE) AS dia,
               CAST(o_totalprice AS DECIMAL(18,2)) AS valor
        FROM orders))"""


def lines(spark: SparkSession, d: str, o: DataFrame | None = None) -> DataFrame:
    """Lines with the credit key of their order."""
    keys = (orders(spark, d) if o is None else o).select("o_orderkey", "Credito", "Cedula_Cliente", "dia")
    return table(spark, d, "lineitem").join(keys, F.col("l_orderkey") == F.col("o_orderkey")).drop(
        "o_orderkey")


LINES = """
lin AS (
  SELECT l.*, o.credito, o.cedula, o.dia,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS importe
  FROM lineitem l JOIN ord o ON l.l_orderkey = o.o_orderkey)"""


def installments(spark: SparkSession, d: str) -> DataFrame:
    return installments_of(lines(spark, d))


def installments_of(rows: DataFrame) -> DataFrame:
    return rows.select(
        "Credito",
        F.to_date("l_shipdate").alias("Fecha_Cuota_Vigente"),
        F.col("l_linenumber").cast("bigint").alias("Cuota_Vigente"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("Valor_Cuota_Vigente"),
        *LINE_ORDER[1:],
    )


def sales(spark: SparkSession, d: str) -> DataFrame:
    """Sales documents, one row per item."""
    return sales_of(lines(spark, d), table(spark, d, "part"))


def sales_of(rows: DataFrame, part: DataFrame) -> DataFrame:
    parts = part.select("p_partkey", "p_name")
    return rows.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        "Credito",
        "Cedula_Cliente",
        F.concat(F.lit("c"), "Cedula_Cliente", F.lit("@mail.co")).alias("Correo"),
        F.col("dia").alias("Fecha_Facturada"),
        F.col("p_name").alias("Nombre_Producto"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("Total_Venta"),
        F.col("l_quantity").cast("decimal(18,2)").alias("Cantidad_Item"),
        *LINE_ORDER,
    )


SALES = """
ventas AS (
  SELECT credito, cedula, dia, p_name, importe, CAST(l_quantity AS DECIMAL(18,2)) AS cantidad,
         row_number() OVER (PARTITION BY credito ORDER BY l_shipdate, l_linenumber, l_partkey,
                            l_suppkey, l_extendedprice) AS pos,
         row_number() OVER (ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey,
                            l_extendedprice) AS fila,
         l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice
  FROM lin JOIN part ON l_partkey = p_partkey)"""


def accounts(spark: SparkSession, d: str, status: str) -> DataFrame:
    """Accounts of a lender: the lines of one status, of the order's customer."""
    return (
        lines(spark, d).where(F.col("l_linestatus") == status).select(
            F.col("Cedula_Cliente").alias("CEDULA"),
            F.concat("Credito", F.lit("/"), "l_linenumber").alias("FACTURA"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("SALDO"),
            F.col("l_returnflag").alias("CENTRO_COSTO"),
            "l_orderkey", *LINE_ORDER, "l_quantity",
        )
    )


ACCOUNT_ORDER = ["l_orderkey", *LINE_ORDER, "l_quantity"]
