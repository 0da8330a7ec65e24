"""Queries on the keyed building blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.functions.text import account_key
from ledgerspark.operators import bureau, keyed

from .extracts import LINE_ORDER
from .registry import query, shown, table

_ORDER_BY = "l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice"


def _money_lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem")


def _dedupe_sql(way: str) -> str:
    order = ", ".join(f"{c} {way}" for c in LINE_ORDER)
    return f"""
SELECT l_orderkey, l_partkey, l_extendedprice, strftime(l_shipdate, '%Y-%m-%d') AS dia
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {order}) AS rn FROM lineitem)
WHERE rn = 1"""


@query("dedupe_first", _dedupe_sql("ASC"))
def q_dedupe_first(spark: SparkSession, d: str) -> DataFrame:
    one = keyed.first_per_key(_money_lines(spark, d), ["l_orderkey"], LINE_ORDER,
                              keep=["l_partkey", "l_extendedprice", "l_shipdate"])
    return shown(one.withColumn("dia", F.to_date("l_shipdate")).drop("l_shipdate"))


@query("dedupe_last", _dedupe_sql("DESC"))
def q_dedupe_last(spark: SparkSession, d: str) -> DataFrame:
    one = keyed.last_per_key(_money_lines(spark, d), ["l_orderkey"], LINE_ORDER,
                             keep=["l_partkey", "l_extendedprice", "l_shipdate"])
    return shown(one.withColumn("dia", F.to_date("l_shipdate")).drop("l_shipdate"))


@query("dup_flag", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       CASE WHEN count(*) OVER (PARTITION BY l_partkey, l_suppkey) > 1 THEN 1 ELSE 0 END AS repetida
FROM lineitem""")
def q_dup_flag(spark: SparkSession, d: str) -> DataFrame:
    pair = F.concat_ws("-", "l_partkey", "l_suppkey")
    flagged = keyed.flag_repeats(_money_lines(spark, d).withColumn("par", pair), "par", "repetida")
    return shown(flagged.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "repetida"))


@query("count_by_key", """
SELECT c_custkey, coalesce(n, 0) AS cuentas
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""")
def q_count_by_key(spark: SparkSession, d: str) -> DataFrame:
    pending = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    counted = keyed.lookup(table(spark, d, "customer").select("c_custkey"),
                           keyed.count_per_key(pending, ["c_custkey"], "n"), ["c_custkey"])
    return counted.select("c_custkey", F.coalesce("n", F.lit(0)).alias("cuentas"))


@query("sum_by_key", """
SELECT l_orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
       CAST(sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS total_a
FROM lineitem GROUP BY l_orderkey""")
def q_sum_by_key(spark: SparkSession, d: str) -> DataFrame:
    amount = F.col("l_extendedprice").cast("decimal(18,2)")
    return shown(keyed.sum_per_key(_money_lines(spark, d), ["l_orderkey"], {
        "total": amount, "total_a": F.when(F.col("l_returnflag") == "A", amount)}))


@query("membership_flag", """
SELECT o_orderkey, o_custkey, CASE WHEN o_custkey IN
       (SELECT c_custkey FROM customer WHERE c_acctbal > 0) THEN 1 ELSE 0 END AS activo
FROM orders""")
def q_membership(spark: SparkSession, d: str) -> DataFrame:
    active = table(spark, d, "customer").where("c_acctbal > 0").select(
        F.col("c_custkey").alias("o_custkey"))
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return shown(keyed.membership(o, "o_custkey", active, "activo"))


@query("replace_if_present", """
SELECT o_orderkey, coalesce(c_name, CAST(o_custkey AS VARCHAR)) AS cliente
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') ON o_custkey = c_custkey""")
def q_replace(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").cast("string").alias("cliente"), "c_name")
    o = table(spark, d, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("cliente"))
    return keyed.replace_if_present(o, "cliente", known, "c_name")


@query("null_key_join", """
SELECT o.o_orderkey, o.k, c.n
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS k FROM orders) o
LEFT JOIN (SELECT CASE WHEN c_acctbal >= 0 THEN c_custkey END AS k, count(*) AS n
           FROM customer GROUP BY 1) c ON o.k IS NOT DISTINCT FROM c.k""")
def q_null_key_join(spark: SparkSession, d: str) -> DataFrame:
    left = table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k"))
    right = table(spark, d, "customer").groupBy(
        F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("k")
    ).agg(F.count(F.lit(1)).alias("n"))
    return keyed.null_safe_lookup(left, right, "k")


@query("coalesce_lookup", """
SELECT o_orderkey, coalesce(saldo, o_totalprice) AS valor
FROM orders LEFT JOIN (SELECT l_orderkey, CAST(max(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS saldo
                       FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) ON l_orderkey = o_orderkey""")
def q_coalesce_lookup(spark: SparkSession, d: str) -> DataFrame:
    amounts = table(spark, d, "lineitem").where("l_returnflag = 'R'").groupBy(
        F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_extendedprice").alias("saldo"))
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return keyed.lookup(o, amounts, ["o_orderkey"]).select(
        "o_orderkey", F.coalesce("saldo", "o_totalprice").alias("valor"))


@query("opening_value_variants", """
WITH base AS (
  SELECT replace(o_orderpriority, ' ', '') || o_custkey AS k, o_orderkey AS ord,
         CAST(trunc(o_totalprice / 1000) AS BIGINT) AS v FROM orders),
variantes AS (
  SELECT k AS cuenta, 0 AS pos, ord, v FROM base UNION ALL
  SELECT k || 'C1', 1, ord, v FROM base UNION ALL
  SELECT k || 'C2', 2, ord, v FROM base),
ultima AS (SELECT cuenta, v FROM (SELECT *, row_number() OVER
             (PARTITION BY cuenta ORDER BY pos DESC, ord DESC) AS rn FROM variantes) WHERE rn = 1)
SELECT c.cuenta, v AS apertura
FROM (SELECT '1-URGENT' || c_custkey || CASE WHEN c_acctbal < 0 THEN 'C1' WHEN c_acctbal < 5000 THEN 'C2'
             ELSE '' END AS cuenta FROM customer) c LEFT JOIN ultima u ON u.cuenta = c.cuenta""")
def q_opening_variants(spark: SparkSession, d: str) -> DataFrame:
    opening = table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("kind"), F.col("o_custkey").cast("string").alias("number"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"), F.col("o_orderkey").alias("_ord"))
    suffix = F.when(F.col("c_acctbal") < 0, "C1").when(F.col("c_acctbal") < 5000, "C2").otherwise("")
    accounts = table(spark, d, "customer").select(
        F.concat(account_key(F.lit("1-URGENT"), "c_custkey"), suffix).alias("account"))
    return keyed.lookup(accounts, bureau.opening_values(opening), ["account"]).select(
        F.col("account").alias("cuenta"), F.col("opening").alias("apertura"))


@query("payments_received", """
WITH sumas AS (
  SELECT l_returnflag || l_orderkey AS k,
         CAST(trunc(sum(CAST(l_extendedprice AS DECIMAL(18,2))) / 1000) AS BIGINT) AS v
  FROM lineitem GROUP BY 1),
variantes AS (SELECT k || s AS cuenta, v FROM sumas, (VALUES (''), ('C1'), ('C2')) t(s))
SELECT c.cuenta, coalesce(v, 0) AS abonos
FROM (SELECT 'R' || o_orderkey || CASE o_orderstatus WHEN 'P' THEN 'C1' WHEN 'F' THEN 'C2' ELSE '' END AS cuenta
      FROM orders) c LEFT JOIN variantes v ON v.cuenta = c.cuenta""")
def q_payments_received(spark: SparkSession, d: str) -> DataFrame:
    paid = table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("kind"), F.col("l_orderkey").cast("string").alias("number"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"))
    suffix = (F.when(F.col("o_orderstatus") == "P", "C1")
              .when(F.col("o_orderstatus") == "F", "C2").otherwise(""))
    accounts = table(spark, d, "orders").select(
        F.concat(account_key(F.lit("R"), "o_orderkey"), suffix).alias("account"))
    return keyed.lookup(accounts, bureau.payments_received(paid), ["account"]).select(
        F.col("account").alias("cuenta"), F.coalesce("paid", F.lit(0)).alias("abonos"))
