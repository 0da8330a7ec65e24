"""Heavy keys: found, bounded, cut, and without effect on results."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import advances, invoices, items, keyed


def skewed(spark, rows=3000):
    """A third of the rows under one key, a few without a key."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit("hot")).when(n % 50 == 1, F.lit(None)).otherwise(
        F.concat(F.lit("k"), (n % 97).cast("string")))
    return spark.range(rows).select(n, key.alias("key"))


def dealt(df):
    """Rows per task of the last stage, without merging or splitting tasks."""
    return [r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect()]


@pytest.fixture
def plain_tasks(spark):
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false",
                          "spark.sql.shuffle.partitions": "8"}):
        yield


@contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_heavy_keys_and_their_parts(spark, monkeypatch):
    monkeypatch.setattr(keyed, "HEAVY_ROWS", 400)
    found = keyed.heavy_keys(keyed.row_counts(skewed(spark), ["key"]), ["key"])
    assert [(r.key, r._parts) for r in found.collect()] == [("hot", [3])]


def test_both_sides_of_a_heavy_key_are_cut(spark, monkeypatch):
    monkeypatch.setattr(keyed, "HEAVY_ROWS", 100)
    left = spark.createDataFrame([("a", 50), ("b", 2), ("c", 3), ("d", 1)], "key string, _rows long")
    right = spark.createDataFrame([("a", 5000), ("b", 1000), ("c", 3), ("e", 9999)], "key string, _rows long")
    found = {r.key: r._parts for r in keyed.heavy_keys(left, ["key"], [right]).collect()}
    assert found == {"a": [5, 500], "b": [1, 20]}


def test_heavy_list_is_bounded_by_the_share(spark, monkeypatch):
    monkeypatch.setattr(keyed, "HEAVY_ROWS", 1)
    monkeypatch.setattr(keyed, "HEAVY_SHARE", 0.1)
    assert keyed.heavy_keys(keyed.row_counts(skewed(spark), ["key"]), ["key"]).count() <= 10


@pytest.mark.parametrize("rows", [None, ["id"]])
def test_spread_join_equals_plain_join(spark, spread, rows):
    left = skewed(spark)
    right = left.dropna().select("key").distinct().withColumn("v", F.length("key"))
    more = left.dropna().select("key").distinct().withColumn("w", F.upper("key"))
    got = keyed.spread_join(left, [right, more], ["key"], rows=rows)
    want = left.join(right, "key", "left").join(more, "key", "left").select(*got.columns)
    assert got.count() == 3000
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("how", ["left", "inner"])
def test_fan_out_of_several_tables_with_equal_rows(spark, spread, how):
    """Equal rows on every side, a key that only one table has, keys that none has."""
    n = F.col("id")
    left = skewed(spark, 90).select("key", (n % 3).alias("a"))
    one = skewed(spark, 60).dropna().select("key", (n % 2).alias("b"))
    two = skewed(spark, 40).where("key <> 'k1'").select("key", (n % 5).alias("c"))
    only = left.dropna().select("key").distinct().where("key <> 'k7'").withColumn("v", F.length("key"))
    got = keyed.spread_join(left, only, ["key"], many=[one, two], how=how)
    want = left.join(only, "key", how).join(one, "key", how).join(two, "key", how).select(*got.columns)
    assert got.count() == want.count() > 1000
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_collapsed_rows_come_back(spark, spread):
    df = skewed(spark, 50).select("key")
    packed = keyed.collapsed(df)
    assert packed.agg(F.max("_times")).first()[0] <= 2
    back = keyed.expanded(packed)
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()


def test_a_client_with_a_million_accounts_is_dealt_to_all_tasks(spark, plain_tasks):
    online = spark.range(40).select(
        F.lit("R").alias("TIPO_RECIBO"), F.col("id").alias("No"),
        F.when(F.col("id") < 2, "hot").otherwise(F.col("id").cast("string")).alias("CEDULA"),
        F.lit("n").alias("NOMBRE"), F.lit(-5).cast("decimal(18,2)").alias("VALOR"))

    def accounts(n, end):
        return spark.range(n).select(
            F.lit("z").alias(f"ZONA_COBRADOR_{end}"), F.lit("c").alias(f"CENTRO_COSTO_{end}"),
            F.col("id").cast("string").alias(f"FACTURA_{end}"), F.lit("hot").alias("CEDULA"),
            F.lit(1).cast("decimal(18,2)").alias(f"ULTIMO_SALDO_{end}"))

    matched = advances.match_accounts(online, accounts(1, "ARP"), accounts(1_000_000, "FS"))
    per_task = dealt(matched)
    assert sum(per_task) == 2_000_038
    assert len(per_task) == 8 and max(per_task) <= 2 * sum(per_task) / 8


def test_a_million_equal_rows_are_dealt_to_all_tasks(spark, plain_tasks):
    left = spark.range(1_000_000).select(F.lit("hot").alias("account"))
    right = spark.range(1000).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("account"),
        F.col("id").alias("opening"))
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        per_task = dealt(keyed.lookup(left, right, ["account"]))
    assert sum(per_task) == 1_000_000
    assert len(per_task) == 8 and max(per_task) <= 2 * sum(per_task) / 8


def test_calendar_of_a_hot_client_has_one_row_per_day(spark):
    """Nearest document against brute force, with one client holding most of the documents."""
    n = F.col("id")
    sales = spark.range(600).select(
        F.concat(F.when(n % 4 == 0, "DF-").otherwise("FA-"), n.cast("string")).alias("Credito"),
        F.when(n % 3 < 2, "hot").otherwise((n % 7).cast("string")).alias("Cedula_Cliente"),
        F.date_add(F.lit("2024-01-01").cast("date"), ((n * 37) % 90).cast("int"))
        .alias("Fecha_Facturada"), n.alias("ord"))
    got = {r[0]: r[1] for r in invoices.invoice_of_credit(sales, days=2, order=["ord"]).collect()}
    rows = sales.collect()
    want = {}
    for c in rows:
        if not c.Credito.startswith("DF"):
            continue
        near = [(abs((f.Fecha_Facturada - c.Fecha_Facturada).days), f.ord, f.Credito) for f in rows
                if f.Cedula_Cliente == c.Cedula_Cliente and not f.Credito.startswith("DF")]
        near = [x for x in near if x[0] <= 2]
        if near:
            want[c.Credito] = min(near)[2]
    assert got == want and want


def test_names_are_reduced_before_they_are_listed(spark):
    sales = spark.range(20000).select(
        F.lit("FA-1").alias("Credito"), F.lit(7000).cast("decimal(18,2)").alias("Total_Venta"),
        F.lit(1).cast("decimal(18,2)").alias("Cantidad_Item"), (-F.col("id")).alias("ord"),
        F.concat(F.lit("n"), (F.col("id") % 3).cast("string")).alias("Nombre_Producto"))
    row = items.item_summary(sales, order=["ord"]).collect()[0]
    assert row.Nombre_Producto == "n1, n0, n2" and row.Cantidad_Producto == 20000
    assert row.Obsequio is None


def test_result_does_not_depend_on_partitions(spark):
    df = skewed(spark).withColumn("v", F.col("id") * 7 % 11)
    one = keyed.first_per_key(df.coalesce(1), ["key"], ["v", "id"]).orderBy("key").collect()
    many = keyed.first_per_key(df.repartition(8), ["key"], ["v", "id"]).orderBy("key").collect()
    assert one == many


def test_advances_are_flagged_from_one_row_of_each_kind(spark, monkeypatch):
    from ledgerspark.operators import flags

    rows = [("1", "DF-1", "PAGO TOTAL")] * 300 + [("1", "DF-2", "x"), ("2", None, "x"), (None, None, "x")]
    table = spark.createDataFrame(rows, "CEDULA string, FACTURA_FS string, OBSERVACIONES string")
    kept = []
    monkeypatch.setattr(flags, "written", lambda df: kept.append(df.localCheckpoint()) or kept[-1])
    done = flags.flag_advances(table)
    assert [t.count() for t in kept] == [4]
    got = sorted(done.groupBy("CEDULA", "FACTURA_FS", "CEDULA_repetida", "FACTURA_FS_repetida", "marca")
                 .count().collect(), key=str)
    assert sorted([("1", "DF-1", True, True, "pago total", 300), ("1", "DF-2", True, False, "", 1),
                   ("2", None, False, False, "", 1), (None, None, False, False, "", 1)], key=str) \
        == sorted((tuple(r) for r in got), key=str)


def test_sums_per_account_need_no_sort(spark):
    from ledgerspark.operators import bureau

    paid = spark.createDataFrame([("CR", "1", 5000), ("CR", "1", 2000), ("CR", "1C1", 9000), ("CR", "2", None)],
                                 "kind string, number string, amount int")
    done = bureau.payments_received(paid)
    assert "SortAggregate" not in done._jdf.queryExecution().toString()
    assert {r.account: r.paid for r in done.collect()} == {
        "CR1": 7, "CR1C1": 7, "CR1C2": 7, "CR1C1C1": 9, "CR1C1C2": 9, "CR2": 0, "CR2C1": 0, "CR2C2": 0}


def test_records_are_counted_once_for_both_keys(spark, monkeypatch):
    from ledgerspark.operators import bureau

    asked = []
    counts = bureau.row_counts_of
    monkeypatch.setattr(bureau, "row_counts_of", lambda df, *keys: asked.append(keys) or counts(df, *keys))
    c = "name string, address string, email string, phone string"
    some = lambda schema: spark.createDataFrame([], f"{schema}, _ord long")
    fixes = bureau.Corrections(some("bad string, good string"), some(f"id string, {c}"), some("id string, code int"),
                               *[some("kind string, number string, amount decimal(18,2)")] * 2, some("id string, full_name string"))
    names = bureau.B
    columns = [v for v in vars(names).values()]
    record = spark.createDataFrame([["7" if c == names.id_number else "CR 1" if c == names.account_number else "3"
                                     for c in columns]], columns)
    got = bureau.clean_bureau_b(record.unionByName(record), fixes).collect()
    assert asked == [([names.id_number], [names.account_number])]
    assert [(r[names.id_number], r[names.account_number].strip()) for r in got] == [("0" * 14 + "7", "CR1")] * 2
