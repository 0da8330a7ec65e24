"""Files in, files out."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerspark.plans import bureau as bureau_plan
from ledgerspark.plans.advances import run_advances
from ledgerspark.plans.collections import run_collections
from ledgerspark.plans.monthly_base import run_monthly_base
from ledgerspark.schemas import COLLECTIONS, LAYOUT_A, LAYOUT_B
from ledgerspark.sources import fixed_width, routing, sinks, tables


def lines_of(spark, path):
    return sorted(r.line for r in fixed_width.read_lines(spark, str(path)).collect())


def test_record_file(spark, tmp_path):
    name = "Peña “Ñ”"
    body = ["HEADER", f"a {name}", "", "   ", "b", "TRAILER"]
    (tmp_path / "crlf.txt").write_bytes("\r\n".join(body).encode("cp1252"))
    (tmp_path / "one.txt").write_bytes("HEADER\nonly\nTRAILER\n".encode("cp1252"))
    assert lines_of(spark, tmp_path) == [f"a {name}", "b", "only"]


def test_record_file_in_many_splits(spark, tmp_path):
    body = [f"{i:06d}" + "x" * 94 for i in range(5000)]
    (tmp_path / "big.txt").write_text("\n".join(["H", *body, "T"]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        got = fixed_width.read_lines(spark, str(tmp_path))
        assert got.rdd.getNumPartitions() > 4
        assert sorted(r.line for r in got.collect()) == body
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_record_files_written_and_read(spark, tmp_path):
    df = spark.range(2000).select("id", F.concat(F.lit("Peña “Ñ” €š "), F.col("id"), F.lit("  ")).alias("line"))
    folder = str(tmp_path / "files")
    fixed_width.write_record_files(df, folder, files=3, order=["id"])
    raw = [p.read_bytes().decode("cp1252").splitlines() for p in (tmp_path / "files").rglob("*.csv")]
    assert len(raw) == 3 and all(x[0] == "HEADER" and x[-1] == f"TRAILER{len(x) - 2:010d}" for x in raw)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split in ("100000", "7001", "999"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            got = fixed_width.read_lines(spark, folder)
            assert sorted(r.line for r in got.collect()) == sorted(r.line for r in df.collect())
            assert got.select("_ord").distinct().count() == 2000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_lines_and_rejects(spark):
    layout = [("b", 4, 7), ("a", 0, 3)]
    rows = [(1, "x", "yy"), (2, "long", "z"), (3, "ñ€", "toolong"), (4, "ok", "漢"), (5, None, ""), (6, "a\nb", "")]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    got = {r.id: tuple(r)[1:] for r in fixed_width.lines_and_rejects(df, layout, keep=["id"]).collect()}
    assert got == {
        1: ("x   yy ", None, None, None), 2: (None, "a", "too long", "long"),
        3: (None, "b", "too long", "toolong"), 4: (None, "b", "no such character", "漢"),
        5: ("       ", None, None, None), 6: (None, "a", "no such character", "a\nb")}


@pytest.mark.parametrize("layout", [LAYOUT_A, LAYOUT_B])
def test_layout_roundtrip(spark, layout):
    row = {name: f"{i}"[: end - start] for i, (name, start, end) in enumerate(layout)}
    df = spark.createDataFrame([row]).select(*[n for n, _, _ in layout])
    line = fixed_width.to_lines(df, layout)
    assert len(line.first().line) == max(end for _, _, end in layout)
    assert fixed_width.parse_fields(line, layout).first().asDict() == row


def test_null_texts(spark):
    df = spark.createDataFrame([("NA  nan x  ",)], "line string")
    got = fixed_width.parse_fields(df, [("a", 0, 3), ("b", 4, 7), ("c", 8, 11)]).first()
    assert tuple(got) == (None, None, "x")


def test_routing_agrees_on_driver_and_cluster(spark):
    names = ["R91 enero.xlsx", "cartera analisis.xls", "FRANJAS METAS.xlsx", "desembolsos_finansueños.x",
             "otro.xlsx", "asesores 2.xlsx", "R9.xlsx"]
    df = spark.createDataFrame([(f"/in/{n}",) for n in names], "path string")
    want = [routing.type_of_name(n) for n in names]
    assert [r[0] for r in df.select(routing.file_type("path")).collect()] == want
    assert want == ["R91", "ANALISIS", "METAS_FRANJAS", "DESEMBOLSOS_FINANSUEÑOS", None, "ASESORES", None]


def test_missing_tables_and_columns(spark):
    df = spark.createDataFrame([("1", "2")], "CODEUDOR string, FACTURA string")
    with pytest.raises(ValueError, match="AC FS"):
        tables.require_tables({"CODEUDORES": df}, COLLECTIONS)
    with pytest.raises(ValueError, match="cobra"):
        tables.conform(df, COLLECTIONS["CASA DE COBRANZA"], strict=True)
    swapped = tables.conform(df, COLLECTIONS["CODEUDORES"], strict=True).first()
    assert swapped.DOCUMENTO_CODEUDOR == "1" and swapped.CODEUDOR == "2"


def test_publish_replaces_at_once_and_skips_empty(spark, tmp_path):
    folder = str(tmp_path / "out")
    full, empty = spark.range(3), spark.range(0)
    assert sinks.publish_tables(spark, {"a": full, "b": empty}, folder) == ["a"]
    before = sinks.read_tables(spark, folder)["a"]
    assert sinks.publish_tables(spark, {"c": full}, folder) == ["c"]
    with pytest.raises(ValueError):
        sinks.publish_tables(spark, {"d": empty}, folder)
    now = sinks.read_tables(spark, folder)
    assert list(now) == ["c"] and now["c"].count() == 3 and before.count() == 3
    shown = sinks.publications(spark, folder).orderBy("at").collect()
    assert [[(t.name, t.rows) for t in p.tables] for p in shown] == [[("a", 3)], [("c", 3)]]


def test_a_write_that_fails_midway_leaves_the_old_report(spark, tmp_path):
    path = str(tmp_path / "report")
    sinks.write_report(spark.range(5), path)
    breaks = spark.range(5000).repartition(4).select(
        F.when(F.col("id") == 4321, F.raise_error(F.lit("broken")).cast("bigint")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        sinks.write_report(breaks, path)
    assert sorted(r.id for r in sinks.read_report(spark, path).collect()) == [0, 1, 2, 3, 4]
    with pytest.raises(Exception, match="broken"):  # the first of two tables is whole by then
        sinks.publish_tables(spark, {"report": spark.range(7), "more": breaks}, path)
    assert sinks.read_report(spark, path).count() == 5
    sinks.write_report(spark.range(2), path)
    assert sinks.read_report(spark, path).count() == 2


def test_old_publications_are_forgotten(spark, tmp_path):
    path = str(tmp_path / "report")
    for n in (3, 4, 5):
        sinks.write_report(spark.range(n), path)
    first = sinks.publications(spark, path).orderBy("at").first()
    assert sinks.forget(spark, path, keep=2) == 1
    assert sinks.read_report(spark, path).count() == 5
    assert spark.read.parquet(f"{path}/data/{first.version}/report").count() == 0


def test_an_empty_report_may_be_allowed(spark, tmp_path):
    path = str(tmp_path / "report")
    sinks.write_report(spark.range(0), path, allow_empty=True)
    assert sinks.read_report(spark, path).count() == 0


def write(spark, path, ddl, rows):
    spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(str(path))
    return str(path)


def test_monthly_base_from_files(spark, tmp_path):
    r91 = write(spark, tmp_path / "R91 mayo", " MCDTIPCRU1 string, MCDNUMCRU1 string, MCDVINCULA string, "
                "MCDZONA string, VENCODIGO string, MCDCCOSTO string, META_DC_AL double",
                [("fa ", "1.0", "10", "Z1 ", "7.0", "3", 5.0), ("DF", "2", "10.0", "Z2", "8", "3", 5.0)])
    due = write(spark, tmp_path / "VENCIMIENTOS", "MCNTIPCRU1 string, MCNNUMCRU1 string, VENCE string, "
                "SALDODOC double, MCNCUOCRU1 int", [("FA", "1", "01/05/2024", 10.0, 101),
                                                    ("FA", "1", "20/06/2024", 10.0, 2)])
    odd = write(spark, tmp_path / "otro", "x int", [(1,)])
    out = str(tmp_path / "out")
    done = run_monthly_base(spark, [r91, due, odd, str(tmp_path / "SC04 falta")], out,
                            as_of="2024-06-15")
    states = {os.path.basename(r.path): r.status for r in done.files.collect()}
    assert [(r.step, r.value) for r in done.steps.orderBy("place").collect()] == [
        (step, 2) for step in ("base", "credits and clients", "sellers and zones", "goals", "report")]
    assert states == {"R91 mayo": "loaded", "VENCIMIENTOS": "loaded", "otro": "skipped",
                      "SC04 falta": "failed"}
    got = {r.Credito: r for r in sinks.read_report(spark, out).collect()}
    assert set(got) == {"FA-1", "DF-2"}
    assert got["FA-1"].Empresa == "ARPESOD" and got["FA-1"].Cuota_Vigente == "2"
    assert got["FA-1"].Fecha_Cuota_Vigente == "20/06/2024" and got["FA-1"].Valor_Vencido == 0
    assert got["DF-2"].Factura_Venta == "NO DISPONIBLE" and got["DF-2"].Franja_Mora == "SIN INFO"
    assert got["DF-2"].Vendedor_Activo == "INACTIVO" and got["FA-1"].Codigo_Vendedor == "7"


def test_one_scan_for_many_files(spark, tmp_path):
    ddl = "TIPO_DOCUM string, NUMERO_DOC string, TOTVENTA double"
    paths = [write(spark, tmp_path / f"CRTMPCONSULTA1 {i}", ddl, [("FA", str(i), float(i))]) for i in range(6)]
    few, _ = tables.load_extracts(spark, paths[:2])
    many, report = tables.load_extracts(spark, paths)
    count = lambda df: df._jdf.queryExecution().executedPlan().toString().count("FileScan")
    assert count(few["CRTMPCONSULTA1"]) == count(many["CRTMPCONSULTA1"]) == 1
    assert sorted(r.Credito for r in many["CRTMPCONSULTA1"].collect()) == [f"FA-{i}" for i in range(6)]
    assert {r.status for r in report.collect()} == {"loaded"}


def test_paths_are_read_whole_or_not_at_all(spark, tmp_path):
    """Types that do not go together, blanks in headers, a broken part file, absent sheets."""
    a = write(spark, tmp_path / "SC04 a", "FACTURA string, SLCVALOR double, SLCNCUOTAS int", [("FA-1", 5.0, 3)])
    b = write(spark, tmp_path / "SC04 b", "` FACTURA ` string, SLCVALOR string, SLCNCUOTAS int", [("FA-2", "6", 4)])
    c = write(spark, tmp_path / "SC04 c", "` FACTURA ` string, SLCVALOR double", [("FA-3", 7.0)])
    spark.createDataFrame([("FA-9", 1.0, 1)] * 4, "FACTURA string, SLCVALOR double, SLCNCUOTAS int").repartition(2).write.parquet(str(tmp_path / "SC04 roto"))
    (tmp_path / "SC04 roto" / "part-99999-x.parquet").write_bytes(b"no parquet")
    one = tmp_path / "ASESORES uno"
    write(spark, one / "ASESORES", "CODIGO_VENDEDOR string", [("1",)])
    two = tmp_path / "ASESORES dos"
    write(spark, two / "ASESORES", "CODIGO_VENDEDOR string", [("2",)])
    write(spark, two / "Centro Costos", "`CENTRO DE COSTOS` string, REGIONAL string", [("3", "R")])
    bad = tmp_path / "ASESORES tres"
    write(spark, bad / "ASESORES", "CODIGO_VENDEDOR string", [("4",)])
    (bad / "Centro Costos").mkdir()
    (bad / "Centro Costos" / "part-0.parquet").write_bytes(b"no parquet")
    paths = [a, b, c, str(tmp_path / "SC04 roto"), str(tmp_path / "SC04 falta"), str(one), str(two), str(bad)]
    loaded, report = tables.load_extracts(spark, paths)
    states = {os.path.basename(r.path): r.status for r in report.collect()}
    assert states == {"SC04 a": "loaded", "SC04 b": "loaded", "SC04 c": "loaded", "SC04 roto": "failed", "SC04 falta": "failed",
                      "ASESORES uno": "loaded", "ASESORES dos": "loaded", "ASESORES tres": "failed"}
    got = sorted((r.Factura_Venta, float(r.Valor_Cuota), r.Total_Cuotas) for r in loaded["SC04"].collect())
    assert got == [("FA-1", 5.0, 3), ("FA-2", 6.0, 4), ("FA-3", 7.0, None)]
    assert sorted(r.Codigo_Vendedor for r in loaded["ASESORES"].collect()) == ["1", "2"]
    assert [r.Regional_Venta for r in loaded["CENTRO_COSTOS"].collect()] == ["R"]


def test_rows_are_skipped_in_every_sheet_of_a_scan(spark, tmp_path):
    ddl = ", ".join(f"c{i} string" for i in range(15))
    paths = [str(tmp_path / f"MATRIZ CARTERA {k}") for k in range(3)]
    for k, path in enumerate(paths):
        spark.createDataFrame([(f"{k}-{i}", *["x"] * 14) for i in range(5)], ddl).coalesce(1).write.parquet(path)
    loaded, _ = tables.load_extracts(spark, paths)
    assert sorted(r.Zona for r in loaded["MATRIZ_CARTERA"].collect()) == [f"{k}-{i}" for k in range(3) for i in (2, 3, 4)]


def test_without_a_base_nothing_is_computed(spark, tmp_path):
    due = write(spark, tmp_path / "VENCIMIENTOS", "MCNTIPCRU1 string, MCNNUMCRU1 string", [("FA", "1")])
    with pytest.raises(ValueError, match="base"):
        run_monthly_base(spark, [due], str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def read(spark, path):
    return tables.with_file_order(spark.read.parquet(str(path)))


def test_collections_and_advances_from_files(spark, tmp_path):
    account = "CEDULA string, FACTURA string, saldofac double, ccosto string, cobra string"
    specs = {
        "AC FS": (account, [("1", "DF-1", 100.0, "c", "z")]),
        "AC ARP": (account, [("2", "FA-1", 50.0, "c", "z")]),
        "CODEUDORES": ("CODEUDOR string, FACTURA string", [("3", "DF-5")]),
        "CASA DE COBRANZA": ("FACTURA string, cobra string", [("FA-1", "Casa")]),
        "EMPLEADOS ACTUALES": ("vincedula string, ACTIVO string", [("1", "SI")]),
        "PAGOS BANCOLOMBIA": (
            "`No.` int, Fecha string, `Detalle 1` string, `Detalle 2` string, `Referencia 1` double, "
            "`Referencia 2` string, Valor double",
            [(1, "02/01/2024", "a", "b", 1.0, "5.0", 100.0), (2, "x", "a", "b", 3.0, "r", 7.0)]),
        "PAGOS EFECTY": ("No int, `Identificación` string, Valor double, `N° de Autorización` string, "
                         "Fecha string", [(1, "2", 20.0, "k", "2024-01-02")]),
        "ONLINE": ("MCNTIPCRU1 string, MCNNUMCRU1 int, MCNVINCULA string, VINNOMBRE string, SALDODOC double",
                   [("RC", 1, " 1 ", "n", -100.0), ("RC", 2, "9", "n", -1.0)]),
    }
    found = {}
    for i, (name, (ddl, rows)) in enumerate(specs.items()):
        write(spark, tmp_path / f"t{i}", ddl, rows)
        found[name] = read(spark, tmp_path / f"t{i}")
    out = str(tmp_path / "pagos")
    assert run_collections(spark, found, out) == ["Bancolombia", "Efecty"]
    published = sinks.read_tables(spark, out)
    bank = {r["No."]: r for r in published["Bancolombia"].collect()}
    assert bank[1]["Documento Cartera"] == "DF-1" and bank[1]["marca"] == "empleado"
    assert bank[1]["Novedad"] == "Pago total" and bank[1]["Referencia 2"] == "5"
    assert bank[2]["Novedad"] == "Codeudor:DF-5" and bank[2]["Empresa"] == "Finansueños"
    assert bank[2]["Fecha"] is None and bank[1]["Fecha"] == "02/01/2024"
    cash = published["Efecty"].first()
    assert cash["Novedad"] == "Casa" and cash["VALIDACION ULTIMO SALDO"] == "30.0"

    sheets = str(tmp_path / "anticipos")
    assert run_advances(spark, found, sheets) == ["FINANSUEÑOS", "SIN CARTERA"]
    assert sinks.read_tables(spark, sheets)["FINANSUEÑOS"].first().marca == "pago total"


@pytest.mark.parametrize("rejects", [0, 1])
def test_bureau_b_from_file(spark, tmp_path, rejects):
    def line(number, name):
        cells = {"NUMERO DE IDENTIFICACION": number, "nombre_tercero": name,
                 "numero_obligacion": "DF 1C1", "fecha_inicio": "20240101",
                 "fecha_terminacion": "20230101", "valor_saldo": "10"}
        out = [" "] * 929
        for n, start, end in LAYOUT_B:
            out[start:end] = cells.get(n, "").ljust(end - start)
        return "".join(out)

    body = ["H", line("000000000000012", "Peña CORREGIR"), *[line("ABC", "malo")] * rejects, "T"]
    (tmp_path / "cifras.txt").write_bytes("\n".join(body).encode("cp1252"))
    specs = {
        "Cedulas a corregir": ("`CEDULA MAL` string, `CEDULA CORRECTA` string", [("12", "15")]),
        "Vinculado": ("CODIGO string, NOMBRE string, DIRECCI string, VINEMAIL string, TELEFONO string",
                      [("15", "Núñez  Ana", "d", "e", "t")]),
        "Tipos de identificacion": ("`CEDULA CORRECTA` string, `CODIGO CIFIN` int", [("15", 3)]),
        "FNZ001": ("DSM_TP string, DSM_NUM string, VLR_FNZ double", [("DF", "1", 5000999.0)]),
        "R05": ("MCNTIPCRU2 string, MCNNUMCRU2 string, ABONO double", [("DF", "1", 900.0), ("DF", "1", 200.0)]),
        "names": ("id string, full_name string", [("99", "NADIE")]),
    }
    found = {}
    for i, (name, (ddl, rows)) in enumerate(specs.items()):
        write(spark, tmp_path / f"t{i}", ddl, rows)
        found[name] = read(spark, tmp_path / f"t{i}")
    out = str(tmp_path / "out")
    names = bureau_plan.run_bureau_b(spark, str(tmp_path / "cifras.txt"), found, out)
    assert names == ["records", "rejects"]
    published = sinks.read_tables(spark, out)
    got = published["records"].collect()
    assert len(got) == 1
    assert [r["nombre_tercero"] for r in published["rejects"].collect()] == ["malo"] * rejects
    r = got[0]
    assert r["NUMERO DE IDENTIFICACION"] == "000000000000015" and r["tipo_identificacion"] == "03"
    assert r["nombre_tercero"] == "NUNEZ ANA".ljust(60)
    assert r["valor_inicial"] == 5000 and r["valor_real_pagado"] == 1 and r["valor_saldo"] == 0
    assert r["fecha_terminacion"] == "20240101" and r["periodicidad"] == "05"
    assert r["ciudad_casa"].strip() == "POPAYAN" and r["numero_obligacion"] == "DF1C1".ljust(20)
    assert published["records"].where(F.length("correo_electronico") != 60).isEmpty()
    assert published["records"].columns == published["rejects"].columns


def test_trailer_is_found_however_the_file_is_split(spark, tmp_path):
    lines = ["HEADER"] + [f"record {i:03d} text" for i in range(50)] + ["trailer as long as it is"]
    path = tmp_path / "records.txt"
    path.write_bytes(("\n".join(lines) + "\n").encode("cp1252"))
    size, before = path.stat().st_size, spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split in (size - len(lines[-1]), size - 30, size - 2, size // 3, 40):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
            got = {r["line"] for r in fixed_width.read_lines(spark, str(path)).collect()}
            assert got == set(lines[1:-1])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_skipped_rows_are_counted_over_all_part_files(spark, tmp_path):
    from ledgerspark.schemas import Table
    from ledgerspark.sources import tables

    folder = str(tmp_path / "sheet")
    spark.range(40).selectExpr("cast(id AS string) AS a", "'x' AS b").repartition(4).write.parquet(folder)
    table = Table((("", "cliente", "text"), ("", "prioridad", "text")), skip_rows=2, positional=True)
    rows = tables._shaped(tables.with_file_order(spark.read.parquet(folder)), table).collect()
    assert len(rows) == 38 and len({r["cliente"] for r in rows}) == 38


def test_too_long_values_and_empty_reports_are_refused(spark, tmp_path):
    from ledgerspark.sources import sinks

    df = spark.createDataFrame([("ABCDEFGH",)], "code string")
    with pytest.raises(Exception, match="longer"):
        fixed_width.to_lines(df, [("code", 0, 3)]).collect()
    path = str(tmp_path / "report")
    sinks.write_report(df, path)
    with pytest.raises(ValueError):
        sinks.write_report(df.limit(0), path)
    assert sinks.read_report(spark, path).count() == 1


def test_a_cluster_without_a_shared_folder_is_refused(monkeypatch):
    from ledgerspark import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError):
        session.shared_folder(Session())


def test_record_files_grow_in_number_with_their_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fixed_width, "LINES_PER_FILE", 100)
    df = spark.range(2000).select("id", F.concat(F.lit("line "), F.col("id")).alias("line"))
    folder = str(tmp_path / "files")
    fixed_width.write_record_files(df, folder, files=3, order=["id"])
    sizes = [len(p.read_bytes().splitlines()) - 2 for p in (tmp_path / "files").rglob("*.csv")]
    assert len(sizes) == 20 and sum(sizes) == 2000 and max(sizes) < 200
    assert sorted(r.line for r in fixed_width.read_lines(spark, folder).collect()) == sorted(r.line for r in df.collect())


def test_what_fits_windows_1252(spark):
    from ledgerspark.sources.fixed_width import fits_windows_1252

    texts = ["", "Peña ¿ÿ~ ", "€ Š", "a\nb", "a\n", "\x7f", "\x80", "π", "€π", "😀", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    fits = rows.select("i", fits_windows_1252(F.col("t")).alias("ok"))
    # Plain texts are told by ranges, before any character is looked up.
    assert "RLIKE" in fits._jdf.queryExecution().optimizedPlan().toString()
    assert {r.i: r.ok for r in fits.collect()} == dict(enumerate([True] * 3 + [False] * 7 + [None]))
