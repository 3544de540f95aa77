import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from tests.ledger import ACCOUNT, BUILDINGS, UNITS, day, ledger, rows_of

from vecindad.operators.changes import insert_if_missing, one_row_per_key, update_from_join
from vecindad.plans import imports
from vecindad.sinks.tables import append, replace_partitions, write_new
from vecindad.sources import files
from vecindad.sources.tables import read_stored, read_table


def write(path, text, newline="\n"):
    path.write_bytes(text.replace("\n", newline).encode("utf-8"))
    return str(path)


def test_missing_file(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        files.read_units(spark, str(tmp_path / "nothing.txt"))


def test_buildings(spark, tmp_path):
    path = write(
        tmp_path / "b.csv",
        "Consorcio,Nombre del consorcio,Domicilio,Cant unidades funcionales,m2 totales\n"
        'Consorcio 1,Azcuenaga,"Belgrano 3344, PB",45,1281.00\n'
        "Consorcio 6,Ñandú,Callao 1,10,914.5\nConsorcio 6,ñandú ,Callao 1,10,914.5\n",
    )
    staged = files.read_buildings(spark, path)
    every = imports.import_buildings(staged)
    assert rows_of(every, "nombre", "direccion", "superficieM2Total")[0] == (
        "Azcuenaga", "Belgrano 3344, PB", D("1281.00"),
    )
    assert every.count() == 3
    known = ledger(spark)["Consorcio"]
    assert imports.import_buildings(staged, known, "strict").count() == 1


UNIT_FILE = (
    "Nombre\tnro\tPiso\tDepto\tCoef\tm2\tBauleras\tCochera\tm2b\tm2c\n"
    " azcuenaga \t1\t1\tA\t60,00\t50,5\tSI\tNO\t1\t0\n"  # stored already
    "Azcuenaga\t2\t2\tB\t2,50\t45,75\tSI\tsi\t1\t0\n"
    "Azcuenaga\t3\t2\tB\t2,50\t45,75\tSI\tsi\t1\t0\n"  # the same unit again
    "Alzaga\t4\t3\tC\t100\t45\tNO\tNO\t\t\n"  # share does not fit
    "Desconocido\t5\t3\tC\t1\t45\tNO\tNO\t\t\n"
)


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_units(spark, tmp_path, newline):
    staged = files.read_units(spark, write(tmp_path / "u.txt", UNIT_FILE, newline))
    t = ledger(spark)
    columns = ("consorcioID", "piso", "departamento", "superficieM2", "cochera", "baulera", "coeficiente")
    row = (1, "2", "B", D("45.75"), 1, 1, D("2.50"))
    new = imports.import_units(staged, t["Consorcio"], t["Unidad_Funcional"])
    assert rows_of(new, *columns) == [row, row]
    strict = imports.import_units(staged, t["Consorcio"], t["Unidad_Funcional"], "strict")
    assert rows_of(strict, *columns) == [row]
    assert new.select("unidadFuncionalID").distinct().count() == 2  # the repeat has an id of its own
    rejected = imports.rejected_units(staged, t["Consorcio"])
    assert {r.coeficiente for r in rejected.collect()} == {D("1.00"), None}


def test_unit_accounts(spark, tmp_path):
    path = write(
        tmp_path / "a.csv",
        "CVU/CBU|Consorcio|nro|piso|depto\n"
        f"{'7' * 22}|ALBERDI |1|2 |c\n{'8' * 22}|Alberdi|1|2|C\n{'9' * 22}|Nadie|1|2|C\n",
    )
    staged = files.read_unit_accounts(spark, path)
    t = ledger(spark)
    changed = imports.update_accounts(t["Unidad_Funcional"], staged, t["Consorcio"])
    found = dict(rows_of(changed, "unidadFuncionalID", "CBU_CVU"))
    assert found == {11: ACCOUNT[11], 12: ACCOUNT[12], 21: ACCOUNT[21], 31: "8" * 22}


PERSON_FILE = (
    "Nombre;Apellido;DNI;email;telefono;CVU/CBU;Inquilino\n"
    f" Ana ;Paz;12.345.678;a@b;1;{ACCOUNT[11]};0\n"
    f"Ana;Paz;12345678;a@b;1;{ACCOUNT[12]};0\n"
    f"Ana;Paz;12345678;a@b;1;{ACCOUNT[12]};0\n"
    f"Luis;Gil;1234567;a@b;1;{ACCOUNT[12]};1\n"
    f"Eva;Sol;123;a@b;1;{ACCOUNT[12]};1\n"
    f"Eva;Sol;22222222;a@b;1;{'5' * 22};1\n"
    f"Leo;Rey;20111111;a@b;1;{ACCOUNT[21]};0\n"  # a known owner, at another unit
)


def test_persons(spark, tmp_path):
    staged = files.read_persons(spark, write(tmp_path / "p.csv", PERSON_FILE))
    t = ledger(spark)
    owners = imports.import_owners(staged, t["Unidad_Funcional"], t["Propietario"])
    assert rows_of(owners, "DNI", "unidadFuncionalID", "nombre", "modoEntrega") == [
        ("12345678", 11, "Ana", "Mail"), ("12345678", 12, "Ana", "Mail"),
        ("12345678", 12, "Ana", "Mail"),
    ]
    strict = imports.import_owners(staged, t["Unidad_Funcional"], t["Propietario"], "strict")
    assert rows_of(strict, "DNI", "unidadFuncionalID") == [
        ("12345678", 11), ("12345678", 12), ("20111111", 21),
    ]
    tenants = imports.import_tenants(staged, t["Unidad_Funcional"], t["Propietario"])
    assert rows_of(tenants, "DNI", "unidadFuncionalID") == [("01234567", 12)]


PAYMENT_FILE = (
    "IdPago,fecha,CVU/CBU,Valor\n"
    f"1,05/04/2025,{ACCOUNT[11]},$ 500\n"
    f"2,6/4/2025, {ACCOUNT[11]} ,$ 500\n"
    f'3,07/04/2025,{"9" * 22},"$ 1.234,50"\n'
    f"4,08/04/2025,{ACCOUNT[12]}, \n"  # no amount: dropped
    f"5,08/04/2025,{ACCOUNT[12]},nada\n"
    f"6,99/04/2025,{ACCOUNT[12]},$ 80\n"
)


def payments(spark, tmp_path, name="pagos.csv", text=PAYMENT_FILE):
    return files.read_payments(spark, write(tmp_path / name, text))


def test_payments(spark, tmp_path):
    t = ledger(spark, CSV_Importado=[])
    staged = payments(spark, tmp_path)
    for mode, copies in (("reference", 4), ("strict", 2)):
        out = imports.import_payments(
            staged, t["Unidad_Funcional"], t["CSV_Importado"], file_date=dt.date(2025, 11, 2), mode=mode
        )
        assert rows_of(out["Pago"], "unidadFuncionalID", "monto", "asociado") == [
            (11, D("500.00"), True), (11, D("500.00"), True), (12, D("80.00"), True),
            (None, D("1234.50"), False),
        ]
        detail = out["Detalle_CSV"].where("unidadFuncionalID = 11").collect()
        assert sum(r.copias for r in detail) == copies
        assert sum(r.importe * r.copias for r in detail) == 500 * copies
        assert rows_of(out["rechazados"], "IdPago") == [(4,), (5,), (6,)]
        assert rows_of(out["CSV_Importado"], "nombreArchivo", "fechaCSV") == [
            ("pagos.csv", dt.date(2025, 11, 2))
        ]
    again = imports.import_payments(staged, t["Unidad_Funcional"], out["CSV_Importado"])
    assert [again[n].count() for n in ("Pago", "Detalle_CSV", "CSV_Importado", "rechazados")] == [0] * 4


def test_detail_equals_the_full_join(spark):
    """The counted pairs stand for exactly the rows of the join, older payments included."""
    from vecindad.operators.payments import detail_lines, match_payments

    lines = spark.createDataFrame(
        [(1, i, day(f"2025-04-0{1 + i % 3}"), ACCOUNT[11 + i % 2], D(100 + i % 5)) for i in range(60)],
        "importacionID long, IdPago int, Fecha date, CVU_CBU string, Valor decimal(12,2)",
    )
    units = ledger(spark)["Unidad_Funcional"]
    stored = match_payments(lines.where("IdPago < 20"), units)
    matched = match_payments(lines, units)
    found = detail_lines(lines, matched, stored).groupBy("cuentaOrigen", "importe", "fechaPago").sum("copias")
    pago = matched.select("cuentaOrigen", "monto").unionByName(stored.select("cuentaOrigen", "monto"))
    want = (
        lines.join(pago, (pago.cuentaOrigen == lines.CVU_CBU) & (pago.monto == lines.Valor))
        .groupBy("cuentaOrigen", "monto", "Fecha")
        .count()
    )
    assert rows_of(found, *found.columns) == rows_of(want, *want.columns)


def test_store_payments_can_be_repeated(spark, tmp_path):
    root = str(tmp_path / "store")
    append(ledger(spark)["Unidad_Funcional"], f"{root}/Unidad_Funcional")
    path = write(tmp_path / "pagos.csv", PAYMENT_FILE)

    def counts():
        return [read_stored(spark, root, n).count() for n in ("Pago", "Detalle_CSV", "CSV_Importado")]

    imports.store_payment_files(spark, root, path, "2025-11-02")
    first = counts()
    assert first == [4, 3, 1]
    imports.store_payment_files(spark, root, path, "2025-11-02")  # a repeated call
    assert counts() == first
    imports.store_payment_files(spark, root, path, "2025-11-03")  # a known file
    assert counts() == first
    # A second file with the same account and amount matches the older payments too.
    other = write(tmp_path / "mas.csv", f"IdPago,f,c,v\n7,01/05/2025,{ACCOUNT[11]},$ 500\n")
    imports.store_payment_files(spark, root, other, "2025-12-01")
    (row,) = read_stored(spark, root, "Detalle_CSV").where("lote = '2025-12-01'").collect()
    assert row.copias == 3


def test_files_are_read_once_a_batch(spark, tmp_path):
    root = str(tmp_path / "store")
    append(ledger(spark)["Unidad_Funcional"], f"{root}/Unidad_Funcional")
    for mode in ("reference", "strict"):
        seen = spark.sparkContext.accumulator(0)

        @F.udf("string")
        def touched(value, seen=seen):
            seen.add(1)
            return value

        staged = payments(spark, tmp_path, name=f"{mode}.csv")
        staged = staged.withColumn("Valor", touched.asNondeterministic()("Valor"))
        lines = staged.count()
        seen.value = 0
        imports.store_payments(spark, root, staged, mode, mode=mode)
        assert seen.value == lines
        assert read_stored(spark, root, "Pago").where(F.col("lote") == mode).count() == 4
    assert not list((tmp_path / "store" / "_lotes").glob("*"))


def test_detail_lies_by_month(spark, tmp_path):
    root, batch = str(tmp_path / "store"), "a b:c%d"
    append(ledger(spark)["Unidad_Funcional"], f"{root}/Unidad_Funcional")

    def put(name, batch, *days):
        lines = "\n".join(f"{k},{x},{ACCOUNT[11]},$ {k}" for k, x in enumerate(days, 1))
        path = write(tmp_path / name, f"IdPago,f,c,v\n{lines}\n")
        imports.store_payment_files(spark, root, path, batch, mode="strict")

    def stored(months=None):
        rows = read_stored(spark, root, "Detalle_CSV", months)
        found = sorted((r.periodo, r.lote, r.fechaPago.isoformat()) for r in rows.collect())
        return found, rows.inputFiles()

    april, may, june = (2025 * 12 + m for m in (3, 4, 5))
    put("one.csv", batch, "01/04/2025", "02/05/2025", "03/05/2025", "04/06/2025")
    put("two.csv", "other", "09/05/2025")
    first = [(april, batch, "2025-04-01"), (may, batch, "2025-05-02"), (may, batch, "2025-05-03")]
    other = [(may, "other", "2025-05-09")]
    assert stored()[0] == sorted([*first, *other, (june, batch, "2025-06-04")])
    found, read = stored([may])
    assert found == sorted([*first[1:], *other]) and all(f"periodo={may}/" in f for f in read)
    # The batch again, without its last month; other batches and months stay.
    put("one.csv", batch, "01/04/2025", "02/05/2025", "03/05/2025")
    assert stored()[0] == sorted([*first, *other])
    assert stored([june])[0] == []
    # Rows stored by batch alone are read beside them.
    append(ledger(spark, Detalle_CSV=[("p", 1, 11, ACCOUNT[11], day("2025-01-01"), D(1), 1)])["Detalle_CSV"], f"{root}/Detalle_CSV/lote=old")
    rows = read_stored(spark, root, "Detalle_CSV", [april])
    assert rows_of(rows, "fechaPago") == [(day("2025-01-01"),), (day("2025-04-01"),)]


def test_numbers_of_repeated_units(spark):
    """One key with very many rows, equal and different ones: ids are unique and do not depend on partitions."""
    t = ledger(spark)
    many = spark.range(200000).select(
        F.when(F.col("id") % 50 == 0, F.lit("7")).otherwise(F.lit("9")).alias("Piso"),
        F.lit("Z").alias("Departamento"),
        F.when(F.col("id") < 90000, F.lit(5)).otherwise(F.col("id") % 9000).cast("string").alias("m2_unidad_funcional"),
        F.lit(t["Consorcio"].first().nombre).alias("NombreConsorcio"),
        F.lit("SI").alias("Cochera"),
        F.lit("NO").alias("Bauleras"),
        F.lit("1").alias("Coeficiente"),
    )
    found = []
    for parts in (3, 7):
        units = imports.import_units(many.repartition(parts), t["Consorcio"], t["Unidad_Funcional"])
        found.append(
            units.agg(
                F.count("*"), F.count_distinct("unidadFuncionalID"), F.sum(F.xxhash64("*") % 1000003)
            ).first()
        )
    assert found[0] == found[1]
    assert found[0][0] == found[0][1] == 200000


def test_changes(spark):
    new = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "c")], "k int, v string")
    old = spark.createDataFrame([(1, "x"), (None, "y")], "k int, v string")
    assert rows_of(insert_if_missing(new, old, ["k"]), "k", "v") == [(2, "b"), (2, "b"), (None, "c")]
    assert rows_of(one_row_per_key(new, ["k"]), "k", "v") == [(1, "a"), (2, "b"), (None, "c")]
    source = spark.createDataFrame([(1, "p"), (1, "q"), (9, "z")], "k int, w string")
    assert rows_of(update_from_join(new, source, ["k"], {"v": "w"}), "k", "v") == [
        (1, "q"), (2, "b"), (2, "b"), (None, "c"),
    ]


def test_table_writers(spark, tmp_path):
    path = str(tmp_path / "Consorcio")
    t = ledger(spark)["Consorcio"]
    write_new(t, path)
    with pytest.raises(AnalysisException):
        write_new(t, path)
    assert read_table(spark, str(tmp_path), "Consorcio").count() == len(BUILDINGS)
    units = ledger(spark)["Unidad_Funcional"]
    other = str(tmp_path / "units")
    replace_partitions(units, other, ("consorcioID",))
    replace_partitions(units.where("consorcioID = 1").limit(1), other, ("consorcioID",))
    assert spark.read.parquet(other).count() == len(UNITS) - 1


def test_amounts_quotes_and_cut_lines(spark, tmp_path):
    """A decimal comma needs no quotes, a stray quote is a character, and nothing is lost unseen."""
    text = (
        "IdPago,fecha,CVU,Valor\n"
        f"1,05/04/2025,{ACCOUNT[11]},$ 1.234,50\r\n"
        f'2,05/04/2025,{ACCOUNT[11]},"$ 1.234,50"\n'
        f'"3,05/04/2025,{ACCOUNT[11]},$ 7\n'
        f"4,05/04/2025,{ACCOUNT[11]}\n"
        f"5,05/04/2025,{ACCOUNT[11]},$ 8,25\n"
    )
    units = ledger(spark)["Unidad_Funcional"]
    out = imports.import_payments(
        payments(spark, tmp_path, "comas.csv", text), units, ledger(spark, CSV_Importado=[])["CSV_Importado"]
    )
    assert sorted(r.monto for r in out["Pago"].collect()) == [D("7.00"), D("8.25"), D("1234.50"), D("1234.50")]
    assert [r.linea for r in out["rechazados"].collect()] == [f"4,05/04/2025,{ACCOUNT[11]}"]

    persons = files.read_persons(
        spark,
        write(
            tmp_path / "q.csv",
            f'n;a;d;m;t;c;i\n"Ana;Paz;12345678;a@b;1;{ACCOUNT[11]};0\nLuis;"Gil;1234567;a@b;1;{ACCOUNT[12]};1\n'
            f"Eva;Sol;12345679;a@b;1;{ACCOUNT[12]};x\n",
        ),
    )
    owners = imports.import_owners(persons, units, ledger(spark)["Propietario"])
    assert rows_of(owners, "nombre", "DNI") == [('"Ana', "12345678")]
    assert rows_of(imports.rejected_persons(persons, units), "nombre") == [("Eva",)]


def test_stored_jobs_keep_rejects(spark, tmp_path):
    from vecindad.sinks.tables import append
    from vecindad.sources.tables import read_stored

    root, t = str(tmp_path / "store"), ledger(spark)
    append(t["Consorcio"], f"{root}/Consorcio")
    append(t["Unidad_Funcional"], f"{root}/Unidad_Funcional")
    units = write(tmp_path / "u.txt", UNIT_FILE)
    for _ in range(2):  # the second run finds everything stored
        imports.store_unit_file(spark, root, units, "a")
        imports.store_person_file(spark, root, write(tmp_path / "p.csv", PERSON_FILE), "a")
    imports.store_payment_files(spark, root, write(tmp_path / "pagos.csv", PAYMENT_FILE), "a")
    assert read_stored(spark, root, "Unidad_Funcional").count() == t["Unidad_Funcional"].count() + 2
    rejected = spark.read.option("mergeSchema", "true").parquet(f"{root}/Rechazados")
    counts = {r.tabla: r["count"] for r in rejected.groupBy("tabla").count().collect()}
    assert counts == {"Pago": 3, "Persona": 2, "Unidad_Funcional": 2}
