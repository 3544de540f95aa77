from __future__ import annotations

import pytest

from vecindad.plans import imports
from vecindad.sinks import versions
from vecindad.sources.tables import read_stored

BUILDINGS = "Consorcio,Nombre del consorcio,Domicilio,Cant unidades funcionales,m2 totales\nC,Azcuenaga,\"Calle 1\",2,100.00\n"
UNITS = (
    "NombreConsorcio\tnro\tPiso\tDepartamento\tCoeficiente\tm2\tBauleras\tCochera\tm2b\tm2c\n"
    "Azcuenaga\t1\t1\tA\t50,00\t40,00\tSI\tNO\t1\t1\nAzcuenaga\t2\t1\tB\t50,00\t40,00\tNO\tNO\t1\t1\n"
)
MORE_UNITS = UNITS + "Azcuenaga\t3\t2\tC\t10,00\t40,00\tNO\tNO\t1\t1\n"
ACCOUNTS = "CBU_CVU|NombreConsorcio|nro|piso|departamento\n{a}|azcuenaga |1|1|a\n{b}|Azcuenaga|2|1|B\n{c}|Nobody|9|1|B\n|Azcuenaga|1|1|A\n"
A, B, C = ("1" * 22, "2" * 22, "3" * 22)
PERSONS = f"Nombre;Apellido;DNI;Email;Telefono;CBU_CVU;EsInquilino\nAna;Paz;20111111;;;{A};0\nLuis;Gil;20222222;;;{B};1\n"
PAYMENTS = f"IdPago,Fecha,CVU_CBU,Valor\n1,05/04/2025,{A},\"$ 100,50\"\n2,06/04/2025,{C},$ 7\n"


@pytest.fixture
def files(tmp_path):
    def write(name: str, text: str) -> str:
        path = tmp_path / name
        path.write_text(text, encoding="utf-8")
        return str(path)

    return write


def accounts(spark, root):
    return {r.departamento: r.CBU_CVU for r in read_stored(spark, root, "Unidad_Funcional").collect()}


def test_files_stored_one_after_the_other(spark, tmp_path, files, monkeypatch):
    """Buildings, units, accounts, persons and payments: owners and payments find their units."""
    root = str(tmp_path / "store")
    imports.store_building_file(spark, root, files("b.csv", BUILDINGS))
    imports.store_building_file(spark, root, files("b.csv", BUILDINGS))
    assert read_stored(spark, root, "Consorcio").count() == 1
    imports.store_unit_file(spark, root, files("u.txt", UNITS), "1")
    listed = files("a.csv", ACCOUNTS.format(a=A, b=B, c=C))

    # A run that is cut short before its list is published leaves the old version whole.
    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(versions, "publish", lost)
    with pytest.raises(RuntimeError):
        imports.store_account_file(spark, root, listed, "1")
    monkeypatch.undo()
    assert accounts(spark, root) == {"A": None, "B": None}
    # A list that was cut short is not read, and its number is left to it.
    folder = tmp_path / "store" / "_versiones" / "Unidad_Funcional"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "00000001").write_text('{"0": ["gone')
    assert accounts(spark, root) == {"A": None, "B": None}

    assert imports.store_account_file(spark, root, listed, "1") > 0
    assert accounts(spark, root) == {"A": A, "B": B}
    assert imports.store_account_file(spark, root, listed, "1") == 0  # nothing to change
    assert versions.published(spark, root, "Unidad_Funcional").number == 2
    rejected = spark.read.parquet(f"{root}/Rechazados/tabla=Cuenta/lote=1").collect()
    assert sorted(r.CBU_CVU or "" for r in rejected) == ["", C]

    # Units that come later join the changed table; a new number changes its bucket only.
    imports.store_unit_file(spark, root, files("more.txt", MORE_UNITS), "2")
    assert accounts(spark, root) == {"A": A, "B": B, "C": None}
    assert imports.store_account_file(spark, root, files("a2.csv", ACCOUNTS.format(a=C, b=B, c=C)), "2") == 1
    assert accounts(spark, root) == {"A": C, "B": B, "C": None}
    assert imports.store_account_file(spark, root, listed, "3") == 1

    imports.store_person_file(spark, root, files("p.csv", PERSONS), "1")
    units = {r.departamento: r.unidadFuncionalID for r in read_stored(spark, root, "Unidad_Funcional").collect()}
    (owner,) = read_stored(spark, root, "Propietario").collect()
    (tenant,) = read_stored(spark, root, "Inquilino").collect()
    assert (owner.unidadFuncionalID, tenant.unidadFuncionalID) == (units["A"], units["B"])
    imports.store_payment_files(spark, root, files("pay.csv", PAYMENTS), "1")
    paid = {r.cuentaOrigen: (r.unidadFuncionalID, r.asociado) for r in read_stored(spark, root, "Pago").collect()}
    assert paid == {A: (units["A"], True), C: (None, False)}


def test_a_number_is_published_once(spark, tmp_path):
    root = str(tmp_path)
    versions.publish(spark, root, "Unidad_Funcional", 1, {"0": ["x"]})
    with pytest.raises(Exception, match="exists"):
        versions.publish(spark, root, "Unidad_Funcional", 1, {"0": ["y"]})
    assert versions.published(spark, root, "Unidad_Funcional").folders == {"0": ["x"]}
