from decimal import Decimal as D

from tests.ledger import BUILDINGS, UNITS, ledger, rows_of

from vecindad.operators.quality import check_table, with_default
from vecindad.schemas import RULES, TABLES


def found(frame):
    return rows_of(frame, "regla", "clave", "detalle", "filas")


def test_clean_tables_pass(spark):
    t = ledger(spark)
    for name in ("Consorcio", "Unidad_Funcional", "Propietario"):
        assert found(check_table(name, t)) == []


def test_violations(spark):
    units = [
        *UNITS,
        (11, 1, "123", "A", None, 0, 0, "1" * 23, D("1.00")),
        (99, 77, "1", "A", D("1.00"), 0, 0, None, D("1.00")),
    ]
    assert found(check_table("Unidad_Funcional", ledger(spark, Unidad_Funcional=units))) == [
        ("foreign_key", "77", "consorcioID", 1),
        ("length", "1" * 23, "CBU_CVU", 1),
        ("length", "123", "piso", 1),
        ("not_null", None, "superficieM2", 1),
        ("unique", "11", "unidadFuncionalID", 2),
    ]
    owners = [
        (1, "1234567x", 11, "Ana", "Paz", None, None, "Paloma", None),
        (2, "20222222", 12, "L", "G", None, None, "Fisico", None),
    ]
    assert found(check_table("Propietario", ledger(spark, Propietario=owners))) == [
        ("digits", "1234567x", "DNI", 1),
        ("domain", "Paloma", "modoEntrega", 1),
    ]


def test_amount_that_does_not_fit(spark):
    rows = [(None, 1, 11, "a", None, D("1000000.00"), 1)]
    checks = found(check_table("Detalle_CSV", ledger(spark, Detalle_CSV=rows)))
    assert ("decimal_fit", "1000000.00", "importe", 1) in checks
    assert ("not_null", None, "fechaPago", 1) in checks


def test_every_rule_names_real_columns():
    for table, rules in RULES.items():
        columns = set(TABLES[table].fieldNames())
        used = {
            *rules.key, *rules.parents, *rules.required, *rules.allowed, *rules.between,
            *rules.digits, *rules.max_length, *rules.fits,
        }
        assert used <= columns, table
        for parent, key in rules.parents.values():
            assert key in TABLES[parent].fieldNames()


def test_default(spark):
    frame = spark.createDataFrame([(1, None), (2, True)], "i int, asociado boolean")
    assert rows_of(with_default(frame, "asociado", False), "i", "asociado") == [(1, False), (2, True)]
    assert len(BUILDINGS) == 5
