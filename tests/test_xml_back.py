"""Written XML documents read back to the same rows; unreadable elements are reported."""

from __future__ import annotations

from decimal import Decimal

from vecindad.sinks.xml import STATEMENT_ROW, WEEK_ROW, write_statement_xml, write_weekly_xml
from vecindad.sources.xml import STATEMENT, read_statement_xml, read_weekly_xml, rejected_xml

WEEKS = (
    "Anio int, Semana int, Consorcio string, TotalOrdinarios decimal(24,2), TotalExtraordinarios decimal(24,2), "
    "TotalGeneral decimal(24,2), Acumulado decimal(24,2)"
)


def weeks(spark):
    rows = [
        (2025, w, name, Decimal(w), Decimal("0.50"), Decimal(w) + Decimal("0.50"), Decimal("123456789012.34"))
        for w in range(1, 30)
        for name in ("Azcuénaga & <Sur>", 'con "comillas"')
    ]
    return spark.createDataFrame(rows, WEEKS)


def test_weekly_documents(spark, tmp_path):
    path = str(tmp_path / "weeks")
    frame = weeks(spark)
    write_weekly_xml(frame.repartition(4), path)
    assert len(list((tmp_path / "weeks").glob("part-*"))) == 4
    back = read_weekly_xml(spark, path)
    assert back.schema.simpleString() == frame.schema.simpleString()
    assert sorted(back.collect()) == sorted(frame.collect())
    assert rejected_xml(spark, path, WEEK_ROW).count() == 0


def test_statement_documents(spark, tmp_path):
    some = [
        (1, Decimal("12.34"), "1-A", "Ana Núñez", *[Decimal("1.10")] * 4, Decimal("5.00"), 1, Decimal("0.00"), Decimal("-7.25")),
        (2, None, None, None, *[None] * 4, None, None, None, Decimal("0.01")),
    ]
    frame = spark.createDataFrame(some, STATEMENT)
    path = write_statement_xml(frame, str(tmp_path), 2025, 4)
    assert sorted(map(tuple, read_statement_xml(spark, path).collect())) == sorted(map(tuple, frame.collect()))


def test_unreadable_elements(spark, tmp_path):
    folder = tmp_path / "bad"
    folder.mkdir()
    good = "<Expensa><uf>7</uf><TotalPagar>1.50</TotalPagar></Expensa>"
    (folder / "a.xml").write_text(f"<Expensas>{good}<Expensa><uf>siete</uf><TotalPagar>2</TotalPagar></Expensa></Expensas>")
    (folder / "b.xml").write_text(f"<Expensas>{good.replace('7', '8')}<Expensa><uf>9</uf></Expensa></Expensas>")
    assert sorted(r.uf for r in read_statement_xml(spark, str(folder)).collect()) == [7, 8]
    found = {r.archivo.rsplit("/", 1)[1]: r.texto for r in rejected_xml(spark, str(folder), STATEMENT_ROW).collect()}
    assert set(found) == {"a.xml", "b.xml"}
    assert "siete" in found["a.xml"] and "<uf>9</uf>" in found["b.xml"]


def test_no_rows(spark, tmp_path):
    path = str(tmp_path / "none")
    write_weekly_xml(weeks(spark).limit(0), path)
    assert read_weekly_xml(spark, path).count() == 0
