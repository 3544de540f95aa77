from tests.ledger import ACCOUNT, ledger

from vecindad.sinks.tables import append
from vecindad.sources.tables import read_stored
from vecindad.streaming.payments import stream_payments


def test_payment_intake(spark, tmp_path):
    root, landing = str(tmp_path / "store"), tmp_path / "landing"
    landing.mkdir()
    append(ledger(spark)["Unidad_Funcional"], f"{root}/Unidad_Funcional")
    options = {"checkpoint": str(tmp_path / "checkpoint"), "mode": "strict", "files_per_batch": 1}

    def drop(name, *lines):
        (landing / name).write_text("IdPago,fecha,CVU,Valor\n" + "\n".join(lines) + "\n")

    def counts():
        return [read_stored(spark, root, n).count() for n in ("Pago", "Detalle_CSV", "CSV_Importado")]

    drop("a.csv", f"1,01/04/2025,{ACCOUNT[11]},$ 10", f"2,01/04/2025,{ACCOUNT[12]},$ 20")
    drop("b.csv", f"3,02/04/2025,{ACCOUNT[11]},$ 30")
    query = stream_payments(spark, root, str(landing), **options)
    query.awaitTermination(120)
    assert counts() == [3, 3, 2]
    # Rows that the source gave: each line once, whatever the number of tables.
    assert sum(p["numInputRows"] for p in query.recentProgress) == 3
    drop("c.csv", f"4,03/04/2025,{ACCOUNT[11]},$ 40")
    stream_payments(spark, root, str(landing), **options).awaitTermination(120)
    assert counts() == [4, 4, 3]
    # Read again from the start (checkpoint lost): the registry turns known files away.
    options["checkpoint"] = str(tmp_path / "other")
    stream_payments(spark, root, str(landing), **options).awaitTermination(120)
    assert counts() == [4, 4, 3]
    batches = {r.lote for r in read_stored(spark, root, "Pago").select("lote").collect()}
    assert len(batches) == 3 and all(len(b) > 40 for b in batches)  # name, query id, number
