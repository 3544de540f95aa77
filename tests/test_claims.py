"""Files claimed by imports at the same time."""

from __future__ import annotations

import pytest

from vecindad.plans import imports
from vecindad.sinks.claims import FileClaimed, check_claim, claim, release_claim
from vecindad.sources.tables import read_stored


def test_one_holder(spark, tmp_path):
    root = str(tmp_path)
    held = claim(spark, root, ["b.csv", "a.csv"], "one")
    with pytest.raises(FileClaimed, match="held by batch one"):
        claim(spark, root, ["0.csv", "b.csv"], "two")
    # What the refused import had claimed is free again.
    release_claim(spark, root, claim(spark, root, ["0.csv"], "three"))
    check_claim(spark, root, held)
    release_claim(spark, root, held)
    release_claim(spark, root, claim(spark, root, ["a.csv", "b.csv"], "two"))


def test_a_dead_claim_is_taken_over(spark, tmp_path):
    root = str(tmp_path)
    dead = claim(spark, root, ["a.csv"], "one")
    taken = claim(spark, root, ["a.csv"], "two", stale=0)
    with pytest.raises(FileClaimed, match="taken over"):
        check_claim(spark, root, dead)
    release_claim(spark, root, dead)
    check_claim(spark, root, taken)
    with pytest.raises(FileClaimed):
        claim(spark, root, ["a.csv"], "three")


def test_a_batch_repeats_its_own_claim(spark, tmp_path):
    root = str(tmp_path)
    cut_short = claim(spark, root, ["a.csv"], "one")
    again = claim(spark, root, ["a.csv"], "one")
    with pytest.raises(FileClaimed):
        check_claim(spark, root, cut_short)
    check_claim(spark, root, again)


def test_an_import_stores_no_file_that_another_holds(spark, tmp_path):
    root = str(tmp_path / "ledger")
    path = tmp_path / "pagos.csv"
    path.write_text("Id de pago,fecha,CVU/CBU,Valor\n1,01/02/2025,0000000000000000000001,$ 10.50\n")
    held = claim(spark, root, ["pagos.csv", "PAGOS.CSV"], "other")
    with pytest.raises(FileClaimed):
        imports.store_payment_files(spark, root, str(path), "mine")
    assert read_stored(spark, root, "Pago").count() == read_stored(spark, root, "CSV_Importado").count() == 0
    release_claim(spark, root, held)
    imports.store_payment_files(spark, root, str(path), "mine")
    imports.store_payment_files(spark, root, str(path), "later")
    assert read_stored(spark, root, "Pago").count() == read_stored(spark, root, "CSV_Importado").count() == 1
