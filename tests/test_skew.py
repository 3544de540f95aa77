"""One key holding a third of all rows: results stay whole, work stays split."""

import re
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from tests.ledger import ledger, rows_of

from vecindad.operators.changes import one_row_per_key
from vecindad.operators.payments import collected, detail_lines, match_payments, paid_by_account

ROWS = 60_000


@pytest.fixture()
def small_splits(spark):
    """Thresholds at which test data counts as skewed, and no broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_lines(spark):
    """A third of the lines: one account, one amount, one day."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, ROWS, 1, 8).select(
        F.lit(1).cast("bigint").alias("importacionID"),
        F.col("id").cast("int").alias("IdPago"),
        F.when(hot, F.lit("2025-04-01").cast("date"))
        .otherwise(F.date_add(F.lit("2025-04-01").cast("date"), (F.col("id") % 28).cast("int")))
        .alias("Fecha"),
        F.when(hot, F.lpad(F.lit("11"), 22, "0"))
        .otherwise(F.lpad((F.col("id") % 500).cast("string"), 22, "0"))
        .alias("CVU_CBU"),
        F.when(hot, F.lit(500)).otherwise(F.col("id") % 1000 + 1).cast("decimal(12,2)").alias("Valor"),
    )


def hot_units(spark):
    return spark.range(0, 500).select(
        F.col("id").alias("unidadFuncionalID"), F.lpad(F.col("id").cast("string"), 22, "0").alias("CBU_CVU")
    )


def test_hot_account_is_split(spark, small_splits, tmp_path):
    matched = match_payments(hot_lines(spark), hot_units(spark))
    matched.write.parquet(str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == ROWS
    assert back.where("not asociado").count() == 0
    frame = match_payments(hot_lines(spark), hot_units(spark))
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Join\(skew=true\)", plan), plan


def final_plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def test_hot_target_of_an_update_is_split(spark, small_splits):
    """The source is grouped by the join keys, which alone would prevent the split."""
    from vecindad.operators.changes import update_from_join

    target = spark.range(0, ROWS, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("k"),
        "id",
        F.lit(None).cast("bigint").alias("doc"),
    )
    source = spark.range(0, 5000, 1, 4).select(F.col("id").alias("k"), F.col("id").alias("d"))
    changed = update_from_join(target, source.unionByName(source), ["k"], {"doc": "d"})
    assert "skew=true" in final_plan(changed)
    assert changed.where("doc = k").count() == ROWS


def test_hot_pairs_are_counted_not_listed(spark):
    lines = hot_lines(spark)
    matched = match_payments(lines, hot_units(spark))
    detail = detail_lines(lines, matched)
    hot = detail.where("cuentaOrigen like '%011' and importe = 500 and fechaPago = '2025-04-01'")
    (row,) = hot.collect()
    third = ROWS // 3
    assert row.copias >= third * third  # 400 million pairs in one row
    assert detail.count() <= ROWS
    sums = rows_of(paid_by_account(collected(detail)).where("_cuenta like '%011'"), "pagos")
    assert sums[0][0] >= D(500) * third * third


def unit_rows(spark, count):
    """Units with a third of them in building 1."""
    return spark.range(0, count, 1, 4).select(
        F.col("id").alias("unidadFuncionalID"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 4 + 2).cast("bigint").alias("consorcioID"),
        F.lit("1").alias("piso"),
        F.lit("A").alias("departamento"),
        F.lit(10).cast("decimal(6,2)").alias("superficieM2"),
        F.lit(0).cast("smallint").alias("cochera"),
        F.lit(0).cast("smallint").alias("baulera"),
        F.lpad(F.col("id").cast("string"), 22, "0").alias("CBU_CVU"),
        F.lit(0.05).cast("decimal(4,2)").alias("coeficiente"),
    )


def test_hot_building_is_split(spark, small_splits):
    """Without a known document count nothing is broadcast."""
    from vecindad.operators.history import account_history
    from vecindad.operators.payments import paid_by_unit

    documents = spark.range(1, 200).select(
        F.col("id").alias("consorcioID"), F.lit(24300).alias("periodo"), F.col("id").alias("documentoID"),
        F.lit(100).cast("decimal(18,2)").alias("expOrdinarias"),
        F.lit(0).cast("decimal(18,2)").alias("expExtraordinarias"),
    )
    units = unit_rows(spark, 30_000).withColumn(
        "consorcioID", F.when(F.col("consorcioID") == 1, 1).otherwise(F.col("unidadFuncionalID") % 199 + 1)
    )
    lines = collected(ledger(spark)["Detalle_CSV"])
    rows = account_history(units, documents, paid_by_account(lines), paid_by_unit(lines))
    assert "skew=true" in final_plan(rows)
    assert rows.count() == 30_000


def test_hot_building_and_history(spark):
    """A third of all units in one building: every unit has its row for every month."""
    from vecindad.plans.charges import charge_history

    t = ledger(spark)
    units = unit_rows(spark, 3000)
    rows = charge_history({**t, "Unidad_Funcional": units}, (2025, 1), (2025, 6))["Estado_Cuentas"]
    assert rows.count() == 3000 * 6
    assert rows.select("unidadFuncionalID", "anio", "mes").distinct().count() == 3000 * 6


def test_hot_copies_combine_before_the_shuffle(spark):
    frame = spark.range(0, ROWS, 1, 8).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.lit("x").alias("v")
    )
    picked = one_row_per_key(frame, ["k"])
    assert picked.count() == ROWS - ROWS // 3 + 1
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
