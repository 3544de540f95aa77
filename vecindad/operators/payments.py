"""Payments, their detail lines and what was collected.

The detail of a payment file pairs its lines with stored payments.  In strict
mode every line goes with its own payment.  In reference mode a line goes with
*every* payment of the same account and amount, so n lines and m payments give
n * m detail lines.  Those are never spelled out: equal lines are counted on
each side, and the pair count is kept in ``copias``.  Everything computed from
the detail is a sum or a maximum, so ``importe * copias`` gives the same result
at a size bounded by the distinct (account, amount, day) combinations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecindad.functions.amounts import clean_money
from vecindad.functions.dates import month_index, parse_day_month_year
from vecindad.functions.text import comparable, wide_surrogate
from vecindad.operators.costs import check_mode
from vecindad.schemas import MONEY, TABLES


def typed_lines(staged: DataFrame) -> DataFrame:
    """Payment lines with date and amount; NULL where they cannot be read."""
    kept = [c for c in staged.columns if c not in ("Fecha", "CVU_CBU", "Valor")]
    return staged.select(
        *kept,
        parse_day_month_year(F.col("Fecha")).alias("Fecha"),
        F.trim("CVU_CBU").alias("CVU_CBU"),
        clean_money(F.col("Valor")).alias("Valor"),
    )


def match_payments(lines: DataFrame, units: DataFrame) -> DataFrame:
    """Stored payments from clean lines, each with its unit if the account is known.

    An account shared by several units gives a payment for each of them.
    """
    accounts = units.where(F.col("CBU_CVU").isNotNull()).select(
        "unidadFuncionalID", comparable(F.col("CBU_CVU")).alias("_cuenta")
    )
    joined = lines.withColumn("_cuenta", comparable(F.col("CVU_CBU"))).join(
        accounts, "_cuenta", "left"
    )
    identity = [c for c in ("importacionID", "IdPago") if c in lines.columns]
    return joined.select(
        wide_surrogate(
            *[F.col(c) for c in [*identity, "CVU_CBU", "Fecha", "Valor", "unidadFuncionalID"]]
        ).alias("pagoID"),
        *identity,
        "unidadFuncionalID",
        F.col("CVU_CBU").alias("cuentaOrigen"),
        F.col("Fecha").alias("fechaPago"),
        F.col("Valor").cast("decimal(14,2)").alias("monto"),
        F.col("unidadFuncionalID").isNotNull().alias("asociado"),
    )


def detail_lines(
    lines: DataFrame, matched: DataFrame, stored: DataFrame | None = None, mode: str = "reference"
) -> DataFrame:
    """Detail rows for the ``lines`` of an import.

    ``matched`` is the result of :func:`match_payments` for the same lines,
    ``stored`` the payments of earlier imports (reference mode only).
    """
    check_mode(mode)
    columns = TABLES["Detalle_CSV"].fieldNames()
    if mode == "strict":
        return matched.where(F.col("fechaPago").isNotNull()).select(
            "pagoID",
            "importacionID",
            "unidadFuncionalID",
            "cuentaOrigen",
            "fechaPago",
            F.col("monto").alias("importe"),
            F.lit(1).cast("bigint").alias("copias"),
        )
    shared = ["unidadFuncionalID", "cuentaOrigen", "monto"]
    payments = matched.select(*shared)
    if stored is not None:
        # Of the history only what these lines can go with, before it is counted.
        wanted = lines.where(F.col("Fecha").isNotNull()).select(
            comparable(F.col("CVU_CBU")).alias("_cuenta"),
            F.col("Valor").cast("decimal(14,2)").alias("_importe"),
        )
        same = (comparable(stored["cuentaOrigen"]) == F.col("_cuenta")) & (
            stored["monto"].cast("decimal(14,2)") == F.col("_importe")
        )
        payments = payments.unionByName(stored.join(wanted.distinct(), same, "left_semi").select(*shared))
    payment_counts = payments.groupBy(
        "unidadFuncionalID",
        comparable(F.col("cuentaOrigen")).alias("_cuenta"),
        F.col("monto").cast("decimal(14,2)").alias("importe"),
    ).agg(F.count("*").alias("_pagos"))
    line_counts = (
        lines.where(F.col("Fecha").isNotNull())
        .groupBy(
            "importacionID",
            comparable(F.col("CVU_CBU")).alias("_cuenta"),
            F.col("Valor").cast("decimal(14,2)").alias("importe"),
            F.col("Fecha").alias("fechaPago"),
        )
        .agg(F.count("*").alias("_lineas"), F.min("CVU_CBU").alias("cuentaOrigen"))
    )
    return (
        line_counts.join(payment_counts, ["_cuenta", "importe"])
        .withColumn("copias", F.col("_lineas") * F.col("_pagos"))
        .withColumn("pagoID", F.lit(None).cast("string"))
        .select(*columns)
    )


def payment_lines(detail: DataFrame, payments: DataFrame) -> DataFrame:
    """Detail of separately stored payments: joined on the payment, one row each.

    For tables that keep unit and amount on the payment only.
    """
    lines = detail.groupBy("pagoID", "fechaPago").agg(
        F.sum(F.col("importe") * F.col("copias")).cast(MONEY).alias("importe"),
        F.sum("copias").alias("copias"),
    )
    joined = lines.join(
        payments.select("pagoID", "unidadFuncionalID", "cuentaOrigen", "monto"), "pagoID"
    )
    return joined.select(
        "unidadFuncionalID",
        "cuentaOrigen",
        "fechaPago",
        "importe",
        (F.col("monto") * F.col("copias")).cast(MONEY).alias("monto"),
    )


def collected(detail: DataFrame) -> DataFrame:
    """(unidadFuncionalID, cuentaOrigen, fechaPago, importe, monto) from detail rows.

    Detail rows carry their unit, so no join with the payments is needed; line
    amount and payment amount are equal by construction.
    """
    whole = (F.col("importe") * F.col("copias")).cast(MONEY)
    return detail.select(
        "unidadFuncionalID",
        "cuentaOrigen",
        "fechaPago",
        whole.alias("importe"),
        whole.alias("monto"),
    )


def paid_by_unit(lines: DataFrame) -> DataFrame:
    """Per unit and month: paid by day 10, by day 15, from day 10, after day 10."""
    day, amount = F.dayofmonth("fechaPago"), F.col("monto")
    return (
        lines.where(F.col("unidadFuncionalID").isNotNull())
        .groupBy("unidadFuncionalID", month_index(F.col("fechaPago")).alias("periodo"))
        .agg(
            F.sum(amount).cast(MONEY).alias("pagado"),
            F.sum(F.when(day <= 10, amount)).cast(MONEY).alias("hasta10"),
            F.sum(F.when(day <= 15, amount)).cast(MONEY).alias("hasta15"),
            F.sum(F.when(day >= 10, amount)).cast(MONEY).alias("desde10"),
            F.sum(F.when(day > 10, amount)).cast(MONEY).alias("desde11"),
            F.max("fechaPago").alias("ultimo"),
        )
    )


def paid_by_account(lines: DataFrame) -> DataFrame:
    """Per account and month: amount and last day of payment."""
    return (
        lines.where(F.col("cuentaOrigen").isNotNull())
        .groupBy(
            comparable(F.col("cuentaOrigen")).alias("_cuenta"),
            month_index(F.col("fechaPago")).alias("periodo"),
        )
        .agg(F.sum("monto").cast(MONEY).alias("pagos"), F.max("fechaPago").alias("ultimoPago"))
    )


def paid_by_building(lines: DataFrame, units: DataFrame) -> DataFrame:
    """Per building and month, summed by unit first so the join stays small."""
    by_unit = paid_by_unit(lines)
    sums = ["pagado", "hasta10", "hasta15", "desde10", "desde11"]
    return (
        by_unit.join(units.select("unidadFuncionalID", "consorcioID"), "unidadFuncionalID")
        .groupBy("consorcioID", "periodo")
        .agg(*[F.sum(c).cast(MONEY).alias(c) for c in sums])
    )
