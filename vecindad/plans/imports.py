"""Import jobs: from staged text rows to rows of the stored tables.

Each job takes the staged frame and the stored tables it depends on and returns
the rows to add (or the changed table).  Nothing is written here, except by the
``store_*`` jobs.  Text is compared without regard to case and trailing blanks.

Rows that the stored tables could not hold (a required value is missing or cannot
be read) are not silently dropped: ``rejected_*`` returns them, and the ``store_*``
jobs keep them under ``Rechazados`` before anything else is written.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vecindad.functions.amounts import decimal_comma
from vecindad.functions.dates import month_index
from vecindad.functions.text import comparable, pad_id, surrogate, yes_flag
from vecindad.operators.changes import insert_if_missing, one_row_per_key, update_from_join
from vecindad.operators.costs import check_mode
from vecindad.operators.payments import detail_lines, match_payments, typed_lines
from vecindad.schemas import DELIVERY, TABLES
from vecindad.sinks.batches import folder_name, release, replace_batch, stage
from vecindad.sinks.claims import STALE, check_claim, claim, release_claim
from vecindad.sinks.tables import append
from vecindad.sinks.versions import add_rows, change_rows, published
from vecindad.sources.files import LINE, read_buildings, read_payments, read_persons, read_unit_accounts, read_units
from vecindad.sources.tables import read_stored


def _table(frame: DataFrame, name: str) -> DataFrame:
    return frame.select(*TABLES[name].fieldNames())


#: Parts of a repeated key that are numbered apart, and equal rows that are spelled out at once.
KEY_PARTS = 256
COPIES = 1 << 16


def _distinct_ids(frame: DataFrame, name: str) -> DataFrame:
    """Ids of rows whose id repeats: one of them keeps its own, each other gets one of its number.

    The numbers depend on the rows alone.  Equal rows are counted, so a key with very many
    copies is one row; a key with very many different rows is numbered in parts by the hash
    of the rows, each from the sum of the parts before it.
    """
    column = name_of_id(name)
    columns = TABLES[name].fieldNames()
    rest = [c for c in columns if c != column]
    counted = (
        frame.groupBy(*columns)
        .agg(F.count("*").alias("_copias"))
        .withColumn("_parte", F.pmod(F.xxhash64(*rest), F.lit(KEY_PARTS)))
    )
    before = Window.partitionBy(column, "_parte").orderBy(*rest).rowsBetween(Window.unboundedPreceding, -1)
    inside = counted.withColumn("_antes", F.coalesce(F.sum("_copias").over(before), F.lit(0)))
    # At most KEY_PARTS rows of a key.
    parts = counted.groupBy(F.col(column).alias("_id"), F.col("_parte").alias("_de")).agg(F.sum("_copias").alias("_n"))
    earlier = Window.partitionBy("_id").orderBy("_de").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("_desde", F.sum("_n").over(earlier)).where("_desde > 0")
    same = F.col(column).eqNullSafe(F.col("_id")) & (F.col("_parte") == F.col("_de"))
    first = F.col("_antes") + F.coalesce("_desde", F.lit(0))
    placed = inside.join(offsets, same, "left").withColumn("_primero", first)
    chunks = placed.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copias") - 1, F.lit(COPIES).cast("long"))))
    last = F.least(F.col("_k") + COPIES, F.col("_copias")) - 1
    numbered = chunks.withColumn("_k", F.explode(F.sequence("_k", last))).withColumn("_numero", F.col("_primero") + F.col("_k") + 1)
    other = surrogate(F.col(column), F.col("_numero"))
    return numbered.withColumn(column, F.when(F.col("_numero") > 1, other).otherwise(F.col(column)))


def name_of_id(name: str) -> str:
    return TABLES[name].fieldNames()[0]


# --- buildings ----------------------------------------------------------------
def import_buildings(
    staged: DataFrame, buildings: DataFrame | None = None, mode: str = "reference"
) -> DataFrame:
    """New buildings: name, address and surface of every staged row.

    Strict mode takes each name once and leaves out the ones already stored.
    """
    check_mode(mode)
    rows = staged.select(
        F.col("Nombre del consorcio").alias("nombre"),
        F.col("Domicilio").alias("direccion"),
        F.col("m2 totales").try_cast("decimal(6,2)").alias("superficieM2Total"),
    ).withColumn("consorcioID", surrogate(comparable(F.col("nombre"))))
    if mode == "reference":
        return _table(_distinct_ids(rows, "Consorcio"), "Consorcio")
    rows = _table(rows, "Consorcio")
    if mode == "strict":
        rows = one_row_per_key(rows, ["consorcioID"])
        if buildings is not None:
            known = buildings.select(comparable(F.col("nombre")).alias("_nombre"))
            rows = _table(
                insert_if_missing(
                    rows.withColumn("_nombre", comparable(F.col("nombre"))), known, ["_nombre"]
                ),
                "Consorcio",
            )
    return rows


# --- units --------------------------------------------------------------------
def _staged_units(staged: DataFrame, buildings: DataFrame) -> DataFrame:
    names = buildings.select(
        "consorcioID", F.trim(F.upper("nombre")).alias("_nombre")
    )
    placed = staged.withColumn("_nombre", F.trim(F.upper("NombreConsorcio"))).join(names, "_nombre", "left")
    return placed.select(
        surrogate(
            F.col("consorcioID"), comparable(F.col("Piso")), comparable(F.col("Departamento"))
        ).alias("unidadFuncionalID"),
        "consorcioID",
        F.col("Piso").alias("piso"),
        F.col("Departamento").alias("departamento"),
        decimal_comma(F.col("m2_unidad_funcional"), 6, 2).alias("superficieM2"),
        yes_flag(F.col("Cochera")).alias("cochera"),
        yes_flag(F.col("Bauleras")).alias("baulera"),
        F.lit(None).cast("string").alias("CBU_CVU"),
        decimal_comma(F.col("Coeficiente"), 4, 2).alias("coeficiente"),
    )


def _unit_complete():
    required = ("consorcioID", "piso", "departamento", "superficieM2", "coeficiente")
    return ~F.array_contains(F.array(*[F.col(c).isNull() for c in required]), True)


def import_units(
    staged: DataFrame, buildings: DataFrame, units: DataFrame, mode: str = "reference"
) -> DataFrame:
    """Units whose (building, floor, letter) is not stored yet.

    Strict mode takes a unit repeated inside the file once.
    """
    check_mode(mode)

    def keyed(frame: DataFrame) -> DataFrame:
        return frame.withColumns(
            {"_piso": comparable(F.col("piso")), "_depto": comparable(F.col("departamento"))}
        )

    rows = keyed(_staged_units(staged, buildings).where(_unit_complete()))
    new = insert_if_missing(rows, keyed(units), ["consorcioID", "_piso", "_depto"])
    if mode == "strict":
        new = one_row_per_key(new, ["consorcioID", "_piso", "_depto"])
    else:
        new = _distinct_ids(new, "Unidad_Funcional")
    return _table(new, "Unidad_Funcional")


def rejected_units(staged: DataFrame, buildings: DataFrame) -> DataFrame:
    """Staged units of an unknown building, or that lack a required value or have one that cannot be read."""
    return _staged_units(staged, buildings).where(~_unit_complete())


# --- accounts of units -----------------------------------------------------------
def update_accounts(units: DataFrame, staged: DataFrame, buildings: DataFrame) -> DataFrame:
    """``units`` with the staged account numbers filled in."""
    names = buildings.select("consorcioID", comparable(F.col("nombre")).alias("_nombre"))
    source = (
        staged.withColumn("_nombre", comparable(F.col("NombreConsorcio")))
        .join(names, "_nombre")
        .select(
            "consorcioID",
            comparable(F.col("piso")).alias("_piso"),
            comparable(F.col("departamento")).alias("_depto"),
            F.col("CBU_CVU").alias("_nueva"),
        )
    )
    keyed = units.withColumns(
        {"_piso": comparable(F.col("piso")), "_depto": comparable(F.col("departamento"))}
    )
    changed = update_from_join(
        keyed, source, ["consorcioID", "_piso", "_depto"], {"CBU_CVU": "_nueva"}
    )
    return changed.select(*units.columns)


def rejected_accounts(units: DataFrame, staged: DataFrame, buildings: DataFrame) -> DataFrame:
    """Staged account lines without an account, or of a unit that is not stored."""
    names = buildings.select("consorcioID", comparable(F.col("nombre")).alias("_nombre"))
    known = units.select(
        "consorcioID", comparable(F.col("piso")).alias("_piso"), comparable(F.col("departamento")).alias("_depto")
    )
    keyed = staged.withColumns(
        {
            "_nombre": comparable(F.col("NombreConsorcio")),
            "_piso": comparable(F.col("piso")),
            "_depto": comparable(F.col("departamento")),
        }
    ).join(one_row_per_key(names, ["_nombre"]), "_nombre", "left")
    key = ["consorcioID", "_piso", "_depto"]
    found = known.groupBy(*key).agg(F.lit(True).alias("_hay"))
    return (
        keyed.join(found, key, "left")
        .where(F.col("_hay").isNull() | (F.coalesce(F.trim("CBU_CVU"), F.lit("")) == ""))
        .select(*staged.columns)
    )


# --- persons ------------------------------------------------------------------
def _placed_persons(staged: DataFrame, units: DataFrame) -> DataFrame:
    """Cleaned persons at the units of their account; without one the unit is NULL."""
    accounts = units.where(F.col("CBU_CVU").isNotNull()).select(
        "unidadFuncionalID", comparable(F.col("CBU_CVU")).alias("_cuenta")
    )
    cleaned = staged.select(
        pad_id(F.col("DNI")).alias("DNI"),
        F.trim("Nombre").alias("nombre"),
        F.trim("Apellido").alias("apellido"),
        F.trim("Email").alias("mail"),
        F.trim("Telefono").alias("telefono"),
        F.trim("CBU_CVU").alias("CBU_CVU"),
        comparable(F.col("CBU_CVU")).alias("_cuenta"),
        F.trim("EsInquilino").alias("_inquilino"),
    )
    return cleaned.join(accounts, "_cuenta", "left")


def _person_complete():
    known = F.col("_inquilino").isin("0", "1")
    return F.coalesce(F.col("DNI").isNotNull() & F.col("unidadFuncionalID").isNotNull() & known, F.lit(False))


def _clean_persons(staged: DataFrame, units: DataFrame) -> DataFrame:
    """Persons with a valid identity number and flag, at the units of their account."""
    return _placed_persons(staged, units).where(_person_complete())


def rejected_persons(staged: DataFrame, units: DataFrame) -> DataFrame:
    """Staged persons without a valid identity number or tenant flag, or with an unknown account."""
    return _placed_persons(staged, units).where(~_person_complete()).drop("_cuenta")


def _new_persons(rows: DataFrame, known: DataFrame, mode: str) -> DataFrame:
    if mode == "strict":
        key = ["DNI", "unidadFuncionalID"]
        return one_row_per_key(insert_if_missing(rows, known, key), key)
    return insert_if_missing(rows, known, ["DNI"])


def import_owners(
    staged: DataFrame, units: DataFrame, owners: DataFrame, mode: str = "reference"
) -> DataFrame:
    """New owners.  Reference mode knows a person by identity number alone, strict
    mode by number and unit (and takes a repeated one once)."""
    check_mode(mode)
    rows = _clean_persons(staged, units).where(F.col("_inquilino") == "0")
    rows = rows.withColumns(
        {
            "IDPropietario": surrogate(F.col("DNI"), F.col("unidadFuncionalID")),
            "modoEntrega": F.lit(DELIVERY[0]),
        }
    )
    return _new_persons(_table(rows, "Propietario"), owners, mode)


def import_tenants(
    staged: DataFrame, units: DataFrame, tenants: DataFrame, mode: str = "reference"
) -> DataFrame:
    check_mode(mode)
    rows = _clean_persons(staged, units).where(F.col("_inquilino") == "1")
    return _new_persons(_table(rows, "Inquilino"), tenants, mode)


# --- payments -----------------------------------------------------------------
def not_yet_imported(staged: DataFrame, registry: DataFrame) -> DataFrame:
    """Lines of files whose name is not in the registry."""
    known = registry.select(comparable(F.col("nombreArchivo")).alias("_archivo"))
    named = staged.withColumn("_archivo", comparable(F.col("nombreArchivo")))
    return named.join(known, "_archivo", "left_anti").drop("_archivo")


def registry_rows(staged: DataFrame, file_date: dt.date | None = None) -> DataFrame:
    """One registry row per file; the file date defaults to today."""
    day = F.coalesce(F.lit(file_date).cast("date"), F.current_date())
    files = staged.groupBy("nombreArchivo").agg(F.count("*").alias("_lineas"))
    return files.select(
        import_id().alias("importacionID"),
        F.current_date().alias("fechaImportacion"),
        "nombreArchivo",
        day.alias("fechaCSV"),
    )


def import_id():
    return surrogate(comparable(F.col("nombreArchivo")))


def import_payments(
    staged: DataFrame,
    units: DataFrame,
    registry: DataFrame,
    stored: DataFrame | None = None,
    file_date: dt.date | None = None,
    mode: str = "reference",
) -> dict[str, DataFrame]:
    """Payments, detail lines, registry rows and rejected lines of new files.

    ``staged`` carries the file name of each line.  ``stored`` are the payments
    of earlier imports, which reference mode matches again (see
    ``operators.payments``).  Lines without a readable amount are rejected, and
    so are lines without a readable date, which give a payment but no detail, and
    lines read from a file that end before their amount.
    """
    check_mode(mode)
    lines = new_lines(staged, registry)
    matched = match_payments(lines.where(_readable()), units)
    return {
        "Pago": _table(matched, "Pago"),
        "Detalle_CSV": detail_lines(lines.where(_readable()), matched, stored, mode),
        "CSV_Importado": registry_rows(lines, file_date),
        "rechazados": rejected_lines(lines),
    }


def new_lines(staged: DataFrame, registry: DataFrame) -> DataFrame:
    """Typed lines of files that are not registered; ``_con_importe`` tells the ones with an amount text."""
    return _typed(not_yet_imported(staged, registry))


def _typed(staged: DataFrame) -> DataFrame:
    return typed_lines(
        staged.withColumns({"importacionID": import_id(), "_con_importe": F.coalesce(F.trim("Valor") != "", F.lit(False))})
    )


def _readable() -> Column:
    return F.col("_con_importe") & F.col("Valor").isNotNull()


def rejected_lines(lines: DataFrame) -> DataFrame:
    """Of ``new_lines``: no readable amount, no readable date, or (read from a file) cut before the amount."""
    unread = F.col("_con_importe") & (F.col("Valor").isNull() | F.col("Fecha").isNull())
    cut = ~F.col("_con_importe") if LINE in lines.columns else F.lit(False)
    return lines.where(unread | cut).drop("_con_importe")


def store_payments(
    spark: SparkSession,
    root: str,
    staged: DataFrame,
    batch: str,
    *,
    file_date: dt.date | None = None,
    mode: str = "reference",
    stale_claim: float = STALE,
) -> None:
    """Adds staged payment lines to the tables stored under ``root``.

    The lines are read, parsed and typed once and matched with the units once, into staged
    folders that all tables are derived from.  The rows of one call lie in the partition ``lote=<batch>`` of each table,
    detail rows by their month first.  It is overwritten: a call that was cut short is
    repeated with the same ``batch`` and leaves no row twice.  Rejected lines are stored
    first and the registry last, so a file only counts as imported when all of its lines
    are in some table; then the staged lines go.

    The files are claimed before they are looked up in the registry, so of two imports at the
    same time one stores a file and the other fails (see ``sinks.claims``); a batch that was
    cut short keeps its claim, for itself to be repeated, until ``stale_claim`` seconds are over.
    """
    check_mode(mode)

    def others(name: str) -> DataFrame:
        stored = read_stored(spark, root, name)
        return stored.where(F.col("lote") != batch).drop("lote")

    def put(rows: DataFrame, name: str) -> None:
        rows.write.mode("overwrite").parquet(f"{root}/{name}/lote={folder_name(batch)}")

    lines = stage(spark, root, batch, "lineas", _typed(staged))
    # One row for each file of the batch.
    names = lines.select(comparable(F.col("nombreArchivo")).alias("n")).where("n is not null").distinct().toLocalIterator()
    held = claim(spark, root, [r.n for r in names], batch, stale_claim)
    lines = not_yet_imported(lines, others("CSV_Importado"))
    good = lines.where(_readable())
    units = read_stored(spark, root, "Unidad_Funcional")
    matched = stage(spark, root, batch, "pagos", match_payments(good, units))
    _store_rejected(rejected_lines(lines), root, "Pago", batch)
    detail = detail_lines(good, matched, others("Pago"), mode)
    replace_batch(spark, detail, f"{root}/Detalle_CSV", month_index(F.col("fechaPago")), batch)
    put(_table(matched, "Pago"), "Pago")
    check_claim(spark, root, held)
    put(registry_rows(lines, file_date), "CSV_Importado")
    release_claim(spark, root, held)
    release(spark, root, batch)


def store_payment_files(
    spark: SparkSession, root: str, path: str | list[str], batch: str, **options
) -> None:
    """``store_payments`` for a file, a folder or a list of files."""
    store_payments(spark, root, read_payments(spark, path), batch, **options)


def _store_rejected(rows: DataFrame, root: str, table: str, batch: str) -> None:
    rows.write.mode("overwrite").parquet(f"{root}/Rechazados/tabla={table}/lote={folder_name(batch)}")


def store_building_file(
    spark: SparkSession, root: str, path: str, mode: str = "reference", again: bool = False
) -> None:
    """Adds the buildings of a file that are not stored yet, by id.

    So a run can be repeated; ``again`` asks for all of them once more in reference mode.
    """
    stored = read_stored(spark, root, "Consorcio")
    new = import_buildings(read_buildings(spark, path), stored, mode)
    if not again:
        new = insert_if_missing(new, stored, ["consorcioID"])
    append(new, f"{root}/Consorcio")


def store_unit_file(spark: SparkSession, root: str, path: str, batch: str, mode: str = "reference") -> None:
    """Adds the units of a file that are not stored yet; units already stored are left alone, so it can be repeated."""
    staged, buildings = read_units(spark, path), read_stored(spark, root, "Consorcio")
    _store_rejected(rejected_units(staged, buildings), root, "Unidad_Funcional", batch)
    new = import_units(staged, buildings, read_stored(spark, root, "Unidad_Funcional"), mode)
    add_rows(spark, root, "Unidad_Funcional", new)


def store_account_file(spark: SparkSession, root: str, path: str, batch: str) -> int:
    """Fills the account numbers of a file in the stored units; runs between units and persons.

    Only buckets of units whose number is another one are written; the result is how many.
    Until the new version is published the old one is read, also after a run that was
    cut short; a file stored again changes nothing.
    """
    staged, buildings = read_unit_accounts(spark, path), read_stored(spark, root, "Consorcio")
    before = published(spark, root, "Unidad_Funcional")
    units = read_stored(spark, root, "Unidad_Funcional")
    _store_rejected(rejected_accounts(units, staged, buildings), root, "Cuenta", batch)
    given = staged.where(F.trim("CBU_CVU") != "")
    changed = update_accounts(units.withColumn("_antes", F.col("CBU_CVU")), given, buildings)
    changed = changed.withColumn("_cambio", ~F.col("CBU_CVU").eqNullSafe(F.col("_antes")))
    return change_rows(spark, root, "Unidad_Funcional", changed, units.columns, before)


def store_person_file(spark: SparkSession, root: str, path: str, batch: str, mode: str = "reference") -> None:
    """Adds the owners and tenants of a file; known persons are left alone, so it can be repeated."""
    staged, units = read_persons(spark, path), read_stored(spark, root, "Unidad_Funcional")
    _store_rejected(rejected_persons(staged, units), root, "Persona", batch)
    for name, job in (("Propietario", import_owners), ("Inquilino", import_tenants)):
        append(job(staged, units, read_stored(spark, root, name), mode), f"{root}/{name}")
