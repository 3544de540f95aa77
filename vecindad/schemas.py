"""Tables of the charge ledger: columns, types and declared rules.

Table names, column names, sizes and allowed values are fixed values of the
data model; files and stored tables use them as they stand.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Balances and totals.  Wider than the declared storage sizes, same two
# decimals, so that sums over very many rows do not overflow.
MONEY = T.DecimalType(18, 2)
TOTAL = T.DecimalType(24, 2)


LONG, INT, SHORT = T.LongType(), T.IntegerType(), T.ShortType()
TEXT, DATE, FLAG = T.StringType(), T.DateType(), T.BooleanType()


def _struct(columns: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# --- fixed values: stored tables -------------------------------------------
TABLES: dict[str, T.StructType] = {
    "Consorcio": _struct(
        {
            "consorcioID": LONG,
            "nombre": TEXT,
            "direccion": TEXT,
            "superficieM2Total": T.DecimalType(6, 2),
        }
    ),
    "Unidad_Funcional": _struct(
        {
            "unidadFuncionalID": LONG,
            "consorcioID": LONG,
            "piso": TEXT,
            "departamento": TEXT,
            "superficieM2": T.DecimalType(6, 2),
            "cochera": SHORT,
            "baulera": SHORT,
            "CBU_CVU": TEXT,
            "coeficiente": T.DecimalType(4, 2),
        }
    ),
    "Propietario": _struct(
        {
            "IDPropietario": LONG,
            "DNI": TEXT,
            "unidadFuncionalID": LONG,
            "nombre": TEXT,
            "apellido": TEXT,
            "mail": TEXT,
            "telefono": TEXT,
            "modoEntrega": TEXT,
            "CBU_CVU": TEXT,
        }
    ),
    "Inquilino": _struct(
        {
            "DNI": TEXT,
            "unidadFuncionalID": LONG,
            "nombre": TEXT,
            "apellido": TEXT,
            "mail": TEXT,
            "telefono": TEXT,
            "CBU_CVU": TEXT,
        }
    ),
    "Expensas": _struct(
        {
            "documentoID": LONG,
            "consorcioID": LONG,
            "mes": INT,
            "anio": INT,
            "fechaGenerado": DATE,
            "fechaEnvio": DATE,
            "medioEnvio": TEXT,
            "aPropietario": FLAG,
            "aInquilino": FLAG,
        }
    ),
    "Estado_Financiero": _struct(
        {
            "documentoID": LONG,
            "consorcioID": LONG,
            "saldoAnterior": T.DecimalType(18, 2),
            "ingresosEnTermino": T.DecimalType(18, 2),
            "ingresosAdeudados": T.DecimalType(18, 2),
            "egresosTotales": T.DecimalType(18, 2),
            "saldoFinal": T.DecimalType(18, 2),
        }
    ),
    "Estado_Cuentas": _struct(
        {
            "documentoID": LONG,
            "unidadFuncionalID": LONG,
            "saldoAnterior": T.DecimalType(18, 2),
            "pagosRecibidos": T.DecimalType(18, 2),
            "saldo": T.DecimalType(18, 2),
            "InteresesPorMora": T.DecimalType(18, 2),
            "expensasOrdinarias": T.DecimalType(18, 2),
            "expensasExtraordinarias": T.DecimalType(18, 2),
            "totalPagar": T.DecimalType(18, 2),
        }
    ),
    "Gasto_Extraordinario": _struct(
        {
            "gastoExtraordinarioID": LONG,
            "documentoID": LONG,
            "consorcioID": LONG,
            "razonSocial": TEXT,
            "fecha": DATE,
            "importeTotal": T.DecimalType(14, 2),
            "formaPago": TEXT,
            "nroCuota": SHORT,
        }
    ),
    "Gasto_Ordinario": _struct(
        {
            "gastoOrdinarioID": LONG,
            "documentoID": LONG,
            "consorcioID": LONG,
            "fecha": DATE,
            "importeTotal": T.DecimalType(14, 2),
        }
    ),
    "Gasto_General": _struct(
        {
            "gastoGeneralID": LONG,
            "gastoOrdinarioID": LONG,
            "tipo": TEXT,
            "empresaoPersona": FLAG,
            "nroFactura": TEXT,
            "importe": T.DecimalType(8, 2),
        }
    ),
    "Servicio_Publico": _struct(
        {
            "servicioPublicoID": LONG,
            "gastoOrdinarioID": LONG,
            "tipo": TEXT,
            "Empresa": TEXT,
            "nroFactura": TEXT,
            "importe": T.DecimalType(8, 2),
        }
    ),
    "Servicio_Limpieza": _struct(
        {
            "servicioLimpiezaID": LONG,
            "gastoOrdinarioID": LONG,
            "modalidad": TEXT,
            "nombre": TEXT,
            "importe": T.DecimalType(8, 2),
            "nroFactura": TEXT,
        }
    ),
    "Pago": _struct(
        {
            "pagoID": TEXT,
            "unidadFuncionalID": LONG,
            "cuentaOrigen": TEXT,
            "monto": T.DecimalType(14, 2),
            "asociado": FLAG,
        }
    ),
    "CSV_Importado": _struct(
        {
            "importacionID": LONG,
            "fechaImportacion": DATE,
            "nombreArchivo": TEXT,
            "fechaCSV": DATE,
        }
    ),
    # copias: how many equal detail lines the row stands for (see operators.payments)
    "Detalle_CSV": _struct(
        {
            "pagoID": TEXT,
            "importacionID": LONG,
            "unidadFuncionalID": LONG,
            "cuentaOrigen": TEXT,
            "fechaPago": DATE,
            "importe": T.DecimalType(14, 2),
            "copias": LONG,
        }
    ),
    "Cuota_Gasto": _struct(
        {
            "cuotaID": LONG,
            "gastoExtraordinarioID": LONG,
            "nroCuota": SHORT,
            "totalCuota": T.DecimalType(14, 2),
            "importeCuota": T.DecimalType(14, 2),
        }
    ),
}

# --- fixed values: input files ----------------------------------------------
FILES: dict[str, T.StructType] = {
    "buildings": _struct(
        {
            "Consorcio": TEXT,
            "Nombre del consorcio": TEXT,
            "Domicilio": TEXT,
            "Cant unidades funcionales": INT,
            "m2 totales": T.DecimalType(10, 2),
        }
    ),
    "units": _struct(
        {
            "NombreConsorcio": TEXT,
            "nroUnidadFuncional": INT,
            "Piso": TEXT,
            "Departamento": TEXT,
            "Coeficiente": TEXT,
            "m2_unidad_funcional": TEXT,
            "Bauleras": TEXT,
            "Cochera": TEXT,
            "m2_baulera": TEXT,
            "m2_cochera": TEXT,
        }
    ),
    "unit_accounts": _struct(
        {
            "CBU_CVU": TEXT,
            "NombreConsorcio": TEXT,
            "nroUnidadFuncional": INT,
            "piso": TEXT,
            "departamento": TEXT,
        }
    ),
    "persons": _struct(
        {
            "Nombre": TEXT,
            "Apellido": TEXT,
            "DNI": TEXT,
            "Email": TEXT,
            "Telefono": TEXT,
            "CBU_CVU": TEXT,
            "EsInquilino": TEXT,
        }
    ),
    "payments": _struct(
        {
            "IdPago": INT,
            "Fecha": TEXT,
            "CVU_CBU": TEXT,
            "Valor": TEXT,
        }
    ),
}


@dataclass(frozen=True)
class Rules:
    """Declared rules of one table, checked by ``operators.quality``."""

    key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()  # further keys; rows with a NULL in one are not compared
    parents: dict[str, tuple[str, str]] = field(default_factory=dict)  # column -> (table, key)
    required: tuple[str, ...] = ()
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)
    between: dict[str, tuple[int, int]] = field(default_factory=dict)
    digits: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    fits: dict[str, tuple[int, int]] = field(default_factory=dict)  # column -> (precision, scale)


# --- fixed values: declared rules --------------------------------------------
DELIVERY = ("Mail", "Whatsapp", "Fisico")

RULES: dict[str, Rules] = {
    "Consorcio": Rules(
        key=("consorcioID",),
        unique=(("nombre",),),
        required=("nombre", "direccion", "superficieM2Total"),
        max_length={"nombre": 100, "direccion": 100},
        fits={"superficieM2Total": (6, 2)},
    ),
    "Unidad_Funcional": Rules(
        key=("unidadFuncionalID",),
        unique=(("CBU_CVU",), ("consorcioID", "piso", "departamento")),
        parents={"consorcioID": ("Consorcio", "consorcioID")},
        required=("consorcioID", "piso", "departamento", "superficieM2", "coeficiente"),
        max_length={"piso": 2, "departamento": 1, "CBU_CVU": 22},
        fits={"superficieM2": (6, 2), "coeficiente": (4, 2)},
    ),
    "Propietario": Rules(
        key=("IDPropietario",),
        parents={"unidadFuncionalID": ("Unidad_Funcional", "unidadFuncionalID")},
        required=("DNI", "nombre", "apellido", "modoEntrega"),
        allowed={"modoEntrega": DELIVERY},
        digits=("DNI",),
        max_length={
            "DNI": 8, "nombre": 100, "apellido": 100, "mail": 200, "telefono": 20,
            "modoEntrega": 8, "CBU_CVU": 22,
        },
    ),
    "Inquilino": Rules(
        key=("DNI", "unidadFuncionalID"),
        parents={"unidadFuncionalID": ("Unidad_Funcional", "unidadFuncionalID")},
        required=("DNI", "unidadFuncionalID", "nombre", "apellido"),
        digits=("DNI",),
        max_length={
            "DNI": 8, "nombre": 100, "apellido": 100, "mail": 100, "telefono": 20, "CBU_CVU": 22,
        },
    ),
    "Expensas": Rules(
        key=("documentoID",),
        parents={"consorcioID": ("Consorcio", "consorcioID")},
        required=(
            "consorcioID", "mes", "anio", "fechaGenerado", "fechaEnvio", "medioEnvio",
            "aPropietario", "aInquilino",
        ),
        allowed={"medioEnvio": DELIVERY},
        between={"mes": (1, 12)},
        max_length={"medioEnvio": 10},
    ),
    "Estado_Financiero": Rules(
        key=("documentoID",),
        parents={"documentoID": ("Expensas", "documentoID")},
        required=("documentoID",),
        fits={
            "saldoAnterior": (14, 2), "ingresosEnTermino": (14, 2), "ingresosAdeudados": (14, 2),
            "egresosTotales": (14, 2), "saldoFinal": (14, 2),
        },
    ),
    "Estado_Cuentas": Rules(
        key=("documentoID", "unidadFuncionalID"),
        parents={
            "documentoID": ("Expensas", "documentoID"),
            "unidadFuncionalID": ("Unidad_Funcional", "unidadFuncionalID"),
        },
        required=("documentoID",),
        fits={
            "saldoAnterior": (14, 2), "pagosRecibidos": (14, 2), "saldo": (14, 2),
            "InteresesPorMora": (14, 2), "expensasOrdinarias": (14, 2),
            "expensasExtraordinarias": (14, 2), "totalPagar": (14, 2),
        },
    ),
    "Gasto_Extraordinario": Rules(
        key=("gastoExtraordinarioID",),
        parents={
            "documentoID": ("Expensas", "documentoID"),
            "consorcioID": ("Consorcio", "consorcioID"),
        },
        required=("razonSocial", "fecha", "importeTotal", "formaPago", "nroCuota"),
        allowed={"formaPago": ("TOTAL", "CUOTAS")},
        between={"nroCuota": (0, 255)},
        max_length={"razonSocial": 200, "formaPago": 6},
    ),
    "Gasto_Ordinario": Rules(
        key=("gastoOrdinarioID",),
        parents={
            "documentoID": ("Expensas", "documentoID"),
            "consorcioID": ("Consorcio", "consorcioID"),
        },
        required=("consorcioID", "fecha", "importeTotal"),
    ),
    "Gasto_General": Rules(
        key=("gastoGeneralID",),
        parents={"gastoOrdinarioID": ("Gasto_Ordinario", "gastoOrdinarioID")},
        required=("gastoOrdinarioID", "tipo", "importe"),
        allowed={"tipo": ("BANCARIOS", "ADMINISTRACION", "SEGUROS", "GASTOS GENERALES")},
        max_length={"tipo": 27, "nroFactura": 20},
    ),
    "Servicio_Publico": Rules(
        key=("servicioPublicoID",),
        parents={"gastoOrdinarioID": ("Gasto_Ordinario", "gastoOrdinarioID")},
        required=("gastoOrdinarioID", "tipo", "importe"),
        allowed={
            "tipo": (
                "SERVICIOS PUBLICOS-Agua", "SERVICIOS PUBLICOS-Luz", "SERVICIOS PUBLICOS-Internet",
            )
        },
        max_length={"tipo": 27, "Empresa": 100, "nroFactura": 13},
    ),
    "Servicio_Limpieza": Rules(
        key=("servicioLimpiezaID",),
        parents={"gastoOrdinarioID": ("Gasto_Ordinario", "gastoOrdinarioID")},
        required=("gastoOrdinarioID", "importe"),
        allowed={"modalidad": ("PERSONA", "EMPRESA")},
        max_length={"modalidad": 7, "nombre": 100, "nroFactura": 20},
    ),
    "Pago": Rules(
        key=("pagoID",),
        parents={"unidadFuncionalID": ("Unidad_Funcional", "unidadFuncionalID")},
        required=("monto", "asociado"),
        max_length={"cuentaOrigen": 22},
        fits={"monto": (8, 2)},
    ),
    "CSV_Importado": Rules(
        key=("importacionID",),
        required=("fechaImportacion", "nombreArchivo", "fechaCSV"),
        max_length={"nombreArchivo": 400},
    ),
    "Detalle_CSV": Rules(
        parents={"importacionID": ("CSV_Importado", "importacionID"), "pagoID": ("Pago", "pagoID")},
        required=("importacionID", "fechaPago", "importe"),
        max_length={"cuentaOrigen": 22},
        fits={"importe": (8, 2)},
    ),
}
