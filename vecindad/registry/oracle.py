"""SQL twins of the registered queries, for an independent engine.

Written from the rules, not from the Spark plans: instalments by a range join
over the months, month-to-month state by a recursive query, detail lines by
the full join of lines and payments.
"""

from __future__ import annotations

# --- the test tables as ledger tables ------------------------------------------
COSTS = """
ord AS (
  SELECT CAST(s_nationkey AS BIGINT) AS b, CAST(l_shipdate AS DATE) AS fecha,
         CAST(l_extendedprice AS DECIMAL(14,2)) AS importe
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
ext AS (
  SELECT o_orderkey AS id, CAST(c_nationkey AS BIGINT) AS b, CAST(o_orderdate AS DATE) AS fecha,
         CAST(o_totalprice AS DECIMAL(14,2)) AS importe, o_orderstatus AS estado,
         CASE WHEN o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%'
              THEN 'CUOTAS' ELSE 'TOTAL' END AS forma,
         CAST(o_orderkey % 6 + 1 AS INTEGER) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey),
span AS (
  SELECT min(f) AS lo, max(f) AS hi
  FROM (SELECT CAST(l_shipdate AS DATE) AS f FROM lineitem
        UNION ALL SELECT CAST(o_orderdate AS DATE) FROM orders)),
months AS (
  SELECT CAST(m AS DATE) AS first, last_day(CAST(m AS DATE)) AS last,
         year(m) * 12 + month(m) - 1 AS idx
  FROM (SELECT unnest(generate_series(
          CAST(date_trunc('month', lo) AS TIMESTAMP), CAST(date_trunc('month', hi) AS TIMESTAMP),
          INTERVAL 1 MONTH)) AS m FROM span))"""

# An amount in units of 1e-6, cut after the sixth decimal where it is divided.
MICROS = """CASE forma WHEN 'TOTAL' THEN CAST(importe * 100 AS HUGEINT) * 10000
            ELSE (CAST(importe * 100 AS HUGEINT) * 10000) // n END"""

ACTIVE = {
    "reference": """(year(fecha) * 12 + month(fecha) - 1 = m.idx
        OR (m.first >= fecha AND fecha + to_months(n - 1) >= m.last))""",
    "strict": """(m.idx >= year(fecha) * 12 + month(fecha) - 1 AND m.idx <=
        year(fecha) * 12 + month(fecha) - 1 + CASE forma WHEN 'CUOTAS' THEN n - 1 ELSE 0 END)""",
}


def _two_decimals(micros: str) -> str:
    """Units of 1e-6 (not negative) to a decimal rounded to cents."""
    return f"CAST(CAST((({micros}) + 5000) // 10000 AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2))"


def _totals(mode: str) -> str:
    return f"""{COSTS},
ordt AS (SELECT b, year(fecha) * 12 + month(fecha) - 1 AS idx, sum(importe) AS t
         FROM ord GROUP BY ALL),
extt AS (SELECT b, m.idx, sum({MICROS}) AS t FROM ext JOIN months m ON {ACTIVE[mode]}
         GROUP BY b, m.idx),
tot AS (
  SELECT CAST(n_nationkey AS BIGINT) AS b, n_name AS nombre, m.idx,
         CAST(coalesce(ordt.t, 0) AS DECIMAL(18,2)) AS o,
         coalesce({_two_decimals('extt.t')}, CAST(0 AS DECIMAL(18,2))) AS e
  FROM nation CROSS JOIN months m
  LEFT JOIN ordt ON ordt.b = n_nationkey AND ordt.idx = m.idx
  LEFT JOIN extt ON extt.b = n_nationkey AND extt.idx = m.idx)"""


def _cost_totals(mode: str) -> str:
    return f"""WITH {_totals(mode)}
SELECT b AS consorcioID, nombre AS consorcio, CAST(idx % 12 + 1 AS INTEGER) AS mes,
       CAST(idx // 12 AS INTEGER) AS anio, o AS "expOrdinarias", e AS "expExtraordinarias",
       CAST(o + e AS DECIMAL(18,2)) AS "totalGeneral"
FROM tot"""


def _schedule(mode: str) -> str:
    """Months go on past the span, as far as the last instalment can reach."""
    longer = COSTS.replace("CAST(date_trunc('month', hi) AS TIMESTAMP)", "hi + INTERVAL 12 MONTH")
    return f"""WITH {longer}
SELECT id AS "gastoExtraordinarioID", b AS "consorcioID", CAST(m.idx // 12 AS INTEGER) AS anio,
       CAST(m.idx % 12 + 1 AS INTEGER) AS mes,
       CAST(CAST({MICROS} AS DECIMAL(18,0)) * 0.000001 AS DECIMAL(18,6)) AS cuota
FROM ext JOIN months m ON {ACTIVE[mode]}"""


# --- reports --------------------------------------------------------------------
def _week(date: str) -> str:
    return (
        f"CAST((dayofyear({date}) - 1 + dayofweek(date_trunc('year', {date}))) // 7 + 1"
        " AS INTEGER)"
    )


_WEEKLY = f"""WITH {COSTS},
o AS (SELECT b, CAST(year(fecha) AS INTEGER) AS anio, {_week('fecha')} AS semana, sum(importe) AS t
      FROM ord GROUP BY ALL),
e AS (SELECT b, CAST(year(fecha) AS INTEGER) AS anio, {_week('fecha')} AS semana, sum(importe) AS t
      FROM ext GROUP BY ALL),
u AS (SELECT coalesce(o.b, e.b) AS b, coalesce(o.anio, e.anio) AS anio,
             coalesce(o.semana, e.semana) AS semana,
             CAST(coalesce(o.t, 0) AS DECIMAL(24,2)) AS ordinario,
             CAST(coalesce(e.t, 0) AS DECIMAL(24,2)) AS extra
      FROM o FULL JOIN e ON o.b = e.b AND o.anio = e.anio AND o.semana = e.semana),
flujo AS (
  SELECT anio AS "Anio", semana AS "Semana", b AS "consorcioID", n_name AS "Consorcio",
         ordinario AS "TotalOrdinarios", extra AS "TotalExtraordinarios",
         CAST(ordinario + extra AS DECIMAL(24,2)) AS "TotalGeneral",
         CAST(sum(ordinario + extra) OVER (PARTITION BY b, anio ORDER BY semana
              ROWS UNBOUNDED PRECEDING) AS DECIMAL(24,2)) AS "Acumulado"
  FROM u JOIN nation ON n_nationkey = b)
"""

_WEEKLY_PART = (
    _WEEKLY.replace(
        "AND o.semana = e.semana)",
        "AND o.semana = e.semana WHERE coalesce(o.b, e.b) = 7 AND coalesce(o.anio, e.anio) = 1996"
        " AND coalesce(o.semana, e.semana) BETWEEN 5 AND 40)",
    )
    + " SELECT * FROM flujo"
)

_MONTH_NAMES = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto",
    "Septiembre", "Octubre", "Noviembre", "Diciembre",
)

_PIVOT = f"""
SELECT n_name AS "Consorcio",
       rpad(CAST(c_custkey % 40 AS VARCHAR), 2, ' ')
         || substr('ABCDEF', CAST((c_custkey % 240) // 40 + 1 AS BIGINT), 1) AS "UnidadFuncional",
       CAST(year(o_orderdate) AS INTEGER) AS "Anio",
       {", ".join(
           f'''CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(14,2)))
               FILTER (WHERE month(o_orderdate) = {i}), 0) AS DECIMAL(18,2)) AS "{name}"'''
           for i, name in enumerate(_MONTH_NAMES, start=1))},
       CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DECIMAL(18,2)) AS "TotalAnual"
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY 1, 2, 3"""

_TOP = f"""WITH {COSTS},
gasto AS (
  SELECT CAST(year(fecha) AS INTEGER) AS a, CAST(month(fecha) AS INTEGER) AS m,
         CAST(sum(importe) AS DECIMAL(24,2)) AS t
  FROM (SELECT fecha, importe FROM ord UNION ALL SELECT fecha, importe FROM ext) GROUP BY 1, 2),
ingreso AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS a, CAST(month(o_orderdate) AS INTEGER) AS m,
         CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DECIMAL(24,2)) AS t
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2)
SELECT * FROM (SELECT a AS "Anio", m AS "Mes", t AS "Monto", 'Gasto' AS "Tipo"
               FROM gasto ORDER BY t DESC, a, m LIMIT 5)
UNION ALL
SELECT * FROM (SELECT a AS "Anio", m AS "Mes", t AS "Monto", 'Ingreso' AS "Tipo"
               FROM ingreso ORDER BY t DESC, a, m LIMIT 5)"""

_PIVOT_PART = 'SELECT * EXCLUDE ("Anio") FROM ({})'.format(
    _PIVOT.replace("GROUP BY 1, 2, 3", "WHERE year(o_orderdate) = 1997 AND n_nationkey = 7 GROUP BY 1, 2, 3")
)

_TOP_PART = _TOP.replace(
    "UNION ALL SELECT fecha, importe FROM ext) GROUP BY 1, 2)",
    "WHERE b = 7 UNION ALL SELECT fecha, importe FROM ext WHERE b = 7)"
    " WHERE year(fecha) BETWEEN 1996 AND 1998 GROUP BY 1, 2)",
).replace(
    "  GROUP BY 1, 2)\nSELECT * FROM (SELECT a",
    "  WHERE n_nationkey = 7 AND year(o_orderdate) BETWEEN 1996 AND 1998 GROUP BY 1, 2)\nSELECT * FROM (SELECT a",
)

# --- monthly charges --------------------------------------------------------------
_EARLY = """
early AS (SELECT DISTINCT b, year(fecha) * 12 + month(fecha) - 1 AS idx
          FROM ext WHERE forma = 'CUOTAS' AND estado = 'F')"""

_DOCUMENTS = f"""WITH {COSTS}, {_EARLY}
SELECT CAST(n_nationkey AS BIGINT) AS "consorcioID", CAST(m.idx % 12 + 1 AS INTEGER) AS mes,
       CAST(m.idx // 12 AS INTEGER) AS anio, 'Mail' AS "medioEnvio", true AS "aPropietario",
       false AS "aInquilino"
FROM nation CROSS JOIN months m
WHERE NOT EXISTS (SELECT 1 FROM early WHERE early.b = n_nationkey AND early.idx = m.idx)"""

_LINK = f"""WITH {COSTS}, {_EARLY}
SELECT id AS "gastoExtraordinarioID",
       CASE WHEN estado = 'F' THEN CAST(-1 AS BIGINT)
            ELSE CAST(early.b * 100000 + early.idx AS BIGINT) END AS "documentoID",
       ext.b AS "consorcioID", fecha
FROM ext LEFT JOIN early ON early.b = ext.b AND early.idx = year(fecha) * 12 + month(fecha) - 1"""


def _interest(previous: str, p10: str, p15: str) -> str:
    charge = f"(({previous} - {p10}) * 0.02 + ({previous} - {p15}) * 0.05)"
    return f"(CASE WHEN {previous} > 0 AND {charge} > 0 THEN {charge} ELSE 0 END)"


_PAID = """
pay AS (
  SELECT o_custkey AS u, year(o_orderdate) * 12 + month(o_orderdate) - 1 AS idx,
         CAST(sum(x) AS DECIMAL(18,2)) AS pagos,
         CAST(coalesce(sum(x) FILTER (WHERE day(o_orderdate) <= 10), 0) AS DECIMAL(18,2)) AS p10,
         CAST(coalesce(sum(x) FILTER (WHERE day(o_orderdate) <= 15), 0) AS DECIMAL(18,2)) AS p15,
         CAST(coalesce(sum(x) FILTER (WHERE day(o_orderdate) >= 10), 0) AS DECIMAL(18,2)) AS d10,
         CAST(coalesce(sum(x) FILTER (WHERE day(o_orderdate) > 10), 0) AS DECIMAL(18,2)) AS d11,
         CAST(max(o_orderdate) AS DATE) AS ultimo
  FROM (SELECT o_custkey, o_orderdate, CAST(o_totalprice AS DECIMAL(14,2)) AS x FROM orders)
  GROUP BY ALL)"""


def _position(mode: str) -> str:
    overdue = "d10" if mode == "reference" else "d11"
    interest = _interest("p.egresos", "c.p10", "c.p15")
    return f"""WITH RECURSIVE {_totals(mode)}, {_PAID},
bpay AS (SELECT CAST(c_nationkey AS BIGINT) AS b, idx, sum(p10) AS p10, sum(p15) AS p15,
                sum({overdue}) AS d FROM pay JOIN customer ON c_custkey = u GROUP BY ALL),
cells AS (
  SELECT tot.b, tot.idx, CAST(o + e AS DECIMAL(18,2)) AS egresos,
         CAST(coalesce(p10, 0) AS DECIMAL(18,2)) AS p10,
         CAST(coalesce(p15, 0) AS DECIMAL(18,2)) AS p15,
         CAST(coalesce(d, 0) AS DECIMAL(18,2)) AS d
  FROM tot LEFT JOIN bpay ON bpay.b = tot.b AND bpay.idx = tot.idx - 1),
pos AS (
  SELECT b, idx, CAST(0 AS DECIMAL(18,2)) AS anterior, p10 AS termino, d AS adeudado, egresos,
         CAST(p10 - egresos AS DECIMAL(18,2)) AS saldo
  FROM cells WHERE idx = (SELECT min(idx) FROM months)
  UNION ALL
  SELECT c.b, c.idx, p.saldo, c.p10, c.d, c.egresos,
         CAST(p.saldo + c.p10 + {interest} - c.egresos AS DECIMAL(18,2))
  FROM pos p JOIN cells c ON c.b = p.b AND c.idx = p.idx + 1)
SELECT b AS "consorcioID", CAST(b * 100000 + idx AS BIGINT) AS "documentoID",
       anterior AS "saldoAnterior", termino AS "ingresosEnTermino",
       adeudado AS "ingresosAdeudados", egresos AS "egresosTotales", saldo AS "saldoFinal",
       CAST(idx // 12 AS INTEGER) AS anio, CAST(idx % 12 + 1 AS INTEGER) AS mes
FROM pos"""


_POLICY = {
    # (interest column, balance sign, total), with a = month before, c = inputs of the month
    "partial_payment": (
        _interest("a.total", "c.p10", "c.p15"),
        "-",
        _interest("a.total", "c.p10", "c.p15") + " + c.so + c.se + a.total - c.pagos",
    ),
    "last_payment": (
        "(CASE WHEN c.ultimo IS NULL OR day(c.ultimo) > 10 THEN a.total * 0.02 ELSE 0 END"
        " + CASE WHEN c.ultimo IS NULL OR day(c.ultimo) > 15 THEN a.total * 0.05 ELSE 0 END)",
        "",
        "greatest(0, a.total - c.pagos + CASE WHEN c.ultimo IS NULL"
        " THEN a.total * 0.02 + a.saldo * 0.05 ELSE 0 END + c.so + c.se)",
    ),
    "flat": (
        "(a.total * 0.02 + a.saldo * 0.05)",
        "",
        "a.total - c.pagos + a.total * 0.02 + a.saldo * 0.05 + c.o + c.e",
    ),
}


def _accounts_cte(policy: str) -> str:
    interest, sign, total = _POLICY[policy]
    start = "so + se - pagos" if policy != "flat" else "o + e - pagos"
    if policy == "last_payment":
        start = f"greatest(0, {start})"
    return f"""{_totals('reference')}, {_PAID},
cells AS (
  SELECT c_custkey AS u, tot.b, tot.idx, o, e, ultimo,
         CAST(o * c * 0.01 AS DECIMAL(26,6)) AS so, CAST(e * c * 0.01 AS DECIMAL(26,6)) AS se,
         coalesce(pagos, CAST(0 AS DECIMAL(18,2))) AS pagos,
         coalesce(p10, CAST(0 AS DECIMAL(18,2))) AS p10,
         coalesce(p15, CAST(0 AS DECIMAL(18,2))) AS p15
  FROM (SELECT c_custkey, c_nationkey,
               CAST((c_custkey % 16 + 1) * 0.25 AS DECIMAL(4,2)) AS c FROM customer)
  JOIN tot ON tot.b = c_nationkey
  LEFT JOIN pay ON pay.u = c_custkey AND pay.idx = tot.idx - 1),
acc AS (
  SELECT u, b, idx, CAST(0 AS DECIMAL(18,2)) AS anterior, pagos,
         CAST({"" if sign else "-"}pagos AS DECIMAL(18,2)) AS saldo,
         CAST(0 AS DECIMAL(18,2)) AS mora,
         CAST(so AS DECIMAL(18,2)) AS so, CAST(se AS DECIMAL(18,2)) AS se,
         CAST({start} AS DECIMAL(18,2)) AS total
  FROM cells WHERE idx = (SELECT min(idx) FROM months)
  UNION ALL
  SELECT c.u, c.b, c.idx, a.total, c.pagos, CAST({sign}(a.total - c.pagos) AS DECIMAL(18,2)),
         CAST({interest} AS DECIMAL(18,2)),
         CAST(c.so AS DECIMAL(18,2)), CAST(c.se AS DECIMAL(18,2)),
         CAST({total} AS DECIMAL(18,2))
  FROM acc a JOIN cells c ON c.u = a.u AND c.idx = a.idx + 1)"""


def _accounts(policy: str) -> str:
    return f"""WITH RECURSIVE {_accounts_cte(policy)}
SELECT u AS "unidadFuncionalID", b AS "consorcioID",
       CAST(b * 100000 + idx AS BIGINT) AS "documentoID", anterior AS "saldoAnterior",
       pagos AS "pagosRecibidos", saldo, mora AS "InteresesPorMora", so AS "expensasOrdinarias",
       se AS "expensasExtraordinarias", total AS "totalPagar",
       CAST(idx // 12 AS INTEGER) AS anio, CAST(idx % 12 + 1 AS INTEGER) AS mes
FROM acc"""


_STATEMENT = f"""WITH RECURSIVE {_accounts_cte('partial_payment')},
owner AS (
  SELECT c_custkey AS u, c_name || ' Titular' AS propietario FROM customer
  WHERE c_mktsegment <> 'FURNITURE'
  UNION ALL
  SELECT c_custkey, c_name || ' Socio' FROM customer WHERE c_mktsegment = 'HOUSEHOLD'),
statement AS (
  SELECT CAST(idx // 12 AS INTEGER) AS anio, CAST(idx % 12 + 1 AS INTEGER) AS mes, acc.u AS uf,
         CAST((c_custkey % 16 + 1) * 0.25 AS DECIMAL(4,2)) AS "Porcentaje",
         rpad(CAST(c_custkey % 40 AS VARCHAR), 2, ' ') || '-'
           || substr('ABCDEF', CAST((c_custkey % 240) // 40 + 1 AS BIGINT), 1) AS "PisoDepto",
         propietario AS "Propietario", anterior AS "SaldoAnterior", pagos AS "PagosRecibidos",
         saldo AS "SaldoAFavor", mora AS "InteresMora", so AS "ExpensasOrdinarias",
         CAST(CASE WHEN c_acctbal >= 5000 THEN 1 ELSE 0 END AS SMALLINT) AS "Cocheras",
         se AS "ExpensasExtraordinarias", total AS "TotalPagar"
  FROM acc JOIN owner ON owner.u = acc.u JOIN customer ON c_custkey = acc.u)
"""

_STATEMENT_FIELDS = (
    "uf", "Porcentaje", "PisoDepto", "Propietario", "SaldoAnterior", "PagosRecibidos",
    "SaldoAFavor", "InteresMora", "ExpensasOrdinarias", "Cocheras", "ExpensasExtraordinarias",
    "TotalPagar",
)


def _xml_lines(fields: tuple[str, ...]) -> str:
    return " || ".join(
        f"""'    <{name}>' || CAST("{name}" AS VARCHAR) || '</{name}>' || chr(10)"""
        for name in fields
    )


_STATEMENT_XML = f"""{_STATEMENT}
SELECT anio, mes, uf, "Propietario",
       '<Expensa>' || chr(10) || {_xml_lines(_STATEMENT_FIELDS)} || '</Expensa>' AS xml
FROM statement"""

_WEEKLY_XML = f"""{_WEEKLY}
SELECT "Anio", "Semana", "Consorcio",
       '<Semana Anio="' || "Anio" || '" Semana="' || "Semana" || '" Consorcio="' || "Consorcio"
       || '">' || chr(10) || '    <Totales>' || chr(10)
       || '        <Ordinarios>' || "TotalOrdinarios" || '</Ordinarios>' || chr(10)
       || '        <Extraordinarios>' || "TotalExtraordinarios" || '</Extraordinarios>' || chr(10)
       || '        <General>' || "TotalGeneral" || '</General>' || chr(10)
       || '        <Acumulado>' || "Acumulado" || '</Acumulado>' || chr(10)
       || '    </Totales>' || chr(10) || '</Semana>' AS xml
FROM flujo"""

_QUOTAS = f"""WITH {COSTS},
marks AS (
  SELECT b, CASE WHEN forma = 'CUOTAS' THEN CAST(l_extendedprice AS DECIMAL(14,2))
                 ELSE importe END AS x,
         year(fecha) * 12 + month(fecha) - 1 AS own,
         CASE WHEN l_linenumber IS NOT NULL THEN year(fecha) * 12 + month(fecha) - 1
              + CAST(l_linenumber AS INTEGER) END AS due
  FROM ext LEFT JOIN lineitem ON l_orderkey = id),
charged AS (SELECT b, x, own AS idx FROM marks
            UNION ALL SELECT b, x, due FROM marks WHERE due <> own)
SELECT b AS "consorcioID", CAST(idx // 12 AS INTEGER) AS anio,
       CAST(idx % 12 + 1 AS INTEGER) AS mes, CAST(sum(x) AS DECIMAL(18,2)) AS "importeTotal"
FROM charged GROUP BY b, idx"""

# --- payment files ----------------------------------------------------------------
_FILE = """
lines AS (
  SELECT event_id AS id, CAST(ts AS DATE) AS fecha, event_type AS archivo, value,
         lpad(CAST(user_id AS VARCHAR), 22, '0') AS cuenta, CAST(value AS DECIMAL(14,2)) AS valor
  FROM events WHERE event_type <> 'error' AND value >= 1),
good AS (SELECT * FROM lines WHERE value < 200),
accounts AS (SELECT c_custkey AS u, lpad(CAST(c_custkey AS VARCHAR), 22, '0') AS cuenta
             FROM customer WHERE c_acctbal >= 0),
pago AS (SELECT u, good.cuenta, valor, id, archivo, fecha
         FROM good LEFT JOIN accounts ON accounts.cuenta = good.cuenta)"""

_FANOUT = f"""WITH {_FILE}
SELECT u AS "unidadFuncionalID", good.cuenta AS "cuentaOrigen", good.fecha AS "fechaPago",
       good.valor AS importe, count(*) AS copias
FROM good JOIN pago ON pago.cuenta = good.cuenta AND pago.valor = good.valor
GROUP BY good.archivo, u, good.cuenta, good.fecha, good.valor"""

# --- written texts ---------------------------------------------------------------
_WRITTEN = """
pieces AS (
  SELECT l_orderkey, l_linenumber, l_linenumber % 6 AS style, c, c // 100 AS w,
         CAST(c // 100000 AS VARCHAR) AS th, lpad(CAST(c // 100 % 1000 AS VARCHAR), 3, '0') AS rest,
         lpad(CAST(c % 100 AS VARCHAR), 2, '0') AS frac
  FROM (SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * 100 AS BIGINT) AS c FROM lineitem)),
written AS (
  SELECT *, CASE style WHEN 0 THEN th || ',' || rest || '.' || frac
                       WHEN 1 THEN th || '.' || rest || ',' || frac
                       WHEN 2 THEN th || ',' || rest || ',' || frac
                       WHEN 3 THEN th || '.' || rest || '.' || frac
                       WHEN 4 THEN CAST(w AS VARCHAR)
                       ELSE 'x' || th || ',' || rest || '.' || frac END AS texto
  FROM pieces)"""

_STAGED_UNITS = """
su AS (
  SELECT CAST(c_custkey AS INTEGER) AS nro, CAST(n_nationkey AS BIGINT) AS b,
         CAST(c_custkey % 40 AS VARCHAR) AS piso,
         substr('ABCDEF', CAST((c_custkey % 240) // 40 + 1 AS BIGINT), 1) AS depto, c_acctbal,
         CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'SI' WHEN 'FURNITURE' THEN 'si '
              WHEN 'MACHINERY' THEN 'NO' END AS flag,
         abs(CAST(c_acctbal AS DECIMAL(14,2))) AS m2,
         CAST(c_custkey % 4 + 0.25 AS DECIMAL(4,2)) AS coef,
         lpad(CAST(c_custkey AS VARCHAR), 22, '0') AS cuenta
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

_PERSONS = """
sp AS (
  SELECT c_custkey, c_acctbal, c_name, c_mktsegment, lpad(CAST(c_custkey AS VARCHAR), 22, '0') AS cuenta,
         CASE c_custkey % 3
           WHEN 0 THEN '21.' || substr(num, 1, 3) || '.' || substr(num, 4, 3)
           WHEN 1 THEN '9 ' || num
           ELSE 'DNI-' || CAST(c_custkey % 1000 AS VARCHAR) END AS dni,
         CASE c_custkey % 3 WHEN 0 THEN '21' || num WHEN 1 THEN '09' || num END AS documento
  FROM (SELECT *, lpad(CAST(c_custkey * 7 AS VARCHAR), 6, '0') AS num FROM customer))"""


def _people(tenant: bool, extra: str) -> str:
    return f"""WITH {_PERSONS}
SELECT documento AS "DNI", c_custkey AS "unidadFuncionalID", c_name AS nombre,
       c_mktsegment AS apellido, 'a@b.c' AS mail, CAST(c_custkey AS VARCHAR) AS telefono{extra},
       cuenta AS "CBU_CVU"
FROM sp s WHERE documento IS NOT NULL AND c_custkey % 2 = {0 if tenant else 1}
  AND NOT EXISTS (SELECT 1 FROM sp k WHERE k.c_acctbal < 0 AND k.documento = s.documento)"""


def _rule(rule: str, column: str, source: str, condition: str) -> str:
    return f"""SELECT '{rule}' AS regla, CAST({column} AS VARCHAR) AS clave, '{column}' AS detalle,
       count(*) AS filas FROM {source} WHERE {condition} GROUP BY {column}"""


_NAMES = ", ".join(f"'{n.lower()}'" for n in _MONTH_NAMES)

ORACLE: dict[str, str] = {
    "weekly_cash_flow": f"{_WEEKLY} SELECT * FROM flujo",
    "weekly_cash_flow_xml": _WEEKLY_XML,
    "weekly_cash_flow_filtered": _WEEKLY_PART,
    "file_lines_payments": """
SELECT CAST(o_orderkey AS INTEGER) AS "IdPago", strftime(o_orderdate, '%d/%m/%Y') AS "Fecha",
       lpad(CAST(o_custkey AS VARCHAR), 22, '0') AS "CVU_CBU",
       CAST(CAST(floor(o_totalprice) AS BIGINT) || '.'
            || lpad(CAST(CAST(floor(o_totalprice * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0')
            AS DECIMAL(12,2)) AS importe
FROM orders""",
    "file_lines_persons": """
SELECT CASE WHEN c_custkey % 4 = 0 THEN '"' ELSE '' END || c_name AS "Nombre",
       c_mktsegment AS "Apellido", lpad(CAST(c_custkey AS VARCHAR), 8, '1') AS "DNI",
       CAST(NULL AS VARCHAR) AS "Email", CAST(c_custkey AS VARCHAR) AS "Telefono",
       lpad(CAST(c_custkey AS VARCHAR), 22, '0') AS "CBU_CVU", '0' AS "EsInquilino"
FROM customer""",
    "file_lines_units": """
SELECT '"' || s_name AS "NombreConsorcio", CAST(s_suppkey AS INTEGER) AS "nroUnidadFuncional",
       '1' AS "Piso", s_suppkey || ',50' AS "Coeficiente", 'SI' AS "Bauleras",
       CAST(NULL AS VARCHAR) AS m2_baulera, '0' AS m2_cochera
FROM supplier""",
    "monthly_collection_pivot": _PIVOT,
    "top_months": _TOP,
    "monthly_collection_pivot_filtered": _PIVOT_PART,
    "top_months_filtered": _TOP_PART,
    "period_cost_totals": f"SELECT * FROM ({_cost_totals('reference')}) WHERE anio = 1997 AND mes = 6",
    "period_cost_totals_strict": f"SELECT * FROM ({_cost_totals('strict')}) WHERE anio = 1997 AND mes = 6",
    "monthly_cost_totals": _cost_totals("reference"),
    "monthly_cost_totals_strict": _cost_totals("strict"),
    "installment_schedule": _schedule("reference"),
    "installment_schedule_strict": _schedule("strict"),
    "quota_table_totals": _QUOTAS,
    "generate_documents": _DOCUMENTS,
    "link_costs": _LINK,
    "financial_position": _position("reference"),
    "financial_position_strict": _position("strict"),
    "unit_accounts": _accounts("partial_payment"),
    "unit_accounts_last_payment": _accounts("last_payment"),
    "unit_accounts_flat": _accounts("flat"),
    "unit_accounts_strict": _accounts("partial_payment"),
    "unit_accounts_continued": _accounts("partial_payment"),
    "file_lines_accounts": """
SELECT CASE WHEN c_custkey % 7 <> 0 THEN lpad(CAST(c_custkey AS VARCHAR), 22, '0') END AS "CBU_CVU",
       c_mktsegment AS "NombreConsorcio", CAST(c_custkey AS INTEGER) AS "nroUnidadFuncional",
       '1' AS piso, 'B' AS departamento FROM customer""",
    "file_lines_buildings": """
SELECT s_name AS nombre, 'Calle, ' || CAST(s_suppkey AS VARCHAR) AS direccion,
       CAST(s_suppkey AS INTEGER) AS unidades, CAST(s_suppkey + 0.5 AS DECIMAL(10,2)) AS m2 FROM supplier""",
    "unit_statement": f"{_STATEMENT} SELECT * FROM statement",
    "unit_statement_xml": _STATEMENT_XML,
    "paid_within_month": f"""WITH {_PAID}
SELECT u AS "unidadFuncionalID", CAST(idx AS INTEGER) AS periodo, pagos AS pagado,
       p10 AS hasta10, p15 AS hasta15, ultimo FROM pay""",
    "payment_match": f"""WITH {_FILE}
SELECT u AS "unidadFuncionalID", cuenta AS "cuentaOrigen", valor AS monto,
       u IS NOT NULL AS asociado FROM pago""",
    "payment_detail_fanout": _FANOUT,
    "payment_detail_strict": f"""WITH {_FILE}
SELECT u AS "unidadFuncionalID", cuenta AS "cuentaOrigen", fecha AS "fechaPago",
       valor AS importe, CAST(1 AS BIGINT) AS copias FROM pago""",
    "payments_rejected": f"""WITH {_FILE}
SELECT id AS "IdPago", 'pagos_' || archivo || '.csv' AS "nombreArchivo", fecha AS "Fecha",
       cuenta AS "CVU_CBU", CAST(NULL AS DECIMAL(12,2)) AS "Valor"
FROM lines WHERE value >= 200""",
    "buildings_import": """
SELECT s_name AS nombre, 'Calle ' || CAST(s_suppkey AS VARCHAR) AS direccion,
       CAST(abs(CAST(s_acctbal AS DECIMAL(14,2))) AS DECIMAL(6,2)) AS "superficieM2Total"
FROM supplier""",
    "units_import": f"""WITH {_STAGED_UNITS}
SELECT b AS "consorcioID", piso, depto AS departamento, CAST(m2 AS DECIMAL(6,2)) AS "superficieM2",
       CAST(CASE WHEN flag IN ('SI', 'si ') THEN 1 ELSE 0 END AS SMALLINT) AS cochera,
       CAST(CASE WHEN flag IN ('SI', 'si ') THEN 1 ELSE 0 END AS SMALLINT) AS baulera,
       coef AS coeficiente
FROM su WHERE m2 < 10000 AND NOT EXISTS (
  SELECT 1 FROM su k WHERE k.c_acctbal < 0 AND k.b = su.b AND k.piso = su.piso
                       AND k.depto = su.depto)""",
    "accounts_update": f"""WITH {_STAGED_UNITS}
SELECT CAST(nro AS BIGINT) AS "unidadFuncionalID", b AS "consorcioID", piso,
       depto AS departamento, max(cuenta) OVER (PARTITION BY b, piso, depto) AS "CBU_CVU"
FROM su""",
    "owners_import": _people(False, ", 'Mail' AS \"modoEntrega\""),
    "tenants_import": _people(True, ""),
    "insert_if_missing": """
SELECT l_suppkey, l_partkey, l_orderkey, l_linenumber FROM lineitem l
WHERE l_linestatus = 'O' AND NOT EXISTS (
  SELECT 1 FROM lineitem r WHERE r.l_returnflag = 'R' AND r.l_suppkey = l.l_suppkey
                             AND r.l_partkey = l.l_partkey)""",
    "update_from_join": """
SELECT c_custkey, CASE WHEN c_acctbal >= 0
                       THEN (SELECT max(o_orderkey) FROM orders WHERE o_custkey = c_custkey)
                  END AS ultimo_pedido FROM customer""",
    "parse_amount": f"""WITH {_WRITTEN}
SELECT l_orderkey, l_linenumber, texto,
       CASE WHEN style <= 2 THEN CAST(CAST(c AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2))
            WHEN style <= 4 THEN CAST(0 AS DECIMAL(18,2)) END AS monto FROM written""",
    "clean_money": f"""WITH {_WRITTEN}
SELECT l_orderkey, l_linenumber, TRY_CAST(replace(replace(texto, '.', ''), ',', '.')
       AS DECIMAL(12,2)) AS monto FROM written""",
    "decimal_comma": """
SELECT p_partkey, replace(printf('%.2f', p_retailprice), '.', ',') AS texto,
       CASE WHEN p_retailprice < 1000 THEN CAST(p_retailprice AS DECIMAL(5,2)) END AS valor
FROM part""",
    "yes_flag": f"""WITH {_STAGED_UNITS}
SELECT nro AS "nroUnidadFuncional", flag AS "Cochera",
       CASE WHEN trim(upper(flag)) = 'SI' THEN 1 ELSE 0 END AS cochera_si FROM su""",
    "pad_id": f'WITH {_PERSONS} SELECT c_custkey, dni AS "DNI", documento FROM sp',
    "digits_only": """
SELECT event_id, regexp_replace(props, '[^0-9]', '', 'g') AS digitos FROM events""",
    "month_start_by_name": f"""WITH named AS (
  SELECT o_orderkey, o_orderdate, CAST(o_orderkey % 13 + 1 AS INTEGER) AS k,
         list_extract([{_NAMES}, 'nunca'], CAST(o_orderkey % 13 + 1 AS BIGINT)) AS n FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN upper(n) ELSE n END AS nombre,
       CASE WHEN k <= 12 THEN make_date(year(o_orderdate), k, 1) END AS inicio FROM named""",
    "prev_period": """
SELECT o_orderkey, CAST(month(o_orderdate - INTERVAL 1 MONTH) AS INTEGER) AS mes_anterior,
       CAST(year(o_orderdate - INTERVAL 1 MONTH) AS INTEGER) AS anio_anterior FROM orders""",
    "week_of_year": f"""
SELECT l_orderkey, l_linenumber, {_week('l_shipdate')} AS semana FROM lineitem""",
    "parse_date": """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0
         THEN month(o_orderdate) || '/' || day(o_orderdate) || '/' || year(o_orderdate)
         ELSE ' ' || lpad(CAST(day(o_orderdate) AS VARCHAR), 2, '0') || '/' || month(o_orderdate)
              || '/' || year(o_orderdate) END AS texto,
       CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE)
            WHEN day(o_orderdate) <= 12
            THEN make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate)) END AS fecha
FROM orders""",
    "dq_unique": """
SELECT 'unique' AS regla, l_orderkey || '|' || l_linenumber AS clave,
       'l_orderkey+l_linenumber' AS detalle, count(*) AS filas
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "dq_unique_account": """
SELECT 'unique' AS regla, c_mktsegment || '/' || c_nationkey AS clave, 'CBU_CVU' AS detalle,
       count(*) AS filas
FROM customer WHERE c_acctbal >= 0 GROUP BY c_mktsegment, c_nationkey HAVING count(*) > 1""",
    "dq_fk": """
SELECT 'foreign_key' AS regla, CAST(o_custkey AS VARCHAR) AS clave, 'o_custkey' AS detalle,
       count(*) AS filas
FROM orders WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = o_custkey)
GROUP BY o_custkey""",
    "dq_domain": _rule(
        "domain", "o_orderpriority", "orders",
        "o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')",
    ),
    "dq_range": _rule(
        "range", "mes", "(SELECT month(l_shipdate) AS mes FROM lineitem)", "mes < 2 OR mes > 11"
    ),
    "dq_digits": f"""WITH {_PERSONS}
SELECT 'digits' AS regla, dni AS clave, 'DNI' AS detalle, count(*) AS filas
FROM sp WHERE regexp_matches(dni, '[^0-9]') GROUP BY dni""",
    "dq_not_null": f"""WITH {_STAGED_UNITS}
SELECT 'not_null' AS regla, CAST(NULL AS VARCHAR) AS clave, 'Cochera' AS detalle,
       count(*) AS filas FROM su WHERE flag IS NULL HAVING count(*) > 0""",
    "dq_length": _rule("length", "p_name", "part", "length(p_name) > 9"),
    "dq_decimal_fit": _rule(
        "decimal_fit", "o_totalprice",
        "(SELECT CAST(o_totalprice AS DECIMAL(14,2)) AS o_totalprice FROM orders)",
        "o_totalprice > 99999.99",
    ),
    "dq_default": f"""WITH {_STAGED_UNITS}
SELECT nro AS "nroUnidadFuncional", coalesce(flag, '0') AS "Cochera" FROM su""",
}
