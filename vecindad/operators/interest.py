"""Late interest and the monthly account of a unit, as column expressions.

All amounts in here are whole cents (bigint).  A share of a building total carries
four further decimals, so an amount under way is a pair: whole cents, and a rest in
units of 1e-4 cents.  Products are taken of quotient and remainder apart, sums of each
part, and the pair is rounded once, half away from zero.  That is exact up to 9e16
units of currency, wherever the parts of a sum fit; beyond it an overflow is an
error (ANSI mode).

The same expressions serve one month at a time (plain columns) and a whole history
(struct fields inside the fold of ``operators.history``).
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from vecindad.schemas import MONEY

# Interest in percent for missing the first and the second due day.
FIRST_RATE = 2
SECOND_RATE = 5

POLICIES = ("partial_payment", "last_payment", "flat")

CENT_PARTS = 10_000


def check_policy(policy: str) -> None:
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, not {policy!r}")


def to_cents(amount: Column) -> Column:
    return (amount.cast(MONEY) * 100).cast("bigint")


def from_cents(cents: Column) -> Column:
    return (cents.cast("decimal(19,0)") * F.lit("0.01").cast("decimal(2,2)")).cast(MONEY)


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0).cast("bigint"))


#: ``bind(value, body)`` gives ``body(value)``; one that keeps the value spares its repetition.
Bind = Callable[[Column, Callable[[Column], Column]], Column]


def repeated(value: Column, body: Callable[[Column], Column]) -> Column:
    """For plain columns: the optimizer finds what is repeated."""
    return body(value)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """For lambdas of array functions, in which every mention of a value is computed again."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda kept, _: kept, body)


def _div(value: Column, by: int) -> Column:
    """Quotient towards minus infinity."""
    return F.call_function("div", value - F.pmod(value, F.lit(by)), F.lit(by))


class Parts:
    """Whole cents and a rest in 1e-4 cents, which may exceed a cent until rounded.

    A rest that is not given is 0 and left out of sums.
    """

    def __init__(self, whole: Column, rest: Column | None = None):
        self.whole, self._rest = whole, rest

    @property
    def rest(self) -> Column:
        return F.lit(0).cast("bigint") if self._rest is None else self._rest

    def __add__(self, other: Parts) -> Parts:
        rests = [x._rest for x in (self, other) if x._rest is not None]
        return Parts(self.whole + other.whole, rests[0] + rests[1] if len(rests) == 2 else rests[0] if rests else None)

    def only_if(self, condition: Column | None) -> Parts:
        if condition is None:
            return self
        return Parts(*[zero_if_null(F.when(condition, x)) for x in (self.whole, self.rest)])


def times(amount: Column, rate: Column | int, scale: int) -> Parts:
    """``amount * rate / scale``; ``scale`` divides 1e4."""
    rate = F.lit(rate).cast("bigint") if isinstance(rate, int) else rate
    rest = F.pmod(amount, F.lit(scale))
    return Parts(_div(amount, scale) * rate, rest * rate * (CENT_PARTS // scale))


def hundredths(amount: Column) -> Parts:
    """``amount / 100``, of an amount that is not negative."""
    return Parts(F.call_function("div", amount, F.lit(100)), amount % 100 * (CENT_PARTS // 100))


def rounded(parts: Parts, bind: Bind = repeated) -> Column:
    """Whole cents, half away from zero."""
    half = CENT_PARTS // 2

    def up(whole: Column, part: Column) -> Column:
        one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
        return whole + F.when((part > half) | ((part == half) & (whole >= 0)), one).otherwise(none)

    def split(rest: Column) -> Column:
        return bind(
            F.pmod(rest, F.lit(CENT_PARTS)),
            lambda part: bind(
                parts.whole + F.call_function("div", rest - part, F.lit(CENT_PARTS)), lambda whole: up(whole, part)
            ),
        )

    return bind(parts.rest, split)


def _due(previous: Column, paid_by_10: Column, paid_by_15: Column) -> Column:
    """Late interest in parts of a cent, a hundred to one."""
    charge = (
        previous * (FIRST_RATE + SECOND_RATE)
        - zero_if_null(paid_by_10) * FIRST_RATE
        - zero_if_null(paid_by_15) * SECOND_RATE
    )
    return zero_if_null(F.when(previous > 0, F.greatest(charge, F.lit(0).cast("bigint"))))


def late_interest(previous: Column, paid_by_10: Column, paid_by_15: Column) -> Parts:
    """2 % of what was open after day 10 and 5 % of what was open after day 15.

    Never negative, and 0 when nothing was due.
    """
    return hundredths(_due(previous, paid_by_10, paid_by_15))


def share(total: Column, percent: Column) -> Parts:
    """Part of a building total; ``percent`` in hundredths."""
    return times(zero_if_null(total), percent, CENT_PARTS)


def _percent(amount: Column, rate: int, condition: Column | None = None) -> Parts:
    return times(amount, rate, 100).only_if(condition)


def building_charge(month, policy: str = "partial_payment") -> Parts:
    """What a building's month adds for a hundredth of a percent of it (flat: to every unit)."""
    check_policy(policy)
    if policy == "flat":
        return Parts(zero_if_null(month("ordinario")) + zero_if_null(month("extra")))
    one = F.lit(1).cast("bigint")
    return share(month("ordinario"), one) + share(month("extra"), one)


def own_charge(month, policy: str = "partial_payment", building: Parts | None = None) -> Parts:
    """What a unit's month adds by itself: its shares (flat: the building totals) less what was paid.

    ``building``: the month's :func:`building_charge`, where it is known already.
    """
    building = building_charge(month, policy) if building is None else building
    paid = Parts(-zero_if_null(month("pagos")))
    if policy == "flat":
        return paid + building
    return paid + Parts(building.whole * month("coeficiente"), building.rest * month("coeficiente"))


#: Inputs of a unit's month that come from its payments, by policy.
PAID = {
    "partial_payment": ("pagos", "hasta10", "hasta15"),
    "last_payment": ("pagos", "ultimo"),
    "flat": ("pagos",),
}

#: Policies whose interest goes by the balance of the month before too.
BALANCE = ("last_payment", "flat")


def interest_of(month, policy: str = "partial_payment", in_total: bool = True) -> Parts:
    """Interest on the month before.  With the last-payment policy the one in the total goes
    by the due days of the current month, the one shown by those of the month before."""
    check_policy(policy)
    if policy == "partial_payment":
        return late_interest(month("previo"), month("hasta10"), month("hasta15"))
    previous, balance = zero_if_null(month("previo")), zero_if_null(month("saldoPrevio"))
    if policy == "flat":
        return _percent(previous, FIRST_RATE) + _percent(balance, SECOND_RATE)
    if in_total:
        # Only a missing payment is late by the due days of the current month.
        never = month("ultimo").isNull()
        return _percent(previous, FIRST_RATE, never) + _percent(balance, SECOND_RATE, never)

    def late(day: int) -> Column:
        return month("ultimo").isNull() | (F.dayofmonth(month("ultimo")) > day)

    return _percent(previous, FIRST_RATE, late(10)) + _percent(previous, SECOND_RATE, late(15))


def account_total(
    month, policy: str = "partial_payment", own: Parts | None = None, bind: Bind = repeated
) -> Column:
    """Amount to pay for one unit and month.

    ``month(name)`` gives the inputs: ``previo`` and ``saldoPrevio`` (total and
    balance of the month before, NULL if there is none), ``pagos`` and ``ultimo``
    (amount and last day paid in the month before), ``hasta10``, ``hasta15``,
    ``ordinario``, ``extra`` (building totals) and ``coeficiente``.  ``own``: the month's
    :func:`own_charge`, where it is known already.
    """
    own = (own_charge(month, policy) if own is None else own) + Parts(zero_if_null(month("previo")))
    if policy == "partial_payment":
        due = _due(month("previo"), month("hasta10"), month("hasta15"))
        return bind(due, lambda x: rounded(hundredths(x) + own, bind))
    total = rounded(interest_of(month, policy) + own, bind)
    return F.greatest(total, F.lit(0).cast("bigint")) if policy == "last_payment" else total


#: Amounts up to this many cents, either way, have totals that can be computed in one number.
SMALL = 10**14


def small(*amounts: Column) -> Column:
    """Whether all amounts are within :data:`SMALL`; one that is NULL is."""
    within = [F.coalesce(x.between(F.lit(-SMALL), F.lit(SMALL)), F.lit(True)) for x in amounts]
    return functools.reduce(operator.and_, within)


def small_total(month, charge: Column, policy: str = "partial_payment", paid: bool = True, bind: Bind = repeated) -> Column:
    """:func:`account_total` of amounts within :data:`SMALL`, in one number of 1e-4 cents.

    ``charge``: both building totals of the month together.  ``previo`` and ``saldoPrevio``
    are not NULL.  Without ``paid`` the month has no payment, and none is looked at.
    """
    previous, cent = month("previo"), CENT_PARTS
    late = month("previo") * (FIRST_RATE * cent // 100) + month("saldoPrevio") * (SECOND_RATE * cent // 100) if policy in BALANCE else None
    own = charge * cent if policy == "flat" else charge * month("coeficiente")
    if paid:
        own = own + (previous - zero_if_null(month("pagos"))) * cent
        if policy == "partial_payment":
            own = own + _due(previous, month("hasta10"), month("hasta15")) * (cent // 100)
        elif policy == "last_payment":
            own = own + F.when(month("ultimo").isNull(), late).otherwise(F.lit(0).cast("bigint"))
        else:
            own = own + late
    elif policy == "partial_payment":
        rate = F.lit(cent + (FIRST_RATE + SECOND_RATE) * cent // 100).cast("bigint")
        own = own + previous * F.when(previous > 0, rate).otherwise(F.lit(cent).cast("bigint"))
    else:
        own = own + previous * cent + late
    half = F.lit(cent // 2).cast("bigint")
    total = bind(own, lambda x: F.call_function("div", x + F.when(x >= 0, half).otherwise(-half), F.lit(cent).cast("bigint")))
    return F.greatest(total, F.lit(0).cast("bigint")) if policy == "last_payment" else total


def account_amounts(month, policy: str = "partial_payment", total: Column | None = None) -> dict[str, Column]:
    """All amounts of one unit and month, from the inputs of :func:`account_total`."""
    previous, paid = zero_if_null(month("previo")), zero_if_null(month("pagos"))
    return {
        "saldoAnterior": previous,
        "pagosRecibidos": paid,
        "saldo": paid - previous if policy == "partial_payment" else previous - paid,
        "InteresesPorMora": rounded(interest_of(month, policy, in_total=False)),
        "expensasOrdinarias": rounded(share(month("ordinario"), month("coeficiente"))),
        "expensasExtraordinarias": rounded(share(month("extra"), month("coeficiente"))),
        "totalPagar": account_total(month, policy) if total is None else total,
    }


def final_balance(month, bind: Bind = repeated) -> Column:
    """Final cash balance of one building and month (see :func:`position_amounts`)."""
    known = (
        zero_if_null(month("saldoPrevio"))
        + zero_if_null(month("hasta10"))
        - zero_if_null(month("ordinario"))
        - zero_if_null(month("extra"))
    )
    due = _due(month("egresosPrevios"), month("hasta10"), month("hasta15"))
    return bind(due, lambda x: rounded(Parts(known) + hundredths(x), bind))


def position_amounts(month, mode: str = "reference") -> dict[str, Column]:
    """Cash position of one building and month.

    ``month(name)`` gives ``saldoPrevio`` and ``egresosPrevios`` (final balance
    and outgo of the month before), the payments of the month before
    (``hasta10``, ``hasta15``, ``desde10``, ``desde11``), ``ordinario``, ``extra``.
    In reference mode day 10 counts as on time and as overdue.
    """
    overdue = month("desde10") if mode == "reference" else month("desde11")
    return {
        "saldoAnterior": zero_if_null(month("saldoPrevio")),
        "ingresosEnTermino": zero_if_null(month("hasta10")),
        "ingresosAdeudados": zero_if_null(overdue),
        "egresosTotales": zero_if_null(month("ordinario")) + zero_if_null(month("extra")),
        "saldoFinal": final_balance(month),
    }


def as_money(amounts: dict[str, Column]) -> list[Column]:
    return [from_cents(value).alias(name) for name, value in amounts.items()]
