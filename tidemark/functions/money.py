"""Money rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(38,4)"

# The sides an account can be on.
ASSET, MIXED, LIABILITY = "AA", "AP", "PP"


def _or_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))


def net_debit(debit: Column, credit: Column, side: Column) -> Column:
    """Debit after netting: asset accounts show debit minus credit, mixed accounts
    keep a debit that is not negative, all others have none."""
    return F.when(side == ASSET, _or_zero(debit) - _or_zero(credit)).when(
        (side == MIXED) & (debit >= 0), debit
    )


def net_credit(debit: Column, credit: Column, side: Column) -> Column:
    """Credit after netting, the mirror image of :func:`net_debit`."""
    return F.when(side == LIABILITY, _or_zero(credit) - _or_zero(debit)).when(
        (side == MIXED) & (credit >= 0), credit
    )


def side_label(
    debit: Column, credit: Column, side: Column, loan: str, resource: str
) -> Column:
    """Loan or resource; a mixed account is a resource when it has a credit."""
    return (
        F.when(side == ASSET, loan)
        .when(side == LIABILITY, resource)
        .when((side == MIXED) & (credit >= 0), resource)
        .when((side == MIXED) & (debit >= 0), loan)
    )


def mid_per_unit(mid: Column, unit: Column) -> Column:
    """Mid rate of one currency unit."""
    return F.try_divide(mid, unit)


def note_rate_per_unit(sell: Column, buy: Column, unit: Column) -> Column:
    """Note rate of one currency unit: sell plus half of buy."""
    return F.try_divide(sell + buy / F.lit(2), unit)


def note_average(low: Column, high: Column) -> Column:
    """Midpoint of the two note quotes."""
    return (low + high) / F.lit(2)


def prefix_class(code: Column, classes: dict[str, str], default: str) -> Column:
    """Class of a code by its prefix; longer prefixes are tried first."""
    found = F.when(code.isNull(), F.lit(None).cast("string"))
    for prefix in sorted(classes, key=len, reverse=True):
        found = found.when(code.startswith(prefix), F.lit(classes[prefix]))
    return found.otherwise(F.lit(default))
