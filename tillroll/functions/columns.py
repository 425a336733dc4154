"""Column expressions shared by the operators; all are Spark built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.schemas import BACKUP_PREFIX, BACKUP_UNSAFE_CHARACTERS, CATEGORY_SEPARATOR

UNITS = 10_000


def category_level(code: Column, level: int, missing: str | None = None) -> Column:
    """The ``level``-th (from 1) dotted part of a category code.

    ``get`` gives NULL outside the array where ``getItem`` raises under ANSI.
    """
    part = F.get(F.split(code, CATEGORY_SEPARATOR), level - 1)
    return part if missing is None else F.coalesce(part, F.lit(missing))


def parse_time(value: Column) -> Column:
    """Timestamp, or NULL where the text is no timestamp (ANSI ``cast`` raises)."""
    return value.try_cast("timestamp")


def day_of(time: Column) -> Column:
    return time.cast("date")


def to_units(price: Column) -> Column:
    """A price as a whole number of hundredths of a cent; NULL for NaN and infinity.

    Sums of whole numbers do not depend on the order of the rows, as sums of doubles do,
    and stay in primitive arithmetic, as sums of decimals do not. Too large a price or sum
    raises under ANSI mode.
    """
    return F.when(is_finite(price), F.rint(price * UNITS).cast("long"))


def is_finite(price: Column) -> Column:
    number = price.cast("double")
    return ~F.isnan(number) & (F.abs(number) < F.lit(float("inf")))


def sum_of_odd(price: Column) -> Column:
    """The sum of the prices that are NaN or infinite, NULL if there is none.

    It is NaN or infinite itself and does not depend on the order of the rows.
    """
    return F.sum(F.when(~is_finite(price), price.cast("double")))


def sum_of_prices(price: Column) -> Column:
    """The sum of prices as a double: exact to the unit, NaN or infinite if one of them is."""
    return F.coalesce(sum_of_odd(price), from_units(F.sum(to_units(price))))


def from_units(units: Column) -> Column:
    return units.cast("double") / UNITS


def ratio(numerator: Column, denominator: Column, when_zero: Column) -> Column:
    """Quotient in double precision, ``when_zero`` for a zero denominator."""
    return F.when(denominator == 0, when_zero).otherwise(
        F.try_divide(numerator.cast("double"), denominator.cast("double"))
    )


def table_name_for_file(file_name: Column) -> Column:
    """Backup table name: prefix + file name without its last extension, made safe."""
    stem = F.regexp_replace(file_name, r"^(\.*[^.].*)\.[^.]*$", "$1")
    return F.regexp_replace(F.concat(F.lit(BACKUP_PREFIX), stem), BACKUP_UNSAFE_CHARACTERS, "_")
