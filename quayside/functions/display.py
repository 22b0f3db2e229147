"""Numbers as display text. ``format_number`` rounds half to even on the exact value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "nan"


def grouped(value: Column, digits: int) -> Column:
    """A fixed number of digits with thousands separators; ``nan`` where there is nothing to show."""
    return F.coalesce(F.format_number(value, digits), F.lit(MISSING))


def fixed(value: Column, digits: int) -> Column:
    """A fixed number of digits without separators."""
    return F.replace(grouped(value, digits), F.lit(","), F.lit(""))


def percent(value: Column, digits: int = 1) -> Column:
    """A share between 0 and 1 as a percentage."""
    return F.concat(fixed(value * 100, digits), F.lit("%"))


def dollars(value: Column) -> Column:
    return F.concat(F.lit("$"), grouped(value, 0))


def days(value: Column) -> Column:
    return F.concat(fixed(value, 1), F.lit(" days"))


def signed(value: Column, digits: int = 0) -> Column:
    return F.concat(F.when(value >= 0, "+").otherwise(""), fixed(value, digits))


def signed_dollars(value: Column) -> Column:
    return F.concat(F.lit("$"), F.when(value >= 0, "+").otherwise(""), grouped(value, 0))
