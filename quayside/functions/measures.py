"""Row measures and the aggregate expressions shared by the marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.schema import CANCELLED, CONGESTION_LEVELS, WEATHER_SEVERITY


def congestion_level(index: Column) -> Column:
    """Right-closed bins over (0, 1]; 0, negatives and values above 1 have no label."""
    label = F.when(index <= 0, F.lit(None))
    for upper, name in CONGESTION_LEVELS:
        label = label.when(index <= upper, name)
    return label


def weather_severity(condition: Column) -> Column:
    scores = F.create_map(*[F.lit(x) for pair in WEATHER_SEVERITY.items() for x in pair])
    return F.coalesce(scores[condition], F.lit(0))


def delay_days(actual: Column, scheduled: Column) -> Column:
    late = F.datediff(actual, scheduled)
    # greatest() skips nulls, so an open shipment must be kept out of it.
    return F.when(late.isNotNull(), F.greatest(late, F.lit(0))).cast("bigint")


def is_cancelled(status: Column) -> Column:
    """A missing status does not count as cancelled."""
    return F.coalesce(status == CANCELLED, F.lit(False))


def is_on_time(delay: Column, status: Column) -> Column:
    return F.coalesce(delay == 0, F.lit(False)) & ~is_cancelled(status)


def transit_days(actual: Column, departure: Column) -> Column:
    return F.datediff(actual, departure).cast("bigint")


def route_label(origin: Column, destination: Column) -> Column:
    return F.concat(origin, F.lit(" → "), destination)


def delay_prior(origin_congestion: Column, dest_congestion: Column, rating: Column) -> Column:
    """Expected share of late shipments from port congestion and carrier rating."""
    return (origin_congestion + dest_congestion) / 2 * (5 - rating) / 4


def month_number(day: Column) -> Column:
    return F.month(day)


def monday_weekday(day: Column) -> Column:
    return F.weekday(day)


def is_delayed(delay: Column) -> Column:
    return F.coalesce(delay > 0, F.lit(False)).cast("int")


# Aggregates ------------------------------------------------------------------------------------------------


def half_up(value: Column, digits: int) -> Column:
    """Round half away from zero on the decimal value, so that partial sums in any order give one result."""
    # From 1e29 up a double has no digits left to round; those, infinities and NaN stay as they are.
    return F.coalesce(F.round(value.try_cast("decimal(38,9)"), digits).cast("double"), value.cast("double"))


def money(cost: Column) -> Column:
    """Exact to four decimals, up to 1e26; null for what does not fit."""
    return cost.try_cast("decimal(30,4)")


def total_cost(cost: Column) -> Column:
    """Exact sum of money; adding doubles would depend on the order of the rows.

    A cost that does not fit the decimal (infinite, NaN, or 1e26 and more) makes the sum one of doubles, so that it
    shows in the result instead of vanishing from it.
    """
    unfit = F.count_if(cost.isNotNull() & money(cost).isNull())
    return F.when(unfit > 0, F.sum(cost)).otherwise(F.sum(money(cost)).cast("double"))


def mean_cost(cost: Column) -> Column:
    return total_cost(cost) / F.count(cost)


def count_true(flag: Column) -> Column:
    return F.count_if(flag)


def share(flag: Column) -> Column:
    return F.avg(flag.cast("int"))


def percent_true(flag: Column) -> Column:
    return count_true(flag) * F.lit(100.0) / F.count(F.lit(1))


def mean_late(delay: Column) -> Column:
    return F.avg(F.when(delay > 0, delay))
