"""Additive states of shipments: counts and exact sums per departure year and key, from which marts and dashboards follow.

States of different years are independent, so a delivery of some years rewrites those years alone, and sums of states are
states. They grow with the number of carriers, routes and months, not with that of shipments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions import measures as M
from quayside.functions.joins import broadcast_if_small

YEAR = "departure_year"
KEYS = {
    "carrier_state": ["carrier_id"],
    "route_state": ["origin_port_id", "destination_port_id"],
    "month_state": ["departure_month"],
}
BOARD_KEYS = ["origin_region", "carrier_name", "delay_days"]


def _measures() -> dict[str, Column]:
    cost, delay, transit = F.col("cost_usd"), F.col("delay_days"), F.col("transit_days")
    fits = M.money(cost)
    unfit = cost.isNotNull() & fits.isNull()
    return {
        "n": F.count("*"),
        "n_ids": F.count("shipment_id"),
        "n_on_time": F.count_if("is_on_time"),
        "n_delay": F.count(delay),
        "sum_delay": F.sum(delay),
        "n_transit": F.count(transit),
        "sum_transit": F.sum(transit),
        "n_cost": F.count(cost),
        "sum_cost": F.sum(fits),
        # Costs that are no money (infinite, NaN, 1e26 and more) are summed apart, as doubles.
        "n_cost_unfit": F.count_if(unfit),
        "sum_cost_unfit": F.sum(F.when(unfit, cost)),
    }


def state(shipments: DataFrame, keys: list[str]) -> DataFrame:
    return shipments.groupBy(YEAR, *keys).agg(*[value.alias(name) for name, value in _measures().items()])


def merged(state: DataFrame, keys: list[str]) -> DataFrame:
    """One state per key: the sums over all others."""
    return state.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in _measures()])


def states(shipments: DataFrame) -> dict[str, DataFrame]:
    return {name: state(shipments, keys) for name, keys in KEYS.items()}


def board(shipments: DataFrame, carriers: DataFrame, ports: DataFrame) -> DataFrame:
    """What the dashboard chooses from: states per year, origin region, carrier name and days of delay.

    With many carriers a cell holds few shipments, so they are summed once, after they met carriers and ports (broadcast
    where these are small): sums by id first would shuffle nearly every shipment twice.
    """
    regions = ports.select(F.col("port_id").alias("origin_port_id"), F.col("region").alias("origin_region"))
    names = carriers.select("carrier_id", "carrier_name")
    wide = shipments.join(broadcast_if_small(regions), "origin_port_id", "left")
    wide = wide.join(broadcast_if_small(names), "carrier_id", "left").withColumn("_days", F.col("delay_days"))
    # A cell's days are its key, so their counts and sums follow from the number of shipments.
    days, n = F.col("delay_days"), F.col("n")
    follows = {"n_delay": F.when(days.isNull(), F.lit(0)).otherwise(n).cast("bigint"), "sum_delay": days.cast("bigint") * n}
    measured = _measures()
    summed = [value.alias(name) for name, value in measured.items() if name not in follows]
    cells = wide.groupBy(YEAR, "origin_region", "carrier_name", "_days").agg(*summed).withColumnRenamed("_days", "delay_days")
    return cells.withColumns(follows).select(YEAR, *BOARD_KEYS, *measured)


# Figures of merged states; ``where`` limits them to some of the states that are summed.


def _sum(column: str, where: Column | None) -> Column:
    return F.sum(column if where is None else F.when(where, F.col(column)))


def mean_delay(where: Column | None = None) -> Column:
    return F.try_divide(_sum("sum_delay", where), _sum("n_delay", where))


def mean_transit(where: Column | None = None) -> Column:
    return F.try_divide(_sum("sum_transit", where), _sum("n_transit", where))


def on_time_share(where: Column | None = None) -> Column:
    return F.try_divide(_sum("n_on_time", where), _sum("n", where))


def on_time_percent() -> Column:
    return F.sum("n_on_time") * F.lit(100.0) / F.sum("n")


def total_cost(where: Column | None = None) -> Column:
    exact = _sum("sum_cost", where).cast("double")
    both = _sum("sum_cost_unfit", where) + F.coalesce(exact, F.lit(0.0))
    return F.when(_sum("n_cost_unfit", where) > 0, both).otherwise(exact)


def mean_cost(where: Column | None = None) -> Column:
    return F.try_divide(total_cost(where), _sum("n_cost", where))


def mean_late() -> Column:
    late = F.col("delay_days") > 0
    return F.try_divide(_sum("sum_delay", late), _sum("n_delay", late))


# Marts ----------------------------------------------------------------------------------------------------


def carrier_kpis(state: DataFrame, carriers: DataFrame) -> DataFrame:
    per_carrier = state.groupBy("carrier_id").agg(
        F.sum("n").alias("total_shipments"),
        mean_delay().alias("_delay"),
        on_time_percent().alias("_on_time"),
        mean_cost().alias("_cost"),
        mean_transit().alias("_transit"),
    )
    score = F.col("rating") * 20 - F.col("_delay") * 5 + F.col("_on_time")
    return per_carrier.join(carriers.select("carrier_id", "carrier_name", "carrier_type", "rating"), "carrier_id").select(
        "carrier_id",
        "carrier_name",
        "carrier_type",
        "rating",
        "total_shipments",
        M.half_up(F.col("_delay"), 2).alias("avg_delay_days"),
        M.half_up(F.col("_on_time"), 1).alias("on_time_pct"),
        M.half_up(F.col("_cost"), 2).alias("avg_cost_usd"),
        M.half_up(F.col("_transit"), 1).alias("avg_transit_days"),
        M.half_up(score, 1).alias("performance_score"),
    )


def monthly_kpis(state: DataFrame) -> DataFrame:
    return state.groupBy("departure_month").agg(
        F.sum("n").alias("total_shipments"),
        M.half_up(mean_delay(), 2).alias("avg_delay_days"),
        M.half_up(mean_cost(), 2).alias("avg_cost_usd"),
        M.half_up(on_time_percent(), 1).alias("on_time_pct"),
        total_cost().alias("total_revenue"),
    )
