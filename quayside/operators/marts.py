"""KPI marts over cleaned shipments.

Every mart first aggregates shipments by id, so a busy carrier or port shrinks to a partial sum per task
before anything is shuffled, and only then joins the dimension, one row per id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions import measures as M


def carrier_kpis(shipments: DataFrame, carriers: DataFrame) -> DataFrame:
    per_carrier = shipments.groupBy("carrier_id").agg(
        F.count("*").alias("total_shipments"),
        F.avg("delay_days").alias("_delay"),
        M.percent_true(F.col("is_on_time")).alias("_on_time"),
        M.mean_cost(F.col("cost_usd")).alias("_cost"),
        F.avg("transit_days").alias("_transit"),
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


def port_congestion(shipments: DataFrame, ports: DataFrame) -> DataFrame:
    """Departures per port; a port without any stays, with 0 and no averages."""
    per_port = shipments.groupBy(F.col("origin_port_id").alias("port_id")).agg(
        F.count("shipment_id").alias("departures"),
        M.half_up(F.avg("delay_days"), 2).alias("avg_departure_delay"),
        M.half_up(M.mean_cost(F.col("cost_usd")), 2).alias("avg_cost_origin"),
    )
    return ports.join(per_port, "port_id", "left").select(
        "port_id",
        "port_name",
        "region",
        "congestion_index",
        "congestion_level",
        F.coalesce("departures", F.lit(0).cast("bigint")).alias("departures"),
        "avg_departure_delay",
        "avg_cost_origin",
    )


def route_performance(shipments: DataFrame, ports: DataFrame, min_shipments: int = 5) -> DataFrame:
    per_route = (
        shipments.groupBy("origin_port_id", "destination_port_id")
        .agg(
            F.count("*").alias("shipment_count"),
            M.half_up(F.avg("delay_days"), 2).alias("avg_delay"),
            M.half_up(M.mean_cost(F.col("cost_usd")), 2).alias("avg_cost"),
            M.half_up(F.avg("transit_days"), 1).alias("avg_transit_days"),
            M.half_up(M.percent_true(F.col("is_on_time")), 1).alias("on_time_pct"),
        )
        .where(F.col("shipment_count") >= min_shipments)
    )

    def side(key: str, name: str, region: str) -> DataFrame:
        return ports.select(
            F.col("port_id").alias(key), F.col("port_name").alias(name), F.col("region").alias(region)
        )

    return (
        per_route.join(side("origin_port_id", "origin_port", "origin_region"), "origin_port_id")
        .join(side("destination_port_id", "dest_port", "dest_region"), "destination_port_id")
        .select(
            "origin_port_id",
            "origin_port",
            "destination_port_id",
            "dest_port",
            "origin_region",
            "dest_region",
            "shipment_count",
            "avg_delay",
            "avg_cost",
            "avg_transit_days",
            "on_time_pct",
        )
    )


def monthly_kpis(shipments: DataFrame) -> DataFrame:
    return shipments.groupBy("departure_month").agg(
        F.count("*").alias("total_shipments"),
        M.half_up(F.avg("delay_days"), 2).alias("avg_delay_days"),
        M.half_up(M.mean_cost(F.col("cost_usd")), 2).alias("avg_cost_usd"),
        M.half_up(M.percent_true(F.col("is_on_time")), 1).alias("on_time_pct"),
        M.total_cost(F.col("cost_usd")).alias("total_revenue"),
    )


def carrier_delay_rank(kpis: DataFrame) -> DataFrame:
    """RANK by score, best first, and by mean delay, shortest first (nulls last and first).

    A window over all carriers would sort them in one task. Ranks depend only on how many carriers hold each
    value, and both measures are rounded, so the window runs over the few distinct values instead.
    """
    measures = kpis.select((-F.col("performance_score")).alias("perf"), F.col("avg_delay_days").alias("delay"))
    long = measures.unpivot([], measures.columns, "kind", "value")
    held = long.groupBy("kind", "value").agg(F.count("*").alias("held"))
    order = {"perf": F.col("value").asc_nulls_last(), "delay": F.col("value").asc_nulls_first()}

    def ranks(kind: str) -> DataFrame:
        ahead = Window.orderBy(order[kind]).rowsBetween(Window.unboundedPreceding, -1)
        return held.where(F.col("kind") == kind).select(
            F.col("value").alias(f"_{kind}"),
            (F.coalesce(F.sum("held").over(ahead), F.lit(0)) + 1).alias(f"{kind}_rank"),
        )

    perf, delay = ranks("perf"), ranks("delay")
    return (
        kpis.join(perf, (-kpis["performance_score"]).eqNullSafe(perf["_perf"]))
        .join(delay, kpis["avg_delay_days"].eqNullSafe(delay["_delay"]))
        .select(
            "carrier_id",
            "carrier_name",
            "avg_delay_days",
            "on_time_pct",
            "performance_score",
            "perf_rank",
            "delay_rank",
        )
    )


def monthly_delay_rolling_avg(monthly: DataFrame) -> DataFrame:
    """Mean of the last three rows (not calendar months) of the rounded monthly delay.

    The window has no partition key; its input is one row per month.
    """
    last_three = Window.orderBy("departure_month").rowsBetween(-2, 0)
    rolling = M.half_up(F.avg("avg_delay_days").over(last_three), 2)
    return monthly.select("departure_month", "avg_delay_days", rolling.alias("rolling_3m_avg_delay"))
