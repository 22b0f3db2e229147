"""The wide shipment table and the lookups built on it.

The ``attach_*`` joins leave their side as it is; pass it through ``broadcast_if_small`` first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import measures as M
from quayside.functions.joins import BROADCAST_BYTES, broadcast_if_small
from quayside.functions.ordering import weighted_median
from quayside.schema import DEFAULT_ROUTE_DAYS, MASTER_COLUMNS, ROUTE_DAY_BOUNDS
from quayside.session import stage


def attach_carrier(shipments: DataFrame, carriers: DataFrame) -> DataFrame:
    side = carriers.select(
        "carrier_id", "carrier_name", "carrier_type", "rating", F.col("country").alias("carrier_country")
    )
    return shipments.join(side, "carrier_id", "left")


def _port_side(ports: DataFrame, key: str, prefix: str) -> DataFrame:
    return ports.select(
        F.col("port_id").alias(key),
        F.col("port_name").alias(f"{prefix}_port_name"),
        F.col("region").alias(f"{prefix}_region"),
        F.col("congestion_index").alias(f"{prefix}_congestion"),
        F.col("congestion_level").alias(f"{prefix}_congestion_level"),
    )


def attach_origin(shipments: DataFrame, ports: DataFrame) -> DataFrame:
    return shipments.join(_port_side(ports, "origin_port_id", "origin"), "origin_port_id", "left")


def attach_destination(shipments: DataFrame, ports: DataFrame) -> DataFrame:
    return shipments.join(_port_side(ports, "destination_port_id", "dest"), "destination_port_id", "left")


def weather_daily_max(weather: DataFrame) -> DataFrame:
    """Worst severity and wind per port and day; rows without port or day are left out."""
    return (
        weather.dropna(subset=["port_id", "weather_date"])
        .groupBy("port_id", "weather_date")
        .agg(F.max("weather_severity").alias("max_severity"), F.max("wind_speed_kmh").alias("max_wind"))
    )


def attach_weather(shipments: DataFrame, daily: DataFrame) -> DataFrame:
    """Worst weather at the origin on the departure day: no report means severity 0 and the median wind.

    The median is the one over the joined rows. It comes from shipment counts per port and day, merged to one
    row per wind speed and written out, so the wide rows are not needed for it.
    """
    keys = ["origin_port_id", "departure_date"]
    side = daily.select(
        F.col("port_id").alias("origin_port_id"),
        F.col("weather_date").alias("departure_date"),
        F.col("max_severity").alias("origin_weather_severity"),
        F.col("max_wind").alias("origin_wind_kmh"),
    )
    per_day = shipments.groupBy(*keys).agg(F.count("*").alias("_shipments"))
    winds = per_day.join(side, keys).groupBy("origin_wind_kmh").agg(F.sum("_shipments").alias("_shipments"))
    median = weighted_median(stage(winds, "winds"), "origin_wind_kmh", "_shipments").scalar()
    return shipments.join(side, keys, "left").withColumns(
        {
            "origin_weather_severity": F.coalesce(F.col("origin_weather_severity").cast("double"), F.lit(0.0)),
            "origin_wind_kmh": F.coalesce("origin_wind_kmh", median),
        }
    )


def join_master(
    shipments: DataFrame, carriers: DataFrame, ports: DataFrame, daily: DataFrame, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Every cleaned shipment with its carrier, both ports, the weather and the route label.

    ``daily`` (see ``weather_daily_max``) should be a written table.
    """
    carriers, ports, daily = (broadcast_if_small(side, limit) for side in (carriers, ports, daily))
    wide = attach_carrier(attach_weather(shipments, daily), carriers)
    wide = attach_destination(attach_origin(wide, ports), ports)
    wide = wide.withColumn("route", M.route_label(F.col("origin_port_name"), F.col("dest_port_name")))
    extra = [c for c in wide.columns if c not in MASTER_COLUMNS]
    return wide.select(*MASTER_COLUMNS, *extra)


def build_master(
    shipments: DataFrame, carriers: DataFrame, ports: DataFrame, weather: DataFrame, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """``join_master`` over lazy inputs.

    Shipments and the daily weather feed two branches each, so both go to the shared folder first: the source of the
    shipments is read once.
    """
    daily = stage(weather_daily_max(weather), "weather-daily")
    return join_master(stage(shipments, "shipments"), carriers, ports, daily, limit)


def with_route_days(
    df: DataFrame,
    bounds: dict[tuple[str, str], tuple[int, int]] = ROUTE_DAY_BOUNDS,
    default: tuple[int, int] = DEFAULT_ROUTE_DAYS,
) -> DataFrame:
    """Usual (least, most) days between ``origin_region`` and ``dest_region``.

    A pair listed in one direction only serves both; an unlisted pair gets the default.
    """
    rows = [(o, d, int(lo), int(hi)) for (o, d), (lo, hi) in bounds.items()]
    listed = df.sparkSession.createDataFrame(rows, "o string, d string, lo bigint, hi bigint")
    ahead = listed.select(
        F.col("o").alias("origin_region"), F.col("d").alias("dest_region"), F.struct("lo", "hi").alias("_ahead")
    )
    back = listed.select(
        F.col("d").alias("origin_region"), F.col("o").alias("dest_region"), F.struct("lo", "hi").alias("_back")
    )
    keys = ["origin_region", "dest_region"]
    # A literal list written out in the call, one row per pair of regions.
    found = df.join(F.broadcast(ahead), keys, "left").join(F.broadcast(back), keys, "left")
    pair = F.coalesce("_ahead", "_back")
    return found.withColumns(
        {
            "min_days": F.coalesce(pair["lo"], F.lit(default[0]).cast("bigint")),
            "max_days": F.coalesce(pair["hi"], F.lit(default[1]).cast("bigint")),
        }
    ).drop("_ahead", "_back")


def with_delay_prior(master: DataFrame) -> DataFrame:
    prior = M.delay_prior(F.col("origin_congestion"), F.col("dest_congestion"), F.col("rating"))
    return master.withColumn("delay_prior", prior)


def weather_gaps(ports: DataFrame, weather: DataFrame, every_days: int = 3) -> DataFrame:
    """Days of the observation grid (every third day over the observed range) on which a port has no report."""
    days = weather.agg(F.sequence(F.min("weather_date"), F.max("weather_date"), F.expr(f"interval {every_days} days")))
    grid = ports.select("port_id", F.explode(days.scalar()).alias("weather_date"))
    seen = weather.select("port_id", "weather_date").distinct()
    return grid.join(seen, ["port_id", "weather_date"], "left_anti")
