"""Typing and deriving the four delivered tables. Columns beyond the contract are kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import measures as M
from quayside.functions.casting import lenient_bigint, lenient_date, lenient_double, strip


def clean_carriers(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "rating": lenient_double(raw, "rating"),
            "fleet_size": lenient_bigint(raw, "fleet_size"),
            "carrier_name": strip(F.col("carrier_name")),
        }
    )


def clean_ports(raw: DataFrame) -> DataFrame:
    typed = raw.withColumns(
        {"congestion_index": lenient_double(raw, "congestion_index"), "port_name": strip(F.col("port_name"))}
    )
    return typed.withColumn("congestion_level", M.congestion_level(F.col("congestion_index")))


def clean_shipments(raw: DataFrame) -> DataFrame:
    """Typed shipments with delay, on-time and transit measures, without the cancelled ones."""
    dates = ["departure_date", "scheduled_arrival", "actual_arrival"]
    typed = raw.withColumns({d: lenient_date(raw, d) for d in dates}).withColumn(
        "cost_usd", lenient_double(raw, "cost_usd")
    )
    departure, actual = F.col("departure_date"), F.col("actual_arrival")
    return (
        typed.where(~M.is_cancelled(F.col("status")))
        .withColumn("delay_days", M.delay_days(actual, F.col("scheduled_arrival")))
        .withColumns(
            {
                "is_on_time": M.is_on_time(F.col("delay_days"), F.col("status")),
                "transit_days": M.transit_days(actual, departure),
                "departure_month": F.date_format(departure, "yyyy-MM"),
                "departure_year": F.year(departure),
            }
        )
    )


def clean_weather(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "weather_id": lenient_bigint(raw, "weather_id"),
            "weather_date": lenient_date(raw, "weather_date"),
            "wind_speed_kmh": lenient_double(raw, "wind_speed_kmh"),
            "visibility_km": lenient_bigint(raw, "visibility_km"),
            "weather_severity": M.weather_severity(F.col("condition")),
        }
    )


CLEANERS = {
    "carriers": clean_carriers,
    "ports": clean_ports,
    "shipments": clean_shipments,
    "weather": clean_weather,
}
