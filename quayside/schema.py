"""Table contracts and domain constants."""

from __future__ import annotations

# The columns every delivered table should carry.
RAW_COLUMNS: dict[str, list[str]] = {
    "carriers": ["carrier_id", "carrier_name", "carrier_type", "rating", "country", "fleet_size"],
    "ports": ["port_id", "port_name", "country", "region", "congestion_index"],
    "shipments": [
        "shipment_id",
        "origin_port_id",
        "destination_port_id",
        "carrier_id",
        "departure_date",
        "scheduled_arrival",
        "actual_arrival",
        "cost_usd",
        "status",
    ],
    "weather": ["weather_id", "port_id", "weather_date", "condition", "wind_speed_kmh", "visibility_km"],
}

# Texts that mean "no value" in a delivered CSV (pandas' documented default list).
NULL_TOKENS: list[str] = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# Upper bound (inclusive) of each congestion label; the lowest bound, 0, is exclusive.
CONGESTION_LEVELS: list[tuple[float, str]] = [(0.59, "Low"), (0.74, "Medium"), (0.84, "High"), (1.0, "Critical")]

# Severity score of each weather condition; anything else scores 0.
WEATHER_SEVERITY: dict[str, int] = {"Clear": 0, "Cloudy": 0, "Rain": 1, "Fog": 1, "Thunderstorm": 2, "Storm": 3}

CANCELLED = "Cancelled"

# Usual (least, most) transit days between two regions.
ROUTE_DAY_BOUNDS: dict[tuple[str, str], tuple[int, int]] = {
    ("Asia Pacific", "North America"): (14, 22),
    ("Asia Pacific", "Europe"): (20, 30),
    ("Asia Pacific", "Middle East"): (8, 14),
    ("Asia Pacific", "South Asia"): (5, 10),
    ("Europe", "North America"): (10, 16),
    ("Europe", "Middle East"): (8, 14),
    ("Middle East", "Europe"): (8, 14),
    ("Middle East", "North America"): (18, 26),
    ("North America", "Europe"): (10, 16),
    ("North America", "Asia Pacific"): (14, 22),
    ("South Asia", "Europe"): (18, 26),
    ("South Asia", "Asia Pacific"): (5, 10),
}
DEFAULT_ROUTE_DAYS = (10, 20)

# The columns of the wide table, in order.
MASTER_COLUMNS = [
    "shipment_id",
    "origin_port_id",
    "destination_port_id",
    "carrier_id",
    "departure_date",
    "scheduled_arrival",
    "actual_arrival",
    "cost_usd",
    "status",
    "delay_days",
    "is_on_time",
    "transit_days",
    "departure_month",
    "departure_year",
    "carrier_name",
    "carrier_type",
    "rating",
    "carrier_country",
    "origin_port_name",
    "origin_region",
    "origin_congestion",
    "origin_congestion_level",
    "dest_port_name",
    "dest_region",
    "dest_congestion",
    "dest_congestion_level",
    "origin_weather_severity",
    "origin_wind_kmh",
    "route",
]
