"""Lenient casts and row measures on the edges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quayside.functions import measures as M
from quayside.functions.casting import lenient_bigint, lenient_date, lenient_double, null_tokens_to_null, strip
from quayside.operators.clean import clean_carriers, clean_ports, clean_shipments, clean_weather


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def column(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_lenient_double(spark):
    df = texts(spark, "4.5", " 4.5 ", "1e3", "+5", ".5", "5.", "4.5d", "4.5F", "1,000", "0x10", "x", "", "NaN", None)
    expected = [4.5, 4.5, 1000.0, 5.0, 0.5, 5.0] + [None] * 8
    assert column(df, lenient_double(df, "v")) == expected


@pytest.mark.parametrize(
    ("costs", "total", "mean"),
    [
        ([2.5, None, 0.005], 2.505, 1.2525),
        ([1e17, 2.0, 0.005], 1e17 + 2.005, (1e17 + 2.005) / 3),
        ([1e30, 2.0], 1e30, 5e29),
        ([float("inf"), 2.5], float("inf"), float("inf")),
        ([None], None, None),
    ],
)
def test_no_cost_vanishes(spark, costs, total, mean):
    df = spark.createDataFrame([(c,) for c in costs], "c double")
    assert df.agg(M.total_cost(F.col("c")), M.mean_cost(F.col("c"))).first()[:] == (total, mean)


def test_infinity_is_read_and_rounded_as_it_is(spark):
    df = texts(spark, "inf", "2.5")
    cost = lenient_double(df, "v").alias("c")
    assert df.select(cost).agg(M.half_up(M.mean_cost(F.col("c")), 2)).first()[0] == float("inf")
    assert column(spark.range(1), M.half_up(F.lit(1e30), 2)) == [1e30]


def test_lenient_bigint(spark):
    df = texts(spark, "7", "7.0", "7.5", "seven", None)
    assert column(df, lenient_bigint(df, "v")) == [7, 7, None, None, None]


def test_lenient_date(spark):
    df = texts(spark, "2024-01-05", "2024-1-5", "2024-01-05 10:00:00", "2024-02-30", "20240105", "soon", None)
    day = dt.date(2024, 1, 5)
    assert column(df, lenient_date(df, "v")) == [day, day, None, None, None, None, None]


def test_typed_columns_pass_through(spark):
    df = spark.sql("select 1.5D as x, 3 as n, timestamp '2024-01-05 10:00:00' as t")
    row = df.select(lenient_double(df, "x"), lenient_bigint(df, "n"), lenient_date(df, "t")).first()
    assert tuple(row) == (1.5, 3, dt.date(2024, 1, 5))


def test_strip_cuts_any_white_space(spark):
    df = texts(spark, "\t a b \n", " c ", "d", None)
    assert column(df, strip(F.col("v"))) == ["a b", "c", "d", None]


def test_null_tokens_are_exact(spark):
    df = null_tokens_to_null(texts(spark, "NA", "n/a", "", " NA", "Namibia", None))
    assert column(df, "v") == [None, None, None, " NA", "Namibia", None]


def test_published_port_levels(spark):
    published = {
        0.92: "Critical", 0.71: "Medium", 0.68: "Medium", 0.85: "Critical", 0.74: "Medium", 0.62: "Medium",
        0.78: "High", 0.65: "Medium", 0.80: "High", 0.55: "Low", 0.60: "Medium", 0.83: "High",
    }
    edges = {0.0: None, -0.1: None, 0.59: "Low", 0.84: "High", 1.0: "Critical", 1.01: None}
    expected = published | edges
    raw = spark.createDataFrame([(f"P{i}", " x", float(v)) for i, v in enumerate(expected)], "port_id string, port_name string, congestion_index double")
    rows = clean_ports(raw).collect()
    assert {r["congestion_index"]: r["congestion_level"] for r in rows} == expected
    assert {r["port_name"] for r in rows} == {"x"}


SHIPMENT = "shipment_id string, departure_date string, scheduled_arrival string, actual_arrival string, cost_usd string, status string, note string"


def test_clean_shipments(spark):
    raw = spark.createDataFrame(
        [
            ("late", "2024-01-01", "2024-01-10", "2024-01-13", "10.5", "Delivered", "kept"),
            ("early", "2024-01-01", "2024-01-10", "2024-01-08", "x", "Delayed", "kept"),
            ("open", "2024-01-01", "2024-01-10", None, "1", "In Transit", "kept"),
            ("gone", "2024-01-01", "2024-01-10", "2024-01-10", "1", "Cancelled", "kept"),
            ("unknown", None, "2024-01-10", "2024-01-10", "1", None, "kept"),
            ("backward", "2024-01-09", "2024-01-10", "2024-01-07", "1", "Delivered", "kept"),
        ],
        SHIPMENT,
    )
    rows = {r["shipment_id"]: r for r in clean_shipments(raw).collect()}
    measures = {
        k: (r["delay_days"], r["is_on_time"], r["transit_days"], r["departure_month"], r["departure_year"])
        for k, r in rows.items()
    }
    assert measures == {
        "late": (3, False, 12, "2024-01", 2024),
        "early": (0, True, 7, "2024-01", 2024),
        "open": (None, False, None, "2024-01", 2024),
        "unknown": (0, True, None, None, None),
        "backward": (0, True, -2, "2024-01", 2024),
    }
    assert rows["early"]["cost_usd"] is None
    assert {r["note"] for r in rows.values()} == {"kept"}


@pytest.mark.parametrize(
    ("condition", "score"),
    [("Clear", 0), ("Cloudy", 0), ("Rain", 1), ("Fog", 1), ("Thunderstorm", 2), ("Storm", 3), ("Hail", 0), (None, 0)],
)
def test_weather_severity(spark, condition, score):
    raw = spark.createDataFrame(
        [("1", "P1", "2024-01-05", condition, "10.5", "7")],
        "weather_id string, port_id string, weather_date string, condition string, wind_speed_kmh string, visibility_km string",
    )
    row = clean_weather(raw).first()
    assert (row["weather_severity"], row["wind_speed_kmh"], row["visibility_km"]) == (score, 10.5, 7)


def test_clean_carriers(spark):
    raw = spark.createDataFrame(
        [("C1", "\tA ", "4.5", "700"), ("C2", "B", "good", "70.5")],
        "carrier_id string, carrier_name string, rating string, fleet_size string",
    )
    assert [tuple(r) for r in clean_carriers(raw).orderBy("carrier_id").collect()] == [
        ("C1", "A", 4.5, 700),
        ("C2", "B", None, None),
    ]


def test_date_parts_and_labels(spark):
    df = spark.sql("select date '2024-01-07' as sunday, date '2024-01-08' as monday, cast(null as bigint) as none")
    row = df.select(
        M.monday_weekday(F.col("sunday")), M.monday_weekday(F.col("monday")), M.month_number(F.col("monday")),
        M.is_delayed(F.col("none")), M.route_label(F.lit("A"), F.lit("B")), M.route_label(F.lit("A"), F.lit(None)),
    ).first()
    assert tuple(row) == (6, 0, 1, 0, "A → B", None)


def test_rounding_half_away_from_zero(spark):
    row = spark.range(1).select(*[M.half_up(F.lit(x), 1) for x in (0.25, -0.25, 86.25, 86.35)]).first()
    assert tuple(row) == (0.3, -0.3, 86.3, 86.4)
