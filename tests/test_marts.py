"""Null order, thresholds and bins that the test tables do not reach."""

import sqlite3

from quayside.operators import dashboards, marts
from quayside.operators.enrich import with_route_days

KPI = "carrier_id string, carrier_name string, avg_delay_days double, on_time_pct double, performance_score double"


def test_ranks_equal_sqlite_with_ties_and_nulls(spark):
    rows = [
        ("C1", "a", 1.0, 50.0, 90.0), ("C2", "b", 1.0, 50.0, 90.0), ("C3", "c", None, 50.0, 80.5),
        ("C4", "d", 0.5, 50.0, None), ("C5", "e", 2.0, 50.0, 0.0), ("C6", "f", None, 50.0, -3.0), ("C7", "g", 2.0, 50.0, None),
    ]
    got = marts.carrier_delay_rank(spark.createDataFrame(rows, KPI)).select("carrier_id", "perf_rank", "delay_rank")
    con = sqlite3.connect(":memory:")
    con.execute("create table k (id, name, delay real, pct real, score real)")
    con.executemany("insert into k values (?, ?, ?, ?, ?)", rows)
    sql = "select id, rank() over (order by score desc), rank() over (order by delay) from k"
    assert sorted(tuple(r) for r in got.collect()) == sorted(con.execute(sql).fetchall())


def test_rolling_average_counts_rows_not_months(spark):
    rows = [("2024-01", 1.0), ("2024-02", 2.0), ("2024-06", 4.0), ("2024-07", None), ("2024-08", 1.0)]
    df = spark.createDataFrame(rows, "departure_month string, avg_delay_days double")
    got = {r[0]: r[2] for r in marts.monthly_delay_rolling_avg(df).collect()}
    assert got == {"2024-01": 1.0, "2024-02": 1.5, "2024-06": 2.33, "2024-07": 3.0, "2024-08": 2.5}


SHIP = "shipment_id string, origin_port_id string, destination_port_id string, delay_days bigint, transit_days bigint, cost_usd double, is_on_time boolean"
PORT = "port_id string, port_name string, region string, congestion_index double, congestion_level string"


def test_route_threshold_and_idle_port(spark):
    ships = spark.createDataFrame(
        [(f"a{i}", "P1", "P2", i, 5, 10.0, i == 0) for i in range(5)]
        + [(f"b{i}", "P2", "P1", None, None, None, False) for i in range(4)],
        SHIP,
    )
    ports = spark.createDataFrame([(p, p.lower(), "R", 0.5, "Low") for p in ("P1", "P2", "P3")], PORT)
    routes = marts.route_performance(ships, ports).collect()
    assert [(r["origin_port"], r["shipment_count"], r["avg_delay"], r["on_time_pct"]) for r in routes] == [("p1", 5, 2.0, 20.0)]
    idle = {r["port_id"]: (r["departures"], r["avg_departure_delay"], r["avg_cost_origin"]) for r in marts.port_congestion(ships, ports).collect()}
    assert idle == {"P1": (5, 2.0, 10.0), "P2": (4, None, None), "P3": (0, None, None)}


def test_histogram_widens_its_bins(spark):
    rows = [(d, 2024, "R") for d in (1, 2, 2, 55, 99)] + [(0, 2024, "R"), (None, 2024, "R"), (7, 2023, "R")]
    df = spark.createDataFrame(rows, "delay_days bigint, departure_year int, origin_region string")
    got = sorted(tuple(r) for r in dashboards.delay_histogram(df, [2024], ["R"]).collect())
    assert got == [(0, 5, 3), (55, 60, 1), (95, 100, 1)]
    assert dashboards.delay_histogram(df, [1999], ["R"]).collect() == []


def test_kpi_strip_of_nothing(spark):
    df = spark.createDataFrame([], "delay_days bigint, departure_year int, origin_region string, is_on_time boolean, cost_usd double, transit_days bigint")
    row = dashboards.kpi_strip(df, [2024], ["R"]).first()
    assert (row["total_shipments_text"], row["on_time_rate_text"], row["avg_cost_usd_text"]) == ("0", "nan%", "$nan")


def test_route_days_both_ways(spark):
    pairs = [("Asia Pacific", "Europe"), ("Europe", "Asia Pacific"), ("South Asia", "Middle East"), ("Europe", None)]
    df = spark.createDataFrame(pairs, "origin_region string, dest_region string")
    got = {(r["origin_region"], r["dest_region"]): (r["min_days"], r["max_days"]) for r in with_route_days(df).collect()}
    assert got == dict(zip(pairs, [(20, 30), (20, 30), (10, 20), (10, 20)]))


def test_rankings_and_lists_come_in_order(spark, sf_dir):
    from quayside.plans import registry

    queries = registry.queries()

    def column(name, *fields):
        return [tuple(r[f] for f in fields) for r in queries[name](spark, sf_dir).collect()]

    scores = column("carrier_ranking", "performance_score", "carrier_name")
    assert scores == sorted(scores, key=lambda r: (-r[0], r[1]))
    busy = column("port_bubble", "congestion_index", "port_name")
    assert busy == sorted(busy, key=lambda r: (-r[0], r[1]))
    best = [float(r[0].rstrip("%")) for r in column("top_routes", "on_time_pct")]
    assert best == sorted(best, reverse=True) and len(best) == 15
    months = column("monthly_trend", "departure_month")
    assert months == sorted(months) and len(months) == 36
    options = column("filter_options", "option", "value")
    assert options == sorted(options)
    first = column("preview_shipments", "shipment_id")
    assert first == sorted(first) and len(first) == 3
