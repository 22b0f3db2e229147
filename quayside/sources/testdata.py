"""The four delivered tables, derived from the star-schema test tables."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


LINES_PER_TASK = 1_000_000  # as many as a task sorts in memory


@lru_cache(maxsize=64)
def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@lru_cache(maxsize=16)
def _join_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks of the join of line items: as the session says, and more where these would be too many lines for a task.

    Parquet keeps row counts, so none is read for this.
    """
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-_table(spark, sf_dir, "lineitem").count() // LINES_PER_TASK))


def carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation")
    return (
        _table(spark, sf_dir, "supplier")
        .join(nation, F.expr("s_nationkey = n_nationkey"))
        .selectExpr(
            "'C' || lpad(cast(s_suppkey as string), 6, '0') as carrier_id",
            "s_name as carrier_name",
            "case s_suppkey % 4 when 0 then 'Ocean' when 1 then 'Air' when 2 then 'Rail' else 'Multi' end"
            " as carrier_type",
            "cast(30 + s_suppkey % 18 as double) / 10 as rating",
            "n_name as country",
            "cast(100 + s_suppkey * 7 % 600 as bigint) as fleet_size",
        )
    )


def ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = _table(spark, sf_dir, "region")
    return (
        _table(spark, sf_dir, "nation")
        .join(region, F.expr("n_regionkey = r_regionkey"))
        .selectExpr(
            "'P' || lpad(cast(n_nationkey as string), 3, '0') as port_id",
            "n_name as port_name",
            "n_name as country",
            "r_name as region",
            "cast(n_nationkey * 37 % 101 as double) / 100 as congestion_index",
        )
    )


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the customer's nation as destination.

    Orders meet customers first: both are far smaller than the line items, which are then shuffled once. Both
    sides of that join grow with the data, and the size estimate of a join is too high, so the planner is told
    to merge rather than to broadcast the line items as the seemingly smaller side. The number of tasks follows the
    line items, so that none has to spill what it sorts.
    """
    tasks = _join_tasks(spark, sf_dir)
    lines = _table(spark, sf_dir, "lineitem")
    destinations = (
        _table(spark, sf_dir, "orders")
        .join(_table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
        .select("o_orderkey", "c_nationkey")
    )
    if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):
        destinations, lines = destinations.repartition(tasks, "o_orderkey"), lines.repartition(tasks, "l_orderkey")
    return (
        lines.join(destinations.hint("merge"), F.expr("l_orderkey = o_orderkey"))
        .selectExpr(
            "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_quantity as int)) as shipment_id",
            "'P' || lpad(cast(l_partkey % 24 as string), 3, '0') as origin_port_id",
            "'P' || lpad(cast(c_nationkey as string), 3, '0') as destination_port_id",
            "'C' || lpad(cast(l_suppkey as string), 6, '0') as carrier_id",
            "cast(l_shipdate as date) as departure_date",
            "date_add(cast(l_shipdate as date), cast(5 + l_partkey % 26 as int)) as scheduled_arrival",
            "case when (l_orderkey + l_partkey) % 97 <> 0 then date_add(cast(l_shipdate as date),"
            " cast(5 + l_partkey % 26 + case l_returnflag when 'R' then 1 + l_orderkey % 15"
            " when 'A' then - (l_orderkey % 3) else 0 end as int)) end as actual_arrival",
            "l_extendedprice as cost_usd",
            "case when (l_orderkey + l_partkey) % 97 = 0 and l_linenumber <= 5 then 'Cancelled'"
            " when l_linestatus = 'O' and l_returnflag = 'N' then 'In Transit'"
            " when l_returnflag = 'R' then 'Delayed' else 'Delivered' end as status",
        )
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").selectExpr(
        "event_id as weather_id",
        "'P' || lpad(cast(user_id % 25 as string), 3, '0') as port_id",
        "date_add(date '1995-01-01', cast(3 * (event_id % 833) as int)) as weather_date",
        "case (event_id * 5 + user_id) % 7 when 0 then 'Clear' when 1 then 'Cloudy' when 2 then 'Rain'"
        " when 3 then 'Thunderstorm' when 4 then 'Fog' when 5 then 'Storm' else 'Hail' end as condition",
        "cast(50 + cast(round(value * 100) as bigint) % 850 as double) / 10 as wind_speed_kmh",
        "cast(1 + event_id % 20 as bigint) as visibility_km",
    )


# The same tables as they might arrive in a CSV: all text, with padding, missing-value words and values that
# do not parse.


def raw_carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = carriers(spark, sf_dir).withColumn("n", F.expr("cast(substr(carrier_id, 2, 6) as int)"))
    return numbered.selectExpr(
        "carrier_id",
        "if(n % 3 = 0, '\\t ' || carrier_name || '  ', carrier_name) as carrier_name",
        "if(n % 11 = 0, 'n/a', carrier_type) as carrier_type",
        "case n % 7 when 0 then 'n/a' when 1 then 'good' when 2 then rating || 'f'"
        " else cast(rating as string) end as rating",
        "country",
        "case n % 5 when 0 then fleet_size || '.5' when 1 then fleet_size || '.0' when 2 then 'many'"
        " else cast(fleet_size as string) end as fleet_size",
    )


def raw_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = ports(spark, sf_dir).withColumn("n", F.expr("cast(substr(port_id, 2, 3) as int)"))
    return numbered.selectExpr(
        "port_id",
        "if(n % 2 = 0, '  ' || port_name || '\\n', port_name) as port_name",
        "country",
        "if(n = 7, 'NULL', region) as region",
        "case n when 3 then '?' when 9 then '' else ' ' || congestion_index end as congestion_index",
    )


def raw_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = shipments(spark, sf_dir).withColumn("n", F.dayofyear("departure_date"))
    return numbered.selectExpr(
        "shipment_id",
        "origin_port_id",
        "destination_port_id",
        "carrier_id",
        "if(n = 40, 'soon', cast(departure_date as string)) as departure_date",
        "if(n = 41, '1999-02-30', cast(scheduled_arrival as string)) as scheduled_arrival",
        "case when actual_arrival is null then 'NaN' when n = 42 then actual_arrival || ' 10:00:00'"
        " else cast(actual_arrival as string) end as actual_arrival",
        "if(n % 50 = 43, '$' || cost_usd, cast(cost_usd as string)) as cost_usd",
        "if(n = 44, 'None', status) as status",
    )


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather(spark, sf_dir).selectExpr(
        "cast(weather_id as string) as weather_id",
        "port_id",
        "if(weather_id % 19 = 0, 'today', cast(weather_date as string)) as weather_date",
        "if(weather_id % 17 = 0, '#N/A', condition) as condition",
        "if(weather_id % 13 = 0, 'calm', cast(wind_speed_kmh as string)) as wind_speed_kmh",
        "if(weather_id % 23 = 0, '<NA>', cast(visibility_km as string)) as visibility_km",
    )


CLEAN = {"carriers": carriers, "ports": ports, "shipments": shipments, "weather": weather}
RAW = {"carriers": raw_carriers, "ports": raw_ports, "shipments": raw_shipments, "weather": raw_weather}
