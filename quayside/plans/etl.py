"""Delivered CSVs to clean tables, the wide table and the KPI views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators import dashboards, marts, states
from quayside.operators.clean import CLEANERS
from quayside.operators.enrich import join_master, weather_daily_max
from quayside.operators.quality import audit_tables, row_counts, schema_audit, table_audit
from quayside.plans import views
from quayside.session import stage
from quayside.sources import catalog, files

KPI_VIEWS = ["v_carrier_kpis", "v_port_congestion", "v_route_performance", "v_monthly_kpis"]


def clean_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: CLEANERS[name](df) for name, df in raw.items()}


def run_etl(spark: SparkSession, raw_dir: str, out_dir: str, multiline: bool | None = None) -> dict[str, DataFrame]:
    """Audit what was delivered, clean and write the tables under ``out_dir``, then the wide table, the additive states
    and the marts.

    The result has the audit beside the tables, as ``audit`` and ``schema_audit``.
    """
    raw = files.read_raw_tables(spark, raw_dir, multiline=multiline)
    audit = stage(audit_tables(table_audit, raw), "audit")
    files.write_parquet_tables(clean_all(raw), out_dir)
    tables = files.read_parquet_tables(spark, out_dir, CLEANERS)
    daily = stage(weather_daily_max(tables["weather"]), "weather-daily")
    master = join_master(tables["shipments"], tables["carriers"], tables["ports"], daily)
    # Shipments lie by year, and so does what is read from them.
    files.write_parquet_tables({"master": master}, out_dir, by_year=True)
    files.write_states(all_states(tables), out_dir)
    files.write_marts(kpi_views(tables), out_dir)
    return read_tables(spark, out_dir) | {"audit": audit, "schema_audit": audit_tables(schema_audit, raw)}


def all_states(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The states that marts, views and the dashboard follow from. Shipments should be a written table."""
    shipments, sides = tables["shipments"], (tables["carriers"], tables["ports"])
    boards = {"board": states.board(shipments, *sides), "samples": dashboards.samples(shipments, *sides, written=True)}
    return states.states(shipments) | boards


def load_years(spark: SparkSession, shipments: DataFrame, out_dir: str) -> None:
    """Replace the years that cleaned ``shipments`` hold, in the shipments and the states under ``out_dir``.

    Other years are neither read nor written.
    """
    fresh = stage(shipments, "delivered-years")
    files.write_states({"shipments": fresh}, out_dir)
    sides = files.read_parquet_tables(spark, out_dir, ["carriers", "ports"])
    files.write_states(all_states({"shipments": fresh, **sides}), out_dir)


def read_states(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    return files.read_parquet_tables(spark, out_dir, files.STATES)


def read_tables(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """Tables, wide table, states and marts as ``run_etl`` wrote them."""
    return files.read_parquet_tables(spark, out_dir, [*files.TABLE_ORDER, *files.STATES, *KPI_VIEWS])


def kpi_views(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    shipments = tables["shipments"]
    return {
        "v_carrier_kpis": marts.carrier_kpis(shipments, tables["carriers"]),
        "v_port_congestion": marts.port_congestion(shipments, tables["ports"]),
        "v_route_performance": marts.route_performance(shipments, tables["ports"]),
        "v_monthly_kpis": marts.monthly_kpis(shipments),
    }


def ordered_views(views: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Each mart in the order in which it is read: by score, congestion, delay and time; ties go by id."""
    order = {
        "v_carrier_kpis": [F.desc("performance_score"), "carrier_id"],
        "v_port_congestion": [F.desc("congestion_index"), "port_id"],
        "v_route_performance": [F.asc("avg_delay"), "origin_port_id", "destination_port_id"],
        "v_monthly_kpis": ["departure_month"],
    }
    return {name: df.orderBy(*order[name]) for name, df in views.items()}


def publish(tables: dict[str, DataFrame]) -> None:
    """Make tables and KPI views available by name in the session, written marts where there are any."""
    views = {name: tables[name] for name in KPI_VIEWS if name in tables} or kpi_views(tables)
    files.register_views({name: tables[name] for name in files.TABLE_ORDER} | ordered_views(views))


def save(tables: dict[str, DataFrame], database: str | None = None) -> None:
    """Replace tables, wide table and states in the catalog, where they outlive the session, each in one switch, and
    create the KPI views over them. States that are not given come from the shipments."""
    saved = {name: df for name, df in tables.items() if name in [*files.TABLE_ORDER, *files.STATES]}
    if {"shipments", "carriers", "ports"} <= set(saved):
        saved = all_states(saved) | saved
    files.save_tables(saved, database)
    if {*states.KEYS, "carriers", "ports"} <= set(saved):
        catalog.create_views(saved["carriers"].sparkSession, views.KPI_SQL, database)


def saved_check(spark: SparkSession, database: str) -> DataFrame:
    """The check after a load, on the views as any later session finds them."""
    return post_load_check(*(catalog.table(spark, name, database) for name in ("v_carrier_kpis", "v_monthly_kpis")))


def post_load_check(carrier_kpis: DataFrame, monthly_kpis: DataFrame) -> DataFrame:
    """Rows of the two ranking reports, run once after a load."""
    return row_counts(
        {
            "carrier_delay_rank": marts.carrier_delay_rank(carrier_kpis),
            "monthly_delay_rolling_avg": marts.monthly_delay_rolling_avg(monthly_kpis),
        }
    )
