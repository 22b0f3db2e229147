"""Every registered query: ``(spark, sf_dir) -> DataFrame`` over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import measures as M
from quayside.functions.casting import null_tokens_to_null
from quayside.functions.joins import broadcast_if_small
from quayside.operators import clean, dashboards, enrich, features, marts, models, quality, states, whatif
from quayside.plans import etl, training
from quayside.session import stage, staging_path
from quayside.sources import files, testdata

Query = Callable[[SparkSession, str], DataFrame]

# What a dashboard user picked.
YEARS = [1996, 1997, 1998]
REGIONS = ["ASIA", "EUROPE"]
CARRIER_FROM = "Supplier#000000003"
CARRIER_TO = "Supplier#000000007"

# Route bounds in the region names of the test tables: some pairs one way only, some not listed.
REGION_BOUNDS = {
    ("ASIA", "AMERICA"): (14, 22),
    ("ASIA", "EUROPE"): (20, 30),
    ("ASIA", "MIDDLE EAST"): (8, 14),
    ("EUROPE", "AMERICA"): (10, 16),
    ("EUROPE", "MIDDLE EAST"): (8, 14),
    ("MIDDLE EAST", "EUROPE"): (9, 15),
    ("MIDDLE EAST", "AMERICA"): (18, 26),
    ("AFRICA", "EUROPE"): (6, 12),
}


@lru_cache(maxsize=16)
def shipments(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_shipments(testdata.shipments(spark, sf))


@lru_cache(maxsize=16)
def carriers(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_carriers(testdata.carriers(spark, sf))


@lru_cache(maxsize=16)
def ports(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_ports(testdata.ports(spark, sf))


@lru_cache(maxsize=16)
def weather(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_weather(testdata.weather(spark, sf))


@lru_cache(maxsize=16)
def carrier_side(spark: SparkSession, sf: str) -> DataFrame:
    return broadcast_if_small(carriers(spark, sf))


@lru_cache(maxsize=16)
def port_side(spark: SparkSession, sf: str) -> DataFrame:
    return broadcast_if_small(ports(spark, sf))


def with_origin(spark: SparkSession, sf: str) -> DataFrame:
    """The part of the wide table that most dashboard figures need."""
    return enrich.attach_origin(shipments(spark, sf), port_side(spark, sf))


def with_origin_and_carrier(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.attach_carrier(with_origin(spark, sf), carrier_side(spark, sf))


def with_both_ports(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.attach_destination(with_origin(spark, sf), port_side(spark, sf))


def raw(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {name: null_tokens_to_null(make(spark, sf)) for name, make in testdata.RAW.items()}


def clean_table(name: str) -> Query:
    return lambda spark, sf: clean.CLEANERS[name](null_tokens_to_null(testdata.RAW[name](spark, sf)))


def schema_audit(spark: SparkSession, sf: str) -> DataFrame:
    """A delivery in which carriers lack a column, weather has a strange one and ports have both faults."""
    tables = raw(spark, sf)
    tables["carriers"] = tables["carriers"].drop("fleet_size")
    tables["weather"] = tables["weather"].withColumn("station", F.lit("A"))
    tables["ports"] = tables["ports"].withColumnRenamed("congestion_index", "congestion")
    return quality.audit_tables(quality.schema_audit, tables)


def carrier_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return marts.carrier_kpis(shipments(spark, sf), carrier_side(spark, sf))


def port_congestion(spark: SparkSession, sf: str) -> DataFrame:
    return marts.port_congestion(shipments(spark, sf), ports(spark, sf))


def route_performance(spark: SparkSession, sf: str, min_shipments: int = 5) -> DataFrame:
    return marts.route_performance(shipments(spark, sf), port_side(spark, sf), min_shipments)


def monthly_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return marts.monthly_kpis(shipments(spark, sf))


def master(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.build_master(*(make(spark, sf) for make in (shipments, carriers, ports, weather)))


def route_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Per pair of regions: the usual days, the shipments, and how many were planned within them."""
    # Planned days are few, so the shipments shrink before they meet the bounds.
    planned = (
        with_both_ports(spark, sf)
        .groupBy(
            "origin_region",
            "dest_region",
            F.datediff("scheduled_arrival", "departure_date").alias("planned_days"),
        )
        .agg(F.count("*").alias("n"))
    )
    within = F.col("planned_days").between(F.col("min_days"), F.col("max_days"))
    return (
        enrich.with_route_days(planned, REGION_BOUNDS)
        .groupBy("origin_region", "dest_region", "min_days", "max_days")
        .agg(F.sum("n").alias("shipments"), F.sum(F.when(within, F.col("n")).otherwise(0)).alias("planned_within"))
    )


def delay_prior(spark: SparkSession, sf: str) -> DataFrame:
    wide = enrich.attach_carrier(with_both_ports(spark, sf), carrier_side(spark, sf))
    return enrich.with_delay_prior(wide).select("shipment_id", M.half_up(F.col("delay_prior"), 6).alias("delay_prior"))


def written_csvs(spark: SparkSession, sf: str) -> str:
    folder = staging_path(spark, "raw-csv")
    for name, make in testdata.RAW.items():
        files.write_csv(make(spark, sf), f"{folder}/{name}.csv")
    return folder


def csv_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Shipments after a trip through a CSV file."""
    folder = staging_path(spark, "raw-csv")
    files.write_csv(testdata.raw_shipments(spark, sf), f"{folder}/shipments.csv")
    return clean.clean_shipments(files.read_raw_tables(spark, folder, ["shipments"])["shipments"])


def etl_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return etl.run_etl(spark, written_csvs(spark, sf), staging_path(spark, "processed"))


def etl_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    """CSV files through the whole batch, then the rows of every table and mart it wrote."""
    tables = etl_tables(spark, sf)
    return quality.row_counts({name: tables[name] for name in [*files.TABLE_ORDER, *etl.KPI_VIEWS]})


def etl_audit(spark: SparkSession, sf: str) -> DataFrame:
    """What the batch finds in the delivered files, before it writes anything."""
    return quality.audit_tables(quality.table_audit, files.read_raw_tables(spark, written_csvs(spark, sf)))


def ports_csv_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Port names as they come back from a CSV file, with blanks and line breaks at their ends."""
    folder = staging_path(spark, "raw-csv")
    files.write_csv(testdata.RAW["ports"](spark, sf), f"{folder}/ports.csv")
    return files.read_raw_tables(spark, folder, ["ports"])["ports"]


def csv_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned carriers after a trip through the CSV files that cleaned tables are written to."""
    folder = staging_path(spark, "clean-csv")
    files.write_csv_tables({"carriers": carriers(spark, sf), "ports": ports(spark, sf)}, folder)
    return clean.clean_carriers(files.read_csv(spark, f"{folder}/carriers.csv"))


def _in_database(spark: SparkSession, work: Callable[[str], DataFrame]) -> DataFrame:
    """What ``work`` finds in a database of its own; the database goes again."""
    location = staging_path(spark, "database")
    database = "quayside_" + location.rpartition("-")[2]
    spark.sql(f"create database {database} location '{location}'")
    try:
        return stage(work(database), "found-in-database")
    finally:
        spark.sql(f"drop database {database} cascade")


def saved_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the tables and views in a catalog database that the batch saved them to."""

    def work(database: str) -> DataFrame:
        tables = {"carriers": carriers(spark, sf), "ports": ports(spark, sf), "shipments": written_shipments(spark, sf)}
        etl.save(tables, database)
        names = ["carriers", "ports", "v_carrier_kpis", "v_monthly_kpis"]
        found = files.read_relations(spark, [f"{database}.{name}" for name in names])
        return quality.row_counts({name.partition(".")[2]: df for name, df in found.items()})

    return _in_database(spark, work)


def saved_views(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the four KPI views as another session opens them by name, after the tables below them were replaced."""

    def work(database: str) -> DataFrame:
        fact = written_shipments(spark, sf)
        tables = {"carriers": carriers(spark, sf), "ports": ports(spark, sf)}
        etl.save(tables | states.states(fact.where("departure_year = 1996")), database)
        files.save_tables(states.states(fact), database)
        later = spark.newSession()
        return quality.row_counts({name: later.table(f"{database}.{name}") for name in etl.KPI_VIEWS})

    return _in_database(spark, work)


def saved_view(name: str) -> Query:
    """The rows of one KPI view of a saved database."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        def work(database: str) -> DataFrame:
            sides = {"carriers": carriers(spark, sf), "ports": ports(spark, sf)}
            etl.save(sides | states.states(written_shipments(spark, sf)), database)
            return spark.table(f"{database}.{name}")

        return _in_database(spark, work)

    return query


def saved_load_check(spark: SparkSession, sf: str) -> DataFrame:
    """The check after the load, on what was saved."""

    def work(database: str) -> DataFrame:
        sides = {"carriers": carriers(spark, sf), "ports": ports(spark, sf)}
        etl.save(sides | states.states(written_shipments(spark, sf)), database)
        return etl.saved_check(spark.newSession(), database)

    return _in_database(spark, work)


@lru_cache(maxsize=4)
def board(spark: SparkSession, sf: str) -> DataFrame:
    """The board as the load writes it."""
    folder = staging_path(spark, "states")
    sides = carrier_side(spark, sf), port_side(spark, sf)
    files.write_states({"board": states.board(shipments(spark, sf), *sides)}, folder)
    return files.read_parquet_tables(spark, folder, ["board"])["board"]


def samples(spark: SparkSession, sf: str) -> DataFrame:
    """The samples as the load writes them."""
    folder = staging_path(spark, "states")
    sides = carrier_side(spark, sf), port_side(spark, sf)
    files.write_states({"samples": dashboards.samples(shipments(spark, sf), *sides)}, folder)
    return files.read_parquet_tables(spark, folder, ["samples"])["samples"]


def year_load(spark: SparkSession, sf: str) -> DataFrame:
    """Carrier figures from states of which one year was delivered wrong first and then again."""
    folder = staging_path(spark, "years")
    fact = written_shipments(spark, sf)
    files.write_parquet_tables({"carriers": carriers(spark, sf), "ports": ports(spark, sf)}, folder)
    etl.load_years(spark, fact.where("departure_year <> 1996 or transit_days > 20"), folder)
    etl.load_years(spark, fact.where("departure_year = 1996"), folder)
    return states.carrier_kpis(etl.read_states(spark, folder)["carrier_state"], carrier_side(spark, sf))


@lru_cache(maxsize=4)
def written_shipments(spark: SparkSession, sf: str) -> DataFrame:
    return stage(shipments(spark, sf), "shipments")


@lru_cache(maxsize=4)
def wide_table(spark: SparkSession, sf: str) -> DataFrame:
    """The wide table over written shipments and daily weather; each query computes the columns that it needs."""
    daily = stage(enrich.weather_daily_max(weather(spark, sf)), "weather-daily")
    return enrich.join_master(written_shipments(spark, sf), carriers(spark, sf), ports(spark, sf), daily)


@lru_cache(maxsize=4)
def prepared(spark: SparkSession, sf: str) -> training.Prepared:
    fact = written_shipments(spark, sf)
    # Categories need no weather, and in place of all shipments their carriers and pairs of ports, each alone: of carriers
    # with both ports there may be as many as shipments.
    names = enrich.attach_carrier(fact.select("carrier_id").distinct(), carrier_side(spark, sf))
    pairs = fact.select("origin_port_id", "destination_port_id").distinct()
    places = enrich.attach_destination(enrich.attach_origin(pairs, port_side(spark, sf)), port_side(spark, sf))
    return training.Prepared(wide_table(spark, sf), fact, [names, places])


DELAY_SHAPE, COST_SHAPE = models.DELAY_SHAPE, models.COST_SHAPE


@lru_cache(maxsize=4)
def delay_classifier(spark: SparkSession, sf: str) -> GBTClassificationModel:
    return training.delay_classifier(prepared(spark, sf), DELAY_SHAPE)


@lru_cache(maxsize=4)
def delay_regressor(spark: SparkSession, sf: str) -> GBTRegressionModel:
    return training.delay_regressor(prepared(spark, sf), DELAY_SHAPE)


@lru_cache(maxsize=4)
def cost_model(spark: SparkSession, sf: str) -> GBTRegressionModel:
    return training.cost_model(prepared(spark, sf), COST_SHAPE)


MODELS = (delay_classifier, delay_regressor, cost_model)


def clear_caches() -> None:
    """Forget what queries keep for each other, as at the start of a session."""
    tables = (shipments, carriers, ports, weather, carrier_side, port_side, written_shipments, wide_table, prepared, board)
    for kept in (*tables, *MODELS):
        kept.cache_clear()


def feature_table(spark: SparkSession, sf: str) -> DataFrame:
    return features.feature_table(wide_table(spark, sf), prepared(spark, sf).codes)


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Shipments with the label and the marks of both splits, for which no join is needed."""
    fact = written_shipments(spark, sf)
    rows = fact.select("shipment_id", "delay_days", M.is_delayed(F.col("delay_days")).alias("delay_binary"))
    return training.Prepared(fact).marked(rows)


def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return labelled(spark, sf).select("shipment_id", "delay_binary", F.col("in_delay_train").alias("is_train"))


def stratified_split_counts(spark: SparkSession, sf: str) -> DataFrame:
    return (
        stratified_split(spark, sf)
        .groupBy("delay_binary")
        .agg(F.count_if("is_train").alias("n_train"), F.count_if(~F.col("is_train")).alias("n_test"))
    )


def plain_split(spark: SparkSession, sf: str) -> DataFrame:
    return features.plain_split(shipments(spark, sf)).select("shipment_id", "is_train")


def fixed_report(spark: SparkSession, sf: str) -> DataFrame:
    """The classification report over predictions that are the parity of the shipment id's hash."""
    odd = F.conv(F.substring(F.md5("shipment_id"), 1, 1), 16, 10).cast("int") % 2
    scored = features.labelled(shipments(spark, sf)).select("delay_binary", odd.cast("double").alias("prediction"))
    report = models.classification_report(scored)
    return report.select("class", "support", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1", "accuracy")])


def fixed_errors(spark: SparkSession, sf: str) -> DataFrame:
    """The regression report over predictions of three days for every shipment that has arrived."""
    scored = shipments(spark, sf).select("delay_days", F.lit(3.0).alias("prediction"))
    report = models.regression_report(scored, "delay_days")
    return report.select("support", *[F.round(c, 6).alias(c) for c in ("mae", "rmse", "r2")])


# What trained models say has no SQL: another engine trains other trees. Tests score a fixture from the table of nodes in
# another engine and recompute the figures from the scores.


def delay_classifier_metrics(spark: SparkSession, sf: str) -> DataFrame:
    _, test = training.split(prepared(spark, sf))
    return models.classification_report(models.score_delay(test, delay_classifier(spark, sf)))


def delay_regressor_metrics(spark: SparkSession, sf: str) -> DataFrame:
    _, test = training.split(prepared(spark, sf))
    scored = models.predict_days(test.where("delay_days > 0"), delay_regressor(spark, sf))
    return models.regression_report(scored, "delay_days")


def cost_model_metrics(spark: SparkSession, sf: str) -> DataFrame:
    _, test = training.split(prepared(spark, sf), stratified=False)
    return models.regression_report(models.predict_cost(test, cost_model(spark, sf)), "cost_usd")


def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    return models.feature_importance(spark, delay_classifier(spark, sf))


def score_shipments(spark: SparkSession, sf: str) -> DataFrame:
    scored = models.score_delay(prepared(spark, sf).inputs, delay_classifier(spark, sf))
    return scored.select("shipment_id", "prediction", "delay_probability")


def delay_model_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """The saved classifier, read back as a table of nodes."""
    path = staging_path(spark, "delay-classifier")
    delay_classifier(spark, sf).write().save(path)
    return models.node_table(spark, path)


def whatif_carrier_switch(spark: SparkSession, sf: str) -> DataFrame:
    model, codes = delay_classifier(spark, sf), prepared(spark, sf).codes
    return whatif.whatif_carrier_switch(wide_table(spark, sf), carriers(spark, sf), model, codes, "C000003", "C000007")


def model_queries() -> dict[str, Query]:
    """The figures of trained models, which no SQL can express."""
    return {
        "delay_classifier_metrics": delay_classifier_metrics,
        "delay_regressor_metrics": delay_regressor_metrics,
        "cost_model_metrics": cost_model_metrics,
        "feature_importance": feature_importance,
        "score_shipments": score_shipments,
        "delay_model_nodes": delay_model_nodes,
        "whatif_carrier_switch": whatif_carrier_switch,
    }


def queries() -> dict[str, Query]:
    return {
        "clean_carriers": clean_table("carriers"),
        "clean_ports": clean_table("ports"),
        "clean_shipments": clean_table("shipments"),
        "clean_weather": clean_table("weather"),
        "csv_ingest": csv_ingest,
        "ports_csv_ingest": ports_csv_ingest,
        "csv_tables": csv_tables,
        "saved_tables": saved_tables,
        "saved_views": saved_views,
        "saved_load_check": saved_load_check,
        **{f"saved_{name}": saved_view(name) for name in etl.KPI_VIEWS},
        "year_load": year_load,
        "etl_row_counts": etl_row_counts,
        "etl_audit": etl_audit,
        "schema_audit": schema_audit,
        "null_audit": lambda s, d: quality.audit_tables(quality.null_audit, raw(s, d)),
        "row_audit": lambda s, d: quality.audit_tables(quality.row_audit, raw(s, d)),
        "shipment_quality_metrics": lambda s, d: quality.shipment_quality_metrics(shipments(s, d)),
        "post_load_check": lambda s, d: etl.post_load_check(carrier_kpis(s, d), monthly_kpis(s, d)),
        "preview_shipments": lambda s, d: quality.preview(shipments(s, d), "shipment_id"),
        "carrier_kpis": carrier_kpis,
        "port_congestion": port_congestion,
        "route_performance": route_performance,
        "route_performance_min100": lambda s, d: route_performance(s, d, 100),
        "monthly_kpis": monthly_kpis,
        "carrier_delay_rank": lambda s, d: marts.carrier_delay_rank(carrier_kpis(s, d)),
        "monthly_delay_rolling_avg": lambda s, d: marts.monthly_delay_rolling_avg(monthly_kpis(s, d)),
        "weather_daily_max": lambda s, d: enrich.weather_daily_max(weather(s, d)),
        "master": master,
        "route_bounds": route_bounds,
        "delay_prior": delay_prior,
        "weather_gap_report": lambda s, d: enrich.weather_gaps(ports(s, d), weather(s, d)),
        "kpi_strip": lambda s, d: dashboards.kpi_strip(with_origin(s, d), YEARS, REGIONS),
        "monthly_trend": lambda s, d: dashboards.monthly_trend(monthly_kpis(s, d), YEARS),
        "delay_histogram": lambda s, d: dashboards.delay_histogram(with_origin(s, d), YEARS, REGIONS),
        "carrier_ranking": lambda s, d: dashboards.carrier_ranking(carrier_kpis(s, d)),
        "port_bubble": lambda s, d: dashboards.port_bubble(port_congestion(s, d)),
        "top_routes": lambda s, d: dashboards.top_routes(route_performance(s, d)),
        "cost_delay_sample": lambda s, d: dashboards.cost_delay_sample(with_origin_and_carrier(s, d), YEARS, REGIONS),
        "carrier_compare": lambda s, d: dashboards.carrier_compare(
            with_origin_and_carrier(s, d), YEARS, REGIONS, CARRIER_FROM, CARRIER_TO
        ),
        "filter_options": lambda s, d: dashboards.filter_options(with_origin_and_carrier(s, d)),
        "board_kpi_strip": lambda s, d: dashboards.kpi_strip_of_board(board(s, d), YEARS, REGIONS),
        "board_delay_histogram": lambda s, d: dashboards.delay_histogram_of_board(board(s, d), YEARS, REGIONS),
        "board_carrier_compare": lambda s, d: dashboards.carrier_compare_of_board(
            board(s, d), YEARS, REGIONS, CARRIER_FROM, CARRIER_TO
        ),
        "board_cost_delay_sample": lambda s, d: dashboards.cost_delay_sample_of(samples(s, d), YEARS, REGIONS),
        "board_filter_options": lambda s, d: dashboards.filter_options(board(s, d)),
        "feature_table": feature_table,
        "stratified_split": stratified_split,
        "stratified_split_counts": stratified_split_counts,
        "plain_split": plain_split,
        "fixed_report": fixed_report,
        "fixed_errors": fixed_errors,
    }
