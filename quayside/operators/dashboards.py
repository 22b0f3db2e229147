"""Datasets behind the dashboard. ``master`` may be any table with the columns used."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions import display as D
from quayside.functions import measures as M
from quayside.functions.joins import broadcast_if_small
from quayside.functions.ordering import hash_order
from quayside.operators import states as S
from quayside.session import stage

# Shipments of a sample, and of each year and origin region that samples are merged from.
SAMPLED, SAMPLE_SEED = 300, 42

Years = Sequence[int] | None
Regions = Sequence[str] | None


def _picked(column: str, choice: Sequence | None) -> Column:
    return F.col(column).isNotNull() if choice is None else F.col(column).isin(*choice)


def selected(master: DataFrame, years: Years = None, regions: Regions = None) -> DataFrame:
    """Rows of the chosen years and origin regions; ``None`` chooses every known one."""
    return master.where(_picked("departure_year", years) & _picked("origin_region", regions))


def kpi_strip(master: DataFrame, years: Years, regions: Regions) -> DataFrame:
    """The headline figures, as numbers and as shown."""
    figures = selected(master, years, regions).agg(
        F.count("*").alias("total_shipments"),
        M.share(F.col("is_on_time")).alias("on_time_rate"),
        M.mean_late(F.col("delay_days")).alias("avg_delay_delayed"),
        M.mean_cost(F.col("cost_usd")).alias("avg_cost_usd"),
        F.avg("transit_days").alias("avg_transit_days"),
    )
    return _shown_strip(figures)


def _shown_strip(figures: DataFrame) -> DataFrame:
    return figures.withColumns(
        {
            "total_shipments_text": D.grouped(F.col("total_shipments"), 0),
            "on_time_rate_text": D.percent(F.col("on_time_rate")),
            "avg_delay_delayed_text": D.days(F.col("avg_delay_delayed")),
            "avg_cost_usd_text": D.dollars(F.col("avg_cost_usd")),
            "avg_transit_days_text": D.days(F.col("avg_transit_days")),
        }
    )


def monthly_trend(monthly: DataFrame, years: Years) -> DataFrame:
    """Volume and on-time share per month of the chosen years, in order of time; regions do not apply."""
    dated = monthly.withColumn("_year", F.substring("departure_month", 1, 4))
    chosen = dated.where(_picked("_year", None if years is None else [str(y) for y in years]))
    return chosen.select("departure_month", "total_shipments", "on_time_pct").orderBy("departure_month")


def delay_histogram(master: DataFrame, years: Years, regions: Regions, max_bins: int = 20) -> DataFrame:
    """Delayed shipments per bin of whole days, in the narrowest of 1, 2, 5, 10, 20, ... days that fits.

    Shipments are counted per day first; the bins are merged from those counts.
    """
    late = selected(master, years, regions).where("delay_days > 0")
    return _histogram(late.groupBy("delay_days").agg(F.count("*").alias("n")), max_bins)


def _histogram(per_day: DataFrame, max_bins: int) -> DataFrame:
    ends = per_day.agg(F.struct(F.min("delay_days").alias("a"), F.max("delay_days").alias("b"))).scalar()
    widths = [step * 10**power for power in range(7) for step in (1, 2, 5)]
    fits = [f"when floor(_ends.b / {w}) - floor(_ends.a / {w}) < {max_bins} then {w}" for w in widths]
    width = F.expr(f"cast(case {' '.join(fits)} end as bigint)")
    return (
        per_day.withColumn("_ends", ends)
        .withColumn("width", width)
        .withColumn("bin_start", F.floor(F.col("delay_days") / F.col("width")) * F.col("width"))
        .groupBy("bin_start", (F.col("bin_start") + F.col("width")).alias("bin_end"))
        .agg(F.sum("n").alias("shipments"))
    )


def carrier_ranking(kpis: DataFrame) -> DataFrame:
    return kpis.select("carrier_name", "on_time_pct", "avg_delay_days", "avg_cost_usd", "performance_score").orderBy(
        F.desc("performance_score"), "carrier_name"
    )


def port_bubble(congestion: DataFrame) -> DataFrame:
    return congestion.select("port_name", "region", "congestion_index", "avg_departure_delay", "departures").orderBy(
        F.desc("congestion_index"), "port_name"
    )


def top_routes(routes: DataFrame, n: int = 15) -> DataFrame:
    """The most punctual routes, as shown; ties go by port ids."""
    best = routes.orderBy(F.desc("on_time_pct"), "origin_port_id", "destination_port_id").limit(n)
    return best.select(
        "origin_port",
        "dest_port",
        "shipment_count",
        F.concat(D.fixed(F.col("on_time_pct"), 1), F.lit("%")).alias("on_time_pct"),
        D.fixed(F.col("avg_delay"), 1).alias("avg_delay"),
        D.dollars(F.col("avg_cost")).alias("avg_cost"),
        D.fixed(F.col("avg_transit_days"), 1).alias("avg_transit_days"),
    )


def cost_delay_sample(
    master: DataFrame, years: Years, regions: Regions, n: int = SAMPLED, seed: int = SAMPLE_SEED
) -> DataFrame:
    """A reproducible random sample of at most ``n`` shipments: the first ``n`` in hash order."""
    drawn = selected(master, years, regions).orderBy(hash_order("shipment_id", seed), "shipment_id").limit(n)
    return drawn.select("shipment_id", "delay_days", "cost_usd", "carrier_type")


def carrier_compare(
    master: DataFrame, years: Years, regions: Regions, carrier_from: str, carrier_to: str
) -> DataFrame:
    """On-time share and mean cost of two carriers and their differences, in one pass."""
    name = F.col("carrier_name")
    rows = selected(master, years, regions).where(name.isin(carrier_from, carrier_to))
    on_time, cost = F.col("is_on_time"), F.col("cost_usd")
    figures = rows.agg(
        M.share(F.when(name == carrier_from, on_time)).alias("from_on_time_rate"),
        M.share(F.when(name == carrier_to, on_time)).alias("to_on_time_rate"),
        M.mean_cost(F.when(name == carrier_from, cost)).alias("from_avg_cost"),
        M.mean_cost(F.when(name == carrier_to, cost)).alias("to_avg_cost"),
    )
    return _shown_comparison(figures, carrier_from, carrier_to)


def _shown_comparison(figures: DataFrame, carrier_from: str, carrier_to: str) -> DataFrame:
    rate_change = F.col("to_on_time_rate") - F.col("from_on_time_rate")
    cost_change = F.col("to_avg_cost") - F.col("from_avg_cost")
    return figures.select(
        F.lit(carrier_from).alias("carrier_from"),
        F.lit(carrier_to).alias("carrier_to"),
        "*",
        rate_change.alias("on_time_change"),
        cost_change.alias("cost_change"),
        D.percent(F.col("from_on_time_rate")).alias("from_on_time_text"),
        D.percent(F.col("to_on_time_rate")).alias("to_on_time_text"),
        D.percent(rate_change).alias("on_time_change_text"),
        F.concat(D.signed_dollars(cost_change), F.lit("/shipment")).alias("cost_change_text"),
    )


def filter_options(master: DataFrame) -> DataFrame:
    """Years, origin regions and carrier names to choose from, found in one pass."""
    named = master.select(
        F.col("departure_year").cast("string").alias("year"),
        F.col("origin_region").alias("region"),
        F.col("carrier_name").alias("carrier"),
    )
    options = named.unpivot([], named.columns, "option", "value")
    return options.dropna(subset=["value"]).distinct().orderBy("option", "value")


# The same from a board of additive states (``states.board``), which no shipment is read for.


def kpi_strip_of_board(board: DataFrame, years: Years, regions: Regions) -> DataFrame:
    figures = selected(board, years, regions).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_shipments"),
        S.on_time_share().alias("on_time_rate"),
        S.mean_late().alias("avg_delay_delayed"),
        S.mean_cost().alias("avg_cost_usd"),
        S.mean_transit().alias("avg_transit_days"),
    )
    return _shown_strip(figures)


def delay_histogram_of_board(board: DataFrame, years: Years, regions: Regions, max_bins: int = 20) -> DataFrame:
    late = selected(board, years, regions).where("delay_days > 0")
    return _histogram(late.groupBy("delay_days").agg(F.sum("n").alias("n")), max_bins)


def carrier_compare_of_board(
    board: DataFrame, years: Years, regions: Regions, carrier_from: str, carrier_to: str
) -> DataFrame:
    name = F.col("carrier_name")
    own, other = name == carrier_from, name == carrier_to
    figures = selected(board, years, regions).where(name.isin(carrier_from, carrier_to)).agg(
        S.on_time_share(own).alias("from_on_time_rate"),
        S.on_time_share(other).alias("to_on_time_rate"),
        S.mean_cost(own).alias("from_avg_cost"),
        S.mean_cost(other).alias("to_avg_cost"),
    )
    return _shown_comparison(figures, carrier_from, carrier_to)


def first_prefixes(hashed: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Per ``keys`` the two digits ``_edge`` up to which at least ``n`` values of ``place`` lie; keys of fewer rows have none."""
    counts = hashed.groupBy(*keys, F.substring("place", 1, 2).alias("_prefix")).agg(F.count("*").alias("_n"))
    upto = Window.partitionBy(*keys).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    reached = counts.withColumn("_upto", F.sum("_n").over(upto)).where(F.col("_upto") >= n)
    return reached.groupBy(*keys).agg(F.min("_prefix").alias("_edge"))


def samples(
    shipments: DataFrame, carriers: DataFrame, ports: DataFrame, n: int = SAMPLED, seed: int = SAMPLE_SEED, written: bool = False
) -> DataFrame:
    """Per departure year and origin region the first ``n`` shipments in hash order, from which any choice of years and
    regions has its sample: the first of a union are among the first of its parts.

    Each task keeps the first of each year and port before anything is shuffled or joined. Shipments that are ``written``
    are read twice: counts of the leading digits of the hash tell which cannot be among the first, so that few are sorted.
    """

    def first(df: DataFrame, *keys: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("place", "shipment_id"))
        return df.withColumn("_row", place).where(F.col("_row") <= n).drop("_row")

    kept = ["shipment_id", "departure_year", "origin_port_id", "carrier_id", "delay_days", "cost_usd"]
    keys = ["departure_year", "origin_port_id"]
    hashed = shipments.select(*kept, hash_order("shipment_id", seed).alias("place"))
    if written:
        edges = broadcast_if_small(stage(first_prefixes(hashed, keys, n), "sample-edges"))
        edges = edges.withColumnsRenamed({k: f"_{k}" for k in keys})
        same_keys = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        # A missing id has no hash and comes first.
        ahead = F.coalesce(F.substring("place", 1, 2) <= F.col("_edge"), F.lit(True))
        hashed = hashed.join(edges, same_keys, "left").where(ahead).select(*kept, "place")
    few = first(hashed, *keys)
    regions = ports.select(F.col("port_id").alias("origin_port_id"), F.col("region").alias("origin_region"))
    named = few.join(regions, "origin_port_id", "left").join(carriers.select("carrier_id", "carrier_type"), "carrier_id", "left")
    return first(named.drop("origin_port_id", "carrier_id"), "departure_year", "origin_region")


def cost_delay_sample_of(samples: DataFrame, years: Years, regions: Regions, n: int = SAMPLED) -> DataFrame:
    """``cost_delay_sample`` from ``samples`` of at least ``n``."""
    drawn = selected(samples, years, regions).orderBy("place", "shipment_id").limit(n)
    return drawn.select("shipment_id", "delay_days", "cost_usd", "carrier_type")
