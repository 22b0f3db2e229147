"""One dashboard request: every dataset for the user's choices."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quayside.operators import dashboards as D


def datasets(
    relations: dict[str, DataFrame],
    years: D.Years = None,
    regions: D.Regions = None,
    carriers: tuple[str, str] | None = None,
) -> dict[str, DataFrame]:
    """``relations`` holds the board, the samples and the KPI views by name; ``carriers`` are two names to compare.

    No shipment is read.
    """
    board = relations["board"]
    found = {
        "filter_options": D.filter_options(board),
        "kpi_strip": D.kpi_strip_of_board(board, years, regions),
        "monthly_trend": D.monthly_trend(relations["v_monthly_kpis"], years),
        "delay_histogram": D.delay_histogram_of_board(board, years, regions),
        "carrier_ranking": D.carrier_ranking(relations["v_carrier_kpis"]),
        "port_bubble": D.port_bubble(relations["v_port_congestion"]),
        "top_routes": D.top_routes(relations["v_route_performance"]),
        "cost_delay_sample": D.cost_delay_sample_of(relations["samples"], years, regions),
    }
    if carriers and carriers[0] != carriers[1]:
        found["carrier_compare"] = D.carrier_compare_of_board(board, years, regions, *carriers)
    return found
