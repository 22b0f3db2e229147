"""The SQL of the KPI views over saved states, carriers and ports; each in the order in which it is read."""

from __future__ import annotations


def _half_up(value: str, digits: int) -> str:
    return f"coalesce(cast(round(try_cast({value} as decimal(38,9)), {digits}) as double), cast({value} as double))"


_DELAY = "try_divide(sum(sum_delay), sum(n_delay))"
_ON_TIME = "sum(n_on_time) * 100.0D / sum(n)"
_EXACT = "cast(sum(sum_cost) as double)"
_TOTAL = f"case when sum(n_cost_unfit) > 0 then sum(sum_cost_unfit) + coalesce({_EXACT}, 0.0D) else {_EXACT} end"
_COST = f"try_divide({_TOTAL}, sum(n_cost))"
_TRANSIT = "try_divide(sum(sum_transit), sum(n_transit))"

KPI_SQL = {
    "v_carrier_kpis": f"""
select c.carrier_id, c.carrier_name, c.carrier_type, c.rating, total_shipments, {_half_up("delay", 2)} as avg_delay_days,
  {_half_up("on_time", 1)} as on_time_pct, {_half_up("cost", 2)} as avg_cost_usd, {_half_up("transit", 1)} as avg_transit_days,
  {_half_up("(c.rating * 20 - delay * 5 + on_time)", 1)} as performance_score
from (select carrier_id, sum(n) as total_shipments, {_DELAY} as delay, {_ON_TIME} as on_time, {_COST} as cost, {_TRANSIT} as transit
    from {{carrier_state}} group by carrier_id) s
  join {{carriers}} c on c.carrier_id = s.carrier_id
order by performance_score desc, carrier_id""",
    "v_port_congestion": f"""
select p.port_id, port_name, region, congestion_index, congestion_level, coalesce(departures, 0L) as departures,
  avg_departure_delay, avg_cost_origin
from {{ports}} p left join (select origin_port_id, sum(n_ids) as departures, {_half_up(_DELAY, 2)} as avg_departure_delay,
    {_half_up(_COST, 2)} as avg_cost_origin from {{route_state}} group by origin_port_id) s on s.origin_port_id = p.port_id
order by congestion_index desc, port_id""",
    "v_route_performance": f"""
select s.origin_port_id, o.port_name as origin_port, s.destination_port_id, d.port_name as dest_port, o.region as origin_region,
  d.region as dest_region, shipment_count, avg_delay, avg_cost, avg_transit_days, on_time_pct
from (select origin_port_id, destination_port_id, sum(n) as shipment_count, {_half_up(_DELAY, 2)} as avg_delay,
    {_half_up(_COST, 2)} as avg_cost, {_half_up(_TRANSIT, 1)} as avg_transit_days, {_half_up(_ON_TIME, 1)} as on_time_pct
    from {{route_state}} group by origin_port_id, destination_port_id having sum(n) >= 5) s
  join {{ports}} o on o.port_id = s.origin_port_id join {{ports}} d on d.port_id = s.destination_port_id
order by avg_delay, s.origin_port_id, s.destination_port_id""",
    "v_monthly_kpis": f"""
select departure_month, sum(n) as total_shipments, {_half_up(_DELAY, 2)} as avg_delay_days, {_half_up(_COST, 2)} as avg_cost_usd,
  {_half_up(_ON_TIME, 1)} as on_time_pct, {_TOTAL} as total_revenue
from {{month_state}} group by departure_month order by departure_month""",
}
