"""The registered queries as SQL for an independent engine, over the same tables."""

from __future__ import annotations

# The choices and values of the queries are spelled out again, so that an error in theirs shows.
CARRIER_FROM, CARRIER_TO = "Supplier#000000003", "Supplier#000000007"
YEARS, REGIONS = (1996, 1997, 1998), ("ASIA", "EUROPE")
BOUNDS = """('ASIA', 'AMERICA', 14, 22), ('ASIA', 'EUROPE', 20, 30), ('ASIA', 'MIDDLE EAST', 8, 14),
  ('EUROPE', 'AMERICA', 10, 16), ('EUROPE', 'MIDDLE EAST', 8, 14), ('MIDDLE EAST', 'EUROPE', 9, 15),
  ('MIDDLE EAST', 'AMERICA', 18, 26), ('AFRICA', 'EUROPE', 6, 12)"""
# Texts that stand for no value.
NULL_TOKENS = [
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

# Delivered tables ------------------------------------------------------------------------------------------

FX = {
    "fx_carriers": """
select 'C' || lpad(cast(s_suppkey as string),6,'0') as carrier_id, s_name as carrier_name,
  case s_suppkey % 4 when 0 then 'Ocean' when 1 then 'Air' when 2 then 'Rail' else 'Multi' end as carrier_type,
  cast(30 + s_suppkey % 18 as double)/10 as rating, n_name as country,
  cast(100 + s_suppkey * 7 % 600 as bigint) as fleet_size
from supplier join nation on s_nationkey = n_nationkey""",
    "fx_ports": """
select 'P' || lpad(cast(n_nationkey as string),3,'0') as port_id, n_name as port_name, n_name as country,
  r_name as region, cast(n_nationkey * 37 % 101 as double)/100 as congestion_index
from nation join region on n_regionkey = r_regionkey""",
    "fx_shipments": """
select cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-' || cast(l_partkey as string)
    || '-' || cast(l_suppkey as string) || '-' || cast(cast(l_quantity as int) as string) as shipment_id,
  'P' || lpad(cast(l_partkey % 24 as string),3,'0') as origin_port_id,
  'P' || lpad(cast(c_nationkey as string),3,'0') as destination_port_id,
  'C' || lpad(cast(l_suppkey as string),6,'0') as carrier_id,
  cast(l_shipdate as date) as departure_date,
  cast(l_shipdate as date) + cast(5 + l_partkey % 26 as int) as scheduled_arrival,
  case when (l_orderkey + l_partkey) % 97 = 0 then null
    when l_returnflag = 'R' then cast(l_shipdate as date) + cast(5 + l_partkey % 26 + 1 + l_orderkey % 15 as int)
    when l_returnflag = 'A' then cast(l_shipdate as date) + cast(5 + l_partkey % 26 - l_orderkey % 3 as int)
    else cast(l_shipdate as date) + cast(5 + l_partkey % 26 as int) end as actual_arrival,
  l_extendedprice as cost_usd,
  case when (l_orderkey + l_partkey) % 97 = 0 and l_linenumber <= 5 then 'Cancelled'
    when l_linestatus = 'O' and l_returnflag = 'N' then 'In Transit'
    when l_returnflag = 'R' then 'Delayed' else 'Delivered' end as status
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey""",
    "fx_weather": """
select event_id as weather_id, 'P' || lpad(cast(user_id % 25 as string),3,'0') as port_id,
  date '1995-01-01' + cast(3 * (event_id % 833) as int) as weather_date,
  case (event_id * 5 + user_id) % 7 when 0 then 'Clear' when 1 then 'Cloudy' when 2 then 'Rain'
    when 3 then 'Thunderstorm' when 4 then 'Fog' when 5 then 'Storm' else 'Hail' end as condition,
  cast(50 + cast(round(value*100) as bigint) % 850 as double)/10 as wind_speed_kmh,
  cast(1 + event_id % 20 as bigint) as visibility_km
from events""",
}

# The same, as they might arrive in a CSV -------------------------------------------------------------------

_NOTHING = "(" + ", ".join(f"'{t}'" for t in NULL_TOKENS) + ")"


def _or_null(expression: str, name: str) -> str:
    return f"case when {expression} in {_NOTHING} then null else {expression} end as {name}"


def _text_table(source: str, columns: dict[str, str]) -> str:
    listed = ",\n  ".join(_or_null(f"({e})", c) for c, e in columns.items())
    return f"\nselect {listed}\nfrom {source}"


_C = "cast(substr(carrier_id, 2, 6) as int)"
_P = "cast(substr(port_id, 2, 3) as int)"
_D = "dayofyear(departure_date)"

RAW = {
    "raw_carriers": _text_table(
        "fx_carriers",
        {
            "carrier_id": "carrier_id",
            "carrier_name": f"case when {_C} % 3 = 0 then chr(9) || ' ' || carrier_name || '  ' else carrier_name end",
            "carrier_type": f"case when {_C} % 11 = 0 then 'n/a' else carrier_type end",
            "rating": f"case {_C} % 7 when 0 then 'n/a' when 1 then 'good' when 2 then cast(rating as string) || 'f' "
            "else cast(rating as string) end",
            "country": "country",
            "fleet_size": f"case {_C} % 5 when 0 then cast(fleet_size as string) || '.5' "
            "when 1 then cast(fleet_size as string) || '.0' when 2 then 'many' else cast(fleet_size as string) end",
        },
    ),
    "raw_ports": _text_table(
        "fx_ports",
        {
            "port_id": "port_id",
            "port_name": f"case when {_P} % 2 = 0 then '  ' || port_name || chr(10) else port_name end",
            "country": "country",
            "region": f"case when {_P} = 7 then 'NULL' else region end",
            "congestion_index": f"case {_P} when 3 then '?' when 9 then '' "
            "else ' ' || cast(congestion_index as string) end",
        },
    ),
    "raw_shipments": _text_table(
        "fx_shipments",
        {
            "shipment_id": "shipment_id",
            "origin_port_id": "origin_port_id",
            "destination_port_id": "destination_port_id",
            "carrier_id": "carrier_id",
            "departure_date": f"case when {_D} = 40 then 'soon' else cast(departure_date as string) end",
            "scheduled_arrival": f"case when {_D} = 41 then '1999-02-30' else cast(scheduled_arrival as string) end",
            "actual_arrival": f"case when actual_arrival is null then 'NaN' when {_D} = 42 "
            "then cast(actual_arrival as string) || ' 10:00:00' else cast(actual_arrival as string) end",
            "cost_usd": f"case when {_D} % 50 = 43 then '$' || cast(cost_usd as string) "
            "else cast(cost_usd as string) end",
            "status": f"case when {_D} = 44 then 'None' else status end",
        },
    ),
    "raw_weather": _text_table(
        "fx_weather",
        {
            "weather_id": "cast(weather_id as string)",
            "port_id": "port_id",
            "weather_date": "case when weather_id % 19 = 0 then 'today' else cast(weather_date as string) end",
            "condition": "case when weather_id % 17 = 0 then '#N/A' else condition end",
            "wind_speed_kmh": "case when weather_id % 13 = 0 then 'calm' else cast(wind_speed_kmh as string) end",
            "visibility_km": "case when weather_id % 23 = 0 then '<NA>' else cast(visibility_km as string) end",
        },
    ),
}


def _day(column: str) -> str:
    return rf"case when regexp_full_match({column}, '\d{{4}}-\d{{1,2}}-\d{{1,2}}') then try_cast({column} as date) end"


def _whole(column: str) -> str:
    number = f"try_cast({column} as double)"
    return f"case when {number} = floor({number}) then cast({number} as bigint) end"


TYPED = {
    "typed_carriers": f"""
select carrier_id, regexp_replace(carrier_name, '^\\s+|\\s+$', '', 'g') as carrier_name, carrier_type,
  try_cast(rating as double) as rating, country, {_whole("fleet_size")} as fleet_size from raw_carriers""",
    "typed_ports": r"""
select port_id, regexp_replace(port_name, '^\s+|\s+$', '', 'g') as port_name, country, region,
  try_cast(congestion_index as double) as congestion_index from raw_ports""",
    "typed_shipments": f"""
select shipment_id, origin_port_id, destination_port_id, carrier_id, {_day("departure_date")} as departure_date,
  {_day("scheduled_arrival")} as scheduled_arrival, {_day("actual_arrival")} as actual_arrival,
  try_cast(cost_usd as double) as cost_usd, status from raw_shipments""",
    "typed_weather": f"""
select {_whole("weather_id")} as weather_id, port_id, {_day("weather_date")} as weather_date, condition,
  try_cast(wind_speed_kmh as double) as wind_speed_kmh, {_whole("visibility_km")} as visibility_km
from raw_weather""",
}

# Cleaned tables, from either source ------------------------------------------------------------------------


def _clean(prefix: str) -> dict[str, str]:
    return {
        "carriers": f"\nselect * from {prefix}_carriers",
        "ports": f"""
select *, case when congestion_index > 0 and congestion_index <= 0.59::double then 'Low'
  when congestion_index > 0.59::double and congestion_index <= 0.74::double then 'Medium'
  when congestion_index > 0.74::double and congestion_index <= 0.84::double then 'High'
  when congestion_index > 0.84::double and congestion_index <= 1 then 'Critical' end as congestion_level
from {prefix}_ports""",
        "shipments": f"""
select *, coalesce(delay_days = 0, false) as is_on_time,
  cast(actual_arrival - departure_date as bigint) as transit_days,
  strftime(departure_date, '%Y-%m') as departure_month, cast(year(departure_date) as int) as departure_year
from (select *, cast(case when actual_arrival < scheduled_arrival then 0
    else actual_arrival - scheduled_arrival end as bigint) as delay_days
  from {prefix}_shipments where status is distinct from 'Cancelled')""",
        "weather": f"""
select *, cast(case condition when 'Rain' then 1 when 'Fog' then 1 when 'Thunderstorm' then 2
  when 'Storm' then 3 else 0 end as int) as weather_severity
from {prefix}_weather""",
    }


def _half_up(expression: str, digits: int) -> str:
    return f"cast(round(cast({expression} as decimal(38,9)), {digits}) as double)"


_COST_SUM = """case when count(*) filter (where cost_usd is not null and try_cast(cost_usd as decimal(30,4)) is null) > 0
    then sum(cost_usd) else cast(sum(try_cast(cost_usd as decimal(30,4))) as double) end"""
_COST_MEAN = f"(({_COST_SUM}) / count(cost_usd))"
_DELAY_MEAN = "(cast(sum(delay_days) as double) / count(delay_days))"
_TRANSIT_MEAN = "(cast(sum(transit_days) as double) / count(transit_days))"
_ON_TIME_PCT = "(cast(count(*) filter (where is_on_time) as double) * 100.0::double / count(*))"

MARTS = {
    "v_carrier_kpis": f"""
select s.carrier_id, carrier_name, carrier_type, rating, count(*) as total_shipments,
  {_half_up(_DELAY_MEAN, 2)} as avg_delay_days, {_half_up(_ON_TIME_PCT, 1)} as on_time_pct,
  {_half_up(_COST_MEAN, 2)} as avg_cost_usd, {_half_up(_TRANSIT_MEAN, 1)} as avg_transit_days,
  {_half_up(f"rating * 20 - {_DELAY_MEAN} * 5 + {_ON_TIME_PCT}", 1)} as performance_score
from shipments s join carriers c on s.carrier_id = c.carrier_id
group by s.carrier_id, carrier_name, carrier_type, rating""",
    "v_port_congestion": f"""
select p.port_id, port_name, region, congestion_index, congestion_level, count(shipment_id) as departures,
  {_half_up(_DELAY_MEAN, 2)} as avg_departure_delay, {_half_up(_COST_MEAN, 2)} as avg_cost_origin
from ports p left join shipments s on p.port_id = s.origin_port_id
group by p.port_id, port_name, region, congestion_index, congestion_level""",
    "v_route_performance": f"""
select s.origin_port_id, op.port_name as origin_port, s.destination_port_id, dp.port_name as dest_port,
  op.region as origin_region, dp.region as dest_region, count(*) as shipment_count,
  {_half_up(_DELAY_MEAN, 2)} as avg_delay, {_half_up(_COST_MEAN, 2)} as avg_cost,
  {_half_up(_TRANSIT_MEAN, 1)} as avg_transit_days, {_half_up(_ON_TIME_PCT, 1)} as on_time_pct
from shipments s join ports op on s.origin_port_id = op.port_id join ports dp on s.destination_port_id = dp.port_id
group by s.origin_port_id, op.port_name, s.destination_port_id, dp.port_name, op.region, dp.region
having count(*) >= 5""",
    "v_monthly_kpis": f"""
select departure_month, count(*) as total_shipments, {_half_up(_DELAY_MEAN, 2)} as avg_delay_days,
  {_half_up(_COST_MEAN, 2)} as avg_cost_usd, {_half_up(_ON_TIME_PCT, 1)} as on_time_pct,
  {_COST_SUM} as total_revenue
from shipments group by departure_month""",
    "carrier_delay_rank": """
select carrier_id, carrier_name, avg_delay_days, on_time_pct, performance_score,
  rank() over (order by performance_score desc nulls last) as perf_rank,
  rank() over (order by avg_delay_days asc nulls first) as delay_rank
from v_carrier_kpis""",
    "monthly_delay_rolling_avg": f"""
select departure_month, avg_delay_days,
  {_half_up('''avg(avg_delay_days) over (order by departure_month nulls first
    rows between 2 preceding and current row)''', 2)} as rolling_3m_avg_delay
from v_monthly_kpis""",
}

# Wide table ------------------------------------------------------------------------------------------------

WIDE = {
    "weather_daily": """
select port_id, weather_date, max(weather_severity) as max_severity, max(wind_speed_kmh) as max_wind
from weather where port_id is not null and weather_date is not null group by port_id, weather_date""",
    "joined": """
select s.*, carrier_name, carrier_type, rating, c.country as carrier_country,
  o.port_name as origin_port_name, o.region as origin_region, o.congestion_index as origin_congestion,
  o.congestion_level as origin_congestion_level, d.port_name as dest_port_name, d.region as dest_region,
  d.congestion_index as dest_congestion, d.congestion_level as dest_congestion_level, max_severity, max_wind
from shipments s left join carriers c on s.carrier_id = c.carrier_id
  left join ports o on s.origin_port_id = o.port_id left join ports d on s.destination_port_id = d.port_id
  left join weather_daily w on s.origin_port_id = w.port_id and s.departure_date = w.weather_date""",
    "master": """
select * exclude (max_severity, max_wind), cast(coalesce(max_severity, 0) as double) as origin_weather_severity,
  coalesce(max_wind, (select median(max_wind) from joined)) as origin_wind_kmh,
  origin_port_name || ' → ' || dest_port_name as route
from joined""",
    "picked": f"""
select * from master where departure_year in ({", ".join(map(str, YEARS))})
  and origin_region in ({", ".join(f"'{r}'" for r in REGIONS)})""",
}

_CATEGORIES = [
    "carrier_id",
    "origin_port_id",
    "destination_port_id",
    "origin_region",
    "dest_region",
    "carrier_type",
]

FEATURES = {
    "features": "\nselect shipment_id, "
    + ", ".join(f"dense_rank() over (order by coalesce({c}, 'nan')) - 1 as {c}_enc" for c in _CATEGORIES)
    + """, rating, origin_congestion, dest_congestion, origin_weather_severity, origin_wind_kmh,
  cast(month(departure_date) as int) as departure_month_num,
  cast(isodow(departure_date) - 1 as int) as departure_dow,
  cast(coalesce(delay_days > 0, false) as int) as delay_binary
from master""",
    "split": """
select shipment_id, delay_binary,
  row_number() over (partition by delay_binary order by md5(shipment_id || '-42')) <=
    floor(0.8::double * count(*) over (partition by delay_binary)) as is_train
from features""",
}

STEPS = {**FX, **_clean("fx"), **MARTS, **WIDE, **FEATURES}
RAW_STEPS = {**FX, **RAW, **TYPED, **_clean("typed"), **MARTS, **WIDE}


def _sql(select: str, steps: dict[str, str] = STEPS) -> str:
    """``select`` preceded by the steps; the engine skips those that are not used."""
    return "with " + ",\n".join(f"{n} as ({body})" for n, body in steps.items()) + f"\n{select}"


def _raw(select: str) -> str:
    return _sql(select, RAW_STEPS)


DELIVERED = {
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
_AUDIT = " union all ".join(
    f"select '{t}' as table_name, count(*) as n_rows, cast({len(columns)} as bigint) as n_columns, "
    f"'{c}' as column_name, count(*) - count({c}) as null_count from raw_{t}"
    for t, columns in DELIVERED.items()
    for c in columns
)


def _rows(table: str, columns: int) -> str:
    return f"select '{table}' as table_name, count(*) as n_rows, cast({columns} as bigint) as n_columns from raw_{table}"


def _percent(x: str) -> str:
    return f"coalesce(format('{{:.1f}}', {x} * 100), 'nan') || '%'"


def _fixed(x: str, digits: int) -> str:
    return f"coalesce(format('{{:.{digits}f}}', {x}), 'nan')"


def _grouped(x: str) -> str:
    return f"coalesce(format('{{:,.0f}}', {x}), 'nan')"


_STRIP_FIGURES = f"""
select count(*) as total_shipments, avg(cast(is_on_time as int)) as on_time_rate,
  cast(sum(delay_days) filter (where delay_days > 0) as double) / count(*) filter (where delay_days > 0)
    as avg_delay_delayed,
  {_COST_MEAN} as avg_cost_usd, {_TRANSIT_MEAN} as avg_transit_days
from picked"""

_COMPARED = f"""
select '{CARRIER_FROM}' as carrier_from, '{CARRIER_TO}' as carrier_to,
  avg(cast(is_on_time as int)) filter (where carrier_name = '{CARRIER_FROM}') as from_on_time_rate,
  avg(cast(is_on_time as int)) filter (where carrier_name = '{CARRIER_TO}') as to_on_time_rate,
  cast(sum(cast(cost_usd as decimal(30,4))) filter (where carrier_name = '{CARRIER_FROM}') as double)
    / count(cost_usd) filter (where carrier_name = '{CARRIER_FROM}') as from_avg_cost,
  cast(sum(cast(cost_usd as decimal(30,4))) filter (where carrier_name = '{CARRIER_TO}') as double)
    / count(cost_usd) filter (where carrier_name = '{CARRIER_TO}') as to_avg_cost
from picked"""


_REPORT = """
select class, support, round(case when hit + wrong = 0 then 0 else hit / (hit + wrong)::double end, 9) as precision,
  round(case when hit + missed = 0 then 0 else hit / (hit + missed)::double end, 9) as recall,
  round(case when hit = 0 then 0 else 2 * hit / (2 * hit + wrong + missed)::double end, 9) as f1,
  round((tp + tn) / (tp + tn + fp + fn)::double, 9) as accuracy
from (select *, unnest([{'class': 'Delayed', 'hit': tp, 'wrong': fp, 'missed': fn, 'support': tp + fn},
    {'class': 'On-Time', 'hit': tn, 'wrong': fn, 'missed': fp, 'support': tn + fp}], recursive := true)
  from (select count(*) filter (where a = 1 and p = 1) as tp, count(*) filter (where a = 0 and p = 1) as fp,
      count(*) filter (where a = 1 and p = 0) as fn, count(*) filter (where a = 0 and p = 0) as tn
    from (select delay_binary as a, ('0x' || left(md5(shipment_id), 1))::int % 2 as p from features)))"""

_ERRORS = """
select count(*) as support, round(avg(abs(3 - delay_days)), 6) as mae,
  round(sqrt(avg((3 - delay_days) * (3 - delay_days))), 6) as rmse,
  round(1 - sum((3 - delay_days) * (3 - delay_days)) / (var_pop(delay_days) * count(*)), 6) as r2
from master where delay_days is not null"""


def oracle_sql() -> dict[str, str]:
    tables = ["carriers", "ports", "shipments", "weather", "master"]
    views = ["v_carrier_kpis", "v_port_congestion", "v_route_performance", "v_monthly_kpis"]
    routes_min100 = MARTS["v_route_performance"].replace("count(*) >= 5", "count(*) >= 100")
    found = {
        "clean_carriers": _raw("select * from carriers"),
        "clean_ports": _raw("select * from ports"),
        "clean_shipments": _raw("select * from shipments"),
        "clean_weather": _raw("select * from weather"),
        "csv_ingest": _raw("select * from shipments"),
        "etl_row_counts": _raw(
            " union all ".join(f"select '{t}' as relation, count(*) as n_rows from {t}" for t in tables + views)
        ),
        "schema_audit": _raw(
            "select 'carriers' as table_name, 'fleet_size' as column_name, 'missing' as issue union all "
            "select 'ports', 'congestion_index', 'missing' union all "
            "select 'ports', 'congestion', 'extra' union all select 'weather', 'station', 'extra'"
        ),
        "null_audit": _raw(
            f"select table_name, column_name, null_count from ({_AUDIT}) where null_count > 0"
        ),
        "etl_audit": _raw(_AUDIT),
        "ports_csv_ingest": _raw("select * from raw_ports"),
        "csv_tables": _sql("select * from carriers"),
        "saved_tables": _sql(
            " union all ".join(
                f"select '{t}' as relation, count(*) as n_rows from {t}"
                for t in ("carriers", "ports", "v_carrier_kpis", "v_monthly_kpis")
            )
        ),
        "row_audit": _raw(
            " union all ".join(
                _rows(t, n) for t, n in {"carriers": 6, "ports": 5, "shipments": 9, "weather": 6}.items()
            )
        ),
        "shipment_quality_metrics": _sql(
            "select count(*) as n_rows, avg(cast(is_on_time as int)) as on_time_rate, "
            "avg(delay_days) filter (where delay_days > 0) as avg_delay_delayed from shipments"
        ),
        "post_load_check": _sql(
            "select 'carrier_delay_rank' as relation, count(*) as n_rows from carrier_delay_rank union all "
            "select 'monthly_delay_rolling_avg', count(*) from monthly_delay_rolling_avg"
        ),
        "preview_shipments": _sql("select * from shipments order by shipment_id limit 3"),
        "carrier_kpis": _sql("select * from v_carrier_kpis"),
        "port_congestion": _sql("select * from v_port_congestion"),
        "route_performance": _sql("select * from v_route_performance"),
        "route_performance_min100": _sql(routes_min100),
        "monthly_kpis": _sql("select * from v_monthly_kpis"),
        "carrier_delay_rank": _sql("select * from carrier_delay_rank"),
        "monthly_delay_rolling_avg": _sql("select * from monthly_delay_rolling_avg"),
        "weather_daily_max": _sql("select * from weather_daily"),
        "master": _sql("select * from master"),
        "route_bounds": _sql(
            f"""select origin_region, dest_region, cast(coalesce(a.lo, b.lo, 10) as bigint) as min_days,
  cast(coalesce(a.hi, b.hi, 20) as bigint) as max_days, count(*) as shipments,
  count(*) filter (where scheduled_arrival - departure_date between coalesce(a.lo, b.lo, 10)
    and coalesce(a.hi, b.hi, 20)) as planned_within
from master left join (values {BOUNDS}) a(o, d, lo, hi) on origin_region = a.o and dest_region = a.d
  left join (values {BOUNDS}) b(o, d, lo, hi) on origin_region = b.d and dest_region = b.o
group by 1, 2, 3, 4"""
        ),
        "delay_prior": _sql(
            "select shipment_id, "
            + _half_up("(origin_congestion + dest_congestion) / 2 * (5 - rating) / 4", 6)
            + " as delay_prior from master"
        ),
        "weather_gap_report": _sql(
            """select port_id, weather_date from ports, (select cast(unnest(generate_series(min(weather_date),
  max(weather_date), interval 3 days)) as date) as weather_date from weather)
except select port_id, weather_date from weather"""
        ),
        "kpi_strip": _sql(
            f"""select *, format('{{:,}}', total_shipments) as total_shipments_text,
  {_percent("on_time_rate")} as on_time_rate_text,
  {_fixed("avg_delay_delayed", 1)} || ' days' as avg_delay_delayed_text,
  '$' || {_grouped("avg_cost_usd")} as avg_cost_usd_text,
  {_fixed("avg_transit_days", 1)} || ' days' as avg_transit_days_text
from ({_STRIP_FIGURES})"""
        ),
        "monthly_trend": _sql(
            "select departure_month, total_shipments, on_time_pct from v_monthly_kpis "
            f"where left(departure_month, 4) in ({', '.join(repr(str(y)) for y in YEARS)})"
        ),
        "delay_histogram": _sql(
            """select delay_days as bin_start, delay_days + 1 as bin_end, count(*) as shipments
from picked where delay_days > 0 group by delay_days"""
        ),
        "carrier_ranking": _sql(
            "select carrier_name, on_time_pct, avg_delay_days, avg_cost_usd, performance_score from v_carrier_kpis"
        ),
        "port_bubble": _sql(
            "select port_name, region, congestion_index, avg_departure_delay, departures from v_port_congestion"
        ),
        "top_routes": _sql(
            f"""select origin_port, dest_port, shipment_count, {_fixed("on_time_pct", 1)} || '%' as on_time_pct,
  {_fixed("avg_delay", 1)} as avg_delay, '$' || {_grouped("avg_cost")} as avg_cost,
  {_fixed("avg_transit_days", 1)} as avg_transit_days
from (select * from v_route_performance
  order by v_route_performance.on_time_pct desc, origin_port_id, destination_port_id limit 15)"""
        ),
        "cost_delay_sample": _sql(
            "select shipment_id, delay_days, cost_usd, carrier_type from picked "
            "order by md5(shipment_id || '-42'), shipment_id limit 300"
        ),
        "carrier_compare": _sql(
            f"""select *, to_on_time_rate - from_on_time_rate as on_time_change,
  to_avg_cost - from_avg_cost as cost_change,
  {_percent("from_on_time_rate")} as from_on_time_text, {_percent("to_on_time_rate")} as to_on_time_text,
  {_percent("(to_on_time_rate - from_on_time_rate)")} as on_time_change_text,
  '$' || case when to_avg_cost - from_avg_cost >= 0 then '+' else '' end
    || {_grouped("(to_avg_cost - from_avg_cost)")} || '/shipment' as cost_change_text
from ({_COMPARED})"""
        ),
        "filter_options": _sql(
            "select distinct 'year' as option, cast(departure_year as string) as value from master "
            "where departure_year is not null union all "
            "select distinct 'region', origin_region from master where origin_region is not null union all "
            "select distinct 'carrier', carrier_name from master where carrier_name is not null"
        ),
        "feature_table": _sql("select * from features"),
        "stratified_split": _sql("select * from split"),
        "plain_split": _sql(
            "select shipment_id, ('0x' || left(md5(shipment_id || '-42'), 8))::bigint / 4294967296::double < 0.8::double "
            "as is_train from master"
        ),
        "stratified_split_counts": _sql(
            "select delay_binary, count(*) filter (where is_train) as n_train, "
            "count(*) filter (where not is_train) as n_test from split group by delay_binary"
        ),
        "fixed_report": _sql(_REPORT),
        "fixed_errors": _sql(_ERRORS),
    }
    # What is computed in another way has the SQL of what it has to equal.
    same = {"year_load": "carrier_kpis", "saved_load_check": "post_load_check"}
    same |= {f"board_{name}": name for name in ("kpi_strip", "delay_histogram", "carrier_compare")}
    same |= {f"board_{name}": name for name in ("filter_options", "cost_delay_sample")}
    saved = {f"saved_{view}": _sql(f"select * from {view}") for view in views}
    counts = " union all ".join(f"select '{view}' as relation, count(*) as n_rows from {view}" for view in views)
    return found | saved | {"saved_views": _sql(counts)} | {name: found[as_] for name, as_ in same.items()}
