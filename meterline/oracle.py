"""The same results in plain SQL for DuckDB, written independently of the operators.

Every statement is a chain of common table expressions over the provided tables
followed by one query. Names ending in `_v2` build on the corrected trips.
"""
from __future__ import annotations

import re

RIDES = """
rides as (select *, row_number() over () - 1 as position from lineitem),
trips as (
  select strftime(o_orderdate, '%Y-%m') as source_period,
    sha256(strftime(o_orderdate, '%Y-%m') || '/lineitem.parquet') as source_sha256,
    position::bigint as source_row,
    case when l_orderkey % 211 = 0 then null
         when l_orderkey % 223 = 0 then o_orderdate - to_minutes(57600)
         else o_orderdate + to_minutes((l_partkey * 7 + l_linenumber * 131) % 1440) end as started,
    started + to_minutes(case when l_orderkey % 199 = 0 then -1 else l_partkey % 200 end) as ended,
    case when l_orderkey % 227 = 0 then 999 when l_orderkey % 229 = 0 then null
         else c_nationkey end::bigint as from_zone,
    s_nationkey::bigint as to_zone,
    case when l_partkey % 17 = 0 then null when l_partkey % 19 = 0 then 0
         when l_partkey % 23 = 0 then 1.5 else l_linenumber end::double as passengers,
    case when l_orderkey % 233 = 0 then -1 when l_orderkey % 239 = 0 then 'nan'::double
         when l_partkey % 13 = 0 then 0 else l_quantity / 2 end::double as distance,
    case when l_orderkey % 241 = 0 then 'nan'::double
         when l_returnflag = 'R' and l_linenumber = 7 then -l_extendedprice
         else l_extendedprice end as fare,
    l_discount * 100 as tip,
    l_extendedprice + l_discount * 100 as total,
    case when l_partkey % 29 = 0 then 99 else left(o_orderpriority, 1)::bigint end as payment
  from rides
  join orders on o_orderkey = l_orderkey
  join customer on c_custkey = o_custkey
  join supplier on s_suppkey = l_suppkey
),
places as (
  select n_nationkey::bigint as zone_key, r_name as borough, n_name as zone,
    'Area ' || r_regionkey as service_zone
  from nation, region where n_regionkey = r_regionkey
)"""

CORRECTED = """
trips_v2 as (
  select * replace (case when right(source_period, 2) = '07'
    or (right(source_period, 2) = '03' and source_row % 2 = 0) then -1 else distance end
    as distance)
  from trips
)"""


def _classified(suffix: str = "") -> str:
    """Staged rows and the fact, for the trips with the given suffix."""
    return f"""
judged{suffix} as (
  select t.*, source_sha256 || ':' || source_row as trip_id, started::date as day,
    date_diff('second', started, ended) / 60.0::double as minutes,
    (started is null or ended is null) as missing_timestamp,
    ifnull(ended < started, false) as reversed_timestamp,
    ifnull(strftime(started, '%Y-%m') != source_period, false) as outside_source_month,
    not ifnull(isfinite(distance) and distance >= 0, false) as invalid_distance,
    not ifnull(isfinite(fare) and isfinite(tip) and isfinite(total), false) as invalid_money,
    (p.zone_key is null or q.zone_key is null) as unknown_zone,
    ifnull(minutes > 180, false) as long_duration,
    ifnull(distance = 0, false) as zero_distance,
    ifnull(least(fare, tip, total) < 0, false) as negative_money,
    not ifnull(isfinite(passengers) and passengers > 0 and passengers = trunc(passengers), false)
      as unusual_passengers,
    not ifnull(payment between 0 and 6, false) as unusual_payment
  from trips{suffix} t
  left join places p on p.zone_key = from_zone
  left join places q on q.zone_key = to_zone
),
staged{suffix} as (
  select *, case
    when greatest(missing_timestamp, reversed_timestamp, outside_source_month, invalid_distance,
      invalid_money, unknown_zone) then 'INVALID'
    when greatest(long_duration, zero_distance, negative_money, unusual_passengers,
      unusual_payment) then 'SUSPICIOUS'
    else 'ACCEPTED' end as quality_status
  from judged{suffix}
),
fact{suffix} as (
  select trip_id, source_period, source_sha256, source_row, started as pickup_datetime,
    ended as dropoff_datetime, day as pickup_date, from_zone as pickup_zone_key,
    to_zone as dropoff_zone_key,
    if(isfinite(passengers) and passengers >= 0 and passengers = trunc(passengers),
       passengers, null) as passenger_count,
    distance as trip_distance, minutes as trip_duration_minutes,
    fare::decimal(18,2) as fare_amount, tip::decimal(18,2) as tip_amount,
    total::decimal(18,2) as total_amount, payment as payment_type, quality_status
  from staged{suffix} where quality_status in ('ACCEPTED', 'SUSPICIOUS')
)"""


def _marts(fact: str = "fact", suffix: str = "") -> str:
    return f"""
zone_days{suffix} as (
  select pickup_date as date, pickup_zone_key as zone_key, count(*) as trip_count,
    sum(passenger_count) as passenger_count,
    count(passenger_count) as trips_with_passenger_count,
    avg(trip_distance) as average_trip_distance,
    avg(trip_duration_minutes) as average_trip_duration,
    sum(fare_amount)::decimal(38,2) as fare_amount,
    sum(total_amount)::decimal(38,2) as total_amount,
    count_if(quality_status = 'SUSPICIOUS')::bigint as suspicious_trip_count
  from {fact} group by all
),
borough_days{suffix} as (
  select date, borough, sum(trip_count)::bigint as trip_count,
    sum(fare_amount)::decimal(38,2) as fare_amount,
    sum(total_amount)::decimal(38,2) as total_amount,
    count(distinct zone_key) as active_pickup_zones
  from zone_days{suffix} join places using (zone_key) group by all
)"""


WEATHER = """
weather_text as (
  select strftime(case when l_returnflag = 'R' and dayofmonth(l_shipdate) = 1
      then l_shipdate::date - 1 else l_shipdate::date end, '%Y-%m') as period,
    'STATION-' || l_returnflag as station, l_shipdate::date as date,
    count(*) as n, count_if(l_tax = 0) as untaxed,
    if(n % 7 = 0, '', max(l_quantity)::varchar) as prcp,
    min(l_discount)::varchar as snow,
    if(n % 5 = 0, null, min(l_tax)::varchar) as tmin,
    max(l_linenumber)::varchar as tmax,
    (untaxed % 4 = 1) as prcp_rejected,
    (untaxed % 3 = 2) as snow_rejected
  from lineitem group by l_returnflag, l_shipdate
),
observed as (
  select date, station, prcp_rejected::bigint + snow_rejected::bigint as quality_flagged_values,
    if(prcp_rejected or prcp = '', null, prcp)::double as precipitation_mm,
    if(snow_rejected, null, snow)::double as snowfall_mm,
    tmin::double as min_temperature_c, tmax::double as max_temperature_c
  from weather_text
),
weather as (
  select * exclude (place) from (
    select *, row_number() over (partition by date order by station) as place from observed)
  where place = 1
),
calendar as (
  select unnest(range(min(date)::timestamp, max(date)::timestamp + interval 1 day,
                      interval 1 day))::date as date_key
  from weather
)"""


def _demand(suffix: str = "", staged: str = "") -> str:
    staged = staged or f"staged{suffix}"
    return f"""
weather_days{suffix} as (
  select w.date, ifnull(d.n, 0)::bigint as trip_count,
    ifnull(d.amount, 0)::decimal(38,2) as total_amount, precipitation_mm, snowfall_mm,
    min_temperature_c, max_temperature_c, quality_flagged_values,
    (trip_count - lag(trip_count) over by_date)::bigint as change_from_previous_day,
    avg(trip_count) over (by_date rows 6 preceding) as trailing_7_day_trips
  from weather w
  left join (select date, sum(trip_count) as n, sum(total_amount) as amount
             from zone_days{suffix} group by date) d using (date)
  where w.date in (select date_key from calendar)
  window by_date as (order by w.date)
),
quality{suffix} as (
  select source_period, quality_status, count(*) as trip_count,
    sum(missing_timestamp::int)::bigint as missing_timestamp,
    sum(reversed_timestamp::int)::bigint as reversed_timestamp,
    sum(outside_source_month::int)::bigint as outside_source_month,
    sum(invalid_distance::int)::bigint as invalid_distance,
    sum(invalid_money::int)::bigint as invalid_money,
    sum(unknown_zone::int)::bigint as unknown_zone,
    sum(long_duration::int)::bigint as long_duration,
    sum(zero_distance::int)::bigint as zero_distance,
    sum(negative_money::int)::bigint as negative_money,
    sum(unusual_passengers::int)::bigint as unusual_passengers,
    sum(unusual_payment::int)::bigint as unusual_payment
  from {staged} group by all
)"""


LEDGER = """
registered as (
  select if(l_linestatus = 'F', 'trips', 'weather') as source,
    strftime(l_shipdate, '%Y-%m') as period,
    'landing/' || source || '/' || period || '-' || l_returnflag as path,
    sum(l_partkey)::bigint as length,
    sha256((sum(l_partkey) % 499)::varchar) as sha256,
    count(*) as row_count,
    sha256(l_returnflag) as schema_fingerprint,
    max(l_shipdate) as registered_at,
    l_returnflag as version
  from lineitem group by l_linestatus, l_returnflag, strftime(l_shipdate, '%Y-%m')
),
ledger_now as (
  select * from registered
  qualify row_number() over (partition by source, period
    order by registered_at desc, sha256 desc, path desc) = 1
),
found as (
  select source, period, sha256 as raw_sha256,
    if(row_count % 7 = 0, null, 'bronze-' || row_count % 3) as bronze
  from ledger_now
),
committed as (
  select source, period, sha256 as raw_sha256,
    'bronze-' || if(length % 5 = 0, 'old', (row_count % 3)::varchar) as bronze
  from registered where version = 'N'
),
work as (
  select f.source, f.period, case
    when right(f.period, 3) = '-12' then 'forced'
    when f.raw_sha256 is distinct from c.raw_sha256 then 'raw_changed'
    when f.bronze is null then 'bronze_missing'
    when f.bronze is distinct from c.bronze then 'bronze_changed' end as reason
  from found f left join committed c using (source, period)
),
order_months as (
  select strftime(unnest(range(
    date_trunc('month', min(o_orderdate))::timestamp,
    max(o_orderdate)::timestamp + interval 1 microsecond, interval 1 month)), '%Y-%m') as period
  from orders
),
loaded as (
  select period from order_months
  union select period from committed where source = 'trips'
)"""

STEPS = ",".join([
    RIDES, _classified(), _marts(), WEATHER, _demand(), LEDGER, CORRECTED, _classified("_v2"), """
replaced as (
  select * from fact where right(source_period, 2) not in ('03', '07')
  union all select * from fact_v2 where right(source_period, 2) in ('03', '07')
)""", _marts("replaced", "_v2"), _demand("_v2"), """
held as (
  select * from registered where version <> 'R'
  qualify row_number() over (partition by source, period
    order by registered_at desc, sha256 desc, path desc) = 1
),
given as (
  select * replace (if(length % 13 = 0, null, sha256) as sha256), copy::int as copy
  from registered, range(1, 3) as copies(copy)
  where (version = 'R' or (version = 'N' and right(period, 3) = '-06')) and (copy = 1 or row_count % 11 = 0)
),
contents as (select page_id, encode(html) as content from pages)"""])


def _sql(query: str) -> str:
    return f"with {STEPS.strip()}\n{query.strip()}"


def _count(name: str, condition: str, table: str) -> str:
    return f"select '{name}' as check_name, " \
           f"(select count(*) from {table} where {condition})::bigint as violations"


def _repeated(name: str, key: str, table: str) -> str:
    return f"select '{name}' as check_name, (select count(*) from (select {key} from {table} " \
           f"where {key} is not null group by {key} having count(*) > 1))::bigint as violations"


NOT_NULL = {
    "stg_trips": ("staged", ("trip_id", "source_period", "quality_status")),
    "stg_zones": ("places", ("zone_key",)),
    "stg_weather": ("weather", ("date",)),
    "dim_zone": ("places", ("zone_key", "borough")),
    "dim_date": ("calendar", ("date_key",)),
    "fct_trips": ("fact", (
        "trip_id", "source_period", "pickup_zone_key", "dropoff_zone_key", "pickup_date")),
    "mart_zone_daily": ("zone_days", ("date", "zone_key")),
    "mart_borough_daily": ("borough_days", ("date", "borough")),
    "mart_weather_demand": ("weather_days", ("date",)),
    "mart_quality": ("quality", ("source_period", "quality_status")),
}

CHECK_NOT_NULL = "\nunion all ".join(
    _count(f"not_null_{name}_{column}", f"{column} is null", table)
    for name, (table, columns) in NOT_NULL.items() for column in columns)

CHECK_UNIQUE = "\nunion all ".join([
    _repeated("unique_stg_trips_trip_id", "trip_id", "staged"),
    _repeated("unique_fct_trips_trip_id", "trip_id", "fact"),
    _repeated("unique_stg_zones_zone_key", "zone_key", "places"),
    _repeated("unique_stg_weather_date", "date", "weather"),
    _repeated("unique_dim_zone_zone_key", "zone_key", "places"),
    _repeated("unique_dim_date_date_key", "date_key", "calendar"),
    _repeated("unique_mart_weather_demand_date", "date", "weather_days"),
])

CHECK_ACCEPTED = "\nunion all ".join([
    _count("accepted_values_stg_trips_quality_status",
           "quality_status not in ('INVALID', 'SUSPICIOUS', 'ACCEPTED')", "staged"),
    _count("accepted_values_fct_trips_quality_status",
           "quality_status not in ('SUSPICIOUS', 'ACCEPTED')", "fact"),
])

CHECK_RELATIONSHIPS = "\nunion all ".join([
    _count("relationships_fct_trips_pickup_zone_key",
           "pickup_zone_key not in (select zone_key from places where zone_key > -1)", "fact"),
    _count("relationships_fct_trips_dropoff_zone_key",
           "dropoff_zone_key not in (select zone_key from places where zone_key > -1)", "fact"),
    _count("relationships_fct_trips_pickup_date",
           "pickup_date not in (select date_key from calendar where date_key > date '0001-01-01')",
           "fact"),
])

RECONCILIATION = """
select *, facts = zone_trips and facts = borough_trips and facts = weather_trips
  and facts = retained and input_rows = classified as balanced
from (select
  (select count(*) from fact) as facts,
  (select ifnull(sum(trip_count), 0) from zone_days)::bigint as zone_trips,
  (select ifnull(sum(trip_count), 0) from borough_days)::bigint as borough_trips,
  (select ifnull(sum(trip_count), 0) from weather_days)::bigint as weather_trips,
  (select ifnull(sum(trip_count), 0) from quality
   where quality_status != 'INVALID')::bigint as retained,
  (select count(*) from trips) as input_rows,
  (select ifnull(sum(trip_count), 0) from quality)::bigint as classified)"""


def _grain(model: str, table: str, keys: str) -> str:
    return f"""select '{model}' as model, count(*) as key_groups,
  count_if(n > 1)::bigint as repeated
from (select count(*) as n from {table} group by {keys})"""


GRAINS = "\nunion all ".join([
    _grain("zone_day", "zone_days", "date, zone_key"),
    _grain("borough_day", "borough_days", "date, borough"),
    _grain("quality", "quality", "source_period, quality_status"),
])
SOURCES = "\nunion all ".join([
    _grain("zone", "places", "zone_key"), _grain("weather", "observed", "date")])

UNCOVERED = """select distinct pickup_date from fact
where not exists (from weather where weather.date = pickup_date)"""

LOOK_ALIKE = """select source_period, pickup_datetime, dropoff_datetime, pickup_zone_key,
  dropoff_zone_key, trip_distance, total_amount, count(*) as occurrences
from fact group by all having occurrences > 1"""

VALIDITY = {
    "reversed": "{end} < {start}", "negative_distance": "{distance} < 0",
    "wrong_month": "strftime({start}, '%Y-%m') != source_period",
}
CHECK_VALIDITY = "\nunion all ".join(
    [_count(f"staged_{name}", rule.format(start="started", end="ended", distance="distance"),
            "staged") for name, rule in VALIDITY.items()]
    + [_count(f"fact_{name}", rule.format(
        start="pickup_datetime", end="dropoff_datetime", distance="trip_distance"), "fact")
       for name, rule in VALIDITY.items()])

CHECK_RESULTS = f"""
select check_name, violations,
  if(violations = 0, 'pass', if(check_name = 'duplicate_observations', 'warn', 'fail')) as status
from ({CHECK_NOT_NULL}
union all {CHECK_UNIQUE}
union all {CHECK_ACCEPTED}
union all {CHECK_RELATIONSHIPS}
union all select 'reconciliation', (not balanced)::bigint from ({RECONCILIATION})
union all select 'grains', sum(repeated)::bigint from ({GRAINS})
union all select 'source_unique', sum(repeated)::bigint from ({SOURCES})
union all select 'fact_validity', sum(violations)::bigint from ({CHECK_VALIDITY})
  where left(check_name, 5) = 'fact_'
union all select 'weather_coverage', count(*)::bigint from ({UNCOVERED})
union all select 'duplicate_observations', count(*)::bigint from ({LOOK_ALIKE}))"""
CHECK_SUMMARY = f"select status, count(*) as checks from ({CHECK_RESULTS}) group by status"


def _hit(step: int) -> str:
    return f"source_row % {step} = 0 and source_row % 97 <> 0"


def _small(table: str, twice: str, blank: str, *names: str) -> str:
    return "\n  union all ".join(
        [f"select * from {table}", f"select * from {table} where {twice}"]
        + [f"select * replace (null as {name}) from {table} where {blank}" for name in names])


FAULTY_MONTH = "date between date '1995-05-01' and date '1995-05-31'"
FAULTS = f"""
bad_staged as (
  select * replace (
    if({_hit(101)}, null, trip_id) as trip_id, if({_hit(103)}, null, source_period) as source_period,
    case when {_hit(157)} then null when {_hit(151)} then 'ODD' else quality_status end
      as quality_status) from staged
  union all select * from staged where source_row % 97 = 0
),
bad_fact as (
  select * replace (
    if({_hit(101)}, null, trip_id) as trip_id, if({_hit(103)}, null, source_period) as source_period,
    case when {_hit(127)} then 777 when {_hit(107)} then null else pickup_zone_key end
      as pickup_zone_key,
    case when {_hit(131)} then 777 when {_hit(109)} then null else dropoff_zone_key end
      as dropoff_zone_key,
    case when {_hit(137)} then date '1900-01-01' when {_hit(113)} then null else pickup_date end
      as pickup_date,
    if({_hit(139)}, 'INVALID', quality_status) as quality_status,
    if({_hit(149)}, -1, trip_distance) as trip_distance) from fact
  union all select * from fact where source_row % 97 = 0
),{_marts("bad_fact", "_f")},{_demand("_f", "bad_staged")},
bad_places as ({_small("places", "zone_key = 3", "zone_key = 4", "zone_key", "borough")}),
bad_weather as (select * from ({_small(
    "weather", "dayofmonth(date) = 3", "dayofmonth(date) = 4", "date")})
  where not ifnull({FAULTY_MONTH}, false)),
bad_calendar as ({_small(
    "calendar", "dayofmonth(date_key) = 5", "dayofmonth(date_key) = 6", "date_key")}),
bad_zone_days as ({_small("zone_days_f", f"{FAULTY_MONTH} and zone_key = 2", "false")}),
bad_borough_days as ({_small(
    "borough_days_f", f"{FAULTY_MONTH} and borough = 'ASIA'", f"{FAULTY_MONTH} and borough = 'AFRICA'",
    "borough")}),
bad_weather_days as ({_small(
    "weather_days_f", "dayofmonth(date) = 7", "dayofmonth(date) = 8", "date")}),
bad_quality as ({_small(
    "quality_f", "quality_status = 'INVALID'", "quality_status = 'INVALID'", "quality_status")})"""
CHECK_FAULTS = re.sub(
    r"\b(staged|fact|places|weather|calendar|zone_days|borough_days|weather_days|quality)\b",
    r"bad_\1", CHECK_RESULTS)

def _consistency(fact: str = "fact", suffix: str = "", places: str = "true") -> str:
    return f"""
select unnest(['statuses_known', 'grains_unique', 'dates_unique', 'monthly_equals_retained',
    'locations_equal_retained', 'retained_equals_fact', 'source_equals_input',
    'days_as_recorded', 'periods_as_recorded', 'period_totals_as_recorded']) as requirement,
  unnest([known, grains, dates, by_month = retained, by_place = retained, retained = facts,
    classified = inputs, days = observed_days, months_match, month_totals_match]) as holds
from (select
  (select bool_and(quality_status in ('INVALID', 'SUSPICIOUS', 'ACCEPTED')) from quality{suffix}) as known,
  (select count(*) = count(distinct (date, borough)) from borough_days{suffix})
    and (select count(*) = count(distinct (source_period, quality_status)) from quality{suffix}) as grains,
  (select count(*) > 0 and count(*) = count(distinct date) from weather_days{suffix}) as dates,
  (select sum(trip_count) from weather_days{suffix}) as by_month,
  (select sum(trip_count) from borough_days{suffix} where {places}) as by_place,
  (select sum(trip_count) from quality{suffix} where quality_status != 'INVALID') as retained,
  (select sum(trip_count) from quality{suffix}) as classified,
  (select count(*) from {fact}) as facts,
  (select count(*) from staged{suffix}) as inputs,
  (select count(*) from weather_days{suffix}) as days,
  (select count(*) from weather) as observed_days,
  (select count(*) from ((select distinct strftime(date, '%Y-%m') from weather_days{suffix}) except
     (select source_period from {fact}))) + (select count(*) from ((select source_period from {fact})
     except (select strftime(date, '%Y-%m') from weather_days{suffix}))) = 0 as months_match,
  (select count(*) from
     (select strftime(date, '%Y-%m') as m, sum(trip_count) as n from weather_days{suffix} group by m)
     join (select source_period as m, count(*) as k from {fact} group by m) using (m)
   where n != k) = 0 as month_totals_match)"""


RUN_TOTALS = "\nunion all ".join(
    f"select '{name}' as measure, ifnull(({value}), 0)::bigint as value" for name, value in {
        "input_rows": "select count(*) from staged",
        "quality_warnings":
            "select sum(trip_count) from quality where quality_status = 'SUSPICIOUS'",
        "invalid_rows": "select sum(trip_count) from quality where quality_status = 'INVALID'",
        "gold_mart_zone_daily": "select count(*) from zone_days",
        "gold_mart_borough_daily": "select count(*) from borough_days",
        "gold_mart_weather_demand": "select count(*) from weather_days",
        "gold_mart_quality": "select count(*) from quality",
        "gold_fct_trips": "select count(*) from fact",
        "gold_dim_zone": "select count(*) from places",
        "gold_dim_date": "select count(*) from calendar",
        "earliest_run_input_rows": """
            select n from (select strftime(o_orderdate, '%Y-%m') as run_id,
              min(o_orderdate) as start_time, count(*) as n, sum(o_custkey) % 3 as rest
              from orders group by run_id)
            where rest != 0 and n > 1 order by start_time, run_id limit 1""",
    }.items())


def _compared(name: str, left: str, right: str, keys: tuple[str, ...], cells: tuple[str, ...],
              floats: tuple[str, ...] = ()) -> str:
    on = " and ".join(f"a.{k} is not distinct from b.{k}" for k in keys)
    differs = " or ".join(
        [f"a.{c} is distinct from b.{c}" for c in cells]
        + [f"ifnull(abs(a.{c} - b.{c}) > greatest(1e-12 * greatest(abs(a.{c}), abs(b.{c})), "
           f"1e-9), a.{c} is distinct from b.{c})" for c in floats]) or "false"
    gaps = ", ".join(["0.0::double"] + [f"abs(a.{c} - b.{c})" for c in floats])
    return f"""select '{name}' as table_name,
  count_if(a.here and b.here)::bigint as matched, count_if(b.here is null)::bigint as only_before,
  count_if(a.here is null)::bigint as only_after,
  count_if(a.here and b.here and ({differs}))::bigint as differing,
  round(ifnull(max(if(a.here and b.here, greatest({gaps}), null)), 0.0), 6) as max_float_gap
from (select *, true as here from {left}) a full join (select *, true as here from {right}) b
  on {on}"""


MONEY = ("trip_count", "fare_amount", "total_amount")
SNAPSHOT = "\nunion all ".join([
    """select 'fct_trips' as table_name, count_if(old and new)::bigint as matched,
  count_if(not new)::bigint as only_before, count_if(not old)::bigint as only_after,
  count_if(old and new and touched)::bigint as differing, 0.0::double as max_float_gap
from (select source_period,
    source_period in (select source_period from fact) as old,
    source_period in (select source_period from replaced) as new,
    source_period in (select source_period from (from fact except all from replaced))
      or source_period in (select source_period from (from replaced except all from fact))
      as touched
  from (select source_period from fact union select source_period from replaced))""",
    _compared("mart_zone_daily", "zone_days", "zone_days_v2", ("date", "zone_key"),
              (*MONEY, "trips_with_passenger_count", "suspicious_trip_count"),
              ("passenger_count", "average_trip_distance", "average_trip_duration")),
    _compared("mart_borough_daily", "borough_days", "borough_days_v2", ("date", "borough"),
              (*MONEY, "active_pickup_zones")),
])

FLOATS = ("passenger_count", "average_trip_distance", "average_trip_duration")


def _differing(name: str, left: str, right: str, keys: tuple[str, ...], cells: tuple[str, ...],
               floats: tuple[str, ...] = ()) -> str:
    on = " and ".join(f"a.{k} is not distinct from b.{k}" for k in keys)
    differs = " or ".join(
        [f"a.{c} is distinct from b.{c}" for c in cells]
        + [f"ifnull(abs(a.{c} - b.{c}) > greatest(1e-12 * greatest(abs(a.{c}), abs(b.{c})), "
           f"1e-9), a.{c} is distinct from b.{c})" for c in floats])
    key = ", ".join(f"ifnull(if(a.here, a.{k}, b.{k})::varchar, '~')" for k in keys)
    return f"""select '{name}' as table_name, concat_ws('|', {key}) as key,
  case when b.here is null then 'only_before' when a.here is null then 'only_after' else 'differing' end as kind
from (select *, true as here from {left}) a full join (select *, true as here from {right}) b on {on}
where b.here is null or a.here is null or {differs}"""


CALENDAR_MONEY = ("trip_count", "total_amount")
DIFFERENCES = "\nunion all ".join([
    _differing("fct_trips", "fact", "replaced", ("trip_id",), (
        "source_period", "pickup_datetime", "dropoff_datetime", "pickup_zone_key", "dropoff_zone_key",
        "passenger_count", "trip_distance", "fare_amount", "tip_amount", "total_amount", "payment_type",
        "quality_status")),
    _differing("mart_zone_daily", "zone_days", "zone_days_v2", ("date", "zone_key"),
               (*MONEY, "trips_with_passenger_count", "suspicious_trip_count"), FLOATS),
    _differing("mart_borough_daily", "borough_days", "borough_days_v2", ("date", "borough"),
               (*MONEY, "active_pickup_zones")),
    _differing("mart_weather_demand", "weather_days", "weather_days_v2", ("date",),
               (*CALENDAR_MONEY, "change_from_previous_day"), ("trailing_7_day_trips",)),
    _differing("mart_quality", "quality", "quality_v2", ("source_period", "quality_status"),
               ("trip_count", "invalid_distance", "zero_distance", "unknown_zone")),
])
RECORDED = "\nunion all ".join(
    f"select '{name}' as measure, ifnull(({value}), 0)::bigint as value" for name, value in {
        "input_rows": "select count(*) from staged_v2",
        "quality_warnings": "select sum(trip_count) from quality_v2 where quality_status = 'SUSPICIOUS'",
        "invalid_rows": "select sum(trip_count) from quality_v2 where quality_status = 'INVALID'",
        "gold_fct_trips": "select count(*) from replaced",
        "gold_dim_date": "select count(*) from calendar",
        "gold_dim_zone": "select count(*) from places",
        "gold_mart_zone_daily": "select count(*) from zone_days_v2",
        "gold_mart_borough_daily": "select count(*) from borough_days_v2",
        "gold_mart_weather_demand": "select count(*) from weather_days_v2",
        "gold_mart_quality": "select count(*) from quality_v2",
    }.items())
STORED = "\nunion all ".join(
    f"select '{run}' as run_id, * from ({_consistency('replaced', '_v2', places)})"
    for run, places in (("after", "true"), ("tampered", "borough <> 'ASIA'")))
COMMITS = """(select date_diff('day', date '1992-01-01', registered_at::date) * 4 + instr('ANR', version) as sequence,
  source, period, path, sha256 from registered)"""
STATES = "\nunion all ".join(
    f"""select {upto}::bigint as upto, * from (select source, period, sequence::bigint as sequence, path, sha256 from {COMMITS}
  where sequence <= {bound} qualify row_number() over (partition by source, period order by sequence desc) = 1)"""
    for upto, bound in ((3000, 3000), (6000, 6000), ("null", 10**9)))

FLAGS = """missing_timestamp, reversed_timestamp, outside_source_month, invalid_distance,
  invalid_money, unknown_zone, long_duration, zero_distance, negative_money, unusual_passengers,
  unusual_payment"""



def _tree_digests(leaf_bytes: int, fan_out: int, levels: int) -> str:
    """Leaves of every page, then `levels` times the nodes above them; a single node stays as it is."""
    nodes = f"""select page_id, i as place, greatest(1, ceil(octet_length(content) / {leaf_bytes}.0))::bigint as n,
    sha256(content[i * {leaf_bytes} + 1:(i + 1) * {leaf_bytes}]) as digest
  from (select *, unnest(range(greatest(1, ceil(octet_length(content) / {leaf_bytes}.0))::bigint)) as i
    from contents)"""
    for _ in range(levels):
        nodes = f"""select page_id, place // {fan_out} as place, ceil(n / {fan_out}.0)::bigint as n,
    if(n > 1, sha256(string_agg(digest, '' order by place)), min(digest)) as digest
  from ({nodes}) group by page_id, place // {fan_out}, n"""
    return f"""from (select page_id, octet_length(content) as length,
  if(content is null, null, greatest(1, ceil(octet_length(content) / {leaf_bytes}.0)))::bigint as leaves
  from contents) join (select page_id, digest as sha256 from ({nodes})) using (page_id)"""


QUERIES: dict[str, str] = {
    "page_digests": f"select page_id, length, leaves, sha256 {_tree_digests(256, 4, 8)}",
    "bronze_identity": """select source_period, source_sha256, source_row, trip_id,
  started as pickup_datetime, ended as dropoff_datetime, day as pickup_date,
  from_zone as pickup_zone_key, to_zone as dropoff_zone_key, minutes as trip_duration_minutes
from staged""",
    "trip_flags": f"select trip_id, {FLAGS}, quality_status from staged",
    "quality_status_counts":
        "select quality_status, count(*) as trip_count from staged group by all",
    "quarantine": f"""select trip_id, source_period, started as pickup_datetime,
  ended as dropoff_datetime, from_zone as pickup_zone_key, to_zone as dropoff_zone_key, {FLAGS}
from staged where quality_status = 'INVALID'""",
    "fact_trips": "select * from fact",
    "row_ordinals": """select 'lineitem.parquet' as source_file, position::bigint as source_row,
  l_orderkey from rides""",
    "content_fingerprint": """select source_period, count(*) as row_count,
  sum(('0x' || left(digest, 16))::ubigint)::varchar as high_sum,
  sum(('0x' || right(digest, 16))::ubigint)::varchar as low_sum
from (select source_period, md5(concat_ws('|', trip_id, source_period, source_sha256, source_row,
    coalesce(pickup_datetime::varchar, '~'), coalesce(dropoff_datetime::varchar, '~'),
    coalesce(pickup_date::varchar, '~'), coalesce(pickup_zone_key::varchar, '~'),
    coalesce(dropoff_zone_key::varchar, '~'), coalesce(passenger_count::decimal(38,6)::varchar, '~'),
    coalesce(trip_distance::decimal(38,6)::varchar, '~'),
    coalesce(trip_duration_minutes::decimal(38,6)::varchar, '~'),
    coalesce(fare_amount::varchar, '~'), coalesce(tip_amount::varchar, '~'),
    coalesce(total_amount::varchar, '~'), coalesce(payment_type::varchar, '~'), quality_status)) as digest
  from fact) group by 1""",
    "profile_month": """select source_period, count(*) as source_rows,
  count_if(started is null or ended is null)::bigint as null_timestamps,
  count_if(ended < started)::bigint as backwards,
  count_if(strftime(started, '%Y-%m') <> source_period)::bigint as outside_month,
  count_if(distance < 0)::bigint as negative_distance,
  count_if(fare < 0)::bigint as negative_fare,
  count_if(passengers is null)::bigint as null_passengers,
  count_if(distance = 0)::bigint as zero_distance,
  max(date_diff('minute', started, ended)) as max_duration
from trips group by source_period""",
    "dim_zone": "select * from places",
    "dim_date": """select date_key, year(date_key)::bigint as year, month(date_key)::bigint as month,
  dayofweek(date_key)::bigint as weekday_number, dayname(date_key) as weekday_name,
  isodow(date_key) >= 6 as is_weekend
from calendar""",
    "zone_daily": """select * replace (round(average_trip_distance, 6) as average_trip_distance,
  round(average_trip_duration, 6) as average_trip_duration) from zone_days""",
    "borough_daily": "select * from borough_days",
    "weather_demand": """select * replace (round(trailing_7_day_trips, 6) as trailing_7_day_trips)
from weather_days""",
    "quality_mart": "select * from quality",
    "weather_dedup": "select * from weather",
    "weather_masking": "select * from observed",
    "weather_month_coverage": """select period, count(*) as row_count,
  count(distinct date) as distinct_days,
  count_if(station != 'STATION-A')::bigint as unexpected_station,
  count_if(strftime(date, '%Y-%m') != period)::bigint as outside_period,
  dayofmonth(last_day((period || '-01')::date))::bigint as expected_days,
  row_count = expected_days and distinct_days = expected_days as complete
from weather_text group by period""",
    "zone_contract": """select 'nations' as lookup, zone_key, count(*) as occurrences from places
group by zone_key having occurrences > 1
union all select 'customers', c_nationkey::bigint, count(*) as occurrences from customer
group by c_nationkey having occurrences > 1""",
    "month_spine": "select period from order_months",
    "report_monthly": """select strftime(date, '%Y-%m') as period, sum(trip_count)::bigint as trips
from weather_days group by period""",
    "report_locations": """select ifnull(borough, '(missing label)') as location,
  sum(trip_count)::bigint as trips from borough_days group by location""",
    "report_quality_totals":
        "select quality_status, sum(trip_count)::bigint as trips from quality group by all",
    "report_consistency": _consistency(),
    "run_totals": RUN_TOTALS,
    "check_unique": CHECK_UNIQUE,
    "check_not_null": CHECK_NOT_NULL,
    "check_accepted": CHECK_ACCEPTED,
    "check_relationships": CHECK_RELATIONSHIPS,
    "check_reconciliation": RECONCILIATION,
    "check_grains": GRAINS,
    "check_source_unique": SOURCES,
    "check_fact_validity": CHECK_VALIDITY,
    "check_weather_coverage": UNCOVERED,
    "check_duplicate_observations": LOOK_ALIKE,
    "check_summary": CHECK_SUMMARY,
    "check_faults": CHECK_FAULTS,
    "work_detection": """select 'incremental' as scenario, source, period, reason from work
where reason is not null
union all select 'rebuild_all', source, period, 'rebuild_all' from found""",
    "change_propagation": """select distinct 'trips_only' as scenario, period from work
where reason is not null and source = 'trips'
union all select 'zones_too', period from
  (select period from loaded union select period from work
   where reason is not null and source = 'trips')""",
    "ledger_current": """select source, period, path, length, sha256, row_count,
  schema_fingerprint from ledger_now""",
    "ledger_history": """select source, period, sha256, path, length, row_count from registered
qualify row_number() over (partition by source, period, sha256 order by registered_at, path) = 1""",
    "ledger_duplicate_bytes": """select source, sha256, count(distinct period) as periods,
  min(period) as first_period, max(period) as last_period
from ledger_now group by source, sha256 having periods > 1""",
    "registration_outcomes": """
select source, period, path, sha256, copy, case
  when named > 1 then 'named_twice' when sha256 is null then 'no_digest' when again > 1 then 'twice_in_period'
  when exists (from held k where k.source = i.source and k.sha256 = i.sha256 and k.period <> i.period
      and (k.source, k.period) not in (select (source, period) from given))
    or exists (from given g where g.source = i.source and g.sha256 = i.sha256 and g.period <> i.period) then 'elsewhere'
  when not exists (from held k where k.source = i.source and k.period = i.period
      and not exists (from given g where g.path = k.path and g.sha256 = k.sha256))
    and not exists (from given g where g.source = i.source and g.period = i.period
      and not exists (from held k where k.path = g.path and k.sha256 = g.sha256)) then 'unchanged'
  else 'added' end as outcome
from (select *, count(*) over (partition by path) as named,
        count(sha256) over (partition by source, period, sha256) as again from given) i""",
    "period_replacement": """select trip_id, source_period, quality_status, trip_distance,
  total_amount from replaced""",
    "snapshot_equivalence": SNAPSHOT,
    "generation_differences": DIFFERENCES,
    "recorded_run": RECORDED,
    "stored_consistency": STORED,
    "commit_states": STATES,
    "vacuum_plan": f"""select path, source, period from (
  select *, lead(sequence) over (partition by source, period order by sequence) as next from {COMMITS})
where next <= 6000""",
}


def statements() -> dict[str, str]:
    return {name: _sql(query) for name, query in QUERIES.items()} | {
        "check_faults": f"with {STEPS.strip()},{FAULTS}\n{CHECK_FAULTS.strip()}"}
