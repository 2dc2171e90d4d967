"""SQL that computes the result of each named query on the same tables, for DuckDB."""

from __future__ import annotations

# Relations the final selects build on: name -> (relations needed, select).
RELATIONS: dict[str, tuple[tuple[str, ...], str]] = {}


def _relation(name: str, needs: str, sql: str) -> None:
    RELATIONS[name] = (tuple(needs.split()), sql)


def _with(needs: str, final: str) -> str:
    """The final select behind the relations it needs, each defined once."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in RELATIONS[name][0]:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in needs.split():
        visit(name)
    parts = ",\n".join(f"{name} as ({RELATIONS[name][1]})" for name in ordered)
    return f"with {parts}\n{final}" if parts else final


def money(column: str) -> str:
    return f"cast(sum(cast(coalesce({column}, 0.0) as decimal(28,6))) as double)"


def two(column: str) -> str:
    """Half-up rounding to cents of a value that holds six places."""
    return f"cast(round(cast({column} as decimal(28,6)), 2) as double)"


TIME_KEY = "cast(strftime(event_time, '%Y%m%d%H') as bigint)"
PROMO = (
    "coalesce(regexp_replace(cast(cast(promotion_amount as decimal(38,6)) as varchar), "
    "'\\.?0+$', ''), '0')"
)
METHOD = "coalesce(source_system, 'unknown')"
NOW = "timestamp '2024-01-31 00:00:00'"
CUT = "timestamp '2024-01-16 00:00:00'"

_relation(
    "parsed", "",
    "select *, cast(json_extract_string(props, '$.k') as integer) as k from events",
)
_relation(
    "canonical", "parsed",
    """
    select event_id as n,
      'e' || cast(case when event_id % 50 = 49 then event_id - 1 else event_id end as varchar) as event_id,
      case event_type when 'purchase' then 'trip_completed' when 'error' then 'trip_cancelled'
        when 'signup' then 'ride_requested' when 'view' then 'fraud_signal'
        when 'click' then 'support_ticket_created' end as event_type,
      ts as event_time,
      case when k = 99 then null else
        case user_id % 4 when 0 then 'NYC' when 1 then 'CHICAGO' when 2 then 'DUBAI' else 'ABU DHABI' end
      end as city_id,
      't' || cast(parsed.event_id - parsed.event_id % 4 as varchar) as trip_id,
      case when k <> 98 then 'r' || cast(user_id as varchar) end as rider_id,
      case when parsed.event_type <> 'signup' then 'd' || cast(user_id % 40 as varchar) end as driver_id,
      case when parsed.event_type <> 'signup' then 'v' || cast(user_id % 40 as varchar) end as vehicle_id,
      case when parsed.event_type = 'purchase' then 'p' || cast(parsed.event_id as varchar) end as payment_id,
      cast(null as varchar) as refund_id,
      case when k % 7 = 0 then 'w' || cast(parsed.event_id as varchar) end as review_id,
      case when parsed.event_type = 'click' then 's' || cast(parsed.event_id as varchar) end as support_ticket_id,
      case when parsed.event_type = 'view' then 'f' || cast(parsed.event_id as varchar) end as fraud_case_id,
      case when parsed.event_type = 'purchase' then value end as fare_total,
      1 + (k % 10) / 10.0::double as surge_multiplier,
      case when k % 5 <> 0 then cast(k % 5 as double) end as promotion_amount,
      case when parsed.event_type = 'purchase' then value * 0.25::double end as platform_fee,
      case when parsed.event_type = 'purchase' then value * 0.75::double end as driver_payout,
      case when parsed.event_type = 'purchase' then value end as payment_amount,
      cast(null as double) as refund_amount,
      case when k % 7 = 0 then cast(k % 5 + 1 as double) end as rating_value,
      case when parsed.event_type = 'view' then k / 100.0::double end as fraud_score,
      cast(null as double) as latitude, cast(null as double) as longitude,
      cast(null as double) as avg_surge_multiplier,
      cast(null as bigint) as requested_trips, cast(null as bigint) as completed_trips,
      cast(null as bigint) as active_drivers,
      case when k % 11 <> 0 then 'src' || cast(k % 3 as varchar) end as source_system,
      cast(null as varchar) as schema_version,
      cast(ts as date) as event_date
    from parsed
    """,
)
_relation(
    "stg", "canonical",
    """
    select * exclude (n) from canonical
    where event_id is not null and event_time is not null and city_id is not null
    qualify row_number() over (partition by event_id order by event_time desc, n desc) = 1
    """,
)
# The events as messages: own id each, every fiftieth delivered twice.
_relation(
    "deliveries", "canonical",
    """
    select canonical.* exclude (event_id), 'e' || cast(n as varchar) as event_id,
      n * 2 + copy as "offset",
      case event_type when 'fraud_signal' then 'rh.fraud.signals.v1'
        when 'support_ticket_created' then 'rh.support.tickets.v1'
        else 'rh.trip.lifecycle.events.v1' end as topic,
      case event_type when 'fraud_signal' then 'op_fraud_signal_events'
        when 'support_ticket_created' then 'op_support_ticket_events'
        else 'op_trip_events' end as bronze_entity
    from canonical, (values (0), (1)) as copies(copy)
    where copy = 0 or n % 50 = 49
    """,
)
MEASURES = f"""
  count(*) filter (where event_type = 'trip_completed') as completed_trips,
  count(*) filter (where event_type = 'trip_cancelled') as cancelled_trips,
  {money('fare_total')} as gross_fare_total,
  {money('platform_fee')} as platform_fee_total,
  {money('driver_payout')} as driver_payout_total,
  round(sum(cast(coalesce(surge_multiplier, 1.0) as decimal(28,6)))::double / count(*), 6) as avg_surge_multiplier
"""
_relation("mart", "stg", f"select event_date, city_id, {MEASURES} from stg group by 1, 2")
HOURLY = f"""
  select city_id, date_trunc('hour', event_time) as window_start,
    date_trunc('hour', event_time) + interval 1 hour as window_end, {MEASURES},
    cast(date_trunc('hour', event_time) as date) as event_date
"""

FACT_SELECTS = {
    "fact_trip": (
        "trip_fact_key", "trip_id is not null",
        f"""
        md5(coalesce(trip_id, event_id)) as trip_fact_key, trip_id, md5(rider_id) as rider_key,
        md5(driver_id) as driver_key, md5(vehicle_id) as vehicle_key, md5(city_id) as city_key,
        {TIME_KEY} as time_key, md5({PROMO}) as promotion_key, md5({METHOD}) as payment_method_key,
        coalesce(fare_total, 0.0::double) as final_fare,
        coalesce(surge_multiplier, 1.0::double) as surge_multiplier,
        coalesce(promotion_amount, 0.0::double) as promotion_amount,
        coalesce(platform_fee, 0.0::double) as platform_fee,
        coalesce(driver_payout, 0.0::double) as driver_payout,
        case when event_type = 'trip_completed' then 1 else 0 end as completed_flag,
        case when event_type = 'trip_cancelled' then 1 else 0 end as cancelled_flag,
        event_time as created_at
        """,
    ),
    "fact_driver_earnings": (
        "earning_fact_key", "driver_id is not null and trip_id is not null",
        f"""
        md5(coalesce(trip_id, event_id) || '_earn') as earning_fact_key, trip_id,
        md5(driver_id) as driver_key, md5(city_id) as city_key, {TIME_KEY} as time_key,
        coalesce(driver_payout, 0.0::double) as base_earning, 0.0::double as surge_bonus,
        0.0::double as incentive_bonus, 0.0::double as tip_amount,
        0.0::double as adjustment_amount,
        coalesce(driver_payout, 0.0::double) as net_driver_earning, event_time as created_at
        """,
    ),
    "fact_payment": (
        "payment_fact_key", "payment_id is not null",
        f"""
        md5(coalesce(payment_id, event_id)) as payment_fact_key, payment_id, trip_id,
        md5(rider_id) as rider_key, md5(city_id) as city_key, {TIME_KEY} as time_key,
        md5({METHOD}) as payment_method_key, coalesce(payment_amount, 0.0::double) as captured_amount,
        coalesce(refund_amount, 0.0::double) as refunded_amount, 0.0::double as chargeback_amount,
        0.0::double as fee_amount, event_time as created_at
        """,
    ),
    "fact_review": (
        "review_fact_key", "review_id is not null",
        f"""
        md5(coalesce(review_id, event_id)) as review_fact_key, review_id, trip_id,
        md5(rider_id) as rider_key, md5(driver_id) as driver_key, md5(city_id) as city_key,
        {TIME_KEY} as time_key, coalesce(rating_value, 0.0::double) as rating_value,
        0.0::double as sentiment_score, event_time as created_at
        """,
    ),
    "fact_fraud": (
        "fraud_fact_key", "fraud_case_id is not null",
        f"""
        md5(coalesce(fraud_case_id, event_id)) as fraud_fact_key, fraud_case_id, trip_id,
        md5(rider_id) as rider_key, md5(driver_id) as driver_key, md5(city_id) as city_key,
        {TIME_KEY} as time_key, coalesce(fraud_score, 0.0::double) as fraud_score,
        case when coalesce(fraud_score, 0) >= 0.8::double then 'high'
          when coalesce(fraud_score, 0) >= 0.5::double then 'medium' else 'low' end as risk_band,
        coalesce(fraud_score, 0) >= 0.8::double as blocked_flag, event_time as created_at
        """,
    ),
    "fact_operational_event": (
        "operational_event_fact_key", "event_id is not null",
        f"""
        md5(event_id) as operational_event_fact_key, event_id, trip_id, md5(rider_id) as rider_key,
        md5(driver_id) as driver_key, md5(city_id) as city_key, {TIME_KEY} as time_key, event_type,
        1 as event_count, 0 as latency_ms, source_system, event_time as created_at
        """,
    ),
}
for _name, (_key, _where, _columns) in FACT_SELECTS.items():
    _relation(_name, "stg", f"select {_columns} from stg where {_where}")

_relation(
    "dim_city", "stg",
    """select distinct md5(city_id) as city_key, city_id, city_id as city_name, 'NA' as country_code,
       'UTC' as timezone, 'default' as region_cluster, 'standard' as regulatory_tier
       from stg where city_id is not null""",
)
_relation(
    "dim_rider", "stg",
    f"""select distinct md5(rider_id) as rider_key, rider_id,
       min(event_date) over (partition by rider_id) as signup_date, 'standard' as rider_segment,
       md5(city_id) as city_key, 'active' as lifecycle_status, {NOW} as effective_from,
       cast(null as timestamp) as effective_to, true as is_current
       from stg where rider_id is not null""",
)
_relation(
    "dim_driver", "stg",
    f"""select distinct md5(driver_id) as driver_key, driver_id,
       min(event_date) over (partition by driver_id) as onboarding_date, 'standard' as driver_tier,
       md5(city_id) as city_key, 'active' as lifecycle_status, 'unrated' as rating_band,
       {NOW} as effective_from, cast(null as timestamp) as effective_to, true as is_current
       from stg where driver_id is not null""",
)
_relation(
    "dim_vehicle", "stg",
    """select distinct md5(vehicle_id) as vehicle_key, vehicle_id, 'sedan' as vehicle_type,
       'unknown' as make, 'unknown' as model, 2024 as model_year, 4 as capacity
       from stg where vehicle_id is not null""",
)
_relation(
    "dim_time", "stg",
    f"""select distinct {TIME_KEY} as time_key, cast(event_time as date) as full_date,
       cast(extract(hour from event_time) as integer) as hour_of_day,
       cast(extract(dow from event_time) as integer) as day_of_week,
       cast(extract(week from event_time) as integer) as week_of_year,
       cast(extract(month from event_time) as integer) as month_of_year,
       cast(extract(quarter from event_time) as integer) as quarter_of_year,
       cast(extract(year from event_time) as integer) as year_number, false as is_holiday
       from stg where event_time is not null""",
)
_relation(
    "dim_promotion", "stg",
    f"""select distinct md5({PROMO}) as promotion_key, 'promo_' || {PROMO} as promotion_id,
       'dynamic' as campaign_type, 'amount' as discount_type,
       coalesce(promotion_amount, 0.0::double) as cap_amount,
       min(event_time) over () as valid_from, cast(null as timestamp) as valid_to from stg""",
)
_relation(
    "dim_payment_method", "stg",
    f"""select distinct md5({METHOD}) as payment_method_key, {METHOD} as method_code,
       'mixed' as method_type, 'platform' as provider, 'standard' as risk_profile from stg""",
)
_relation(
    "fraud_cases", "stg",
    f"""select event_id as fraud_case_id, trip_id, driver_id, rider_id, city_id, event_type, event_time,
       nullif(fraud_score, 0) as fraud_score, nullif(fare_total, 0) as final_fare,
       coalesce(nullif(surge_multiplier, 0), 1.0) as surge_multiplier, source_system,
       case when fraud_score is null then 'unknown' when fraud_score >= 0.8::double then 'high'
         when fraud_score >= 0.5::double then 'medium' else 'low' end as risk_band, {NOW} as synced_at
       from stg where event_type in ('fraud_signal', 'ghost_trip_detected', 'fraud_detected')""",
)
_relation(
    "support_tickets", "stg",
    f"""select event_id as support_ticket_id, trip_id, rider_id, driver_id, city_id,
       event_type as issue_type,
       'Auto-synced from Silver: ' || event_type || ' for trip ' || coalesce(trip_id, 'None') as description,
       'open' as status, event_time, source_system, {NOW} as synced_at
       from stg where event_type in ('support_ticket_created', 'complaint_raised', 'refund_requested')""",
)
_relation(
    "rider_sessions", "stg",
    f"""select 'session_' || rider_id || '_' || city_id as session_id, rider_id, city_id,
       count(*) filter (where event_type = 'ride_requested') as total_requests,
       count(*) filter (where event_type = 'trip_completed') as total_completions,
       count(*) filter (where event_type = 'trip_cancelled') as total_cancellations,
       round(count(*) filter (where event_type = 'trip_completed')::double
         / greatest(count(*) filter (where event_type = 'ride_requested'), 1), 3) as completion_rate,
       min(event_time) as first_seen, max(event_time) as event_time, {NOW} as synced_at
       from stg where rider_id is not null
         and event_type in ('ride_requested', 'trip_completed', 'trip_cancelled')
       group by rider_id, city_id""",
)
_relation(
    "churn", "fact_trip",
    """select rider_key, activity_date, trip_events,
         case when last_day <= activity_date + interval 7 day then 0 else 1 end as churned_7d
       from (select rider_key, cast(created_at as date) as activity_date, count(*) as trip_events,
               max(cast(created_at as date)) over (partition by rider_key) as last_day
             from fact_trip group by rider_key, cast(created_at as date))""",
)
_relation(
    "quality_by_city", "mart",
    f"""select 'dq-' || city_id as run_id, rule_id, 'gold.mart_city_daily_kpis' as target_entity,
         case when violation_count = 0 then 'passed' else 'failed' end as status, violation_count,
         {NOW} as observed_at
       from (
         select city_id, 'kpi_table_not_empty' as rule_id, 0::bigint as violation_count from mart group by 1
         union all
         select city_id, 'kpi_table_freshness',
           case when max(event_date) >= date '2024-01-29' then 0 else 1 end from mart group by 1
         union all
         select city_id, 'kpi_negative_fares', count(*) filter (where gross_fare_total < 0)
         from mart group by 1)""",
)
_relation(
    "runs", "",
    """select 'run-' || cast(o_orderkey as varchar) as run_id, o_orderpriority as pipeline_name,
         'stage-' || cast(o_custkey % 5 as varchar) as stage_name,
         case o_orderstatus when 'P' then 'running' when 'F' then 'failed' else 'success' end as status,
         o_orderdate as started_at,
         case when o_orderstatus <> 'P'
           then o_orderdate + to_seconds(o_orderkey % 3600 + 1) end as ended_at,
         'gold' as target_schema,
         cast(case when o_orderstatus = 'P' then o_orderkey % 7 else o_orderkey % 5 end as varchar) as target_tables,
         case when o_orderstatus <> 'P' then cast(o_orderkey % 3600 + 1 as varchar) end as duration_seconds
       from orders""",
)

ORACLES: dict[str, str] = {}


def _oracle(name: str, needs: str, final: str) -> None:
    ORACLES[name] = _with(needs, final)


# Bronze, silver, gold --------------------------------------------------------

_oracle(
    "bronze_messages", "deliveries",
    """select topic, 0 as "partition", "offset", event_time as kafka_timestamp, event_id as key,
       bronze_entity from deliveries""",
)
STAGING_COLUMNS = """event_id, event_type, event_time, city_id, trip_id, rider_id, driver_id, vehicle_id,
  payment_id, refund_id, review_id, support_ticket_id, fraud_case_id, fare_total, surge_multiplier,
  promotion_amount, platform_fee, driver_payout, payment_amount, refund_amount, rating_value,
  fraud_score, latitude, longitude, avg_surge_multiplier, requested_trips, completed_trips,
  active_drivers, source_system, schema_version, event_date"""
_oracle(
    "silver_canonical", "deliveries",
    f"select topic as source_topic, bronze_entity, {STAGING_COLUMNS} from deliveries",
)
_oracle(
    "silver_quarantine", "canonical",
    """select event_id, event_type, event_time, city_id, trip_id, rider_id from canonical
       where event_id is null or event_time is null or city_id is null""",
)
_oracle(
    "loader_first_arrivals", "deliveries",
    """select event_id, topic, min("offset") as "offset" from deliveries group by event_id, topic""",
)
_oracle(
    "loader_trip_payloads", "deliveries",
    """select topic, count(*) as payloads from deliveries
       where event_type = 'trip_completed' and trip_id <> '' group by topic""",
)
_oracle("staging_events", "stg", f"select {STAGING_COLUMNS} from stg")
_oracle(
    "duplicate_event_rows", "canonical",
    """select cast(coalesce(sum(c), 0) as bigint) as duplicate_rows
       from (select count(*) as c from canonical group by event_id having count(*) > 1)""",
)
_oracle(
    "duplicate_line_rows", "",
    """select cast(coalesce(sum(c), 0) as bigint) as duplicate_rows
       from (select count(*) as c from lineitem group by l_orderkey, l_linenumber having count(*) > 1)""",
)
_oracle("gold_city_hourly", "stg", f"{HOURLY} from stg group by 1, 2, 3")
_oracle("mart_city_daily_kpis", "mart", "select * from mart")
_oracle(
    "mart_completed_trips_only", "stg",
    f"""select event_date, city_id,
       count(*) filter (where event_type = 'trip_completed') as completed_trips,
       count(*) filter (where event_type = 'trip_cancelled') as cancelled_trips,
       {money("case when event_type = 'trip_completed' then fare_total end")} as gross_fare_total,
       {money("case when event_type = 'trip_completed' then platform_fee end")} as platform_fee_total,
       {money("case when event_type = 'trip_completed' then driver_payout end")} as driver_payout_total,
       round(sum(cast(coalesce(surge_multiplier, 1.0) as decimal(28,6)))::double / count(*), 6) as avg_surge_multiplier
       from stg group by 1, 2""",
)

# Dimensions and facts --------------------------------------------------------

for _name in (
    "dim_city", "dim_rider", "dim_driver", "dim_vehicle", "dim_time", "dim_promotion",
    "dim_payment_method",
):
    _oracle(_name, _name, f"select * from {_name}")
_oracle(
    "dim_driver_history", "stg",
    """select md5(driver_id) as driver_key, driver_id, city_id, event_time as effective_from,
         lead(event_time) over (partition by driver_id order by event_time, event_id) as effective_to,
         lead(event_time) over (partition by driver_id order by event_time, event_id) is null as is_current
       from (select driver_id, city_id, event_time, event_id,
               lag(city_id) over (partition by driver_id order by event_time, event_id) as before
             from stg where driver_id is not null)
       where before is null or before <> city_id""",
)
for _name, (_key, _where, _columns) in FACT_SELECTS.items():
    _oracle(_name, _name, f"select * from {_name}")
    _second = f"""select * from {_name} where created_at >= {CUT}
            union all
            select * from {_name} where created_at < {CUT} and {_key} not in
              (select {_key} from {_name} where created_at >= {CUT})"""
    _oracle(f"{_name}_second_load", _name, _second)
    if _name in ("fact_trip", "fact_payment"):
        _oracle(f"{_name}_stored_loads", _name, _second)
_oracle(
    "fact_trip_latest_per_key", "fact_trip",
    """select * from fact_trip
       qualify row_number() over (partition by trip_fact_key
         order by created_at desc, rider_key desc nulls last) = 1""",
)
_oracle(
    "fact_trip_insert_if_absent", "fact_trip",
    f"""select * from fact_trip where created_at < {CUT}
        union all
        select * from fact_trip where trip_fact_key not in
          (select trip_fact_key from fact_trip where created_at < {CUT})""",
)
_oracle(
    "fact_trip_replace_prefix", "fact_trip",
    """select * replace (case when trip_id like 't1%' then 0.0::double else promotion_amount end as promotion_amount)
       from fact_trip""",
)

# City KPI queries ------------------------------------------------------------

_oracle(
    "serve_city_daily", "mart",
    "select * from mart order by event_date desc, city_id asc limit 30",
)
_oracle(
    "serve_kpi_table", "mart",
    f"""select city_id, event_date, completed_trips, cancelled_trips,
        {two('gross_fare_total')} as gross_fare_total, {two('platform_fee_total')} as platform_fee_total,
        {two('driver_payout_total')} as driver_payout_total,
        {two('avg_surge_multiplier')} as avg_surge_multiplier from mart""",
)
_oracle(
    "serve_completed_trips_series", "mart",
    "select event_date as time, city_id as metric, completed_trips as value from mart",
)
_oracle(
    "serve_gross_fare_series", "mart",
    f"select event_date as time, city_id as metric, {two('gross_fare_total')} as value from mart",
)
_LATEST = "from mart where event_date = (select max(event_date) from mart)"
_oracle(
    "serve_latest_surge", "mart",
    f"select city_id as metric, {two('avg_surge_multiplier')} as avg_surge {_LATEST}",
)
_oracle(
    "serve_latest_driver_payout", "mart",
    f"select city_id as metric, {two('driver_payout_total')} as driver_payout {_LATEST}",
)
_oracle(
    "serve_latest_platform_revenue", "mart",
    f"select city_id as metric, {two('platform_fee_total')} as platform_revenue {_LATEST}",
)
_oracle(
    "serve_latest_trips", "mart",
    f"select city_id as metric, cast(completed_trips as double) as trips {_LATEST}",
)

# Fraud queries ---------------------------------------------------------------

_oracle("serve_fraud_total", "fact_fraud", "select count(*) as total_fraud_cases from fact_fraud")
_oracle(
    "serve_fraud_high_risk", "fact_fraud",
    "select count(*) as high_risk_cases from fact_fraud where risk_band = 'high'",
)
_oracle(
    "serve_fraud_blocked", "fact_fraud",
    "select count(*) as blocked_cases from fact_fraud where blocked_flag",
)
_THREE = "cast(round(cast(round(avg(fraud_score), 6) as decimal(28,6)), 3) as double)"
_oracle(
    "serve_fraud_average_score", "fact_fraud",
    f"select {_THREE} as avg_fraud_score from fact_fraud",
)
_oracle(
    "serve_fraud_by_band_and_city", "fact_fraud dim_city",
    f"""select risk_band, dc.city_id as city_id, count(*) as cases, {_THREE} as avg_score,
        sum(case when blocked_flag then 1 else 0 end)::bigint as blocked
        from fact_fraud ff left join dim_city dc on ff.city_key = md5(dc.city_id) group by 1, 2""",
)
_oracle(
    "serve_fraud_by_day", "fact_fraud",
    """select cast(date_trunc('day', created_at) as timestamp) as time, risk_band as metric, count(*) as value
       from fact_fraud group by 1, 2""",
)

# Operational stores ----------------------------------------------------------

_oracle("store_fraud_cases", "fraud_cases", "select * from fraud_cases")
_oracle("store_support_tickets", "support_tickets", "select * from support_tickets")
_oracle("store_rider_sessions", "rider_sessions", "select * from rider_sessions")
_oracle(
    "store_totals", "fraud_cases support_tickets rider_sessions",
    """select 'fraud_cases' as collection, count(*) as documents from fraud_cases
       union all select 'support_tickets', count(*) from support_tickets
       union all select 'rider_app_sessions', count(*) from rider_sessions""",
)
_oracle(
    "serve_fraud_cases", "fraud_cases",
    """select * from fraud_cases where city_id = 'NYC'
       order by event_time desc, fraud_case_id limit 50""",
)
_oracle(
    "serve_support_tickets", "support_tickets",
    """select * from support_tickets where city_id = 'CHICAGO' and status = 'open'
       order by event_time desc, support_ticket_id limit 200""",
)
_oracle(
    "serve_rider_sessions", "rider_sessions",
    """select * from rider_sessions where rider_id = 'r8'
       order by event_time desc, session_id limit 20""",
)
_relation(
    "requests", "",
    """select 'req-' || conv_id || '-' || turn as support_ticket_id,
         case when turn % 5 <> 4 then 'r' || cast(conv_id as varchar) end as rider_id,
         case when role = 'user' then 'NYC' else 'CHICAGO' end as city_id, role as issue_type,
         text as description, case when turn % 3 = 0 then 'closed' end as status
       from conversations""",
)
_oracle(
    "ticket_intake_accepted", "requests",
    f"""select * replace (coalesce(status, 'open') as status), {NOW} as event_time, {NOW} as created_at
        from requests where support_ticket_id is not null and rider_id is not null
          and city_id is not null and issue_type is not null and description is not null""",
)
_oracle(
    "ticket_intake_rejected", "requests",
    """select support_ticket_id, concat_ws(',', case when city_id is null then 'city_id' end,
         case when description is null then 'description' end,
         case when issue_type is null then 'issue_type' end,
         case when rider_id is null then 'rider_id' end,
         case when support_ticket_id is null then 'support_ticket_id' end) as missing_fields
       from requests where support_ticket_id is null or rider_id is null or city_id is null
         or issue_type is null or description is null""",
)
_oracle(
    "ticket_upsert", "support_tickets",
    f"""select support_ticket_id, city_id, event_time,
          case when city_id = 'NYC' then 'closed' else 'open' end as status, synced_at,
          case when event_time < {CUT} then trip_id end as trip_id,
          case when event_time < {CUT} then rider_id end as rider_id,
          case when event_time < {CUT} then driver_id end as driver_id,
          case when event_time < {CUT} then issue_type end as issue_type,
          case when event_time < {CUT} then description end as description,
          case when event_time < {CUT} then source_system end as source_system
        from support_tickets""",
)

# Contracts -------------------------------------------------------------------

_oracle(
    "contract_violations_events", "canonical",
    """select 'required_column' as check_name, name as column_name, cast(null as varchar) as detail,
         cast(null as bigint) as rows
       from (values ('pickup_ts'), ('dropoff_ts'), ('distance_km'), ('duration_sec'), ('source_record_id')) as m(name)
       union all
       select 'not_null', 'city_id', null, count(*) from canonical where city_id is null having count(*) > 0
       union all
       select 'not_null', 'source_system', null, count(*) from canonical where source_system is null having count(*) > 0
       union all
       select 'not_null', 'schema_version', null, count(*) from canonical where schema_version is null having count(*) > 0
       union all
       select 'allowed_values', 'event_type', event_type, count(*) from canonical
       where event_type <> 'trip_completed' group by event_type
       union all
       select 'allowed_values', 'city_id', city_id, count(*) from canonical
       where city_id not in ('NYC', 'CHICAGO', 'SF') group by city_id
       union all
       select 'primary_key', 'event_id', null, cast(sum(c) as bigint)
       from (select count(*) as c from canonical group by event_id having count(*) > 1) having sum(c) > 0""",
)
_oracle(
    "contract_violations_open_trips", "",
    """select 'allowed_values' as check_name, 'city_id' as column_name, 'DUBAI' as detail,
         count(*) as rows from orders""",
)

# Data quality ----------------------------------------------------------------

_oracle(
    "quality_kpi_checks", "mart",
    f"""select 'dq' as run_id, rule_id, 'gold.mart_city_daily_kpis' as target_entity,
          case when violation_count = 0 then 'passed' else 'failed' end as status, violation_count,
          {NOW} as observed_at
        from (
          select 'kpi_table_not_empty' as rule_id,
            cast(case when count(*) > 0 then 0 else 1 end as bigint) as violation_count from mart
          union all
          select 'kpi_table_freshness',
            case when max(event_date) >= date '2024-01-29' then 0 else 1 end from mart
          union all
          select 'kpi_negative_fares', count(*) filter (where gross_fare_total < 0) from mart)""",
)
_oracle("quality_kpi_checks_by_city", "quality_by_city", "select * from quality_by_city")
_oracle(
    "quality_verdict", "quality_by_city",
    """select run_id, count(*) as total_checks, count(*) filter (where status = 'failed') as failed_checks,
         count(*) filter (where status <> 'failed') as passed_checks,
         case when count(*) filter (where status = 'failed') = 0 then 'success' else 'failed' end as status
       from quality_by_city group by run_id""",
)
_oracle(
    "quality_pass_rate", "quality_by_city",
    """select run_id, round(avg(case when status = 'passed' then 1.0 else 0.0 end), 6)::double as pass_rate,
         round(avg(case when status = 'passed' then 1.0 else 0.0 end), 6) >= 0.99 as meets_threshold
       from quality_by_city group by run_id""",
)


def _column_tests() -> str:
    tests = {
        "silver_canonical_events": ("stg", "event_id", ["event_id", "event_time", "city_id"]),
        "stg_silver_canonical_events": ("stg", "event_id", ["event_id", "event_time", "city_id"]),
        "dim_city": ("dim_city", "city_key", ["city_key", "city_id"]),
        "dim_rider": ("dim_rider", "rider_key", ["rider_key", "rider_id"]),
        "dim_driver": ("dim_driver", "driver_key", ["driver_key", "driver_id"]),
        "dim_vehicle": ("dim_vehicle", "vehicle_key", ["vehicle_key", "vehicle_id"]),
        "dim_promotion": ("dim_promotion", "promotion_key", ["promotion_key"]),
        "dim_payment_method": ("dim_payment_method", "payment_method_key", ["payment_method_key"]),
        "dim_time": ("dim_time", "time_key", ["time_key"]),
        "fact_trip": ("fact_trip", "trip_fact_key", ["trip_fact_key", "trip_id"]),
        "fact_driver_earnings": (
            "fact_driver_earnings", "earning_fact_key", ["earning_fact_key", "trip_id"],
        ),
        "fact_payment": ("fact_payment", "payment_fact_key", ["payment_fact_key", "payment_id"]),
        "fact_review": ("fact_review", "review_fact_key", ["review_fact_key", "review_id"]),
        "fact_fraud": ("fact_fraud", "fraud_fact_key", ["fraud_fact_key", "fraud_case_id"]),
        "fact_operational_event": (
            "fact_operational_event", "operational_event_fact_key",
            ["operational_event_fact_key", "event_id"],
        ),
        "mart_city_daily_kpis": ("mart", None, ["event_date", "city_id"]),
    }
    parts = []
    for model, (relation, unique, filled) in tests.items():
        for column in filled:
            parts.append(
                f"select '{model}' as model, '{column}' as column_name, 'not_null' as test, "
                f"count(*) filter (where {column} is null) as failures from {relation}"
            )
        if unique:
            parts.append(
                f"select '{model}', '{unique}', 'unique', count(*) from (select {unique} "
                f"from {relation} where {unique} is not null group by 1 having count(*) > 1)"
            )
    return "\nunion all\n".join(parts)


_oracle(
    "quality_column_tests",
    "stg dim_city dim_rider dim_driver dim_vehicle dim_promotion dim_payment_method dim_time "
    "mart " + " ".join(FACT_SELECTS),
    _column_tests(),
)
_oracle(
    "serve_latest_quality", "quality_by_city",
    """select run_id, rule_id, target_entity, status, violation_count, observed_at from quality_by_city
       order by observed_at desc, run_id, rule_id limit 200""",
)
_oracle(
    "serve_recent_quality", "quality_by_city",
    """select strftime(observed_at, '%Y-%m-%d %H:%M') as checked_at, run_id, rule_id as rule,
         target_entity as target, status, violation_count as violations from quality_by_city
       order by observed_at desc, run_id, rule_id limit 20""",
)

# Run audit -------------------------------------------------------------------

_oracle("audit_current_runs", "runs", "select * from runs")
_oracle(
    "audit_run_health", "runs",
    """select pipeline_name, count(*) as runs,
         round(avg(case when status = 'failed' then 1.0::double else 0.0::double end), 6) as failure_rate,
         round(avg(cast(duration_seconds as double)), 6) as avg_duration_s
       from runs group by pipeline_name""",
)
_oracle(
    "audit_result_rollup", "",
    """with results as (
         select case o_orderstatus when 'F' then 'error' when 'O' then 'success' else 'unknown' end as status,
           case when o_orderkey % 10 = 0 then 'unknown' else lower(substring(o_orderpriority, 3, 20)) end as resource
         from orders)
       select 'status' as kind, status as name, count(*) as results from results group by status
       union all select 'resource', resource, count(*) from results group by resource""",
)
_oracle(
    "serve_latest_runs", "runs",
    """select run_id, pipeline_name, stage_name, status, started_at, ended_at from runs
       order by started_at desc, run_id limit 100""",
)
_oracle(
    "serve_recent_runs", "runs",
    """select strftime(started_at, '%Y-%m-%d %H:%M') as started, pipeline_name as pipeline,
         stage_name as stage, status, strftime(ended_at, '%Y-%m-%d %H:%M') as ended,
         round(cast(duration_seconds as double), 2) as duration_s, run_id
       from runs order by started_at desc, run_id limit 20""",
)

# Open data -------------------------------------------------------------------

_relation(
    "nyc_source", "",
    """select l_linenumber as vendor, l_shipdate + interval 8 hour as pickup,
         l_shipdate + interval 8 hour + to_microseconds(cast(l_quantity * 60000000 as bigint)) as dropoff,
         cast(l_partkey as varchar) || '_' || cast(l_suppkey as varchar) as zones,
         l_quantity as miles, l_extendedprice / 1000 as fare, l_returnflag as method
       from lineitem""",
)
_NO_PLACE = (
    "cast(null as double) as pickup_lat, cast(null as double) as pickup_lng, "
    "cast(null as double) as dropoff_lat, cast(null as double) as dropoff_lng"
)
_relation(
    "nyc", "nyc_source",
    f"""select sha256('evt_' || trip_id) as event_id, trip_id,
          sha256('nyc_rider_' || zones || '_' || stamp) as rider_id,
          sha256('nyc_driver_' || cast(vendor as varchar)) as driver_id, 'NYC' as city_id,
          'trip_completed' as event_type, dropoff as event_time, pickup as pickup_ts,
          dropoff as dropoff_ts, {_NO_PLACE}, miles * 1.60934::double as distance_km,
          (epoch_us(dropoff) - epoch_us(pickup)) / 1000000.0::double as duration_sec,
          {NOW} as ingestion_time, fare as fare_total, 1.0::double as surge_multiplier,
          0.0::double as promotion_amount, fare * 0.2::double as platform_fee,
          fare - fare * 0.2::double as driver_payout, method as payment_method_code,
          'nyc_tlc' as source_system, trip_id as source_record_id, 'nyc_v1' as schema_version
        from (select *, strftime(pickup, '%Y-%m-%d %H:%M:%S') as stamp,
                'nyc_' || cast(vendor as varchar) || '_' || strftime(pickup, '%Y-%m-%d %H:%M:%S')
                  || '_' || zones as trip_id
              from nyc_source)""",
)
_relation(
    "chicago", "",
    f"""select sha256('evt_chi_' || record) as event_id, 'chi_' || record as trip_id,
          sha256('chi_rider_' || cast(o_custkey % 77 as varchar) || '_'
            || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')) as rider_id,
          sha256('chi_driver_' || cast(o_custkey as varchar)) as driver_id, 'CHICAGO' as city_id,
          'trip_completed' as event_type, o_orderdate + to_minutes(o_orderkey % 60) as event_time,
          o_orderdate as pickup_ts, o_orderdate + to_minutes(o_orderkey % 60) as dropoff_ts,
          case when o_orderkey % 4 <> 0 then 41.5::double + (o_custkey % 50) / 100.0::double end as pickup_lat,
          case when o_orderkey % 4 <> 0 then -87.9::double + (o_custkey % 40) / 100.0::double end as pickup_lng,
          case when o_orderkey % 4 <> 0 then 41.5::double + (o_orderkey % 50) / 100.0::double end as dropoff_lat,
          case when o_orderkey % 4 <> 0 then -87.9::double + (o_orderkey % 40) / 100.0::double end as dropoff_lng,
          cast(o_orderkey % 25 as double) * 1.60934::double as distance_km,
          cast(o_orderkey % 60 * 60 as double) as duration_sec, {NOW} as ingestion_time,
          fare as fare_total, 1.0::double as surge_multiplier, 0.0::double as promotion_amount,
          fare * 0.2::double as platform_fee, fare - fare * 0.2::double as driver_payout,
          o_orderpriority as payment_method_code, 'chicago_taxi' as source_system,
          record as source_record_id, 'chicago_v1' as schema_version
        from (select *, cast(o_orderkey as varchar) as record,
                o_totalprice / 10000 + case when o_orderkey % 3 <> 0 then 1.5::double else 0.0::double end
                  + 0.0::double + 0.5::double as fare from orders)""",
)
_oracle("open_trips_nyc", "nyc", "select * from nyc")
_oracle("open_trips_chicago", "chicago", "select * from chicago")
_oracle(
    "open_trips_new_city", "",
    f"""select sha256('evt_dubai_' || record) as event_id, 'dubai_' || record as trip_id,
          sha256('rider_dubai_' || record) as rider_id,
          sha256('driver_dubai_' || cast(o_custkey as varchar)) as driver_id, 'DUBAI' as city_id,
          'trip_completed' as event_type, o_orderdate + interval 15 minute as event_time,
          o_orderdate as pickup_ts, o_orderdate + interval 15 minute as dropoff_ts, {_NO_PLACE},
          cast(o_orderkey % 30 as double) as distance_km, 900.0::double as duration_sec,
          {NOW} as ingestion_time, o_totalprice / 10000 as fare_total,
          case when o_orderkey % 2 = 0 then 1.0::double else 1.25::double end as surge_multiplier,
          0.0::double as promotion_amount, o_totalprice / 10000 * 0.2::double as platform_fee,
          o_totalprice / 10000 - o_totalprice / 10000 * 0.2::double as driver_payout,
          o_orderpriority as payment_method_code, 'dubai_open' as source_system,
          record as source_record_id, 'city_template_v1' as schema_version
        from (select *, cast(o_orderkey as varchar) as record from orders)""",
)
_DAY = "pickup_ts >= timestamp '1998-05-05' and pickup_ts < timestamp '1998-05-06'"
_oracle("open_trips_one_day", "nyc", f"select * from nyc where {_DAY}")
_oracle(
    "open_trips_all_cities", "nyc chicago",
    """select city_id, count(*) as trips, round(sum(fare_total), 4) as fares,
         min(event_time) as first_event, max(event_time) as last_event
       from (select * from nyc union all select * from chicago) group by city_id""",
)
_oracle(
    "open_trips_append_keep_last", "nyc",
    f"""select event_id, trip_id,
          case when max(case when {_DAY} then 1 else 0 end) = 1 then {NOW}
            else timestamp '2024-01-01 00:00:00' end as ingestion_time
        from nyc group by event_id, trip_id""",
)

# Declared rules --------------------------------------------------------------

_oracle(
    "rules_alignment", "nyc chicago",
    """, trips as (select * from nyc union all select * from chicago)
       select 'AR001' as rule_id, count(*) filter (where not coalesce(event_time between pickup_ts and dropoff_ts, false)) as violations from trips
       union all select 'AR002', count(*) filter (where distance_km < 0 or duration_sec < 0) from trips
       union all select 'AR003', count(*) filter
         (where abs(fare_total - (platform_fee + driver_payout + promotion_amount)) > 0.01) from trips
       union all select 'AR004', count(*) filter (where not coalesce(city_id in ('NYC', 'CHICAGO'), false)) from trips
       union all select 'AR005', cast(coalesce(sum(c), 0) as bigint)
         from (select count(*) as c from trips group by event_id having count(*) > 1)""",
)
_oracle(
    "rules_source_quality", "nyc_source",
    """select 'required_columns_present' as rule_id, 0::bigint as violations
       union all select 'start_before_end', count(*) filter (where pickup > dropoff) from nyc_source
       union all select 'non_negative_fare', count(*) filter (where fare < 0) from nyc_source
       union all select 'non_negative_distance', count(*) filter (where miles < 0) from nyc_source""",
)
_oracle(
    "kpi_extended_daily", "stg",
    """, counts as (
         select event_date, city_id, count(*) filter (where event_type = 'ride_requested') as total_requests,
           count(*) filter (where event_type = 'trip_completed') as completed_trips
         from stg group by all),
       firsts as (
         select trip_id, min(case when event_type = 'ride_requested' then event_time end) as asked,
           min(case when event_type = 'support_ticket_created' then event_time end) as arrived
         from stg where trip_id is not null group by 1),
       waits as (
         select s.event_date, s.city_id, f.trip_id, any_value(epoch_us(arrived) - epoch_us(asked)) as w
         from firsts f join (select trip_id, event_time, min((event_date, city_id)) as k from stg
             where event_type = 'ride_requested' group by 1, 2) r on r.trip_id = f.trip_id and r.event_time = f.asked
           join stg s on s.trip_id = f.trip_id and s.event_time = f.asked and s.event_type = 'ride_requested'
             and (s.event_date, s.city_id) is not distinct from r.k
         where arrived >= asked group by 1, 2, 3),
       means as (select event_date, city_id, sum(w)::double / 60000000.0::double / count(*) as m from waits group by 1, 2)
       select c.event_date, c.city_id, total_requests, completed_trips,
         round(completed_trips::double / nullif(total_requests, 0)::double, 6) as completion_rate,
         round(m, 6) as avg_wait_minutes
       from counts c left join means m on c.event_date is not distinct from m.event_date
         and c.city_id is not distinct from m.city_id""",
)
_oracle(
    "kpi_catalogue", "stg",
    f""", sums as (
         select city_id, {money('fare_total')} as gross_bookings, {money('platform_fee')} as fees,
           {money('promotion_amount')} as promotions, {money('refund_amount')} as refunds,
           count(*) filter (where event_type = 'trip_completed') as completed_trips,
           count(*) filter (where event_type = 'trip_cancelled') as cancelled,
           count(support_ticket_id) as tickets, round(avg(rating_value), 6) as avg_rating
         from stg group by city_id)
       select city_id, gross_bookings, round(fees - promotions - refunds, 6) as net_revenue,
         round((fees - promotions - refunds) / nullif(gross_bookings, 0), 6) as take_rate,
         round(cancelled::double / nullif(completed_trips + cancelled, 0)::double, 6) as cancellation_rate,
         round(1000.0::double * tickets / nullif(completed_trips, 0)::double, 6) as tickets_per_1000_trips,
         avg_rating from sums""",
)
_oracle(
    "kpi_trailing_demand", "mart",
    """select event_date, city_id, completed_trips,
         round(avg(completed_trips) over before, 6) as trailing_avg_trips,
         round(sum(gross_fare_total) over before / nullif(sum(completed_trips) over before, 0)::double, 6) as trailing_avg_fare
       from mart window before as (partition by city_id order by event_date
         range between interval 7 days preceding and interval 1 days preceding)""",
)


def _orphans(fact: str, dimension: str, key: str, name: str, keep: str = "true") -> str:
    return (
        f"select '{fact}' as fact, '{name}' as dimension, count(distinct {key}) as orphan_keys, "
        f"count(*) as orphan_rows from {fact} where {key} is not null and {key} not in "
        f"(select {key} from {dimension} where {key} is not null and {keep})"
    )


_oracle(
    "rules_relationships",
    "fact_trip fact_payment fact_fraud dim_city dim_rider dim_promotion dim_time dim_payment_method",
    "\nunion all\n".join(
        [
            _orphans("fact_trip", "dim_city", "city_key", "dim_city"),
            _orphans("fact_trip", "dim_rider", "rider_key", "dim_rider"),
            _orphans("fact_trip", "dim_promotion", "promotion_key", "dim_promotion"),
            _orphans("fact_trip", "dim_time", "time_key", "dim_time"),
            _orphans(
                "fact_payment", "dim_payment_method", "payment_method_key", "dim_payment_method"
            ),
            _orphans("fact_payment", "fact_trip", "trip_id", "completed_trip", "completed_flag = 1"),
            _orphans("fact_fraud", "fact_trip", "trip_id", "completed_trip", "completed_flag = 1"),
        ]
    ),
)
_oracle(
    "rules_lifecycle", "stg",
    """, placed as (
         select trip_id, event_time, case event_type when 'ride_requested' then 1 when 'fraud_signal' then 2
           when 'trip_completed' then 3 when 'support_ticket_created' then 4 end as state
         from stg where trip_id is not null),
       spans as (select trip_id, state, min(event_time) as first_at from placed
         where state is not null group by 1, 2),
       broken as (select s.trip_id, s.state from spans s where exists
         (select 1 from placed p where p.trip_id = s.trip_id and p.state < s.state
            and p.event_time > s.first_at))
       select trip_id, count(*) as breaks,
         case min(state) when 2 then 'fraud_signal' when 3 then 'trip_completed'
           else 'support_ticket_created' end as first_break
       from broken group by trip_id""",
)
_oracle(
    "capacity_use", "stg",
    """select city_id, date_trunc('hour', event_time) as event_hour, count(*) as events,
         case when city_id in ('NYC', 'CHICAGO') then 'scaled' else 'pilot' end as tier,
         case when city_id in ('NYC', 'CHICAGO') then 100000 else 10000 end::bigint as hour_limit,
         count(*) <= case when city_id in ('NYC', 'CHICAGO') then 100000 else 10000 end as within_limit
       from stg group by 1, 2""",
)
_oracle(
    "volume_anomalies", "stg",
    """, city_hours as (
         select city_id, date_trunc('hour', event_time) as event_hour, count(*) as events,
           round(avg(case when rider_id is null then 1.0::double else 0.0::double end), 6) as null_rider_share,
           count(*) filter (where fraud_score >= 0.8::double) as high_risk_cases
         from stg group by 1, 2),
       compared as (
         select *, round(avg(events) over (partition by city_id order by event_hour
           range between interval 24 hours preceding and interval 1 seconds preceding), 6) as trailing_mean
         from city_hours)
       select *, coalesce(events < trailing_mean * 0.5::double or events > trailing_mean * 2.0::double, false) as is_anomaly
       from compared""",
)
_oracle(
    "surge_out_of_bounds", "stg",
    """select city_id, count(surge_multiplier) as checked,
         count(*) filter (where not surge_multiplier between 1.0::double and 1.75::double) as violations
       from stg group by city_id""",
)

# Features --------------------------------------------------------------------

_oracle("feature_demand_city_daily", "mart", "select * from mart")
_oracle(
    "feature_fraud_trip", "fact_fraud fact_trip",
    """select f.fraud_fact_key, f.trip_id, f.city_key, f.fraud_score,
         case when f.risk_band = 'high' then 1 else 0 end as is_high_risk,
         coalesce(t.final_fare, 0) as final_fare, coalesce(t.surge_multiplier, 1) as surge_multiplier,
         coalesce(t.cancelled_flag, 0) as cancelled_flag, coalesce(t.completed_flag, 0) as completed_flag
       from fact_fraud f left join fact_trip t on t.trip_id = f.trip_id""",
)
_oracle("feature_rider_churn_daily", "churn", "select * from churn")
_oracle(
    "feature_rider_history", "stg",
    """select event_id, md5(rider_id) as rider_key, event_time,
         cast(coalesce(sum(1) over before, 0) as bigint) as prior_events,
         cast(coalesce(sum(case when event_type = 'trip_completed' then 1 else 0 end) over before, 0) as bigint) as prior_completed,
         cast(coalesce(sum(case when event_type = 'trip_cancelled' then 1 else 0 end) over before, 0) as bigint) as prior_cancelled
       from stg where rider_id is not null
       window before as (partition by rider_id order by event_time
         range between unbounded preceding and interval 1 microseconds preceding)""",
)
_LAST_ACTIVE = "from churn where activity_date = (select max(activity_date) from churn)"
_oracle(
    "serve_churned_riders", "churn",
    f"select cast(sum(churned_7d) as bigint) as churned_riders {_LAST_ACTIVE}",
)
_oracle(
    "serve_active_riders", "churn",
    f"select count(distinct rider_key) as active_riders {_LAST_ACTIVE} and trip_events > 0",
)
_oracle(
    "serve_churn_rate", "churn",
    f"""select round(100.0::double * sum(churned_7d)::double / nullif(count(*), 0)::double, 1) as churn_rate_pct
        {_LAST_ACTIVE}""",
)
_oracle(
    "serve_active_and_churned", "churn",
    """select activity_date as time, 'active_riders' as metric, count(distinct rider_key)::double as value
       from churn where trip_events > 0 group by activity_date
       union all
       select activity_date, 'churned_riders', sum(churned_7d)::double from churn group by activity_date""",
)
_oracle(
    "model_split", "churn",
    """select cast('0x' || substr(md5(coalesce(rider_key, '') || '|' || cast(activity_date as varchar)), 1, 8) as bigint) % 5 = 0 as is_test,
         count(*) as rows, cast(sum(churned_7d) as bigint) as churned
       from churn group by 1""",
)


def _model_oracle(name: str, needs: str, rows: str, target: str, key: tuple[str, ...], classifier: bool) -> None:
    text = " || '|' || ".join(f"coalesce(cast({c} as varchar), '')" for c in key)
    enough = "count(*) > 0" + (f" and count(distinct {target}) > 1" if classifier else "")
    test = f"cast('0x' || substr(md5({text}), 1, 8) as bigint) % 5 = 0"
    _oracle(
        f"train_{name}", needs,
        f"""select '{name}' as model_name, 'success' as status,
             count(*) filter (where not {test}) as train_rows, count(*) filter (where {test}) as test_rows,
             count(*) filter (where {target} > 0) as positive_rows, case when {enough} then true end as metric_in_band
           from ({rows}) where {target} is not null""",
    )
    _oracle(f"score_{name}", needs, f"select {', '.join(key)}, true as in_range from ({rows})")


_FRAUD_ROWS = """select f.fraud_fact_key, case when f.risk_band = 'high' then 1 else 0 end as is_high_risk
    from fact_fraud f left join fact_trip t on t.trip_id = f.trip_id"""
_DAY_AND_CITY = ("event_date", "city_id")
_model_oracle("demand_model", "mart", "select * from mart", "completed_trips", _DAY_AND_CITY, False)
_model_oracle("surge_model", "mart", "select * from mart", "avg_surge_multiplier", _DAY_AND_CITY, False)
_model_oracle("fraud_model", "fact_fraud fact_trip", _FRAUD_ROWS, "is_high_risk", ("fraud_fact_key",), True)
_model_oracle("churn_model", "churn", "select * from churn", "churned_7d", ("rider_key", "activity_date"), True)

# Documents and retrieval -----------------------------------------------------

# White space as Unicode has it, spelled out because \s covers ASCII only here.
_SPACE = (
    r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
# Version 5 UUID from the SHA-1 of namespace and name; the variant digit keeps two bits.
_UUID = """substr(d, 1, 8) || '-' || substr(d, 9, 4) || '-5' || substr(d, 14, 3) || '-'
    || substr('89ab', cast('0x' || substr(d, 17, 1) as integer) % 4 + 1, 1) || substr(d, 18, 3)
    || '-' || substr(d, 21, 12)"""
_relation(
    "corpus", "",
    f"""select {_UUID} as id, source_id, target_table, source_type, city_id, doc_id, text
        from (select 'documents' as source_id, 'documents' as target_table,
                coalesce(source, 'unknown') as source_type, coalesce(lang, 'unknown') as city_id,
                cast(doc_id as varchar) as doc_id, text,
                sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode('documents::' || cast(doc_id as varchar))) as d
              from documents where text is not null and text <> '')""",
)


def _cells(relation: str, key: str, text: str) -> str:
    """Summed signs per document and cell, by the low byte of the token's hash."""
    return f"""select {key}, cast('0x' || right(h, 2) as integer) as idx,
        cast(sum(case when cast('0x' || right(h, 1) as integer) & 2 <> 0 then -1 else 1 end) as bigint) as weight
      from (select {key}, sha256(token) as h from
             (select {key}, unnest(regexp_split_to_array(lower({text}), '{_SPACE}')) as token from {relation})
            where token <> '')
      group by 1, 2 having sum(case when cast('0x' || right(h, 1) as integer) & 2 <> 0 then -1 else 1 end) <> 0"""


_relation("document_cells", "", _cells("documents", "doc_id", "text"))
_relation("corpus_cells", "corpus", _cells("corpus", "id", "text"))
_relation("question_cells", "", _cells("benchmark", "item_id", "text"))
_relation(
    "pairs", "corpus corpus_cells question_cells",
    """select q.item_id as question_id, c.id,
         round(1 - coalesce(d.dot / (sqrt(q.n) * sqrt(c.n)), 0), 6) + 0.0 as distance
       from (select b.item_id, coalesce(sum(weight * weight), 0)::double as n
             from benchmark b left join question_cells using (item_id) group by 1) q
       cross join (select corpus.id, coalesce(sum(weight * weight), 0)::double as n
             from corpus left join corpus_cells using (id) group by 1) c
       left join (select item_id, id, sum(a.weight * b.weight)::double as dot
             from question_cells a join corpus_cells b using (idx) group by 1, 2) d
         on d.item_id = q.item_id and d.id = c.id""",
)
_relation(
    "hits", "pairs",
    """select question_id, id, distance,
         row_number() over (partition by question_id order by distance, id) as rank
       from pairs qualify rank <= 5""",
)
_oracle("corpus_documents", "corpus", "select * exclude (text) from corpus")
_oracle(
    "embedding_cells", "document_cells",
    """select doc_id, idx, weight,
         weight / sqrt(sum(weight * weight) over (partition by doc_id)::double) as value
       from document_cells""",
)
_oracle(
    "embedding_vectors", "document_cells",
    """select d.doc_id, case when e.vec_id is not null then 'model' else 'hash' end as provider,
         case when e.vec_id is not null then len(e.embedding) else 256 end::integer as dim,
         case when e.vec_id is not null
           then round(sqrt(list_sum(list_transform(e.embedding, lambda x: x::double * x::double))), 5)
           when c.doc_id is not null then 1.0::double else 0.0::double end as norm
       from documents d left join embeddings e on e.vec_id = d.doc_id
       left join (select distinct doc_id from document_cells) c on c.doc_id = d.doc_id""",
)
_oracle(
    "index_documents", "corpus",
    """select id, doc_id, case when doc_id in (select cast(doc_id as varchar) from labels)
         then 'held' else source_id end as source_id, city_id from corpus""",
)
_oracle("index_object_count", "corpus", "select count(*) as objects from corpus")
_oracle(
    "nearest_documents", "hits",
    """select question_id, cast(rank as integer) as rank, id, doc_id, distance from hits
       join (select id, doc_id from corpus) using (id)""",
)
_oracle(
    "nearest_documents_in_scope", "pairs",
    """select question_id, cast(row_number() over (partition by question_id order by distance, id) as integer) as rank,
         id, city_id, distance
       from pairs join (select id, city_id from corpus where city_id = 'en') using (id)
       qualify rank <= 3""",
)
_oracle(
    "nearest_to_label_centre", "",
    """with cells as (
         select vec_id, label, unnest(embedding)::double as v, unnest(range(len(embedding))) as pos
         from embeddings),
       centre as (select label, pos, round(avg(v), 6) as v from cells group by 1, 2),
       dots as (select c.label, d.vec_id, sum(c.v * d.v) as dot, sum(c.v * c.v) as cc, sum(d.v * d.v) as dd
         from centre c join cells d using (pos) group by 1, 2)
       select label, vec_id, round(1 - dot / (sqrt(cc) * sqrt(dd)), 6) + 0.0 as distance,
         cast(row_number() over (partition by label
           order by round(1 - dot / (sqrt(cc) * sqrt(dd)), 6), vec_id) as integer) as rank
       from dots qualify rank <= 10""",
)
_relation(
    "full_hits", "hits corpus",
    """select hits.*, doc_id, source_id, source_type, city_id, text from hits join corpus using (id)""",
)
_oracle(
    "answer_prompts", "full_hits",
    """select item_id as question_id, md5('Answer the question from the numbered context only. '
         || 'If the context does not suffice, say so.' || chr(10) || chr(10) || 'Question:' || chr(10) || b.text
         || chr(10) || chr(10) || 'Context:' || chr(10) || coalesce(context, 'No context found.')
         || chr(10) || chr(10) || 'Reply with short bullet points and cite the context by number, such as [1].') as prompt_md5
       from benchmark b left join (
         select question_id, string_agg('[' || rank || '] source=' || source_id || ' type=' || source_type
           || ' city=' || city_id || chr(10) || 'text=' || text, chr(10) || chr(10) order by rank) as context
         from full_hits group by question_id) h on h.question_id = b.item_id""",
)
_oracle(
    "answer_records", "full_hits",
    """select b.item_id as question_id,
         coalesce('Extractive fallback answer (LLM unavailable):' || chr(10) || '- Most relevant source: '
           || h.source_id || ' [' || h.source_type || ']' || chr(10) || '- Evidence: ' || h.text,
           'Insufficient context to answer this question.') as answer,
         true as used_fallback, coalesce(n.hits, 0) as retrieved_count
       from benchmark b left join full_hits h on h.question_id = b.item_id and h.rank = 1
       left join (select question_id, count(*) as hits from full_hits group by 1) n
         on n.question_id = b.item_id""",
)

# Monitoring ------------------------------------------------------------------

_relation(
    "windows", "",
    """select date_trunc('minute', ts) + to_minutes(step) as window_end, '/' || event_type as endpoint,
         case when user_id % 2 = 0 then 'GET' else 'POST' end as method,
         event_type = 'error' as failed, value / 100 as latency
       from events, range(1, 6) as steps(step)""",
)
_oracle(
    "monitor_request_rate", "windows",
    """select method, endpoint, window_end, count(*) as requests,
         round(count(*) / 300.0::double, 6) as requests_per_second
       from windows group by 1, 2, 3""",
)
_relation(
    "error_windows", "windows",
    """select window_end, count(*) as requests, count(*) filter (where failed) as errors,
         round((count(*) filter (where failed) / 300.0::double)
           / greatest(count(*) / 300.0::double, 0.001::double), 6) as error_ratio
       from windows group by 1""",
)
_oracle(
    "monitor_error_ratio", "error_windows",
    "select *, error_ratio > 0.05::double as above from error_windows",
)


def _held(relation: str, condition: str, minutes: int) -> str:
    return f"""select a.window_end + to_minutes(step) as fires_at
        from (select window_end from {relation} where {condition}) a, range(0, {minutes + 1}) as s(step)
        group by 1 having count(*) = {minutes + 1}"""


_oracle("monitor_error_alerts", "error_windows", _held("error_windows", "error_ratio > 0.05::double", 5))
_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]
_BUCKETS = ", ".join(
    f"count(*) filter (where latency <= {b}::double) as le{i}" for i, b in enumerate(_BOUNDS)
)


def _quantile() -> str:
    cases = []
    for i, bound in enumerate(_BOUNDS):
        low = _BOUNDS[i - 1] if i else 0.0
        below = f"le{i - 1}" if i else "0"
        cases.append(
            f"when le{i} >= requests * 0.95::double then {low}::double + ({bound}::double - {low}::double) * "
            f"((requests * 0.95::double - {below}) / nullif(le{i} - {below}, 0)::double)"
        )
    return f"case {' '.join(cases)} else {_BOUNDS[-1]}::double end"


_relation(
    "latency_windows", "windows",
    f"""select window_end, requests, round({_quantile()}, 6) as p95_seconds
        from (select window_end, count(*) as requests, {_BUCKETS} from windows group by 1)""",
)
_oracle(
    "monitor_latency_p95", "latency_windows",
    "select *, p95_seconds > 1.5::double as above from latency_windows",
)
_oracle(
    "monitor_latency_alerts", "latency_windows",
    _held("latency_windows", "p95_seconds > 0.25::double", 10),
)

# Inventory and streams -------------------------------------------------------

_oracle(
    "inventory_of_stored_tables", "fact_payment dim_city",
    "\nunion all\n".join(
        f"select 'lake' as schema, '{name}' as relation, 'BASE TABLE' as type, count(*) as row_count from {source}"
        for name, source in (("staging", "stg"), ("dim_city", "dim_city"), ("fact_payment", "fact_payment"))
    ),
)
_oracle(
    "named_trips_by_city", "fact_trip dim_city mart",
    """select c.city_name, m.event_date, m.completed_trips, count(*) as trips, count(distinct f.trip_id) as trip_ids
       from fact_trip f join dim_city c on c.city_key = f.city_key
         join mart m on m.city_id = c.city_id and m.event_date = cast(f.created_at as date)
       group by all""",
)
_oracle(
    "table_inventory", "",
    "\nunion all\n".join(
        f"select 'lake' as schema, '{t}' as relation, 'BASE TABLE' as type, count(*) as row_count from {t}"
        for t in (
            "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
            "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
        )
    ),
)
_oracle(
    "stream_bronze_messages", "deliveries",
    """select topic, bronze_entity, count(*) as messages, min("offset") as first_offset,
         max("offset") as last_offset from deliveries group by 1, 2""",
)
_oracle(
    "stream_silver_events", "deliveries",
    f"""select distinct topic as source_topic, bronze_entity, {STAGING_COLUMNS} from deliveries
        where city_id is not null""",
)
_oracle(
    "stream_quarantine_events", "deliveries",
    """select event_id, event_time, city_id, topic as source_topic from deliveries where city_id is null""",
)
_DAY_BEFORE = """select * replace ('day-before-' || event_id as event_id, event_time - interval 1 day as event_time,
         cast(event_time - interval 1 day as date) as event_date) from usable"""
_oracle(
    "backfill_events", "deliveries",
    f""", usable as (select distinct topic as source_topic, bronze_entity, {STAGING_COLUMNS} from deliveries
          where city_id is not null)
        select * from usable union all {_DAY_BEFORE}""",
)
_oracle(
    "backfill_gold_hourly", "deliveries",
    f""", usable as (select distinct {STAGING_COLUMNS} from deliveries where city_id is not null),
          filled as (select * from usable union all {_DAY_BEFORE})
        select * from ({HOURLY} from filled group by 1, 2, 3)
        where window_end <= (select date_trunc('millisecond', max(event_time)) - interval 30 minute from usable)""",
)
# Only hours the watermark has passed: half an hour behind the latest usable event.
_oracle(
    "stream_gold_hourly", "deliveries",
    f""", usable as (select distinct {STAGING_COLUMNS} from deliveries where city_id is not null)
        select * from ({HOURLY} from usable group by 1, 2, 3)
        where window_end <= (select date_trunc('millisecond', max(event_time)) - interval 30 minute from usable)""",
)
