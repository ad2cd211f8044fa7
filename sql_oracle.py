"""DuckDB SQL equivalents of the query catalogue (the correctness oracle).

The same table mapping and the same operator rules as the Spark code, written
independently as SQL over the benchmark tables (pre-registered views).
"""

from __future__ import annotations

HUB = "N08"
HUB_TZ = "America/New_York"
LO, HI = "2024-01-01 00:00", "2034-01-01 00:00"
DAY_LO, DAY_HI = "2024-01-01 00:00", "2033-12-31 23:59"
WEEK_LO, WEEK_HI = "2024-01-08 00:00", "2024-01-15 00:00"
ONE_DAY = "2024-01-10"
EDGE_LO, EDGE_HI = "2024-01-08 06:30", "2024-01-15 18:45"
DESCRIPTOR_EVERY = 101

_CARDINALS = "['N','NNE','NE','ENE','E','ESE','SE','SSE','S','SSW','SW','WSW','W','WNW','NW','NNW','VRB']"
_BOUNDS = "[2.57::DOUBLE, 5.14::DOUBLE, 7.72::DOUBLE, 10.29::DOUBLE, 12.86::DOUBLE, 15.43::DOUBLE, 18.01::DOUBLE]"
_ZONES = "['America/Phoenix','America/Chicago','America/Denver','America/New_York','America/Los_Angeles']"
_DRY = "('Clear','Fog','Mostly Clear','Mostly Cloudy','N/A','Overcast','Partly Cloudy','Smoke')"
_CROSS = "('NW','NNW','N','NNE','NE','SE','SSE','S','SSW','SW')"
_COMPASS = ["N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE", "S", "SSW", "SW", "WSW", "W", "WNW", "NW", "NNW"]


def _code(k: str) -> str:
    return f"('N' || lpad(CAST({k} AS VARCHAR), 2, '0'))"


def _int(s: str) -> str:
    return f"TRY_CAST(trunc(TRY_CAST({s} AS DOUBLE)) AS INTEGER)"


def _minutes(s: str) -> str:
    p = f"lpad({s}, 4, '0')"
    hh = f"TRY_CAST(substr({p}, 1, 2) AS INTEGER)"
    mm = f"TRY_CAST(substr({p}, 3, 2) AS INTEGER)"
    return (f"(CASE WHEN regexp_full_match({s}, '[0-9]{{1,4}}') AND {hh} < 24 AND {mm} < 60 "
            f"THEN {hh} * 60 + {mm} ELSE 0 END)")


def _clock(s: str) -> str:
    m = _minutes(s)
    return f"(lpad(CAST({m} // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST({m} % 60 AS VARCHAR), 2, '0'))"


def _round5(t: str) -> str:
    sod = f"(hour({t}) * 3600 + minute({t}) * 60 + second({t}))"
    return (f"(CAST(CAST({t} AS DATE) AS TIMESTAMP) + "
            f"to_seconds(CAST(floor(({sod} + 150.0::DOUBLE) / 300.0::DOUBLE) * 300 AS BIGINT)))")


def _r2(x: str) -> str:
    return f"(floor(({x}) * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE)"


def _bins(s: str) -> str:
    b = [0.0, 2.57, 5.14, 7.72, 10.29, 12.86, 15.43, 18.01]
    labels = ["00-05", "05-10", "10-15", "15-20", "20-25", "25-30", "30-35", ">35"]
    parts = []
    for i, (lo, lab) in enumerate(zip(b, labels)):
        cond = f"{s} >= {lo}::DOUBLE"
        if i + 1 < len(b):
            cond += f" AND {s} < {b[i + 1]}::DOUBLE"
        parts.append(f"WHEN {cond} THEN '{lab}'")
    return "(CASE " + " ".join(parts) + " END)"


def _to_hub(t: str, zone: str) -> str:
    return f"timezone('{HUB_TZ}', timezone({zone}, {t}))"


def _ctes(descriptor_every: int | None = None) -> str:
    blank = f"event_id % {descriptor_every} = 0" if descriptor_every else "FALSE"
    cancelled = "l.l_partkey % 20 = 0"
    return f"""
flight_raw AS (
  SELECT
    CAST(DATE '2024-01-01' + CAST((l.l_orderkey + 7 * l.l_linenumber) % 30 + l.l_orderkey // 15000 * 34 AS INTEGER) AS VARCHAR) AS FlightDate,
    'C' || CAST(l.l_suppkey % 10 AS VARCHAR) AS Reporting_Airline,
    {_code('s.s_nationkey')} AS Origin,
    CASE WHEN {cancelled} THEN NULL WHEN l.l_partkey % 41 = 1 THEN '2400'
         ELSE CAST((l.l_partkey % 24) * 100 + (l.l_suppkey * 7 + l.l_linenumber * 11) % 60 AS VARCHAR) END AS DepTime,
    CASE WHEN {cancelled} THEN NULL ELSE CAST(CAST(floor(l.l_quantity) AS BIGINT) - 20 AS VARCHAR) || '.00' END AS DepDelay,
    CASE WHEN {cancelled} THEN NULL WHEN l.l_quantity >= 35 THEN '1.00' ELSE '0.00' END AS DepDel15,
    {_code('c.c_nationkey')} AS Dest,
    CASE WHEN {cancelled} THEN NULL
         ELSE CAST(((l.l_partkey + 2) % 24) * 100 + (l.l_suppkey * 7 + l.l_linenumber * 13) % 60 AS VARCHAR) END AS ArrTime,
    CASE WHEN {cancelled} THEN NULL ELSE CAST(CAST(floor(l.l_quantity) AS BIGINT) - 25 AS VARCHAR) || '.00' END AS ArrDelay,
    CASE WHEN {cancelled} THEN NULL WHEN l.l_quantity >= 40 THEN '1.00' ELSE '0.00' END AS ArrDel15,
    CAST(l.l_orderkey % 2500 AS VARCHAR) || '.00' AS Distance,
    CASE WHEN {cancelled} THEN (CASE l.l_returnflag WHEN 'A' THEN 'A' WHEN 'N' THEN 'B' WHEN 'R' THEN 'C' END) END
      AS CancellationCode,
    CASE WHEN l.l_quantity >= 35 THEN
      (CASE WHEN l.l_returnflag = 'R' THEN '0.00' ELSE CAST(CAST(floor(l.l_quantity) AS BIGINT) AS VARCHAR) || '.00' END)
    END AS WeatherDelay,
    CAST(l.l_linenumber AS VARCHAR) || '.00' AS LateAircraftDelay,
    CASE WHEN l.l_partkey % 97 = 0 THEN {_code('s.s_nationkey')} END AS Div1Airport
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
weather_raw AS (
  SELECT
    CASE WHEN {blank} THEN NULL ELSE
      strftime(ts + to_days(CAST(event_id % greatest(1, (SELECT count(*) FROM events) // 10000) * 34 AS INTEGER)), '%Y-%m-%dT%H:') || lpad(CAST(CAST(floor(minute(ts) / 5) * 5 AS BIGINT) AS VARCHAR), 2, '0') || ':00Z'
    END AS Date_Time,
    ({_CARDINALS})[event_id % 17 + 1] AS wind_cardinal_direction_set_1d,
    CAST((event_id * 37) % 360 AS VARCHAR) AS wind_direction_set_1,
    CAST(CASE WHEN event_id % 50 = 0 THEN NULL
              WHEN event_id % 11 = 0 THEN ({_BOUNDS})[event_id % 7 + 1]
              ELSE {_r2('value / 10.0::DOUBLE')} END AS VARCHAR) AS wind_speed_set_1,
    CAST(CASE WHEN event_id % 3 = 0 THEN {_r2('value / 10.0::DOUBLE + 2.0::DOUBLE')} END AS VARCHAR)
      AS wind_gust_set_1,
    CASE event_type WHEN 'view' THEN 'Clear' WHEN 'signup' THEN 'Overcast' WHEN 'purchase' THEN 'Light Rain'
                    WHEN 'click' THEN 'Fog' END AS weather_condition_set_1d
  FROM events
),
airport_raw AS (
  SELECT {_code('n_nationkey')} AS iata, CAST(n_nationkey + 25 AS VARCHAR) AS lat,
         CAST(-(n_nationkey * 2 + 70) AS VARCHAR) AS long
  FROM nation
),
timezone_raw AS (
  SELECT {_code('n_nationkey')} AS iata_code, ({_ZONES})[n_regionkey + 1] AS timezone
  FROM nation
),
p1 AS (
  SELECT TRY_CAST(FlightDate AS DATE) AS date, Reporting_Airline AS airline_id, Origin AS dep_iata,
         DepTime AS dep_time, {_int('DepDelay')} AS dep_delay, {_int('DepDel15')} AS dep_del15,
         Dest AS arr_iata, ArrTime AS arr_time, {_int('ArrDelay')} AS arr_delay, {_int('ArrDel15')} AS arr_del15,
         {_int('Distance')} AS distance, CancellationCode AS cncl_code, WeatherDelay AS wthr_code,
         LateAircraftDelay AS late_arr_code, Div1Airport AS diverted
  FROM flight_raw
),
hub_p1 AS (SELECT * FROM p1 WHERE dep_iata = '{HUB}' OR arr_iata = '{HUB}'),
f_times AS (
  SELECT date, airline_id, dep_iata, arr_iata, dep_delay, dep_del15, arr_delay, arr_del15, distance,
         cncl_code, wthr_code, late_arr_code, diverted,
         CASE WHEN dep_iata = '{HUB}' THEN 'departure' WHEN arr_iata = '{HUB}' THEN 'arrival' END AS dep_or_arr,
         CAST(date AS TIMESTAMP) + to_minutes({_minutes('dep_time')}) AS dep_time,
         CAST(date AS TIMESTAMP) + to_minutes({_minutes('arr_time')}) AS arr_time
  FROM hub_p1
),
f_side AS (
  SELECT *,
         CASE WHEN dep_or_arr = 'departure' THEN dep_time WHEN dep_or_arr = 'arrival' THEN arr_time END AS date_time,
         CASE WHEN dep_or_arr = 'departure' THEN dep_delay WHEN dep_or_arr = 'arrival' THEN arr_delay END AS delay_time
  FROM f_times
),
flights AS (SELECT *, {_round5('date_time')} AS time_interval FROM f_side),
w_cols AS (
  SELECT try_strptime(Date_Time, '%Y-%m-%dT%H:%M:%SZ') AS time_interval,
         wind_cardinal_direction_set_1d AS card_dir,
         {_int('wind_direction_set_1')} AS wind_dir,
         TRY_CAST(wind_speed_set_1 AS DOUBLE) AS wind_speed,
         TRY_CAST(wind_gust_set_1 AS DOUBLE) AS gust_speed,
         weather_condition_set_1d AS precip
  FROM weather_raw WHERE Date_Time IS NOT NULL
),
w_gust AS (
  SELECT time_interval AS observed_utc, card_dir, wind_dir, gust_speed, precip AS condition,
         CASE WHEN gust_speed >= wind_speed THEN gust_speed ELSE wind_speed END AS wind_speed
  FROM w_cols
),
w_flags AS (
  SELECT observed_utc, timezone('{HUB_TZ}', timezone('UTC', observed_utc)) AS time_interval,
         card_dir, wind_dir, wind_speed, gust_speed,
         CASE WHEN condition IN {_DRY} THEN 0 ELSE 1 END AS precip,
         {_bins('wind_speed')} AS binned_wind,
         CASE WHEN card_dir IN {_CROSS} THEN 1 ELSE 0 END AS crosswind
  FROM w_gust
),
weather_utc AS (
  SELECT *,
         CASE WHEN precip = 0 AND crosswind = 1 AND wind_speed >= 15.43::DOUBLE THEN 1
              WHEN precip = 1 AND crosswind = 1 AND wind_speed >= 7.72::DOUBLE THEN 2 ELSE 0 END AS crosswind_lim
  FROM w_flags
),
weather AS (SELECT * EXCLUDE (observed_utc) FROM weather_utc),
weather_latest AS (
  SELECT * EXCLUDE (observed_utc, rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY time_interval ORDER BY
      observed_utc DESC NULLS LAST, card_dir DESC NULLS LAST, wind_dir DESC NULLS LAST,
      wind_speed DESC NULLS LAST, gust_speed DESC NULLS LAST, precip DESC NULLS LAST,
      binned_wind DESC NULLS LAST, crosswind DESC NULLS LAST, crosswind_lim DESC NULLS LAST) AS rn
    FROM weather_utc) WHERE rn = 1
),
dim AS (
  SELECT a.iata AS iata_code, a.lat, a.long, z.timezone
  FROM airport_raw a LEFT JOIN timezone_raw z ON a.iata = z.iata_code
),
roles AS (
  SELECT f.*, d.lat AS dep_lat, d.long AS dep_long, d.timezone AS dep_timezone,
         r.lat AS arr_lat, r.long AS arr_long, r.timezone AS arr_timezone
  FROM flights f LEFT JOIN dim d ON f.dep_iata = d.iata_code LEFT JOIN dim r ON f.arr_iata = r.iata_code
),
localised AS (
  SELECT * REPLACE ({_to_hub('dep_time', 'dep_timezone')} AS dep_time, {_to_hub('arr_time', 'arr_timezone')} AS arr_time)
  FROM roles
),
enriched AS (SELECT * FROM localised LEFT JOIN weather USING (time_interval)),
enriched_latest AS (SELECT * FROM localised LEFT JOIN weather_latest USING (time_interval)),
{_mart_cte('mart', 'enriched')},
{_mart_cte('mart_latest', 'enriched_latest')}
"""


def _mart_cte(name: str, src: str) -> str:
    return f"""{name} AS (
  SELECT dep_or_arr, dep_iata, TRY_CAST(dep_long AS FLOAT) AS dep_long, TRY_CAST(dep_lat AS FLOAT) AS dep_lat,
         dep_time, dep_delay, dep_del15, arr_iata, TRY_CAST(arr_long AS FLOAT) AS arr_long,
         TRY_CAST(arr_lat AS FLOAT) AS arr_lat, arr_time, arr_delay, arr_del15, distance,
         {_int('diverted')} AS diverted, cncl_code, late_arr_code, wthr_code, card_dir, wind_dir,
         CAST(wind_speed AS FLOAT) AS wind_speed, binned_wind, crosswind, crosswind_lim,
         diverted AS diverted_iata
  FROM {src}
)"""


def _with(body: str, descriptor_every: int | None = None) -> str:
    return "WITH " + _ctes(descriptor_every) + body


MART_COLS = ("dep_or_arr, dep_iata, dep_long, dep_lat, dep_time, dep_delay, dep_del15, arr_iata, arr_long, "
             "arr_lat, arr_time, arr_delay, arr_del15, distance, diverted, cncl_code, late_arr_code, wthr_code, "
             "card_dir, wind_dir, wind_speed, binned_wind, crosswind, crosswind_lim")


def _role(direction: str) -> str:
    return {"departure": "dep", "arrival": "arr"}[direction]


def _compass_values() -> str:
    return ", ".join(f"('{d}', {i})" for i, d in enumerate(_COMPASS))


def _wind_rose(direction: str, lo: str, hi: str) -> str:
    p = _role(direction)
    return _with(f"""
, agg AS (
  SELECT card_dir, binned_wind, COUNT(*) AS count FROM mart
  WHERE {p}_time >= TIMESTAMP '{lo}' AND {p}_time < TIMESTAMP '{hi}' AND {p}_del15 > 0
    AND {p}_time IS NOT NULL AND card_dir IS NOT NULL AND binned_wind IS NOT NULL
  GROUP BY card_dir, binned_wind
), compass(card_dir, idx) AS (VALUES {_compass_values()})
SELECT a.card_dir, a.binned_wind, a.count, CAST(COALESCE(c.idx, 0) AS INTEGER) AS index_dir
FROM agg a LEFT JOIN compass c ON a.card_dir = c.card_dir
UNION ALL
SELECT c.card_dir, '00-05' AS binned_wind, CAST(0 AS BIGINT) AS count, CAST(c.idx AS INTEGER) AS index_dir
FROM compass c WHERE c.card_dir NOT IN (SELECT card_dir FROM agg)
""")


def _delay_count(direction: str, lo: str, hi: str, *, counterpart: bool = False, exclude_hub: bool = False) -> str:
    p = _role(direction)
    k = ("arr" if p == "dep" else "dep") if counterpart else p
    extra = f" AND dep_or_arr = '{direction}'" if counterpart else ""
    having = f"WHERE {k}_iata <> '{HUB}'" if exclude_hub else ""
    return _with(f"""
SELECT * FROM (
  SELECT {k}_iata, {k}_long, {k}_lat, COUNT({p}_del15) AS {p}_del15 FROM mart
  WHERE {p}_time >= TIMESTAMP '{lo}' AND {p}_time < TIMESTAMP '{hi}' AND {p}_time IS NOT NULL
    AND {p}_del15 > 0{extra}
  GROUP BY {k}_iata, {k}_long, {k}_lat
) {having}
""")


def _crosswind_counts(direction: str, lo: str, hi: str) -> str:
    p = _role(direction)
    rng = f"{p}_time >= TIMESTAMP '{lo}' AND {p}_time < TIMESTAMP '{hi}'"
    wd = "TRY_CAST(wthr_code AS DOUBLE) > 0"
    return f"""
, c AS (
  SELECT
    (SELECT COUNT(*) FROM mart WHERE crosswind_lim = 1 AND {wd} AND {rng}) AS dry_delay,
    (SELECT COUNT(*) FROM mart WHERE crosswind_lim = 1 AND cncl_code = 'B' AND {rng}) AS dry_cncl,
    (SELECT COUNT(*) FROM mart WHERE crosswind_lim = 2 AND {wd} AND {rng}) AS wet_delay,
    (SELECT COUNT(*) FROM mart WHERE crosswind_lim = 2 AND cncl_code = 'B' AND {rng}) AS wet_cncl
), matrix AS (
  SELECT 'weather delay by CW' AS cond, dry_delay AS dry, wet_delay AS precip FROM c
  UNION ALL
  SELECT 'weather cancellation by CW' AS cond, dry_cncl AS dry, wet_cncl AS precip FROM c
)"""


def _crosswind(direction: str, lo: str, hi: str) -> str:
    return _with(_crosswind_counts(direction, lo, hi) + "\nSELECT cond, dry, precip FROM matrix")


def _interruptions(cond: str, name: str) -> str:
    wd = "TRY_CAST(wthr_code AS DOUBLE) > 0"
    return _with(f"""
SELECT CASE WHEN {cond} AND {wd} THEN 1
            WHEN {cond} AND cncl_code = 'B' THEN 2
            WHEN {cond} AND dep_or_arr = 'departure' AND dep_del15 > 0 THEN 3
            WHEN {cond} AND dep_or_arr = 'arrival' AND arr_del15 > 0 THEN 4
            WHEN {cond} AND dep_or_arr = 'arrival' AND diverted_iata IS NOT NULL THEN 5 END AS {name},
       COUNT(*) AS n
FROM mart GROUP BY 1
""")


def oracle() -> dict[str, str]:
    q: dict[str, str] = {}
    q["flight_columns"] = _with("SELECT * FROM p1")
    q["weather_columns"] = _with("SELECT * FROM w_cols", DESCRIPTOR_EVERY)
    q["airport_zone_dim"] = _with("SELECT iata_code, lat, long, timezone FROM dim")
    q["hub_flights"] = _with("SELECT * FROM hub_p1")
    q["direction_label"] = _with("SELECT date, dep_iata, arr_iata, dep_or_arr FROM flights")
    q["parse_hhmm"] = _with(f"SELECT DepTime AS dep_raw, {_clock('DepTime')} AS dep_clock, "
                            f"ArrTime AS arr_raw, {_clock('ArrTime')} AS arr_clock FROM flight_raw")
    q["flight_timestamps"] = _with("SELECT date, dep_iata, arr_iata, dep_time, arr_time FROM flights")
    q["hub_time_delay"] = _with("SELECT dep_iata, arr_iata, dep_or_arr, dep_time, arr_time, date_time, delay_time "
                                "FROM flights")
    q["round_five_minutes"] = _with("SELECT dep_iata, arr_iata, date_time, time_interval FROM flights")
    q["gust_override"] = _with("SELECT time_interval, card_dir, wind_speed AS reported_speed, gust_speed, "
                               "CASE WHEN gust_speed >= wind_speed THEN gust_speed ELSE wind_speed END AS wind_speed "
                               "FROM w_cols")
    q["wind_bins"] = _with("SELECT time_interval, card_dir, wind_speed, binned_wind FROM weather")
    q["precip_flag"] = _with(f"SELECT Date_Time, weather_condition_set_1d AS condition, "
                             f"CASE WHEN weather_condition_set_1d IN {_DRY} THEN 0 ELSE 1 END AS precip "
                             f"FROM weather_raw")
    q["weather_hub_time"] = _with("SELECT observed_utc, time_interval, card_dir FROM weather_utc")
    q["crosswind_flag"] = _with("SELECT time_interval, card_dir, crosswind FROM weather")
    q["crosswind_limit"] = _with("SELECT time_interval, card_dir, precip, crosswind, wind_speed, crosswind_lim "
                                 "FROM weather")
    q["flight_weather_join"] = _with(
        "SELECT time_interval, dep_or_arr, dep_iata, arr_iata, date_time, card_dir, wind_dir, wind_speed, "
        "gust_speed, precip, binned_wind, crosswind, crosswind_lim FROM flights LEFT JOIN weather USING (time_interval)")
    q["airport_roles"] = _with("SELECT dep_or_arr, dep_iata, dep_lat, dep_long, dep_timezone, arr_iata, arr_lat, "
                               "arr_long, arr_timezone FROM roles")
    q["times_in_hub_zone"] = _with("SELECT dep_iata, arr_iata, dep_timezone, arr_timezone, dep_time, arr_time "
                                   "FROM localised")
    q["missing_airport"] = q["airport_roles"].replace("  FROM nation\n),\ntimezone_raw", "  FROM nation WHERE n_nationkey <> 24\n),\ntimezone_raw")
    q["unknown_zone"] = q["times_in_hub_zone"].replace(f"({_ZONES})[n_regionkey + 1] AS timezone",
                                                       f"CASE WHEN n_nationkey <> 24 THEN ({_ZONES})[n_regionkey + 1] END AS timezone")
    q["surrogate_key"] = _with("SELECT COUNT(*) AS total, COUNT(*) AS distinct_ids, TRUE AS non_negative FROM mart")
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in MART_COLS.split(", "))
    q["mart_preview"] = _with(f"SELECT {MART_COLS} FROM mart ORDER BY {order} LIMIT 20")
    q["csv_flights"] = _with("SELECT * FROM flight_raw")
    q["csv_weather"] = _with("SELECT * FROM weather_raw", DESCRIPTOR_EVERY)
    q["csv_airport_zone"] = q["airport_zone_dim"]
    q["csv_mart"] = _with(f"SELECT {MART_COLS} FROM mart")
    q["stored_mart_factored"] = q["stored_mart_late_weather"] = _with(f"SELECT {MART_COLS} FROM mart")
    q["stored_mart_factored_rose"] = _wind_rose("departure", LO, HI)
    q["stored_mart_rollup_rose"] = _wind_rose("departure", EDGE_LO, EDGE_HI)
    q["stored_mart_rollup_delays"] = _delay_count("arrival", EDGE_LO, EDGE_HI)
    q["stored_mart_rollup_crosswind"] = _crosswind("arrival", EDGE_LO, EDGE_HI)
    q["stored_stable_key"] = _with(f"SELECT {MART_COLS}, row_number() OVER (ORDER BY {order}) - 1 AS unique_id FROM mart")
    q["stored_csv_quarantine"] = _with("""
SELECT CASE CancellationCode WHEN 'C' THEN 'short' WHEN 'A' THEN 'long' ELSE 'good' END AS kind, COUNT(*) AS n
FROM flight_raw GROUP BY 1""")
    q["stored_mart_week_departure"] = _delay_count("departure", WEEK_LO, WEEK_HI)
    q["stored_mart_week_arrival"] = _delay_count("arrival", WEEK_LO, WEEK_HI)
    q["wind_rose_day"] = _wind_rose("departure", f"{ONE_DAY} 00:00", f"{ONE_DAY} 23:59")
    q["delay_map_day"] = _delay_count("arrival", f"{ONE_DAY} 00:00", f"{ONE_DAY} 23:59", exclude_hub=True)
    q["delay_rank"] = (f"SELECT dep_iata, dep_del15, CAST(row_number() OVER (ORDER BY dep_del15 DESC, dep_iata) AS INTEGER) AS place "
                       f"FROM ({_delay_count('departure', WEEK_LO, WEEK_HI)})")
    q["mart"] = _with(f"SELECT {MART_COLS} FROM mart")
    q["mart_dedupe"] = _with(f"SELECT {MART_COLS} FROM mart_latest")
    q["mart_split"] = _with(f"SELECT {MART_COLS} FROM mart")
    q["streamed_mart"] = _with(f"SELECT {MART_COLS} FROM mart")
    q["stored_mart_delay_count"] = _delay_count("departure", LO, HI)
    q["stored_mart_crosswind"] = _crosswind("departure", LO, HI)
    q["dedupe_weather"] = _with("SELECT time_interval, card_dir, wind_dir, wind_speed, gust_speed, precip, "
                                "binned_wind, crosswind, crosswind_lim FROM weather_latest")
    q["interruption_class_dry"] = _interruptions("crosswind_lim = 1", "cw_del_dry")
    q["interruption_class_wet"] = _interruptions("crosswind_lim = 2", "cw_del_wet")
    q["interruption_class_any"] = _interruptions("crosswind_lim > 0", "cw_del_total")
    q["wind_rose_departure"] = _wind_rose("departure", LO, HI)
    q["wind_rose_arrival"] = _wind_rose("arrival", LO, HI)
    q["wind_rose_mart"] = _wind_rose("departure", LO, HI)
    q["wind_rose_weighted"] = _wind_rose("departure", LO, HI)
    q["crosswind_weighted"] = _crosswind("arrival", LO, HI)
    q["wind_rose_days"] = _wind_rose("arrival", DAY_LO, DAY_HI)
    q["wind_rose_inclusive"] = _wind_rose("departure", DAY_LO, "2024-01-31 00:00")
    q["airport_delay_departure"] = _delay_count("departure", LO, HI)
    q["delay_count_named"] = _delay_count("departure", LO, HI).replace(
        "COUNT(dep_del15) AS dep_del15", "COUNT(dep_del15) AS delay_count")
    q["airport_delay_arrival"] = _delay_count("arrival", LO, HI)
    q["airport_delay_counterpart"] = _delay_count("departure", LO, HI, counterpart=True)
    q["delay_map"] = _delay_count("departure", DAY_LO, DAY_HI, exclude_hub=True)
    q["crosswind_departure"] = _crosswind("departure", LO, HI)
    q["crosswind_arrival"] = _crosswind("arrival", LO, HI)
    q["crosswind_json"] = _with(_crosswind_counts("departure", LO, HI)
                                + "\nSELECT CAST(to_json({'cond': cond, 'dry': dry, 'precip': precip}) AS VARCHAR) AS json FROM matrix")
    q["interruption_bars"] = _with(_crosswind_counts("arrival", DAY_LO, DAY_HI) + """
SELECT cond, 'dry' AS runway, dry AS n FROM matrix
UNION ALL
SELECT cond, 'precip' AS runway, precip AS n FROM matrix""")
    return q
