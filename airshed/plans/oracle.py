"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each statement re-derives its result from the raw driver tables with plain SQL
(window ``row_number`` for dedup/latest, ``ASOF JOIN`` for the as-of join, ``PIVOT``-free
conditional aggregation), i.e. independently of the DataFrame operators it checks.
"""

from __future__ import annotations

from airshed.functions import constants as K
from airshed.sources import adapters as A

RUN_TS = "2024-02-01T00:00:00+00:00"
DIGITS = 4

PTS = "timezone('UTC', TRY_CAST(timestamp AS TIMESTAMPTZ))"


def rnd(expr: str, digits: int) -> str:
    scale = f"{float(10 ** digits)}::DOUBLE"
    return f"(round_even(({expr}) * {scale}, 0) / {scale})"


def exact_avg(expr: str) -> str:
    d = f"CAST({expr} AS DECIMAL(38,6))"
    return f"(CAST(SUM({d}) AS DOUBLE) / CAST(COUNT({d}) AS DOUBLE))"


def aqi_cat(c: str, null_label: str | None = None) -> str:
    whens = " ".join(f"WHEN {c} <= {b} THEN '{lab}'" for b, lab in K.AQI_BANDS)
    body = f"CASE {whens} ELSE '{K.AQI_TOP_LABEL}' END"
    if null_label is None:
        return body
    return f"CASE WHEN {c} IS NULL THEN '{null_label}' ELSE {body} END"


def cong_level(c: str) -> str:
    whens = " ".join(f"WHEN {c} < {b} THEN '{lab}'" for b, lab in K.CONGESTION_BANDS)
    return f"CASE {whens} ELSE '{K.CONGESTION_TOP_LABEL}' END"


def uv_band(c: str) -> str:
    whens = " ".join(f"WHEN {c} <= {b} THEN '{lab}'" for b, lab in K.UV_BANDS)
    return f"CASE WHEN {c} IS NULL OR isnan({c}) THEN '{K.UV_MISSING_LABEL}' {whens} ELSE '{K.UV_TOP_LABEL}' END"


def pretty(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL OR {c} = '' THEN '' ELSE array_to_string(list_transform("
            f"string_split({c}, '-'), lambda w: upper(w[1]) || w[2:]), ' ') END")


def dedup(src: str, keys: list[str], others: list[str]) -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in others)
    cols = ", ".join(keys + others)
    return (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} "
            f"ORDER BY {order}) AS _rn FROM ({src})) WHERE _rn = 1")


def time_parts() -> str:
    return (f"strftime({PTS}, '%Y-%m-%d') AS date, CAST(hour({PTS}) AS BIGINT) AS hour, "
            f"'{RUN_TS}' AS processed_at")


# ------------------------------------------------------------------ silver
def aqi_silver(raw_sql: str = A.AQI_RAW_SQL) -> str:
    casts = ", ".join(f"TRY_CAST({m} AS DOUBLE) AS {m}" for m in K.AQI_METRICS)
    c = f"""
SELECT station, lat, lon, timestamp, {casts}, source,
       {aqi_cat('TRY_CAST(aqi AS DOUBLE)')} AS aqi_category, {time_parts()}
FROM ({raw_sql})
WHERE station IS NOT NULL AND aqi IS NOT NULL AND timestamp IS NOT NULL
  AND TRY_CAST(aqi AS DOUBLE) BETWEEN {K.AQI_MIN} AND {K.AQI_MAX}"""
    others = ["lat", "lon", *K.AQI_METRICS, "source", "aqi_category", "date", "hour", "processed_at"]
    return dedup(c, ["station", "timestamp"], others)


WEATHER_RAW_COLS = ["lat", "lon", "temp_c", "feels_like_c", "humidity_pct", "pressure_hpa",
                    "wind_speed_ms", "wind_deg", "wind_gust_ms", "visibility_m", "clouds_pct",
                    "weather_main", "weather_desc", "rain_1h_mm", "uv_index", "source"]


def weather_union() -> str:
    """SET1: weather and wind records in one directory (missing columns are NULL)."""
    return f"""
SELECT station, lat, lon, timestamp, temp_c, feels_like_c, humidity_pct, pressure_hpa,
       wind_speed_ms, wind_deg, wind_gust_ms, visibility_m, clouds_pct, weather_main,
       weather_desc, rain_1h_mm, uv_index, source FROM ({A.WEATHER_RAW_SQL})
UNION ALL
SELECT station, lat, lon, timestamp, NULL, NULL, NULL, NULL, wind_speed_ms, wind_deg,
       wind_gust_ms, NULL, NULL, NULL, NULL, NULL, NULL, source FROM ({A.WIND_RAW_SQL})"""


def weather_silver() -> str:
    cast_set = set(K.WEATHER_CASTS)
    sel = ", ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}" if c in cast_set else c
                    for c in WEATHER_RAW_COLS)
    c = f"""
SELECT station, timestamp, {sel}, {time_parts()}
FROM ({weather_union()})
WHERE temp_c IS NOT NULL AND station IS NOT NULL AND timestamp IS NOT NULL
  AND humidity_pct IS NOT NULL"""
    return dedup(c, ["station", "timestamp"], WEATHER_RAW_COLS + ["date", "hour", "processed_at"])


TRAFFIC_RAW_COLS = ["lat", "lon", "current_speed_kmh", "free_flow_kmh", "congestion_ratio",
                    "confidence", "road_closure", "source"]


def traffic_silver() -> str:
    cast_set = set(K.TRAFFIC_CASTS)
    sel = ", ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}" if c in cast_set else c
                    for c in TRAFFIC_RAW_COLS)
    c = f"""
SELECT corridor, timestamp, {sel},
       {cong_level('TRY_CAST(congestion_ratio AS DOUBLE)')} AS congestion_level, {time_parts()}
FROM ({A.TRAFFIC_RAW_SQL})
WHERE corridor IS NOT NULL AND timestamp IS NOT NULL AND congestion_ratio IS NOT NULL
  AND TRY_CAST(congestion_ratio AS DOUBLE) BETWEEN {K.RATIO_MIN} AND {K.RATIO_MAX}"""
    return dedup(c, ["corridor", "timestamp"],
                 TRAFFIC_RAW_COLS + ["congestion_level", "date", "hour", "processed_at"])


# ------------------------------------------------------------------ gold
LATEST = ["aqi", "aqi_category", "pm25", "pm10", "no2", "o3", "so2", "co"]


def gold_stations(silver: str | None = None) -> str:
    silver = silver or aqi_silver()
    avgs = ", ".join(f"{rnd(exact_avg(p), DIGITS)} AS avg_{p}"
                     for p in ["pm25", "pm10", "no2", "o3", "so2", "co"])
    latest = ", ".join(f"{c} AS {'latest_category' if c == 'aqi_category' else 'latest_' + c}"
                       for c in LATEST)
    return f"""
WITH s AS ({silver}),
g AS (SELECT station, lat, lon, {rnd(exact_avg('aqi'), DIGITS)} AS avg_aqi,
             min(aqi) AS min_aqi, max(aqi) AS max_aqi, {avgs},
             count(*) AS reading_count, max(timestamp) AS last_updated
      FROM s GROUP BY station, lat, lon),
l AS (SELECT station, {latest} FROM (
        SELECT *, row_number() OVER (PARTITION BY station ORDER BY timestamp DESC) AS rn FROM s)
      WHERE rn = 1)
SELECT g.*, '{RUN_TS}' AS processed_at, l.* EXCLUDE (station)
FROM g LEFT JOIN l USING (station)"""


def gold_traffic() -> str:
    return f"""
SELECT corridor, lat, lon, {rnd(exact_avg('current_speed_kmh'), DIGITS)} AS avg_speed_kmh,
       min(current_speed_kmh) AS min_speed_kmh,
       {rnd(exact_avg('congestion_ratio'), DIGITS)} AS avg_congestion,
       max(congestion_ratio) AS max_congestion, count(*) AS reading_count,
       max(timestamp) AS last_updated, {cong_level(exact_avg('congestion_ratio'))} AS congestion_level,
       '{RUN_TS}' AS processed_at
FROM ({traffic_silver()}) GROUP BY corridor, lat, lon"""


def gold_weather() -> str:
    fields = ", ".join(K.WEATHER_FIELDS)
    return f"""
SELECT station, lat, lon, {fields}, timestamp AS last_updated, '{RUN_TS}' AS processed_at
FROM (SELECT *, row_number() OVER (PARTITION BY station ORDER BY timestamp DESC) AS rn
      FROM ({weather_silver()})) WHERE rn = 1"""


def station_current() -> str:
    wf = ", ".join(f"w.{f} AS {f}" for f in K.WEATHER_FIELDS)
    return f"""
SELECT s.*, {wf}, w.last_updated AS weather_updated,
       {aqi_cat('coalesce(s.latest_aqi, s.avg_aqi)', K.AQI_UNKNOWN_LABEL)} AS aqi_category,
       coalesce(s.latest_aqi, s.avg_aqi) AS current_aqi
FROM ({gold_stations()}) s LEFT JOIN ({gold_weather()}) w USING (station)
WHERE s.station IS NOT NULL"""


def overview_sql() -> str:
    cur = f"({station_current()})"
    tr = f"({gold_traffic()})"
    return f"""
WITH c AS (SELECT * FROM {cur}), t AS (SELECT * FROM {tr}),
r AS (SELECT * FROM c WHERE current_aqi IS NOT NULL),
w AS (SELECT station AS worst_station, current_aqi AS wa FROM r ORDER BY current_aqi DESC, station LIMIT 1),
b AS (SELECT station AS best_station, current_aqi AS ba FROM r ORDER BY current_aqi ASC, station LIMIT 1),
wc AS (SELECT corridor AS worst_corridor, avg_congestion AS wv, congestion_level AS worst_corridor_level
       FROM t WHERE avg_congestion IS NOT NULL ORDER BY avg_congestion DESC, corridor LIMIT 1),
agg AS (SELECT count(*) AS station_count, coalesce(sum(coalesce(reading_count, 0)), 0) AS total_aqi_readings,
               {rnd(exact_avg('current_aqi'), 1)} AS city_avg_aqi,
               {rnd(exact_avg('temp_c'), 1)} AS avg_temp_c,
               {rnd(exact_avg('humidity_pct'), 1)} AS avg_humidity_pct,
               {rnd(exact_avg('wind_speed_ms'), 1)} AS avg_wind_speed_ms,
               {rnd('max(uv_index)', 1)} AS max_uv_index FROM c),
tc AS (SELECT count(*) AS corridor_count FROM t)
SELECT agg.station_count, tc.corridor_count, CAST(agg.total_aqi_readings AS BIGINT) AS total_aqi_readings,
       agg.city_avg_aqi, {aqi_cat('agg.city_avg_aqi', K.AQI_UNKNOWN_LABEL)} AS city_avg_category,
       w.worst_station, {rnd('w.wa', 1)} AS worst_aqi, {aqi_cat('w.wa', K.AQI_UNKNOWN_LABEL)} AS worst_category,
       b.best_station, {rnd('b.ba', 1)} AS best_aqi, {aqi_cat('b.ba', K.AQI_UNKNOWN_LABEL)} AS best_category,
       wc.worst_corridor, {rnd('wc.wv', 2)} AS worst_corridor_congestion, wc.worst_corridor_level,
       agg.avg_temp_c, agg.avg_humidity_pct, agg.avg_wind_speed_ms, agg.max_uv_index
FROM agg CROSS JOIN tc LEFT JOIN w ON TRUE LEFT JOIN b ON TRUE LEFT JOIN wc ON TRUE"""


def worst_best_sql() -> str:
    return f"""
WITH r AS (SELECT * FROM ({station_current()}) WHERE current_aqi IS NOT NULL),
w AS (SELECT station AS worst_station, current_aqi AS wa FROM r ORDER BY current_aqi DESC, station LIMIT 1),
b AS (SELECT station AS best_station, current_aqi AS ba FROM r ORDER BY current_aqi ASC, station LIMIT 1)
SELECT w.worst_station, {rnd('w.wa', 1)} AS worst_aqi, {aqi_cat('w.wa', K.AQI_UNKNOWN_LABEL)} AS worst_category,
       b.best_station, {rnd('b.ba', 1)} AS best_aqi, {aqi_cat('b.ba', K.AQI_UNKNOWN_LABEL)} AS best_category
FROM w, b"""


def worst_corridor_sql() -> str:
    return f"""
SELECT corridor, {rnd('avg_congestion', 2)} AS avg_congestion, congestion_level
FROM ({gold_traffic()}) WHERE avg_congestion IS NOT NULL
ORDER BY avg_congestion DESC, corridor LIMIT 1"""


def city_weather_sql() -> str:
    return f"""
SELECT {rnd(exact_avg('temp_c'), 1)} AS avg_temp_c, {rnd(exact_avg('humidity_pct'), 1)} AS avg_humidity_pct,
       {rnd(exact_avg('wind_speed_ms'), 1)} AS avg_wind_speed_ms, {rnd('max(uv_index)', 1)} AS max_uv_index
FROM ({station_current()})"""


ISO = "'%Y-%m-%dT%H:%M:%S.%f+00:00'"
NOW_LOCAL = f"(timezone('UTC', TIMESTAMPTZ '{RUN_TS}') + INTERVAL 7 HOUR)"


def combined_sql() -> str:
    cols = ", ".join(K.COMBINED_AQI_COLS)
    return f"""
WITH w AS (SELECT *, {PTS} AS _t FROM ({weather_silver()})),
a AS (SELECT station, {PTS} AS _t, {cols} FROM ({aqi_silver()}) WHERE {PTS} IS NOT NULL)
SELECT w.* EXCLUDE (_t, processed_at), {', '.join('a.' + c for c in K.COMBINED_AQI_COLS)},
       '{RUN_TS}' AS processed_at
FROM w ASOF LEFT JOIN a ON w.station = a.station AND w._t >= a._t"""


def uv_enrich_sql() -> str:
    return f"""
WITH w AS (SELECT station, timestamp, uv_index, {PTS} AS _t FROM ({weather_silver()})),
u AS (SELECT station, {PTS} AS _t, TRY_CAST(uv AS DOUBLE) AS uv, TRY_CAST(uv_max AS DOUBLE) AS uv_max
      FROM ({A.UV_RAW_SQL}) WHERE {PTS} IS NOT NULL AND station IS NOT NULL)
SELECT w.station, w.timestamp, w.uv_index, u.uv, u.uv_max
FROM w ASOF LEFT JOIN u ON w.station = u.station AND w._t >= u._t"""


def source_fallback_sql() -> str:
    p = A.aqi_feed_sql(["signup"], "primary", 300.0)
    s = A.aqi_feed_sql(["error", "purchase"], "secondary", None)
    pick = lambda c: f"CASE WHEN p.aqi IS NOT NULL THEN p.{c} ELSE s.{c} END AS {c}"
    return f"""
WITH p AS ({p}), s AS ({s})
SELECT coalesce(p.station, s.station) AS station, coalesce(p.slot, s.slot) AS slot,
       {pick('aqi')}, {pick('pm25')}, {pick('source')}
FROM p FULL OUTER JOIN s ON p.station = s.station AND p.slot = s.slot
WHERE p.aqi IS NOT NULL OR s.station IS NOT NULL"""


def training_rows_sql() -> str:
    return f"""
SELECT a.station, a.time, a.pm25, a.pm10, a.no2, a.o3, a.aqi, w.temp_c, w.humidity_pct,
       w.wind_speed_ms, CAST(hour(a.time + INTERVAL 7 HOUR) AS BIGINT) AS hour,
       CAST(isodow(a.time + INTERVAL 7 HOUR) - 1 AS BIGINT) AS dayofweek
FROM ({A.AQ_HOURLY_SQL}) a JOIN ({A.WX_HOURLY_SQL}) w ON a.station = w.station AND a.time = w.time
WHERE a.pm25 IS NOT NULL AND a.pm10 IS NOT NULL AND a.no2 IS NOT NULL AND a.o3 IS NOT NULL
  AND w.temp_c IS NOT NULL AND w.humidity_pct IS NOT NULL AND w.wind_speed_ms IS NOT NULL
  AND a.aqi IS NOT NULL"""


def horizon_samples_sql() -> str:
    cur = ", ".join(f"ex.{c}" for c in K.CURRENT_COLS)
    return f"""
WITH h AS ({training_rows_sql()}),
ex AS (SELECT h.*, g.horizon_h, h.time + to_hours(g.horizon_h) AS target_time
       FROM h CROSS JOIN range(0, {max(K.HORIZONS) + 1}) g(horizon_h))
SELECT ex.station, strftime(ex.time, {ISO}) AS time, {cur}, t.aqi AS aqi_target,
       CAST(ex.horizon_h AS BIGINT) AS horizon_h,
       CAST(hour(ex.target_time + INTERVAL 7 HOUR) AS BIGINT) AS target_hour,
       CAST(isodow(ex.target_time + INTERVAL 7 HOUR) - 1 AS BIGINT) AS target_dayofweek
FROM ex JOIN h t ON t.station = ex.station AND t.time = ex.target_time"""


def sensor_pivot_sql() -> str:
    cols = ", ".join(
        f"arg_max(value, pos_ts) FILTER (WHERE lower(name) = '{p}' AND value IS NOT NULL) AS {p}"
        for p in K.SENSOR_PARAMS)
    return f"SELECT site, slot, {cols} FROM ({A.SENSOR_LONG_SQL}) GROUP BY site, slot"


def fill(expr: str, default: float) -> str:
    return f"CASE WHEN ({expr}) IS NULL OR ({expr}) = 0 THEN {float(default)}::DOUBLE ELSE ({expr}) END"


def horizon_features_sql() -> str:
    pol = ", ".join(f"{fill(f'coalesce(latest_{p}, avg_{p})', 0.0)} AS {p}"
                    for p in ["pm25", "pm10", "no2", "o3"])
    wx = ", ".join(f"{fill(f, d)} AS {f}" for f, d in K.SCORING_DEFAULTS.items())
    return f"""
WITH b AS (SELECT station, {pol}, {wx}, CAST(hour({NOW_LOCAL}) AS BIGINT) AS hour,
                  CAST(isodow({NOW_LOCAL}) - 1 AS BIGINT) AS dayofweek
           FROM ({station_current()}))
SELECT b.*, CAST(g.horizon_h AS BIGINT) AS horizon_h,
       CAST((b.hour + g.horizon_h) % 24 AS BIGINT) AS target_hour,
       CAST((b.dayofweek + (b.hour + g.horizon_h) // 24) % 7 AS BIGINT) AS target_dayofweek
FROM b CROSS JOIN range(0, {max(K.HORIZONS) + 1}) g(horizon_h)"""


def forecast_time_grid_sql() -> str:
    return f"""
SELECT station, CAST(g.horizon_h AS BIGINT) AS horizon_h,
       strftime({NOW_LOCAL} + to_hours(g.horizon_h), '%Y-%m-%dT%H:%M:%S{K.SCORING_TZ}') AS valid_time
FROM ({station_current()}) CROSS JOIN range(0, {max(K.HORIZONS) + 1}) g(horizon_h)"""


def dashboard_stations_sql() -> str:
    return f"""
SELECT station, {pretty('station')} AS name, coalesce(latest_aqi, avg_aqi) AS current_aqi,
       coalesce(latest_pm25, avg_pm25) AS current_pm25,
       {aqi_cat('coalesce(latest_aqi, avg_aqi)', K.AQI_UNKNOWN_LABEL)} AS band, lat, lon
FROM ({station_current()})"""


def dashboard_traffic_sql() -> str:
    return f"""SELECT corridor, {pretty('corridor')} AS name, avg_speed_kmh, congestion_level, lat, lon
FROM ({gold_traffic()})"""


def map_points_sql() -> str:
    return f"""
SELECT 'station' AS kind, station AS id, name, lat, lon, band AS label FROM ({dashboard_stations_sql()})
WHERE lat IS NOT NULL AND lon IS NOT NULL
UNION ALL
SELECT 'corridor', corridor, name, lat, lon, congestion_level FROM ({dashboard_traffic_sql()})
WHERE lat IS NOT NULL AND lon IS NOT NULL"""


def compass(c: str) -> str:
    names = ", ".join(f"'{n}'" for n in K.COMPASS)
    idx = f"(floor({c} / 45.0 + 0.5) % 8)"
    return (f"CASE WHEN {c} IS NULL OR isnan({c}) OR isinf({c}) THEN '' ELSE coalesce(CASE WHEN {idx} >= 0 THEN "
            f"[{names}][CAST({idx} AS INTEGER) + 1] END, '') END")


def realised_curve_sql() -> str:
    value = rnd("arg_max(aqi_target, time) - 25.0::DOUBLE", 1)
    return f"""
SELECT station, horizon_h, aqi_predicted, {aqi_cat('aqi_predicted')} AS category,
  strftime(TIMESTAMP '2024-02-01 07:00:00' + to_hours(CAST(horizon_h AS INTEGER)),
           '%Y-%m-%dT%H:%M:%S+07:00') AS valid_time
FROM (SELECT station, horizon_h, CASE WHEN {value} > 0 THEN {value} ELSE 0.0::DOUBLE END AS aqi_predicted
      FROM ({horizon_samples_sql()}) GROUP BY station, horizon_h)"""


def realised_trend_sql() -> str:
    return f"""
SELECT *, CASE WHEN delta IS NULL THEN '' WHEN delta > 1 THEN 'up' WHEN delta < -1 THEN 'down'
          ELSE 'flat' END AS trend
FROM (SELECT station, nowcast_aqi, forecast_aqi, forecast_category,
        {rnd('forecast_aqi - nowcast_aqi', 1)} AS delta, current_aqi
      FROM (SELECT station, max(aqi_predicted) FILTER (horizon_h = 0) AS nowcast_aqi,
              max(aqi_predicted) FILTER (horizon_h = 6) AS forecast_aqi,
              max(category) FILTER (horizon_h = 6) AS forecast_category
            FROM ({realised_curve_sql()}) GROUP BY station)
      LEFT JOIN (SELECT station, current_aqi FROM ({station_current()})) USING (station))"""


def realised_oracles() -> dict[str, str]:
    curve = realised_curve_sql()
    return {
        "realised_curve": curve,
        "realised_peak": f"""SELECT station, horizon_h AS peak_horizon_h, aqi_predicted AS peak_aqi,
            category AS peak_category, valid_time AS peak_valid_time
            FROM (SELECT *, row_number() OVER (PARTITION BY station
                    ORDER BY aqi_predicted DESC, horizon_h) AS rn FROM ({curve})) WHERE rn = 1""",
        "realised_downsample": f"SELECT * FROM ({curve}) WHERE horizon_h % 3 = 0",
        "realised_trend": realised_trend_sql(),
        "realised_dashboard": f"""SELECT * FROM ({dashboard_stations_sql()}) LEFT JOIN (
            SELECT station, forecast_aqi, forecast_category, delta, trend
            FROM ({realised_trend_sql()})) USING (station)""",
        "traffic_current": f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
            PARTITION BY corridor ORDER BY last_updated DESC) AS rn FROM ({gold_traffic()})
            WHERE corridor IS NOT NULL) WHERE rn = 1""",
    }


def more_oracles() -> dict[str, str]:
    return {
        "combined": combined_sql(),
        "uv_enrich": uv_enrich_sql(),
        "source_fallback": source_fallback_sql(),
        "aq_weather_hourly": f"SELECT * EXCLUDE (time), strftime(time, {ISO}) AS time FROM ({training_rows_sql()})",
        "horizon_samples": horizon_samples_sql(),
        "sensor_pivot": sensor_pivot_sql(),
        "props_json": """SELECT event_id, CAST(k AS BIGINT) AS k,
            CAST(to_json({'station': printf('st-%04d', user_id), 'k': k}) AS VARCHAR) AS payload
            FROM (SELECT *, TRY_CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)""",
        "hourly_arrays_explode": f"""SELECT station, strftime(time, '%Y-%m-%d') AS day,
            strftime(time, {ISO}) AS time, pm25, aqi FROM ({A.AQ_HOURLY_SQL})""",
        "stations_view": f"""SELECT station, current_aqi, aqi_category, reading_count, last_updated,
            weather_updated, temp_c FROM ({station_current()})""",
        "station_series": f"SELECT station, timestamp, aqi, pm25, pm10, no2, o3 FROM ({aqi_silver()})",
        "traffic_view": gold_traffic(),
        "dashboard_stations": dashboard_stations_sql(),
        "dashboard_traffic": dashboard_traffic_sql(),
        "map_points": map_points_sql(),
        "pretty_names": f"SELECT id AS slug, name AS pretty FROM ({map_points_sql()})",
        "uv_bands": f"""SELECT station, timestamp, TRY_CAST(uv AS DOUBLE) AS uv,
            {uv_band('TRY_CAST(uv AS DOUBLE)')} AS uv_band FROM ({A.UV_RAW_SQL})""",
        "wind_octant": f"SELECT station, timestamp, wind_deg, {compass('wind_deg')} AS wind_dir FROM ({weather_silver()})",
        "horizon_features": horizon_features_sql(),
        "forecast_time_grid": forecast_time_grid_sql(),
        "aq_payload": f"""SELECT station, lat, lon, timestamp, aqi, pm25, pm10, no2, o3, so2, co,
            'open-meteo-aq' AS source FROM ({A.AQI_RAW_SQL}) WHERE aqi >= 0""",
        "aq_fallback_payload": f"""SELECT station, lat, lon, timestamp, CAST(aqi AS VARCHAR) AS aqi, pm25, pm10,
            no2, o3, so2, co, 'aqicn' AS source FROM ({A.AQI_RAW_SQL}) WHERE aqi >= 0""",
        "weather_payload": f"""SELECT station, lat, lon, timestamp, temp_c, feels_like_c, humidity_pct, pressure_hpa,
            wind_speed_ms, CASE WHEN wind_deg > 0 THEN wind_deg ELSE 0.0 END AS wind_deg, wind_gust_ms,
            visibility_m, clouds_pct, weather_main, weather_desc, rain_1h_mm, uv_index,
            'openweathermap+openmeteo-uv' AS source
            FROM ({A.WEATHER_RAW_SQL}) WHERE wind_speed_ms > 0.1""",
        "traffic_payload": f"""SELECT printf('co-%04d', l_suppkey) AS corridor, -6.2::DOUBLE AS lat, 106.8::DOUBLE AS lon,
            strftime(l_shipdate, {ISO}) AS timestamp, cur AS current_speed_kmh, 50.0::DOUBLE AS free_flow_kmh,
            greatest(0.0::DOUBLE, round_even((1.0::DOUBLE - cur / greatest(50.0::DOUBLE, 1.0::DOUBLE))
                     * 1000.0::DOUBLE, 0) / 1000.0::DOUBLE) AS congestion_ratio,
            1.0::DOUBLE - l_discount AS confidence, coalesce(l_linestatus = 'F', false) AS road_closure,
            'tomtom' AS source
            FROM (SELECT *, CASE WHEN l_returnflag <> 'R' THEN l_quantity ELSE 0.0 END AS cur FROM lineitem)""",
        "uv_payload": f"""SELECT station, lat, lon, timestamp, uv, uv_max, uv_max_time, ozone, safe_exposure_min,
            'openuv' AS source FROM ({A.UV_RAW_SQL})""",
        "ingest_stream": f"""
SELECT 'aqi' AS dir, count(*) AS rows, count(DISTINCT station) AS entities FROM ({A.AQI_RAW_SQL})
UNION ALL
SELECT 'weather', count(*), count(DISTINCT station) FROM (
    SELECT station FROM ({A.WEATHER_RAW_SQL}) UNION ALL SELECT station FROM ({A.WIND_RAW_SQL}))
UNION ALL
SELECT 'uv', count(*), count(DISTINCT station) FROM ({A.UV_RAW_SQL})
UNION ALL
SELECT 'traffic', count(*), count(DISTINCT corridor) FROM ({A.TRAFFIC_RAW_SQL})
UNION ALL
SELECT 'openaq', count(*), count(DISTINCT station) FROM ({A.OPENAQ_SQL})
UNION ALL
SELECT 'openmeteo', count(*), count(DISTINCT station) FROM ({A.OPENMETEO_SQL})""",
    }


def landing_compacted_sql() -> str:
    feeds = [("aqi", "aqi-raw", A.AQI_RAW_SQL), ("weather", "weather-raw", A.WEATHER_RAW_SQL),
             ("weather", "wind-derived", A.WEATHER_RAW_SQL), ("uv", "uv-raw", A.UV_RAW_SQL)]
    return " UNION ALL ".join(
        f"""SELECT '{d}' AS dir, '{f}' AS feed, count(*) AS rows, least(count(DISTINCT station), 4) AS batches,
        count(DISTINCT station) AS stations FROM ({sql}) HAVING count(*) > 0""" for d, f, sql in feeds)


def landing_sinks_sql() -> str:
    feeds = [("aqi", "aqi-raw", A.AQI_RAW_SQL, "station"), ("weather", "weather-raw", A.WEATHER_RAW_SQL, "station"),
             ("weather", "wind-derived", A.WEATHER_RAW_SQL, "station"), ("uv", "uv-raw", A.UV_RAW_SQL, "station"),
             ("traffic", "traffic-raw", A.TRAFFIC_RAW_SQL, "corridor"), ("openaq", "openaq-raw", A.OPENAQ_SQL, "station"),
             ("openmeteo", "openmeteo-raw", A.OPENMETEO_SQL, "station")]
    landed = " UNION ALL ".join(
        f"SELECT 'bronze' AS sink, '{d}' AS part, '{f}' AS feed, count(*) AS rows, count(DISTINCT {key}) AS entities "
        f"FROM ({sql})" for d, f, sql, key in feeds)
    return f"""SELECT * FROM ({landed}) WHERE rows > 0 UNION ALL
        SELECT 'rejects', CASE k WHEN 0 THEN 'unknown topic' WHEN 1 THEN 'malformed' WHEN 2 THEN 'not an object'
               ELSE 'no value' END, CASE k WHEN 0 THEN 'alerts' ELSE 'uv-raw' END, count(*), 0
        FROM (SELECT TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) WHERE k < 4 GROUP BY k"""


def job_oracles() -> dict[str, str]:
    combined = f"SELECT count(*) FROM ({weather_silver()})"
    tables = [("aqi", "silver_aqi", f"SELECT count(*) FROM ({aqi_silver()})"),
              ("aqi", "gold_stations", f"SELECT count(*) FROM ({gold_stations()})"),
              ("aqi", "gold_ml_features", f"SELECT count(*) FROM ({aqi_silver()})"),
              ("weather", "silver_weather", combined), ("weather", "gold_weather", f"SELECT count(*) FROM ({gold_weather()})"),
              ("weather", "silver_combined", combined), ("traffic", "gold_traffic", f"SELECT count(*) FROM ({gold_traffic()})"),
              ("refresh", "stations", f"SELECT count(*) FROM ({station_current()})"),
              ("refresh", "corridors", f"SELECT count(DISTINCT corridor) FROM ({gold_traffic()})")]
    key = "md5(station || '|' || CAST(epoch(t) AS BIGINT)"
    split = (f"SELECT 'sample' AS key, {key} || '|' || horizon_h) AS h FROM samples UNION ALL SELECT 'target', "
             "md5(station || '|' || CAST(epoch(t) + horizon_h * 3600 AS BIGINT)) FROM samples")
    return {
        "job_rows": " UNION ALL ".join(f"SELECT '{j}' AS job, 'ok' AS status, '{n}' AS name, ({q}) AS rows"
                                       for j, n, q in tables),
        "bronze_audit": f"""SELECT 'aqi' AS dir, count(*) AS rows, true AS has_files FROM ({A.AQI_RAW_SQL}) UNION ALL
            SELECT 'weather', 2 * count(*), true FROM ({A.WEATHER_RAW_SQL}) UNION ALL
            SELECT 'traffic', count(*), true FROM ({A.TRAFFIC_RAW_SQL})""",
        "incremental_stations": gold_stations(),
        "station_detail": f"""SELECT station, current_aqi, aqi_category, reading_count, last_updated, temp_c,
            readings, times FROM ({station_current()}) JOIN (SELECT station, count(*) AS readings,
              '[' || string_agg('"' || timestamp || '"', ',' ORDER BY timestamp) || ']' AS times
              FROM ({aqi_silver()}) GROUP BY station) USING (station) WHERE station = 'st-0007'""",
        "split_counts": f"""WITH samples AS (SELECT station, horizon_h, timezone('UTC', CAST(time AS TIMESTAMPTZ)) AS t
              FROM ({horizon_samples_sql()}))
            SELECT key, CAST('0x' || h[1:8] AS BIGINT) % 100 >= 80 AS test, count(*) AS samples FROM ({split}) GROUP BY 1, 2""",
    }


def payload_oracles() -> dict[str, str]:
    # records by form: 5 an empty object, 6 a null block, 7 a valid response
    return {
        "openaq_payload": A.OPENAQ_SQL,
        "openmeteo_payload": f"""SELECT station, timestamp, temp_c AS current_temp_c, cloud AS cloud_cover_pct,
            i AS hour_no, strftime(ts + to_hours(CAST(i AS INTEGER)), {ISO}) AS time,
            value * 0.05::DOUBLE + CAST(i AS DOUBLE) AS temp_c
            FROM (SELECT *, unnest(range(n)) AS i FROM ({A.OPENMETEO_SQL}))""",
        "payload_kinds": f"""SELECT feed, CASE k % 8 WHEN 0 THEN 'no body' WHEN 1 THEN 'malformed' WHEN 2 THEN 'array'
            WHEN 3 THEN 'scalar' WHEN 4 THEN 'null' ELSE 'object' END AS kind, count(*) AS bodies
            FROM ({A.DIRTY_SQL}) GROUP BY 1, 2""",
        "dirty_payloads": f"""SELECT feed, event_id, CASE WHEN k % 8 = 7 THEN CAST(k AS DOUBLE)
            WHEN feed = 'traffic' THEN 0.0 END AS value FROM ({A.DIRTY_SQL})
            WHERE k % 8 = 7 OR k % 8 = 5 AND feed IN ('traffic', 'uv', 'openmeteo')""",
        "request_features": f"""SELECT * EXCLUDE (horizons, h), h AS horizon_h, (hour + h) % 24 AS target_hour,
            (dayofweek + (hour + h) // 24) % 7 AS target_dayofweek
            FROM (SELECT *, CAST(unnest(horizons) AS INTEGER) AS h FROM ({A.REQUESTS_SQL}))
            WHERE hour BETWEEN 0 AND 23 AND dayofweek BETWEEN 0 AND 6""",
        "request_rejects": f"""SELECT request_id, station, hour, dayofweek, concat_ws(',',
            CASE WHEN hour NOT BETWEEN 0 AND 23 THEN 'hour' END,
            CASE WHEN dayofweek NOT BETWEEN 0 AND 6 THEN 'dayofweek' END) AS rejected
            FROM ({A.REQUESTS_SQL}) WHERE hour NOT BETWEEN 0 AND 23 OR dayofweek NOT BETWEEN 0 AND 6""",
        "landing_sinks": landing_sinks_sql(),
        "landing_compacted": landing_compacted_sql(),
    }


def oracle_sql() -> dict[str, str]:
    silver = aqi_silver()
    return {
        "aqi_silver": silver,
        "silver_dirty_casts": aqi_silver(A.AQI_DIRTY_SQL),
        "gold_stations": gold_stations(),
        "aqi_latest": f"""SELECT station, timestamp, aqi, aqi_category FROM (
            SELECT *, row_number() OVER (PARTITION BY station ORDER BY timestamp DESC) AS rn
            FROM ({silver})) WHERE rn = 1""",
        "ml_features": f"""SELECT station, timestamp, lat, lon, aqi, pm25, pm10, no2, o3, so2, co,
            hour, date, CAST(dayofweek({PTS}) + 1 AS BIGINT) AS dayofweek FROM ({silver})""",
        "traffic_silver": traffic_silver(),
        "gold_traffic": gold_traffic(),
        "traffic_bands": f"""SELECT congestion_level, count(*) AS readings
            FROM ({traffic_silver()}) GROUP BY congestion_level""",
        "weather_wind_union": f"""SELECT station, timestamp, source, temp_c, wind_speed_ms, wind_deg
            FROM ({weather_union()})""",
        "weather_silver": weather_silver(),
        "gold_weather": gold_weather(),
        "station_current": station_current(),
        "overview": overview_sql(),
        "worst_best_station": worst_best_sql(),
        "worst_corridor": worst_corridor_sql(),
        "city_weather": city_weather_sql(),
        **more_oracles(),
        **payload_oracles(),
        **job_oracles(),
        **realised_oracles(),
    }
