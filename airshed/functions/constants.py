"""Fixed values that must equal the upstream pipeline's for results to agree.

FIXED VALUES — keep exactly as listed, in this order.
"""

# US EPA AQI bands: (inclusive upper bound, label); above the last bound -> "Hazardous".
AQI_BANDS = [
    (50, "Good"),
    (100, "Moderate"),
    (150, "Unhealthy for Sensitive Groups"),
    (200, "Unhealthy"),
    (300, "Very Unhealthy"),
]
AQI_TOP_LABEL = "Hazardous"
AQI_UNKNOWN_LABEL = "Unknown"

# Congestion ratio bands: (exclusive upper bound, label); otherwise "Severe".
CONGESTION_BANDS = [
    (0.2, "Free Flow"),
    (0.4, "Light"),
    (0.6, "Moderate"),
    (0.8, "Heavy"),
]
CONGESTION_TOP_LABEL = "Severe"

# WHO UV index bands: (inclusive upper bound, label); otherwise "Extreme"; missing -> em dash.
UV_BANDS = [
    (2, "Low"),
    (5, "Moderate"),
    (7, "High"),
    (10, "Very High"),
]
UV_TOP_LABEL = "Extreme"
UV_MISSING_LABEL = "—"

# Compass octants, clockwise from north.
COMPASS = ["N", "NE", "E", "SE", "S", "SW", "W", "NW"]

# Trend threshold on the forecast delta (AQI points).
TREND_THRESHOLD = 1.0

# Valid AQI range kept by the silver filter (inclusive) and the congestion ratio range.
AQI_MIN, AQI_MAX = 0, 500
RATIO_MIN, RATIO_MAX = 0, 1

# Default fills for scoring features (a zero also counts as missing).
SCORING_DEFAULTS = {"temp_c": 30.0, "humidity_pct": 75.0, "wind_speed_ms": 2.0}
# Request defaults of the forecast scorer.
REQUEST_DEFAULTS = {"pm25": 0.0, "pm10": 0.0, "no2": 0.0, "o3": 0.0,
                    "temp_c": 28.0, "humidity_pct": 75.0, "wind_speed_ms": 2.0,
                    "hour": 12, "dayofweek": 0}

# Inclusive bounds of a request's fields.
REQUEST_BOUNDS = {"hour": (0, 23), "dayofweek": (0, 6)}

# Traffic payload defaults: current speed, free-flow speed, road closure.
TRAFFIC_DEFAULTS = {"current_speed_kmh": 0.0, "free_flow_kmh": 1.0, "road_closure": False}

# Local time used by scoring: UTC+7.
SCORING_TZ = "+07:00"
TRAINING_TZ = "Asia/Jakarta"

# Forecast: horizons 0..24 h, feature order of the model, current-observation columns.
HORIZONS = list(range(0, 25))
FEATURE_ORDER = [
    "pm25", "pm10", "no2", "o3",
    "temp_c", "humidity_pct", "wind_speed_ms",
    "hour", "dayofweek",
    "horizon_h", "target_hour", "target_dayofweek",
]
CURRENT_COLS = [
    "pm25", "pm10", "no2", "o3",
    "temp_c", "humidity_pct", "wind_speed_ms",
    "hour", "dayofweek",
]
TREND_HORIZON = 6
MIN_TRAINING_ROWS = 500

# Random forest settings of the forecast model.
RF_TREES = 140
RF_MIN_LEAF = 5
RF_SUBSAMPLE = 0.5
RF_SEED = 42
TEST_FRACTION = 0.2

# Silver column sets.
AQI_METRICS = ["aqi", "pm25", "pm10", "no2", "o3", "so2", "co"]
WEATHER_CASTS = ["temp_c", "feels_like_c", "humidity_pct", "pressure_hpa", "wind_speed_ms",
                 "wind_deg", "rain_1h_mm", "uv_index", "clouds_pct"]
TRAFFIC_CASTS = ["current_speed_kmh", "free_flow_kmh", "congestion_ratio"]
WEATHER_FIELDS = ["temp_c", "feels_like_c", "humidity_pct", "pressure_hpa", "wind_speed_ms",
                  "wind_deg", "clouds_pct", "rain_1h_mm", "uv_index", "weather_main",
                  "weather_desc"]
COMBINED_AQI_COLS = ["aqi", "pm25", "pm10", "no2", "o3", "aqi_category"]

# Stream topics and the bronze directory each lands in (wind shares the weather dir).
TOPIC_TO_DIR = {
    "aqi-raw": "aqi",
    "weather-raw": "weather",
    "wind-raw": "weather",
    "uv-raw": "uv",
    "traffic-raw": "traffic",
    "openaq-raw": "openaq",
    "openmeteo-raw": "openmeteo",
}

# Sensor parameters pivoted into one wide openaq row.
SENSOR_PARAMS = ["pm25", "pm10", "no2", "so2", "co", "o3"]

# Monitoring stations and traffic corridors: name -> (lat, lon).
STATIONS = {
    "jakarta-pusat": (-6.1805, 106.8284),
    "jakarta-selatan": (-6.2615, 106.8106),
    "jakarta-utara": (-6.1381, 106.8451),
    "jakarta-timur": (-6.2250, 106.9004),
    "jakarta-barat": (-6.1688, 106.7639),
    "depok": (-6.4025, 106.7942),
    "tangerang": (-6.1781, 106.6297),
    "bekasi": (-6.2383, 106.9756),
    "bogor": (-6.5971, 106.8060),
    "tangerang-selatan": (-6.2877, 106.7161),
}
CORRIDORS = {
    "sudirman-thamrin": (-6.2088, 106.8229),
    "tb-simatupang": (-6.2903, 106.7837),
    "gatot-subroto": (-6.2272, 106.8104),
    "bekasi-toll": (-6.2344, 106.9922),
    "tangerang-toll": (-6.1720, 106.6198),
    "depok-margonda": (-6.3876, 106.8287),
    "bogor-toll": (-6.4875, 106.8148),
    "jakarta-cikampek": (-6.2000, 107.0500),
    "serpong-corridor": (-6.3192, 106.6697),
    "kelapa-gading": (-6.1603, 106.9063),
}
