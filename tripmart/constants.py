"""Fixed values.

Everything in this module is a value the results depend on (code lists,
thresholds, calendars, labels).  No logic lives here.
"""

from __future__ import annotations

LOCAL_TIME_ZONE = "America/New_York"

# --- Event topics --------------------------------------------------------
YELLOW_TOPIC = "nyc_taxi_yellow"
GREEN_TOPIC = "nyc_taxi_green"
WEATHER_TOPIC = "weather_stream"

# --- Default event-date window [start, end) ------------------------------
WINDOW_START = "2023-01-01"
WINDOW_END = "2025-01-01"

# --- Row validity limits ------------------------------------------------
MAX_VALID_DISTANCE = 100
MAX_VALID_FARE = 1000
MAX_VALID_TOTAL = 1500

# --- Fare/tip feature policy ---------------------------------------------
MIN_MODEL_FARE = 2.5
MAX_MODEL_FARE = 300.0
MAX_TIP_PERCENT = 100.0

# --- Training clean-up limits (exclusive) --------------------------------
MAX_TRAIN_FARE = 500.0
MAX_TRAIN_DISTANCE = 150.0

# --- Imputation defaults -------------------------------------------------
IMPUTE_DEFAULTS = {
    "passenger_count": "1",
    "ratecode_id": "99",
    "payment_type": "0",
    "congestion_surcharge": "0.00",
    "airport_fee": "0.00",
}

# --- Calendar ------------------------------------------------------------
RUSH_HOURS = [7, 8, 9, 17, 18, 19]
NIGHT_HOURS = [0, 1, 2, 3, 4]

# Weekday numbers below use Sunday = 1 unless they say ISO (Monday = 1).
# The demand model and the fare/tip model disagree on what a weekend is; both
# published definitions are kept as defaults and can be overridden.  The ISO
# pair is the calendar weekend.
DEMAND_WEEKEND_DAYS = [6, 7]
FARE_WEEKEND_DAYS = [5, 6]
ISO_WEEKEND_DAYS = [6, 7]

HOLIDAYS = [
    "2023-01-02",
    "2023-01-16",
    "2023-02-20",
    "2023-05-29",
    "2023-06-19",
    "2023-07-04",
    "2023-09-04",
    "2023-10-09",
    "2023-11-11",
    "2023-11-23",
    "2023-12-25",
    "2024-01-01",
    "2024-01-15",
    "2024-02-19",
    "2024-05-27",
    "2024-06-19",
    "2024-07-04",
    "2024-09-02",
    "2024-10-14",
    "2024-11-11",
    "2024-11-28",
    "2024-12-25",
]

DAY_ORDER = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
DAY_LABELS = {
    "Monday": "Thứ Hai",
    "Tuesday": "Thứ Ba",
    "Wednesday": "Thứ Tư",
    "Thursday": "Thứ Năm",
    "Friday": "Thứ Sáu",
    "Saturday": "Thứ Bảy",
    "Sunday": "Chủ Nhật",
}

# --- Weather -------------------------------------------------------------
COLD_BELOW_F = 36
WMO_DESCRIPTIONS = {
    0: "Clear sky",
    1: "Mainly clear",
    2: "Partly cloudy",
    3: "Overcast",
    45: "Foggy",
    48: "Depositing rime fog",
    51: "Light drizzle",
    53: "Moderate drizzle",
    55: "Dense drizzle",
    61: "Slight rain",
    63: "Moderate rain",
    65: "Heavy rain",
    71: "Slight snow",
    73: "Moderate snow",
    75: "Heavy snow",
    77: "Snow grains",
    80: "Slight rain showers",
    81: "Moderate rain showers",
    82: "Violent rain showers",
    85: "Slight snow showers",
    86: "Heavy snow showers",
    95: "Thunderstorm",
    96: "Thunderstorm with slight hail",
    99: "Thunderstorm with heavy hail",
}
UNKNOWN_WEATHER = "Unknown"
WEATHER_LATITUDE = 40.7128
WEATHER_LONGITUDE = -74.0060
WEATHER_LOCATION = "NYC_Manhattan"
WEATHER_SOURCE = "open_meteo"

# --- Zones ---------------------------------------------------------------
AIRPORT_ZONES = [1, 132, 138]
CORE_ZONES = [
    50, 68, 90, 100, 107, 113, 114, 142, 148, 158, 161, 162, 163, 164,
    166, 167, 168, 170, 186, 187, 188, 209, 211, 224, 230, 231, 232, 233,
    234, 235, 236, 237, 238, 239, 240, 241, 242, 243, 244, 245, 246, 247,
    248, 249, 250, 251, 252, 253, 254, 255, 256, 257, 258, 259, 260, 261,
    262, 263,
]
ZONE_TYPE_LABELS = {
    "normal": "Bình thường",
    "airport": "Sân bay",
    "core": "Manhattan core",
}
FORECAST_ZONE_NAMES = {
    1: "Newark Airport",
    48: "Clinton East",
    87: "Financial District N",
    88: "Financial District S",
    132: "JFK Airport",
    138: "LaGuardia Airport",
    161: "Midtown Center",
    162: "Midtown East",
    163: "Midtown North",
    170: "Murray Hill",
    186: "Penn Station",
    230: "Times Sq/Theatre District",
    234: "Union Square",
    236: "Upper East Side N",
    237: "Upper East Side S",
}
EARTH_RADIUS_MILES = 3958.7613
DISTANCE_METHOD = "haversine_zone_centroid"

# --- Payments ------------------------------------------------------------
CARD_PAYMENT = 1
PAYMENT_LABELS = {
    1: "Thẻ tín dụng",
    2: "Tiền mặt",
    3: "Miễn phí",
    4: "Tranh chấp",
    5: "Không xác định",
    6: "Chuyến hủy",
}

# --- Rule-based price used when no model is available ---------------------
FALLBACK_BASE_FARE = 3.0
FALLBACK_PER_MILE = 2.5
FALLBACK_EVENING_SURCHARGE = 2.5
FALLBACK_EVENING_HOURS = (16, 20)
FALLBACK_CARD_TIP_PERCENT = 15.0

# --- Published comparison point of the demand forecast ---------------------
BASELINE_RMSE = 38.51
BASELINE_R2 = 0.97

# --- Model inputs, in the order the models expect --------------------------
FARE_TIP_FEATURES = [
    "trip_distance",
    "pu_location_id",
    "do_location_id",
    "passenger_count",
    "ratecode_id",
    "hour",
    "day_of_week",
    "month",
    "temperature_f",
    "precipitation_mm",
    "is_rush_hour",
    "is_weekend",
    "is_raining",
    "is_cold",
]
DEMAND_FEATURES = [
    "pu_location_id",
    "hour",
    "day_of_week",
    "month",
    "temperature_f",
    "precipitation_mm",
    "is_weekend",
    "is_rush_hour",
    "is_transient_weekend_night",
    "is_cold",
    "is_raining",
    "is_holiday",
    "demand_lag1h",
    "demand_lag2h",
    "demand_lag24h",
    "demand_lag48h",
    "demand_lag168h",
    "demand_vmo_3day",
    "is_airport",
    "is_manhattan_core",
    "airport_rush_hour",
    "manhattan_weekend",
    "airport_cold",
    "manhattan_rain",
]

# --- Column contracts (name -> Spark simpleString) -------------------------
CORE_CONTRACT = {
    "taxi_type": "string",
    "vendor_id": "tinyint",
    "pickup_datetime": "timestamp",
    "dropoff_datetime": "timestamp",
    "pickup_hour": "timestamp",
    "pickup_date": "date",
    "pickup_year_month": "string",
    "pu_location_id": "smallint",
    "do_location_id": "smallint",
    "passenger_count": "smallint",
    "trip_distance": "float",
    "ratecode_id": "tinyint",
    "payment_type": "tinyint",
    "fare_amount": "decimal(12,2)",
    "extra": "decimal(12,2)",
    "mta_tax": "decimal(12,2)",
    "tip_amount": "decimal(12,2)",
    "tolls_amount": "decimal(12,2)",
    "improvement_surcharge": "decimal(12,2)",
    "total_amount": "decimal(12,2)",
    "congestion_surcharge": "decimal(12,2)",
    "airport_fee": "decimal(12,2)",
    "temperature_f": "float",
    "humidity_percent": "float",
    "precipitation_mm": "float",
    "weather_code": "smallint",
    "wind_speed_kmh": "float",
    "wind_direction_deg": "float",
    "cloud_cover_percent": "float",
    "is_valid_distance": "boolean",
    "is_valid_fare": "boolean",
    "is_valid_total_amount": "boolean",
    "is_outlier_trip": "boolean",
    "core_processed_timestamp": "timestamp",
}
CORE_REQUIRED = [
    "taxi_type", "vendor_id", "pickup_datetime", "dropoff_datetime", "pickup_hour",
    "pickup_date", "pu_location_id", "do_location_id", "trip_distance", "fare_amount",
    "total_amount", "temperature_f", "humidity_percent", "precipitation_mm",
    "weather_code", "wind_speed_kmh", "wind_direction_deg", "cloud_cover_percent",
    "pickup_year_month",
]
CORE_NULLABLE = [
    "passenger_count", "ratecode_id", "payment_type", "congestion_surcharge", "airport_fee",
]

DEMAND_CONTRACT = {
    "pu_location_id": "smallint",
    "pickup_hour": "timestamp",
    "demand": "int",
    "hour": "tinyint",
    "day_of_week": "tinyint",
    "month": "tinyint",
    "temperature_f": "float",
    "precipitation_mm": "float",
    "pickup_year_month": "string",
    "gold_processed_timestamp": "timestamp",
}
DEMAND_REQUIRED = [
    "pu_location_id", "pickup_hour", "demand", "hour", "day_of_week", "month",
    "temperature_f", "precipitation_mm", "pickup_year_month",
]

FARE_TIP_CONTRACT = {
    "fare_amount": "decimal(12,2)",
    "tip_amount": "decimal(12,2)",
    "tip_percent": "float",
    "trip_distance": "float",
    "pu_location_id": "smallint",
    "do_location_id": "smallint",
    "passenger_count": "smallint",
    "ratecode_id": "tinyint",
    "payment_type": "tinyint",
    "hour": "tinyint",
    "day_of_week": "tinyint",
    "month": "tinyint",
    "temperature_f": "float",
    "precipitation_mm": "float",
    "pickup_year_month": "string",
    "gold_processed_timestamp": "timestamp",
}
FARE_TIP_REQUIRED = [
    "fare_amount", "tip_amount", "tip_percent", "trip_distance", "pu_location_id",
    "do_location_id", "hour", "day_of_week", "month", "temperature_f",
    "precipitation_mm", "pickup_year_month",
]
FARE_TIP_NULLABLE = ["passenger_count", "ratecode_id", "payment_type"]

# Key that identifies one physical trip, independent of how it was delivered.
BUSINESS_KEY = [
    "taxi_type", "source_file", "vendor_id", "pickup_datetime", "dropoff_datetime",
    "pu_location_id", "do_location_id", "trip_distance", "fare_amount", "total_amount",
]
TRANSPORT_KEY = ["topic", "partition", "offset"]

# Columns of the envelope whose absence or nulls are profiled.
ENVELOPE_METADATA = [
    "topic", "partition", "offset", "kafka_timestamp", "key", "json_data",
    "ingestion_timestamp",
]
EXPECTED_PAYLOAD_FIELDS = {
    "yellow": ["tpep_pickup_datetime", "VendorID", "PULocationID"],
    "green": ["lpep_pickup_datetime", "trip_type"],
    "weather": ["timestamp", "temperature_f", "precipitation_mm"],
}
