"""Domain constants.

FIXED VALUES — these must equal the reference application's values for
results to match: parameter codes, thresholds, standards, class names and
the wide-table column names. They are stated here once, in natural order.
"""

# Pollutant codes (floored at zero, get below_detection flags).
POLLUTANTS = ["PM2.5", "PM10", "NO2", "OZONE"]
# Weather codes (kept as measured).
WEATHER = ["TEMP", "HUMID", "WSP", "WDR", "RAIN"]
PARAMETERS = POLLUTANTS + WEATHER

# hourly_wide column per parameter code.
WIDE_COLUMNS = [
    ("PM2.5", "pm25"), ("PM10", "pm10"), ("NO2", "no2"), ("OZONE", "ozone"),
    ("TEMP", "temp_c"), ("HUMID", "humidity"), ("WSP", "wind_speed"),
    ("WDR", "wind_dir"), ("RAIN", "rainfall"),
]

# Illustrative daily standards (µg/m³) for exceedance days.
DAILY_STANDARDS = [("PM2.5", 25.0), ("PM10", 50.0)]
MIN_DAILY_COMPLETENESS = 75.0

# Fixed value: silver plausibility floor.
PLAUSIBLE_FLOOR = -20.0

# Rolling anomaly detector.
ANOMALY_WINDOW_ROWS = 168
UNUSUAL_Z = 3.0
EXTREME_Z = 5.0

# Network event classification.
MIN_STATIONS_REPORTING = 3
LOCALISED_FRACTION = 0.25
WIDESPREAD_FRACTION = 0.50
MIN_EPISODE_HOURS = 3
EVENT_CLASSES = ["insufficient_network", "quiet", "isolated_fault", "localised",
                 "widespread", "network_wide"]
EVENT_INTERPRETATION = [
    ("isolated_fault", "Single station - instrument fault likely"),
    ("localised", "Few stations - local source"),
    ("widespread", "Many stations - regional event"),
    ("network_wide", "Majority of network - severe regional event"),
    ("quiet", "No anomalies"),
]
EVENT_INTERPRETATION_OTHER = "Too few stations reporting to judge"

# Flatline detector minimum run (rows).
FLATLINE_MIN_ROWS = 6

# Sensor health thresholds (percent).
HEALTH_POOR_BELOW = 50.0
HEALTH_SUSPECT_ABOVE = 2.0
HEALTH_GAPPY_BELOW = 90.0

# Threshold sweep grid.
SWEEP_Z = [2.5, 3.0, 3.5, 4.0, 5.0]
SWEEP_WINDOWS = [72, 168, 336, 720]

# Wind-speed bands (m/s) and their labels.
WIND_BANDS = [(1.0, "1_still"), (3.0, "2_light"), (6.0, "3_moderate")]
WIND_BAND_OTHER = "4_strong"

# Drop-rate limit of the pipeline gate (percent).
MAX_DROP_RATE = 25.0

# Grain keys.
SILVER_GRAIN = ["site_id", "parameter_code", "obs_time"]
DAILY_GRAIN = ["site_id", "obs_date", "parameter_code"]
REGIONAL_GRAIN = ["region", "parameter_code", "month_start"]
WIDE_GRAIN = ["site_id", "obs_time"]
