from hourglass.functions.exprs import (  # noqa: F401
    fixed, pct, safe_div, passes, obs_time_from, anomaly_class, event_class,
    health_status, wind_band, rain_condition, run_type, interpretation,
)
