"""Adapter-scale parameters of the registered queries (shared by the Spark
catalog and the SQL oracle). The library defaults stay the reference
values; these differ only where the derived test data is too sparse for the
reference value to select anything (noted in the README)."""

EXCEEDANCE_MIN_COMPLETENESS = 10.0
FLATLINE_MIN_ROWS_ADAPTER = 3
SWEEP_SLICE = ("2024-01-01", "2024-01-08")
MONTH = ("2024-01-01", "2024-02-01")
# The dense records begin in February 2023.
DENSE_SWEEP_SLICE = ("2023-02-08", "2023-02-15")
DENSE_MONTH = ("2023-02-01", "2023-03-01")
LOOKUP = (1, "PM2.5", "2024-01-05")
DIURNAL = ("NO2", "Africa")
TREND_POLLUTANT = "PM2.5"
MAP_YEAR = 2024
# Episodes of hours with any anomalous station (the reference-default
# episodes need >= 25 % of stations for 3 hours, which this data never has).
EPISODE_CLASSES_ADAPTER = ("isolated_fault", "localised", "widespread", "network_wide")
EPISODE_MIN_HOURS_ADAPTER = 2
