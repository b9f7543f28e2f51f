"""hourglass: analytics over hourly sensor observations, expressed as Spark
DataFrame / SQL transformations and Structured Streaming jobs.

Layers: raw JSON / adapters -> bronze -> silver (expectations, quarantine,
dedup) -> gold (daily, regional, profile, wide) -> detectors (rolling and
seasonal z-scores, flatline runs, sensor health, network events, threshold
sweep) -> quality gates and reports.
"""

__all__ = ["session", "constants"]
