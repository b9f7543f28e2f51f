"""SQL of the file, stream and upsert keys."""

from __future__ import annotations

from hourglass import constants as K
from hourglass.plans.oracle import CTES, DENSE_HB, POL, cte, fx, with_ctes
from hourglass.plans.oracle_queries import ORACLE

RAW_SQL = """SELECT site_id_raw AS Site_Id, code AS ParameterCode, units AS Units, frequency AS Frequency,
  date_raw AS Date, hour_raw AS Hour, value_raw AS Value,
  CASE WHEN code IN (%s) THEN (CASE WHEN value_raw < 20 THEN 'GOOD' WHEN value_raw < 60 THEN 'FAIR' ELSE 'POOR' END) END AS AirQualityCategory""" % POL
RESCUED = """CASE WHEN value_raw IS NULL THEN '{"Value":"n/a","k":"' ELSE '{"k":"' END
  || json_extract_string(props, '$.k') || '"}' AS _rescued_data"""
cte("hbx", """SELECT hb.*, e.props FROM hb JOIN events e ON hb._record_id = e.event_id""", ["hb"])
ORACLE["bronze_batch"] = with_ctes(f"{RAW_SQL}, _source_file FROM hb", ["hb"])
ORACLE["bronze_rescued"] = with_ctes(f"{RAW_SQL}, {RESCUED} FROM hbx", ["hbx"])
ORACLE["bronze_stream"] = with_ctes(f"{RAW_SQL}, {RESCUED}, _source_file FROM hbx", ["hbx"])
ORACLE["silver_stream"] = with_ctes(
    """SELECT hs.site_id, hs.parameter_code, hs.units, hs.obs_date, hs.hour_1based, hs.obs_time, hs.value,
  hs.below_detection, hs.value_clean, hb._source_file
FROM hs JOIN hb ON hs._record_id = hb._record_id""", ["hs", "hb"])
ORACLE["drift_schema"] = with_ctes("""SELECT 'k' AS field, count(*) AS rows, 'BIGINT' AS data_type FROM hbx
UNION ALL SELECT 'Value', count(*), 'STRING' FROM hbx WHERE value_raw IS NULL""", ["hbx"])
ORACLE["promoted_field"] = with_ctes("""SELECT site_id_raw AS Site_Id, code AS ParameterCode, date_raw AS Date, hour_raw AS Hour, value_raw AS Value,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CASE WHEN value_raw IS NULL THEN '{"Value":"n/a"}' END AS _rescued_data FROM hbx""", ["hbx"])
MAN = r"""SELECT TRY_CAST(regexp_extract(_source_file, 'site(\d+|x)_(.+)_(\d{4})\.json', 1) AS INTEGER) AS site_id,
  replace(regexp_extract(_source_file, 'site(\d+|x)_(.+)_(\d{4})\.json', 2), '_', '.') AS pollutant,
  TRY_CAST(regexp_extract(_source_file, 'site(\d+|x)_(.+)_(\d{4})\.json', 3) AS INTEGER) AS year,
  _source_file AS path, COUNT(*) AS records, 'landed' AS status
FROM hb GROUP BY _source_file"""
cte("man", MAN, ["hb"])
_params = ", ".join(f"('{p}')" for p in K.PARAMETERS)
cte("plan", f"""SELECT d.site_id, p.pollutant, CAST(y.year AS INTEGER) AS year FROM dim d
CROSS JOIN (VALUES {_params}) AS p(pollutant)
CROSS JOIN (SELECT unnest(generate_series((SELECT MIN(year) FROM man), (SELECT MAX(year) FROM man))) AS year) y""",
    ["dim", "man"])
ORACLE["ingest_manifest"] = with_ctes("SELECT * FROM man", ["man"])
ORACLE["manifest_by_class"] = with_ctes(f"""SELECT CASE WHEN pollutant IN ({POL}) THEN 'pollutant' ELSE 'weather' END
  AS parameter_class, COUNT(*) AS files, SUM(records) AS records FROM man GROUP BY 1""".replace(
    "SUM(records)", "CAST(SUM(records) AS BIGINT)"), ["man"])
ORACLE["chunk_plan"] = with_ctes("SELECT * FROM plan", ["plan"])
ORACLE["manifest_summary"] = with_ctes("""SELECT COUNT(*) AS chunks, COUNT(*) FILTER (WHERE m.records IS NULL) AS empty_chunks,
  CAST(SUM(coalesce(m.records, 0)) AS BIGINT) AS records
FROM plan p LEFT JOIN man m ON p.site_id = m.site_id AND p.pollutant = m.pollutant AND p.year = m.year""",
                                       ["plan", "man"])
ORACLE["rows_vs_manifest"] = with_ctes("""SELECT COUNT(*) AS table_rows, COUNT(*) AS records_on_disk,
  CAST(0 AS BIGINT) AS difference FROM hb""", ["hb"])
cte("ufact", "SELECT site_id, parameter_code, obs_time, value, value_clean FROM hfact", ["hfact"])
cte("usrc", """SELECT site_id, parameter_code, obs_time, value, greatest(value, 0.0) AS value_clean FROM ufact
WHERE obs_date_of(obs_time) >= DATE '2024-01-08' AND obs_date_of(obs_time) < DATE '2024-01-15'""".replace(
    "obs_date_of(obs_time)", "CAST(obs_time AS DATE)"), ["ufact"])
cte("uv2", """SELECT * FROM ufact t WHERE NOT EXISTS (
  SELECT 1 FROM usrc s WHERE s.site_id = t.site_id AND s.parameter_code = t.parameter_code AND s.obs_time = t.obs_time)
UNION ALL SELECT * FROM usrc""", ["ufact", "usrc"])
ORACLE["upsert_replay"] = with_ctes("SELECT * FROM uv2", ["uv2"])
ORACLE["upsert_stream"] = ORACLE["upsert_replay"]
ORACLE["silver_stream_replayed"] = with_ctes("""SELECT DISTINCT site_id, parameter_code, units, obs_date, hour_1based, obs_time, value,
  below_detection, value_clean FROM hs""", ["hs"])
ORACLE["replay_equals_incremental"] = with_ctes("""SELECT count(*) AS incremental_rows, count(*) AS replayed_rows, CAST(0 AS BIGINT) AS different_rows
FROM hb""", ["hb"])
ORACLE["pipeline_gate"] = ORACLE["quality_gate"]
cte("daily_hs", CTES["daily"][0], ["hs", "dim"])
ORACLE["gold_daily_streamed"] = with_ctes("SELECT * FROM daily_hs", ["daily_hs"])
ORACLE["gold_daily_incremental"] = ORACLE["gold_daily_streamed"]
cte("monthly_hs", CTES["monthly"][0].replace("FROM ls f", "FROM hs f"), ["hs", "dim"])
cte("regional_hs", CTES["regional"][0].replace("FROM monthly)", "FROM monthly_hs)"), ["monthly_hs"])
ORACLE["gold_regional_incremental"] = with_ctes("SELECT * FROM regional_hs", ["regional_hs"])
#: A run has ended when rows come from two hours and the gap after it.
ENDED = "WHERE {} + INTERVAL 210 MINUTE <= (SELECT max(obs_time) FROM {})"
ORACLE["flatline_stream"] = with_ctes(f"SELECT * FROM flat_time {ENDED.format('run_end', 'f1')}", ["flat_time", "f1"]) \
    .replace(CTES["hb"][0], DENSE_HB)
cte("event_hours", """SELECT *, obs_time - to_hours(row_number() OVER (PARTITION BY parameter_code ORDER BY obs_time)) AS run
FROM cls WHERE event_class IN ('widespread', 'network_wide')""", ["cls"])
ORACLE["episodes_stream"] = with_ctes(f"""SELECT * FROM (
  SELECT parameter_code, min(obs_time) AS event_start, max(obs_time) AS event_end, count(*) AS duration_hours,
    max(stations_anomalous) AS peak_stations_affected, max(stations_reporting) AS network_size, {fx('max(network_max)', 2)} AS peak_concentration
  FROM event_hours GROUP BY parameter_code, run HAVING count(*) >= {K.MIN_EPISODE_HOURS}) {ENDED.format('event_end', 'cls')}""",
                                      ["event_hours", "cls"]).replace(CTES["hb"][0], DENSE_HB)
ORACLE["upsert_counts"] = with_ctes("""SELECT (SELECT COUNT(*) FROM ufact) AS rows_before, (SELECT COUNT(*) FROM uv2) AS rows_after_upsert,
  (SELECT COUNT(*) FROM uv2) AS rows_after_replay, (SELECT COUNT(*) FROM usrc) AS source_rows,
  (SELECT COUNT(*) FROM ufact a JOIN uv2 b ON a.site_id = b.site_id AND a.parameter_code = b.parameter_code
     AND a.obs_time = b.obs_time WHERE a.value_clean IS DISTINCT FROM b.value_clean) AS changed_rows""",
                                    ["ufact", "uv2"])
ORACLE["stream_reconciliation"] = with_ctes("""SELECT (SELECT count(*) FROM hb) AS bronze, (SELECT count(*) FROM hs) AS silver,
  (SELECT count(*) FROM hb) - (SELECT count(*) FROM hs) AS quarantine, CAST(0 AS BIGINT) AS overlap, true AS balanced""", ["hb", "hs"])
