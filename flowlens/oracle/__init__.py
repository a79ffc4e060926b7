"""Independent DuckDB answers for the registered queries.

Each entry is the shared prefix (``prefix.prefix()``) followed by one SELECT.
Views ``events`` etc. are the driver tables.  Column names equal the Spark
output; every rounded value is exact integer arithmetic cast to DOUBLE.
"""

from __future__ import annotations

from ..functions import lookups as L
from .prefix import half_even, half_up, prefix, q

HU, HE = half_up, half_even


def _bodies() -> dict[str, str]:
    b: dict[str, str] = {}
    # ------------------------------------------------------------ cleaning
    b["clean_flows"] = """
SELECT event_id, source_ip, source_port, destination_ip, destination_port, protocol,
  timestamp, flow_duration, fwd_packets, bwd_packets, fwd_bytes, bwd_bytes,
  flow_bytes_per_sec, flow_packets_per_sec, label, attack_category, severity,
  source_country, source_region
FROM flows"""
    b["validate_flow"] = """
SELECT event_id, source_ip, label, _error FROM checked WHERE _error IS NOT NULL"""
    b["clean_stats"] = """
SELECT (SELECT COUNT(*) FROM events) AS rows_before, (SELECT COUNT(*) FROM flows) AS rows_after,
  (SELECT COUNT(*) FROM events) - (SELECT COUNT(*) FROM flows) AS rows_dropped"""
    # ------------------------------------------------------------ models
    b["dim_time"] = """
SELECT DISTINCT minute AS timestamp, CAST(hour(minute) AS INTEGER) AS hour,
  CAST(day(minute) AS INTEGER) AS day, CAST(weekofyear(minute) AS INTEGER) AS week,
  CAST(month(minute) AS INTEGER) AS month, CAST(year(minute) AS INTEGER) AS year,
  dayname(minute) AS day_of_week, is_weekend,
  CASE WHEN hour(minute) BETWEEN 6 AND 11 THEN 'Morning'
       WHEN hour(minute) BETWEEN 12 AND 17 THEN 'Afternoon'
       WHEN hour(minute) BETWEEN 18 AND 22 THEN 'Evening' ELSE 'Night' END AS time_of_day
FROM ev"""
    b["dim_source"] = """
SELECT source_ip, source_port, arg_min(source_country, event_id) AS country,
  arg_min(source_region, event_id) AS region,
  CASE WHEN TRY_CAST(split_part(source_ip, '.', 1) AS INTEGER) IS NULL THEN 'Unknown'
       WHEN TRY_CAST(split_part(source_ip, '.', 1) AS INTEGER) < 128 THEN 'A'
       WHEN TRY_CAST(split_part(source_ip, '.', 1) AS INTEGER) < 192 THEN 'B'
       WHEN TRY_CAST(split_part(source_ip, '.', 1) AS INTEGER) < 224 THEN 'C'
       WHEN TRY_CAST(split_part(source_ip, '.', 1) AS INTEGER) < 240 THEN 'D' ELSE 'E' END AS ip_class
FROM ev GROUP BY source_ip, source_port"""
    b["dim_destination"] = """
SELECT DISTINCT destination_ip AS dest_ip, destination_port AS dest_port, service_name, service_type
FROM ev"""
    b["dim_attack"] = "SELECT attack_label, attack_category, severity FROM da"
    b["dim_protocol"] = "SELECT protocol_name, transport_layer FROM dp"
    b["fact_network_event"] = """
SELECT event_id, minute, source_ip, source_port, destination_ip AS dest_ip,
  destination_port AS dest_port, label AS attack_label, protocol AS protocol_name,
  flow_duration, fwd_packets, bwd_packets, fwd_bytes, bwd_bytes,
  CAST(round(flow_bytes_per_sec, 4) AS DOUBLE) AS flow_bytes_per_sec,
  CAST(round(flow_packets_per_sec, 4) AS DOUBLE) AS flow_pkts_per_sec, is_attack
FROM ev"""
    b["flow_document"] = """
SELECT event_id, timestamp,
  CAST(hour(timestamp) AS INTEGER) AS time_hour, CAST(day(timestamp) AS INTEGER) AS time_day,
  CAST(weekofyear(timestamp) AS INTEGER) AS time_week, CAST(month(timestamp) AS INTEGER) AS time_month,
  CAST(year(timestamp) AS INTEGER) AS time_year, dayname(timestamp) AS time_day_of_week,
  is_weekend AS time_is_weekend,
  CASE WHEN hour(timestamp) BETWEEN 6 AND 11 THEN 'Morning'
       WHEN hour(timestamp) BETWEEN 12 AND 17 THEN 'Afternoon'
       WHEN hour(timestamp) BETWEEN 18 AND 22 THEN 'Evening' ELSE 'Night' END AS time_time_of_day,
  source_ip AS source_ip, source_port AS source_port, source_country AS source_country,
  source_region AS source_region,
  destination_ip AS destination_ip, destination_port AS destination_port,
  service_name AS destination_service_name, service_type AS destination_service_type,
  label AS attack_label, attack_category AS attack_category, severity AS attack_severity,
  is_attack AS attack_is_attack,
  protocol AS protocol_name,
  """ + _transport("protocol") + """ AS protocol_transport_layer,
  flow_duration AS metrics_flow_duration, fwd_packets AS metrics_fwd_packets,
  bwd_packets AS metrics_bwd_packets, fwd_bytes AS metrics_fwd_bytes,
  bwd_bytes AS metrics_bwd_bytes, flow_bytes_per_sec AS metrics_flow_bytes_per_sec,
  flow_packets_per_sec AS metrics_flow_pkts_per_sec
FROM ev"""
    b["doc_hourly_summary"] = """
SELECT hour_bucket, attack_label, event_count, total_bytes, attack_category FROM dhs"""
    # graph vertices / edges
    b["v_source_ip"] = """
SELECT source_ip AS ip, arg_min(source_country, event_id) AS country,
  arg_min(source_region, event_id) AS region FROM ev GROUP BY source_ip"""
    b["v_destination_ip"] = """
SELECT destination_ip AS ip, arg_min(service_name, event_id) AS service_name,
  arg_min(service_type, event_id) AS service_type FROM ev GROUP BY destination_ip"""
    b["v_attack_type"] = """
SELECT label, arg_min(attack_category, event_id) AS category, arg_min(severity, event_id) AS severity
FROM ev GROUP BY label"""
    b["v_protocol"] = "SELECT DISTINCT protocol AS name, " + _transport("protocol") + " AS transport_layer FROM ev"
    b["v_time_window"] = """
SELECT strftime(hour_bucket, '%Y-%m-%dT%H:00:00') AS hour_bucket,
  CAST(isodow(hour_bucket) - 1 AS INTEGER) AS day_of_week, CAST(month(hour_bucket) AS INTEGER) AS month,
  CAST(year(hour_bucket) AS INTEGER) AS year
FROM (SELECT DISTINCT hour_bucket FROM ev)"""
    b["e_attacked"] = """
SELECT source_ip AS src_ip, destination_ip AS dst_ip, COUNT(*) AS count,
  CAST(SUM(total_bytes) AS BIGINT) AS total_bytes, MIN(timestamp) AS first_seen, MAX(timestamp) AS last_seen
FROM ev GROUP BY source_ip, destination_ip"""
    b["e_used_attack"] = """
SELECT source_ip AS src_ip, label, COUNT(*) AS count, MIN(timestamp) AS first_seen,
  MAX(timestamp) AS last_seen FROM ev GROUP BY source_ip, label"""
    b["e_targeted_by"] = """
SELECT destination_ip AS dst_ip, label, COUNT(*) AS count FROM ev GROUP BY destination_ip, label"""
    b["e_used_protocol"] = """
SELECT source_ip AS src_ip, protocol, COUNT(*) AS count FROM ev GROUP BY source_ip, protocol"""
    b["e_active_in"] = """
SELECT label, strftime(hour_bucket, '%Y-%m-%dT%H:00:00') AS hour_bucket, COUNT(*) AS event_count
FROM ev GROUP BY label, hour_bucket"""
    b["graph_counts"] = """
SELECT 'nodes' AS kind, (SELECT COUNT(DISTINCT source_ip) FROM ev) + (SELECT COUNT(DISTINCT destination_ip) FROM ev)
  + (SELECT COUNT(DISTINCT label) FROM ev) + (SELECT COUNT(DISTINCT protocol) FROM ev)
  + (SELECT COUNT(DISTINCT hour_bucket) FROM ev) AS n
UNION ALL
SELECT 'relationships', (SELECT COUNT(*) FROM (SELECT DISTINCT source_ip, destination_ip FROM ev))
  + (SELECT COUNT(*) FROM (SELECT DISTINCT source_ip, label FROM ev))
  + (SELECT COUNT(*) FROM (SELECT DISTINCT destination_ip, label FROM ev))
  + (SELECT COUNT(*) FROM (SELECT DISTINCT source_ip, protocol FROM ev))
  + (SELECT COUNT(*) FROM (SELECT DISTINCT label, hour_bucket FROM ev))"""
    b["summary_hourly_incremental"] = b["doc_hourly_summary"]
    b["edge_merge_two_batches"] = b["e_attacked"]
    b["surrogate_key"] = """
SELECT source_ip, source_port, MIN(event_id) FILTER (WHERE late = first_late) AS first_arrival,
  row_number() OVER (ORDER BY any_value(first_late), MIN(event_id) FILTER (WHERE late = first_late)) AS serial
FROM (SELECT *, hour(timestamp) >= 12 AS late, MIN(hour(timestamp) >= 12) OVER (PARTITION BY source_ip, source_port) AS first_late FROM ev)
GROUP BY source_ip, source_port"""
    b["unique_sources_daily"] = """
SELECT CAST(timestamp AS DATE) AS day_bucket, label AS attack_label, COUNT(DISTINCT (source_ip, source_port)) AS unique_sources
FROM ev GROUP BY 1, 2"""
    dims = {"dim_time": "SELECT DISTINCT minute FROM ev", "dim_source": "SELECT DISTINCT source_ip, source_port FROM ev",
            "dim_destination": "SELECT DISTINCT destination_ip, destination_port FROM ev", "dim_attack": "SELECT attack_label FROM da",
            "dim_protocol": "SELECT protocol_name FROM dp"}
    b["audit_keys"] = " UNION ALL ".join(f"""
SELECT '{name}' AS dimension, (SELECT COUNT(*) FROM ({keys})) AS n_keys, CAST(0 AS BIGINT) AS n_duplicated, CAST(0 AS BIGINT) AS n_orphans,
  (SELECT COUNT(*) FROM ev) AS n_fact_rows, CAST(0 AS BIGINT) AS n_orphan_rows""" for name, keys in dims.items())
    b["dim_upsert_two_batches"] = """
SELECT source_ip, source_port, arg_min(source_country, k) AS country, arg_min(source_region, k) AS region,
  CASE WHEN TRY_CAST(split_part(source_ip, '.', 1) AS INTEGER) IS NULL THEN 'Unknown'
       WHEN TRY_CAST(split_part(source_ip, '.', 1) AS INTEGER) < 128 THEN 'A'
       WHEN TRY_CAST(split_part(source_ip, '.', 1) AS INTEGER) < 192 THEN 'B'
       WHEN TRY_CAST(split_part(source_ip, '.', 1) AS INTEGER) < 224 THEN 'C'
       WHEN TRY_CAST(split_part(source_ip, '.', 1) AS INTEGER) < 240 THEN 'D' ELSE 'E' END AS ip_class
FROM (SELECT *, (CASE WHEN hour(timestamp) < 12 THEN 0 ELSE 1 END, event_id) AS k FROM ev)
GROUP BY source_ip, source_port"""
    # ------------------------------------------------------------ summaries
    b["summary_attack_hourly"] = """
SELECT hour_bucket, attack_category, attack_label, event_count, total_bytes,
  CAST(avg_cents AS DOUBLE) / 100 AS avg_duration_ms, CAST(unique_sources AS BIGINT) AS unique_sources
FROM sah"""
    b["summary_top_sources"] = """
SELECT day_bucket, source_ip, country, CAST(attack_count AS BIGINT) AS attack_count,
  CAST(distinct_targets AS BIGINT) AS distinct_targets, primary_attack,
  CAST(score_cents AS DOUBLE) / 100 AS threat_score FROM sts"""
    b["summary_protocol_daily"] = f"""
SELECT day_bucket, protocol_name, total_events, attack_events,
  {HU('attack_events', 'total_events', 4)} AS attack_ratio FROM spd"""
    b["summary_severity_daily"] = """
SELECT day_bucket, severity, event_count, CAST(unique_sources AS BIGINT) AS unique_sources FROM ssd"""
    b["summary_dest_port_daily"] = """
SELECT day_bucket, dest_port, service_name, attack_category, event_count FROM sdp"""
    b["summary_weekend_weekday"] = f"""
SELECT is_weekend, attack_category, total_events, attack_events,
  {HU('attack_events * 100', 'total_events')} AS attack_rate_pct FROM sww"""
    b |= {f"{name}_refreshed": body for name, body in b.items() if name.startswith("summary_")}  # however it was kept up to date
    # ------------------------------------------------------------ Q _s
    b["q1_s"] = """
SELECT attack_category, CAST(SUM(event_count) AS BIGINT) AS total_events FROM sah
WHERE attack_category <> 'Normal' GROUP BY attack_category"""
    b["q2_s"] = """
SELECT hour_bucket, attack_category, CAST(SUM(event_count) AS BIGINT) AS event_count FROM sah
WHERE attack_category <> 'Normal' GROUP BY hour_bucket, attack_category"""
    b["q3_s"] = """
SELECT source_ip, country, CAST(SUM(attack_count) AS BIGINT) AS total_attacks,
  CAST(SUM(distinct_targets) AS BIGINT) AS total_targets,
  CAST(MAX(score_cents) AS DOUBLE) / 100 AS max_threat_score
FROM sts WHERE attack_count > 0 GROUP BY source_ip, country
ORDER BY total_attacks DESC, source_ip, country LIMIT 10"""
    b["q3_s_avg"] = f"""
SELECT source_ip, country, CAST(SUM(attack_count) AS BIGINT) AS total_attacks,
  CAST(SUM(distinct_targets) AS BIGINT) AS total_targets,
  {HU('SUM(score_cents)', 'COUNT(*) * 100')} AS threat_score
FROM sts WHERE attack_count > 0 GROUP BY source_ip, country
ORDER BY total_attacks DESC, source_ip, country LIMIT 10"""
    b["q4_s"] = f"""
SELECT attack_category, event_count, {HU('event_count * 100', 'SUM(event_count) OVER ()')} AS pct
FROM (SELECT attack_category, CAST(SUM(event_count) AS BIGINT) AS event_count FROM sah
      GROUP BY attack_category)"""
    b["q5_s"] = f"""
SELECT protocol_name, total_events, attack_events,
  {HU('attack_events * 100', 'total_events')} AS attack_pct
FROM (SELECT protocol_name, CAST(SUM(total_events) AS BIGINT) AS total_events,
  CAST(SUM(attack_events) AS BIGINT) AS attack_events FROM spd GROUP BY protocol_name)"""
    b["q6_s"] = """
SELECT dest_port, service_name, CAST(SUM(event_count) AS BIGINT) AS attack_count FROM sdp
GROUP BY dest_port, service_name ORDER BY attack_count DESC, dest_port, service_name LIMIT 15"""
    b["q7_s"] = f"""
SELECT attack_label, attack_category, CAST(SUM(event_count) AS BIGINT) AS event_count,
  {HU('SUM(avg_cents * event_count)', 'SUM(event_count) * 100')} AS avg_duration_ms,
  {HU('SUM(total_bytes)', 'SUM(event_count)')} AS avg_total_bytes
FROM sah WHERE attack_category <> 'Normal' GROUP BY attack_label, attack_category"""
    b["q9_s"] = f"""
SELECT country, CAST(SUM(attack_count) AS BIGINT) AS attack_events,
  COUNT(DISTINCT source_ip) AS unique_ips,
  {HU('SUM(score_cents)', 'COUNT(*) * 100')} AS avg_threat_score
FROM sts GROUP BY country"""
    b["q10_s"] = "SELECT day_bucket AS day, severity, event_count FROM ssd"
    b["q11_s"] = f"""
SELECT is_weekend, attack_category, total_events, attack_events,
  {HU('attack_events * 100', 'total_events')} AS attack_rate_pct FROM sww"""
    b["q12_s"] = """
SELECT hour_bucket, CAST(SUM(event_count) AS BIGINT) AS bot_events,
  CAST(SUM(unique_sources) AS BIGINT) AS unique_bot_sources,
  CAST(SUM(total_bytes) AS BIGINT) AS total_bytes
FROM sah WHERE attack_category = 'Botnet' GROUP BY hour_bucket"""
    # ------------------------------------------------------------ Q _f
    b["q1_f"] = """
SELECT d_category AS attack_category, COUNT(*) AS total_events FROM fe WHERE is_attack
GROUP BY d_category"""
    b["q2_f"] = """
SELECT hour_bucket, d_category AS attack_category, COUNT(*) AS event_count FROM fe WHERE is_attack
GROUP BY hour_bucket, d_category"""
    b["q3_f"] = """
SELECT source_ip, source_country AS country, COUNT(*) AS total_attacks FROM fe WHERE is_attack
GROUP BY source_ip, source_country ORDER BY total_attacks DESC, source_ip, country LIMIT 10"""
    b["q4_f"] = f"""
SELECT attack_category, event_count, {HU('event_count * 100', 'SUM(event_count) OVER ()')} AS pct
FROM (SELECT d_category AS attack_category, COUNT(*) AS event_count FROM fe GROUP BY d_category)"""
    b["q5_f"] = f"""
SELECT protocol_name, total_events, attack_events, {HU('attack_events * 100', 'total_events')} AS attack_pct
FROM (SELECT protocol AS protocol_name, COUNT(*) AS total_events,
  COUNT(*) FILTER (WHERE is_attack) AS attack_events FROM fe GROUP BY protocol)"""
    b["q6_f"] = """
SELECT destination_port AS dest_port, service_name, COUNT(*) AS attack_count FROM fe WHERE is_attack
GROUP BY destination_port, service_name ORDER BY attack_count DESC, dest_port, service_name LIMIT 15"""
    b["q7_f"] = f"""
SELECT label AS attack_label, d_category AS attack_category, COUNT(*) AS event_count,
  {HU('SUM(flow_duration)', 'COUNT(*) * 1000')} AS avg_duration_ms,
  {HU('SUM(total_bytes)', 'COUNT(*)')} AS avg_total_bytes
FROM fe WHERE is_attack GROUP BY label, d_category"""
    pc = """(SELECT source_ip AS ip, source_port AS port, label, COUNT(*) AS c FROM fe WHERE is_attack
  GROUP BY source_ip, source_port, label)"""
    b["q8_f"] = f"""
SELECT a.ip AS ip1, b.ip AS ip2, a.label AS shared_attack, CAST(SUM(a.c * b.c) AS DOUBLE) AS co_count
FROM {pc} a JOIN {pc} b ON a.label = b.label AND (a.ip < b.ip OR (a.ip = b.ip AND a.port < b.port))
GROUP BY a.ip, b.ip, a.label
ORDER BY co_count DESC, ip1, ip2, shared_attack LIMIT 20"""
    b["q9_f"] = """
SELECT source_country AS country, COUNT(*) AS attack_events, COUNT(DISTINCT source_ip) AS unique_ips
FROM fe WHERE is_attack GROUP BY source_country"""
    b["q10_f"] = """
SELECT day_bucket, d_severity AS severity, COUNT(*) AS event_count FROM fe WHERE is_attack
GROUP BY day_bucket, d_severity"""
    b["q11_f"] = f"""
SELECT is_weekend, attack_category, total_events, attack_events,
  {HU('attack_events * 100', 'total_events')} AS attack_rate_pct
FROM (SELECT is_weekend, d_category AS attack_category, COUNT(*) AS total_events,
  COUNT(*) FILTER (WHERE is_attack) AS attack_events FROM fe GROUP BY is_weekend, d_category)"""
    b["q12_f"] = """
SELECT hour_bucket, COUNT(*) AS bot_events, CAST(SUM(total_bytes) AS BIGINT) AS total_bytes
FROM fe WHERE d_category = 'Botnet' GROUP BY hour_bucket"""
    # ------------------------------------------------------------ Q _d
    b["q1_d"] = """
SELECT attack_category, COUNT(*) AS total_events FROM ev WHERE is_attack GROUP BY attack_category"""
    b["q1_ds"] = """
SELECT attack_category, CAST(SUM(event_count) AS BIGINT) AS total_events FROM dhs
WHERE attack_category <> 'Normal' GROUP BY attack_category"""
    b["q2_d"] = """
SELECT hour_bucket, attack_category, COUNT(*) AS event_count FROM ev WHERE is_attack
GROUP BY hour_bucket, attack_category"""
    b["q2_ds"] = """
SELECT hour_bucket, attack_category, CAST(SUM(event_count) AS BIGINT) AS event_count FROM dhs
WHERE attack_category <> 'Normal' GROUP BY hour_bucket, attack_category"""
    b["q3_d"] = """
SELECT source_ip, arg_min(source_country, event_id) AS country, COUNT(*) AS total_attacks
FROM ev WHERE is_attack GROUP BY source_ip ORDER BY total_attacks DESC, source_ip LIMIT 10"""
    b["q4_d"] = "SELECT attack_category, COUNT(*) AS event_count FROM ev GROUP BY attack_category"
    b["q4_ds"] = """
SELECT attack_category, CAST(SUM(event_count) AS BIGINT) AS event_count FROM dhs GROUP BY attack_category"""
    b["q5_d"] = f"""
SELECT protocol_name, total_events, attack_events,
  {HE('attack_events * 100', 'greatest(total_events, 1)')} AS attack_pct
FROM (SELECT protocol AS protocol_name, COUNT(*) AS total_events,
  COUNT(*) FILTER (WHERE is_attack) AS attack_events FROM ev GROUP BY protocol)"""
    b["q6_d"] = """
SELECT destination_port AS dest_port, service_name, COUNT(*) AS attack_count FROM ev WHERE is_attack
GROUP BY destination_port, service_name ORDER BY attack_count DESC, dest_port, service_name LIMIT 15"""
    b["q7_d"] = f"""
SELECT label AS attack_label, attack_category, COUNT(*) AS event_count,
  {HE('SUM(flow_duration)', 'COUNT(*) * 1000')} AS avg_duration_ms,
  {HE('SUM(total_bytes)', 'COUNT(*)')} AS avg_total_bytes
FROM ev WHERE is_attack GROUP BY label, attack_category"""
    b["q9_d"] = """
SELECT source_country AS country, COUNT(*) AS attack_events, COUNT(DISTINCT source_ip) AS unique_ips
FROM ev WHERE is_attack GROUP BY source_country"""
    b["q10_d"] = """
SELECT strftime(timestamp, '%Y-%m-%d') AS day, severity, COUNT(*) AS event_count FROM ev WHERE is_attack
GROUP BY strftime(timestamp, '%Y-%m-%d'), severity"""
    b["q11_d"] = f"""
SELECT is_weekend, attack_category, total_events, attack_events,
  {HE('attack_events * 100', 'greatest(total_events, 1)')} AS attack_rate_pct
FROM (SELECT is_weekend, attack_category, COUNT(*) AS total_events,
  COUNT(*) FILTER (WHERE is_attack) AS attack_events FROM ev GROUP BY is_weekend, attack_category)"""
    b["q12_d"] = """
SELECT hour_bucket, COUNT(*) AS bot_events, CAST(SUM(total_bytes) AS BIGINT) AS total_bytes
FROM ev WHERE attack_category = 'Botnet' GROUP BY hour_bucket"""
    b["q12_ds"] = """
SELECT hour_bucket, CAST(SUM(event_count) AS BIGINT) AS bot_events, CAST(SUM(total_bytes) AS BIGINT) AS total_bytes
FROM dhs WHERE attack_category = 'Botnet' GROUP BY hour_bucket"""
    # ------------------------------------------------------------ Q _g
    vat = "(SELECT label, arg_min(attack_category, event_id) AS cat, arg_min(severity, event_id) AS sev FROM ev GROUP BY label)"
    b["q1_g"] = f"""
SELECT v.cat AS attack_category, COUNT(*) AS total_events FROM ev JOIN {vat} v USING (label)
WHERE v.cat <> 'Normal' GROUP BY v.cat"""
    b["q2_g"] = f"""
SELECT strftime(hour_bucket, '%Y-%m-%dT%H:00:00') AS hour_bucket, v.cat AS attack_category,
  COUNT(*) AS event_count FROM ev JOIN {vat} v USING (label) WHERE v.cat <> 'Normal'
GROUP BY 1, 2"""
    b["q3_g"] = f"""
SELECT source_ip, arg_min(source_country, event_id) AS country, COUNT(*) AS total_attacks
FROM ev JOIN {vat} v USING (label) WHERE v.cat <> 'Normal' GROUP BY source_ip
ORDER BY total_attacks DESC, source_ip LIMIT 10"""
    b["q4_g"] = f"""
SELECT v.cat AS attack_category, COUNT(*) AS event_count FROM ev JOIN {vat} v USING (label) GROUP BY v.cat"""
    b["q5_g"] = "SELECT protocol AS protocol_name, COUNT(*) AS total_events FROM ev GROUP BY protocol"
    b["q6_g"] = """
SELECT destination_ip AS dest_ip, arg_min(service_name, event_id) AS service_name, COUNT(*) AS attack_count
FROM ev GROUP BY destination_ip ORDER BY attack_count DESC, dest_ip LIMIT 15"""
    b["top_attacked_destinations"] = """
SELECT destination_ip AS dest_ip, arg_min(service_name, event_id) AS service_name, COUNT(*) AS hit_count
FROM ev GROUP BY destination_ip ORDER BY hit_count DESC, dest_ip LIMIT 10"""
    b["q7_g"] = f"""
SELECT label AS attack_label, v.cat AS attack_category, COUNT(*) AS event_count
FROM ev JOIN {vat} v USING (label) WHERE v.cat <> 'Normal' GROUP BY label, v.cat"""
    b["q9_g"] = f"""
SELECT country, CAST(SUM(n) AS BIGINT) AS attack_events, COUNT(*) AS unique_ips FROM (
  SELECT source_ip, arg_min(source_country, event_id) AS country, COUNT(*) AS n
  FROM ev JOIN {vat} v USING (label) WHERE v.cat <> 'Normal' GROUP BY source_ip) GROUP BY country"""
    b["q10_g"] = f"""
SELECT strftime(hour_bucket, '%Y-%m-%d') AS day, v.sev AS severity, COUNT(*) AS event_count
FROM ev JOIN {vat} v USING (label) WHERE v.cat <> 'Normal' GROUP BY 1, 2"""
    b["q11_g"] = f"""
SELECT isodow(hour_bucket) IN (6, 7) AS is_weekend, v.cat AS attack_category, COUNT(*) AS attack_events
FROM ev JOIN {vat} v USING (label) GROUP BY 1, 2"""
    b["q12_g"] = f"""
SELECT strftime(hour_bucket, '%Y-%m-%dT%H:00:00') AS hour_bucket, COUNT(*) AS bot_events
FROM ev JOIN {vat} v USING (label) WHERE v.cat = 'Botnet' GROUP BY 1"""
    # ------------------------------------------------------------ dashboard
    b["kpis"] = f"""
SELECT CAST(COALESCE(SUM(event_count), 0) AS BIGINT) AS total_events,
  CAST(COALESCE(SUM(event_count) FILTER (WHERE attack_category <> 'Normal'), 0) AS BIGINT) AS attack_events,
  CASE WHEN SUM(event_count) > 0 THEN {HU("SUM(event_count) FILTER (WHERE attack_category <> 'Normal') * 100", 'SUM(event_count)')}
       ELSE 0.0 END AS attack_rate,
  CAST(COALESCE(SUM(unique_sources) FILTER (WHERE attack_category <> 'Normal'), 0) AS BIGINT) AS unique_sources
FROM sah"""
    hj = "FROM sah JOIN dim_time_o dt ON sah.hour_bucket = dt.timestamp WHERE sah.attack_category <> 'Normal'"
    hh = """FROM (SELECT *, dayname(hour_bucket) AS day_of_week, CAST(hour(hour_bucket) AS INTEGER) AS hour,
  CAST(weekofyear(hour_bucket) AS INTEGER) AS week, CAST(year(hour_bucket) AS INTEGER) AS year,
  CASE WHEN hour(hour_bucket) BETWEEN 6 AND 11 THEN 'Morning'
       WHEN hour(hour_bucket) BETWEEN 12 AND 17 THEN 'Afternoon'
       WHEN hour(hour_bucket) BETWEEN 18 AND 22 THEN 'Evening' ELSE 'Night' END AS time_of_day
  FROM sah) x WHERE attack_category <> 'Normal'"""
    b["day_of_week_heatmap"] = f"""
SELECT day_of_week, hour, CAST(SUM(event_count) AS BIGINT) AS event_count {hj} GROUP BY day_of_week, hour"""
    b["day_of_week_heatmap_hour"] = f"""
SELECT day_of_week, hour, CAST(SUM(event_count) AS BIGINT) AS event_count {hh} GROUP BY day_of_week, hour"""
    cols = ", ".join(f"CAST(COALESCE(SUM(event_count) FILTER (WHERE hour = {i}), 0) AS BIGINT) AS h{i}"
                     for i in range(24))
    b["heatmap_pivot"] = f"SELECT day_of_week, {cols} {hj} GROUP BY day_of_week"
    b["time_of_day_distribution"] = f"""
SELECT time_of_day, sah.attack_category, CAST(SUM(event_count) AS BIGINT) AS event_count {hj}
GROUP BY time_of_day, sah.attack_category"""
    b["time_of_day_distribution_hour"] = f"""
SELECT time_of_day, attack_category, CAST(SUM(event_count) AS BIGINT) AS event_count {hh}
GROUP BY time_of_day, attack_category"""
    b["weekly_trend"] = f"""
SELECT year, week, sah.attack_category, CAST(SUM(event_count) AS BIGINT) AS event_count,
  printf('%d-W%02d', year, week) AS week_label {hj} GROUP BY year, week, sah.attack_category"""
    b["weekly_trend_hour"] = f"""
SELECT year, week, attack_category, CAST(SUM(event_count) AS BIGINT) AS event_count,
  printf('%d-W%02d', year, week) AS week_label {hh} GROUP BY year, week, attack_category"""
    b["country_summary"] = """
SELECT country, CAST(SUM(attack_count) AS BIGINT) AS attack_events, COUNT(DISTINCT source_ip) AS unique_ips
FROM sts GROUP BY country"""
    b["top_countries"] = b["country_summary"] + " ORDER BY attack_events DESC, country LIMIT 10"
    b["severity_totals"] = """
SELECT COALESCE(trim(severity), 'Unknown') AS severity, CAST(SUM(event_count) AS BIGINT) AS events
FROM ssd GROUP BY 1"""
    b["available_dates"] = "SELECT DISTINCT CAST(minute AS DATE) AS day FROM ev"
    b["distinct_categories"] = "SELECT DISTINCT attack_category FROM da"
    b["distinct_protocols"] = "SELECT DISTINCT protocol_name FROM dp"
    b["distinct_severities"] = "SELECT DISTINCT severity FROM da"
    b["weekend_label"] = f"""
SELECT is_weekend, attack_category, total_events, attack_events,
  {HU('attack_events * 100', 'total_events')} AS attack_rate_pct,
  CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS period FROM sww"""
    b["record_count"] = "SELECT COUNT(*) AS record_count FROM ev"
    b["dlq_report"] = """
SELECT _error, source_ip, label, COUNT(*) AS count FROM checked WHERE _error IS NOT NULL
GROUP BY _error, source_ip, label"""
    b["dlq_browse"] = """
SELECT event_id, source_ip, label, _error FROM checked WHERE _error IS NOT NULL
ORDER BY event_id LIMIT 200"""
    b["summary_top_sources_rank"] = """
SELECT b.day_bucket, b.source_ip, b.country, CAST(b.attack_count AS BIGINT) AS attack_count,
  CAST(b.distinct_targets AS BIGINT) AS distinct_targets, m.primary_attack,
  CAST((2 * CAST(b.attack_count * b.distinct_targets * b.w AS HUGEINT) * 100 + b.n) // (2 * b.n) AS DOUBLE) / 100
    AS threat_score
FROM (SELECT day_bucket, source_ip, source_country AS country,
        COUNT(*) FILTER (WHERE is_attack) AS attack_count, COUNT(*) AS n,
        COUNT(DISTINCT (destination_ip, destination_port)) AS distinct_targets,
        MAX(CASE d_severity WHEN 'CRITICAL' THEN 4 WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 ELSE 1 END) AS w
      FROM fe GROUP BY day_bucket, source_ip, source_country) b
JOIN sts_mode m USING (day_bucket, source_ip)"""
    b["q8_g"] = """
SELECT p.ip1, v1.country AS country1, p.ip2, v2.country AS country2, p.shared_attacks, p.shared_count
FROM (SELECT a.source_ip AS ip1, b.source_ip AS ip2, COUNT(*) AS shared_count,
        array_to_string(list_sort(list(a.label)), ',') AS shared_attacks
      FROM (SELECT DISTINCT source_ip, label FROM ev) a
      JOIN (SELECT DISTINCT source_ip, label FROM ev) b ON a.label = b.label AND a.source_ip < b.source_ip
      GROUP BY a.source_ip, b.source_ip) p
JOIN (SELECT source_ip, arg_min(source_country, event_id) AS country FROM ev GROUP BY source_ip) v1 ON v1.source_ip = p.ip1
JOIN (SELECT source_ip, arg_min(source_country, event_id) AS country FROM ev GROUP BY source_ip) v2 ON v2.source_ip = p.ip2
ORDER BY p.shared_count DESC, p.ip1, p.ip2 LIMIT 20"""
    sets = """(SELECT source_ip, string_agg(label, '|' ORDER BY label) AS label_set, list(label) AS labels
      FROM (SELECT DISTINCT source_ip, label FROM ev) GROUP BY source_ip)"""
    b["e_has_label_set"] = f"SELECT source_ip AS src_ip, label_set FROM {sets}"
    b["v_label_set"] = f"""
SELECT label_set, CAST(any_value(len(labels)) AS INTEGER) AS n_labels, COUNT(*) AS n_sources FROM {sets} GROUP BY label_set"""
    classes = f"(SELECT label_set, any_value(labels) AS labels, COUNT(*) AS n FROM {sets} GROUP BY label_set)"
    b["e_connected_to"] = f"""
SELECT set_a, set_b, array_to_string(list_sort(shared), ',') AS shared_attacks, CAST(len(shared) AS BIGINT) AS shared_count,
  CAST(n_pairs AS DOUBLE) AS n_pairs
FROM (SELECT x.label_set AS set_a, y.label_set AS set_b, list_intersect(x.labels, y.labels) AS shared,
        CASE WHEN x.label_set = y.label_set THEN x.n * (x.n - 1) // 2 ELSE x.n * y.n END AS n_pairs
      FROM {classes} x JOIN {classes} y ON x.label_set <= y.label_set)
WHERE len(shared) > 0 AND n_pairs > 0"""
    parts = {m: b[f"q1_{m}"] for m in ("s", "f", "d", "g")}
    b["model_reconcile"] = f"""
SELECT attack_category, s.total_events AS total_events_s, f.total_events AS total_events_f,
  d.total_events AS total_events_d, g.total_events AS total_events_g,
  COALESCE(f.total_events = s.total_events AND d.total_events = s.total_events
           AND g.total_events = s.total_events, false) AS agree
FROM ({parts['s']}) s FULL OUTER JOIN ({parts['f']}) f USING (attack_category)
  FULL OUTER JOIN ({parts['d']}) d USING (attack_category)
  FULL OUTER JOIN ({parts['g']}) g USING (attack_category)"""
    # ------------------------------------------------------------ streaming (batch answers)
    b["attack_rate_1min"] = """
SELECT attack_category, COUNT(*) AS event_count, date_trunc('minute', timestamp) AS window_start,
  date_trunc('minute', timestamp) + INTERVAL 1 MINUTE AS window_end
FROM ev WHERE attack_category <> 'Normal' GROUP BY attack_category, date_trunc('minute', timestamp)"""
    b["protocol_rate_1min"] = """
SELECT protocol, COUNT(*) AS event_count, date_trunc('minute', timestamp) AS window_start
FROM ev WHERE protocol IS NOT NULL GROUP BY protocol, date_trunc('minute', timestamp)"""
    hv = """
SELECT source_ip, COUNT(*) AS attack_count, time_bucket(INTERVAL 5 MINUTE, timestamp, TIMESTAMP '1970-01-01') AS window_start
FROM ev WHERE attack_category <> 'Normal' GROUP BY source_ip, 3 HAVING COUNT(*) > {t}"""
    b["high_volume_sources"] = hv.format(t=L.HIGH_VOLUME_THRESHOLD)
    b["high_volume_sources_t1"] = hv.format(t=1)
    # ------------------------------------------------------------ profiling of raw flows
    b["label_counts"] = """
SELECT label_raw AS label, COUNT(*) AS count FROM raw WHERE label_raw IS NOT NULL GROUP BY label_raw"""
    b["inf_profile"] = """
SELECT * FROM (SELECT 'flow_bytes_per_sec' AS column_name, COUNT(*) FILTER (WHERE isinf(flow_bytes_per_sec)) AS inf_count FROM raw
UNION ALL SELECT 'flow_packets_per_sec', COUNT(*) FILTER (WHERE isinf(flow_packets_per_sec)) FROM raw) WHERE inf_count > 0"""
    raw_cols = ["event_id", "source_file", "ts_raw", "src_ip_raw", "dst_ip_raw", "src_port", "dst_port",
                "protocol_raw", "flow_duration", "fwd_packets", "bwd_packets", "fwd_bytes", "bwd_bytes",
                "flow_bytes_per_sec", "flow_packets_per_sec", "label_raw"]
    src_of = {"src_ip_raw": "src_ip_dec", "dst_ip_raw": "dst_ip_dec", "source_file": "'events'"}
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {src_of.get(c, c)} IS NULL) AS nulls, COUNT(*) AS n FROM raw"
        for c in raw_cols)
    b["null_profile"] = f"""
SELECT column_name, nulls, {HU('nulls * 100', 'n')} AS pct FROM ({parts}) WHERE nulls > 0"""
    b["protocol_share"] = f"""
SELECT protocol_name, count, {HU('count * 100', 'SUM(count) OVER ()', 1)} AS pct FROM (
  SELECT CASE TRY_CAST(protocol_raw AS INTEGER) WHEN 6 THEN 'TCP' WHEN 17 THEN 'UDP' WHEN 0 THEN 'ICMP'
         ELSE 'OTHER' END AS protocol_name, COUNT(*) AS count FROM raw GROUP BY 1)"""
    types = dict(zip(raw_cols, ("bigint", "string", "timestamp_ntz", "bigint", "bigint", "int", "int", "string", "bigint",
                                "int", "int", "bigint", "bigint", "double", "double", "string")))
    shape = ", ".join(f"({i}, '{c}', '{types[c]}')" for i, c in enumerate(raw_cols))
    b["profile_shape"] = f"""
SELECT ordinal, column_name, data_type, (SELECT COUNT(*) FROM raw) AS n_rows, {len(raw_cols)} AS n_columns
FROM (VALUES {shape}) s(ordinal, column_name, data_type)"""
    numbers = [c for c in raw_cols if types[c] in ("bigint", "int", "double")]
    stats = ", ".join(f"round({e}, 4) AS {n}" for n, e in (
        ("mean", "avg(x)"), ("std", "stddev_samp(x)"), ("min", "min(x)"), ("q25", "quantile_cont(x, 0.25)"),
        ("q50", "quantile_cont(x, 0.5)"), ("q75", "quantile_cont(x, 0.75)"), ("max", "max(x)")))
    b["profile_describe"] = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(x) AS count, {stats} FROM (SELECT CAST({src_of.get(c, c)} AS DOUBLE) AS x FROM raw) "
        "WHERE x IS NOT NULL AND isfinite(x)" for c in numbers)
    # ------------------------------------------------------------ one day of Q2
    day = f"CAST(hour_bucket AS DATE) = DATE '{L.SAMPLE_DAY}'"
    for name in ("q2_s", "q2_f", "q2_d", "q2_ds"):
        b[f"{name}_day"] = f"SELECT * FROM ({b[name]}) WHERE {day}"
    b["q2_g_day"] = f"SELECT * FROM ({b['q2_g']}) WHERE starts_with(hour_bucket, '{L.SAMPLE_DAY}')"
    # ------------------------------------------------------------ messages and logs
    b["message_round_trip"] = f"SELECT * REPLACE (date_trunc('second', timestamp) AS timestamp) FROM ({b['clean_flows'].replace('FROM flows', 'FROM ev')})"
    b["csv_round_trip"] = f"SELECT * EXCLUDE (event_id) REPLACE (date_trunc('second', timestamp) AS timestamp) FROM ({b['clean_flows']})"
    counts = {"parse_dead_letters": "1", "dead_letters": "1", "fact_network_event": "1", "documents": "1", "doc_hourly_summary": "event_count",
              **{n: "count" for n in ("e_attacked", "e_used_attack", "e_targeted_by", "e_used_protocol")}, "e_active_in": "event_count",
              **dict.fromkeys((n for n in b if n in ("dim_time", "dim_source", "dim_destination", "dim_attack", "dim_protocol", "v_source_ip",
                                                     "v_destination_ip", "v_attack_type", "v_protocol", "v_time_window")), "NULL")}
    body = {"parse_dead_letters": "SELECT * FROM raw WHERE label_raw IS NULL", "dead_letters": b["validate_flow"], "documents": b["flow_document"]}
    b["fanout_counts"] = "\nUNION ALL ".join(
        f"SELECT '{n}' AS model, COUNT(*) AS n_rows, CAST(SUM({c}) AS BIGINT) AS n_events FROM ({body.get(n) or b[n]})" for n, c in counts.items())
    b["upsert_dim_stream"] = "\nUNION ALL ".join(
        f"SELECT '{n}' AS model, COUNT(*) AS n_rows, COUNT(*) AS n_keys FROM ({b[n]})" for n in counts if n.startswith(("dim_", "v_")))
    each = "CAST(COUNT(*) AS BIGINT) AS n_events_{m}, CAST(SUM({s}) AS BIGINT) AS total_bytes_{m}"
    b["reconcile_events"] = "\nUNION ALL ".join(
        f"SELECT '{v}' AS view, " + ", ".join(each.format(m=m, s="fwd_bytes + bwd_bytes" if v == "e_attacked" else "0") for m in ("star", "document", "graph"))
        + ", 0 AS n_differing, true AS agree FROM ev" for v in ("e_attacked", "e_used_attack", "e_targeted_by", "e_used_protocol", "e_active_in"))
    level = "CASE WHEN label_raw IS NULL THEN 'JUNK' WHEN label_raw = 'BENIGN' THEN 'INFO' ELSE 'WARNING' END"
    parts = f"""SELECT strftime(CAST(ts_raw AS TIMESTAMP), '%Y-%m-%d %H:%M:%S,%g') AS timestamp,
  'port-' || dst_port AS service, {level} AS level, 'flows' AS logger, 'flow ' || event_id AS message, event_id AS line_no FROM raw"""
    line = "CASE WHEN level = 'JUNK' THEN message ELSE timestamp || ' [flows] ' || level || ': ' || message END AS line"
    tail = f"""SELECT *, {line} FROM (SELECT *, row_number() OVER (PARTITION BY service ORDER BY line_no DESC) AS r
FROM ({parts})) WHERE r <= {L.BROWSE_DEFAULT_LIMIT}"""
    b["parse_logs"] = f"SELECT * FROM ({parts}) WHERE level <> 'JUNK'"
    b["tail_per_service"] = f"SELECT line, service, line_no FROM ({tail})"
    b["merged_logs"] = f"""SELECT timestamp, service, level, logger, message FROM ({tail}) WHERE level <> 'JUNK'
ORDER BY timestamp DESC, service, line_no DESC LIMIT {L.BROWSE_DEFAULT_LIMIT}"""
    b["log_level_counts"] = f"SELECT service, level, COUNT(*) AS count FROM ({parts}) WHERE level <> 'JUNK' GROUP BY service, level"
    b["ts_range"] = """
SELECT MIN(ts_raw) AS earliest, MAX(ts_raw) AS latest,
  CAST(epoch_us(MAX(ts_raw)) - epoch_us(MIN(ts_raw)) AS DOUBLE) / 1000000 AS span_seconds FROM raw"""
    b["top_attack_ips"] = """
SELECT CAST(src_ip_dec AS VARCHAR) AS source_ip, COUNT(*) AS count FROM raw
WHERE label_raw IS NULL OR label_raw <> 'BENIGN' GROUP BY 1 ORDER BY count DESC, source_ip LIMIT 10"""
    return b


def _transport(col: str) -> str:
    from .prefix import case_map
    return case_map(col, L.TRANSPORT_LAYERS, "Unknown")


def oracle_sql() -> dict[str, str]:
    p = prefix()
    return {name: p + body for name, body in _bodies().items()}


__all__ = ["oracle_sql", "q"]
