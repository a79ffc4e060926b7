"""Shared DuckDB CTE prefix: events -> raw flows -> clean events -> models.

Written directly in SQL (not generated from the Spark plans) so it is an
independent answer.  Lookup CASE expressions are built from the fixed values
in ``flowlens.functions.lookups``.  Rounding is exact integer arithmetic
(DuckDB averages DECIMAL as DOUBLE, which differs in the last digit).
"""

from __future__ import annotations

from ..functions import lookups as L
from ..sources import adapter as A


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def case_map(expr: str, d: dict, default: str | None = None) -> str:
    whens = " ".join(f"WHEN {q(str(k)) if isinstance(k, str) else k} THEN {q(v)}"
                     for k, v in d.items())
    els = f" ELSE {q(default)}" if default is not None else " ELSE NULL"
    return f"(CASE {expr} {whens}{els} END)"


def sql_list(values) -> str:
    return "[" + ", ".join(q(v) if isinstance(v, str) else str(v) for v in values) + "]"


def half_up(num: str, den: str, scale: int = 2) -> str:
    """ROUND(num / den, scale) half away from zero for num >= 0, den > 0."""
    m = 10 ** scale
    n = f"CAST({num} AS HUGEINT)"
    d = f"CAST({den} AS HUGEINT)"
    return (f"(CASE WHEN {d} = 0 THEN NULL ELSE "
            f"CAST((2 * {n} * {m} + {d}) // (2 * {d}) AS DOUBLE) / {m} END)")


def half_even(num: str, den: str, scale: int = 2) -> str:
    """Half-to-even rounding of num / den for num >= 0, den > 0."""
    m = 10 ** scale
    n = f"(CAST({num} AS HUGEINT) * {m})"
    d = f"CAST({den} AS HUGEINT)"
    fl = f"({n} // {d})"
    rem = f"({n} - {fl} * {d})"
    return (f"(CASE WHEN {d} = 0 THEN NULL ELSE CAST(CASE WHEN 2 * {rem} > {d} THEN {fl} + 1 "
            f"WHEN 2 * {rem} < {d} THEN {fl} ELSE {fl} + ({fl} % 2) END AS DOUBLE) / {m} END)")


def dotted(n: str) -> str:
    return (f"CASE WHEN {n} >= 1 AND {n} <= 4294967295 THEN "
            f"concat_ws('.', ({n} >> 24) & 255, ({n} >> 16) & 255, ({n} >> 8) & 255, {n} & 255) "
            f"ELSE '0.0.0.0' END")


def _label_raw() -> str:
    parts = [f"WHEN event_id % 101 = 7 THEN NULL",
             f"WHEN event_type IN ({', '.join(q(x) for x in A.BENIGN_TYPES)}) THEN 'BENIGN'"]
    for et, labels in A.ATTACK_LABELS.items():
        parts.append(f"WHEN event_type = {q(et)} THEN {sql_list(labels)}[k % 5 + 1]")
    return "CASE " + " ".join(parts) + " ELSE NULL END"


def _category(key: str, base: str) -> str:
    prefix_rules = []
    for p, cat in L.CATEGORY_PREFIXES:
        cond = f"starts_with({base}, {q(p)})"
        if cat == "Botnet":
            cond = f"({cond} OR {base} = 'bot')"
        prefix_rules.append(f"WHEN {cond} THEN {q(cat)}")
    rules = "CASE " + " ".join(prefix_rules) + f" ELSE {q(L.UNKNOWN_CATEGORY)} END"
    return (f"COALESCE({case_map(key, L.CATEGORY_OF_LABEL)}, {case_map(base, L.CATEGORY_OF_LABEL)}, "
            f"{rules})")


def _geo(ip: str, pick: int) -> str:
    words = [f"CAST(('0x' || substr(md5({ip}), {1 + 8 * i}, 8)) AS BIGINT)" for i in range(4)]
    slot = f"(({words[0]} * 36 + {words[1]} * 16 + {words[2]} * 96 + {words[3]}) % 100)"
    whens, upper = [], 0
    for row in L.COUNTRY_WEIGHTS:
        upper += row[2]
        whens.append(f"WHEN {slot} < {upper} THEN {q(row[pick])}")
    return "CASE " + " ".join(whens) + " ELSE 'Unknown' END"


def _seeds_attack() -> str:
    rows = ", ".join(f"({q(a)}, {q(b)}, {q(c)}, -1)" for a, b, c, _ in L.ATTACK_SEEDS)
    return f"SELECT * FROM (VALUES {rows}) s(label, category, severity, seq)"


def _seeds_protocol() -> str:
    rows = ", ".join(f"({q(a)}, {q(b)}, -1)" for a, b in L.PROTOCOL_SEEDS)
    return f"SELECT * FROM (VALUES {rows}) s(protocol_name, transport_layer, seq)"


def prefix() -> str:
    svc_name = case_map("destination_port", {k: v[0] for k, v in L.SERVICES.items()}, "Unknown")
    svc_type = case_map("destination_port", {k: v[1] for k, v in L.SERVICES.items()}, "Unknown")
    return f"""
WITH src AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
),
raw AS (
  SELECT event_id, ts AS ts_raw,
    CASE WHEN event_id % 89 = 5 THEN CAST(0 AS BIGINT)
         ELSE 1 + (user_id * 2654435761) % 4294967294 END AS src_ip_dec,
    3232235776 + k AS dst_ip_dec,
    CAST(CASE WHEN event_id % 127 = 9 THEN 70000 ELSE 1024 + event_id % 16 END AS INTEGER) AS src_port,
    CAST({sql_list(A.DEST_PORTS)}[event_id % 8 + 1] AS INTEGER) AS dst_port,
    CASE WHEN event_id % 83 = 11 THEN 'x' WHEN event_id % 79 = 2 THEN NULL
         ELSE {sql_list(A.PROTOCOL_TEXT)}[event_id % 6 + 1] END AS protocol_raw,
    CAST(floor(value * 1000) AS BIGINT) AS flow_duration,
    CAST(event_id % 50 AS INTEGER) AS fwd_packets,
    CAST(k % 20 AS INTEGER) AS bwd_packets,
    CAST(floor(value * 10) AS BIGINT) AS fwd_bytes,
    CAST(k * 100 AS BIGINT) AS bwd_bytes,
    CASE WHEN event_id % 97 = 3 THEN CAST('Infinity' AS DOUBLE) ELSE value * 100 END AS flow_bytes_per_sec,
    value AS flow_packets_per_sec,
    {_label_raw()} AS label_raw
  FROM src
),
step1 AS (
  SELECT r.*, {dotted('src_ip_dec')} AS source_ip, {dotted('dst_ip_dec')} AS destination_ip
  FROM raw r
),
step2 AS (
  SELECT * FROM step1 WHERE label_raw IS NOT NULL AND ts_raw IS NOT NULL
),
step3 AS (
  SELECT event_id, source_ip, src_port AS source_port, destination_ip, dst_port AS destination_port,
    {case_map("COALESCE(CAST(TRY_CAST(COALESCE(protocol_raw, '0') AS DOUBLE) AS INTEGER), -1)", L.PROTOCOL_NAMES, "OTHER")} AS protocol,
    CAST(ts_raw AS TIMESTAMP) AS timestamp,
    flow_duration, fwd_packets, bwd_packets, fwd_bytes, bwd_bytes,
    CASE WHEN isinf(flow_bytes_per_sec) OR isnan(flow_bytes_per_sec) THEN 0.0
         ELSE COALESCE(flow_bytes_per_sec, 0.0) END AS flow_bytes_per_sec,
    CASE WHEN isinf(flow_packets_per_sec) OR isnan(flow_packets_per_sec) THEN 0.0
         ELSE COALESCE(flow_packets_per_sec, 0.0) END AS flow_packets_per_sec,
    COALESCE({case_map("trim(label_raw)", L.LABEL_VARIANTS)}, trim(label_raw)) AS label
  FROM step2
),
step4 AS (
  SELECT *, lower(label) AS lkey, trim(replace(lower(label), ' - attempted', '')) AS lbase FROM step3
),
flows AS (
  SELECT event_id, source_ip, source_port, destination_ip, destination_port, protocol, timestamp,
    flow_duration, fwd_packets, bwd_packets, fwd_bytes, bwd_bytes, flow_bytes_per_sec,
    flow_packets_per_sec, label,
    {_category('lkey', 'lbase')} AS attack_category,
    COALESCE({case_map('lkey', L.SEVERITY_OF_LABEL)},
             {case_map(_category('lkey', 'lbase'), L.SEVERITY_OF_CATEGORY)}, 'LOW') AS severity,
    {_geo('source_ip', 0)} AS source_country,
    {_geo('source_ip', 1)} AS source_region
  FROM step4
),
checked AS (
  SELECT *, CASE
    WHEN source_port < 0 OR source_port > 65535 THEN 'source_port out of range 0-65535'
    WHEN destination_port < 0 OR destination_port > 65535 THEN 'destination_port out of range 0-65535'
    WHEN abs(round(flow_bytes_per_sec, 4)) >= 1e11 THEN 'flow_bytes_per_sec does not fit NUMERIC(15,4)'
    WHEN abs(round(flow_packets_per_sec, 4)) >= 1e11 THEN 'flow_packets_per_sec does not fit NUMERIC(15,4)'
    ELSE NULL END AS _error
  FROM flows
),
ev AS (
  SELECT * EXCLUDE (_error), attack_category <> 'Normal' AS is_attack,
    date_trunc('minute', timestamp) AS minute,
    date_trunc('hour', timestamp) AS hour_bucket,
    CAST(timestamp AS DATE) AS day_bucket,
    isodow(timestamp) >= 6 AS is_weekend,
    fwd_bytes + bwd_bytes AS total_bytes,
    {svc_name} AS service_name, {svc_type} AS service_type
  FROM checked WHERE _error IS NULL
),
da AS (
  SELECT label AS attack_label, arg_min(category, seq) AS attack_category,
         arg_min(severity, seq) AS severity
  FROM ({_seeds_attack()}
        UNION ALL SELECT label, attack_category,
          CASE WHEN severity IN ('LOW','MEDIUM','HIGH','CRITICAL') THEN severity ELSE 'LOW' END,
          event_id FROM ev) u
  GROUP BY label
),
dp AS (
  SELECT protocol_name, arg_min(transport_layer, seq) AS transport_layer
  FROM ({_seeds_protocol()}
        UNION ALL SELECT protocol, {case_map('protocol', L.TRANSPORT_LAYERS, 'Unknown')}, event_id FROM ev) u
  GROUP BY protocol_name
),
fe AS (
  SELECT ev.*, da.attack_category AS d_category, da.severity AS d_severity
  FROM ev JOIN da ON ev.label = da.attack_label
),
sah AS (
  SELECT hour_bucket, d_category AS attack_category, label AS attack_label,
    COUNT(*) AS event_count, CAST(SUM(total_bytes) AS BIGINT) AS total_bytes,
    CAST((2 * SUM(flow_duration) + 10 * COUNT(*)) // (20 * COUNT(*)) AS BIGINT) AS avg_cents,
    COUNT(DISTINCT (source_ip, source_port)) AS unique_sources
  FROM fe GROUP BY hour_bucket, d_category, label
),
sts_base AS (
  SELECT day_bucket, source_ip, source_country AS country,
    COUNT(*) FILTER (WHERE is_attack) AS attack_count, COUNT(*) AS n,
    COUNT(DISTINCT (destination_ip, destination_port)) AS distinct_targets,
    MAX(d_severity) AS max_severity
  FROM fe GROUP BY day_bucket, source_ip, source_country
),
sts_mode AS (
  SELECT day_bucket, source_ip, label AS primary_attack FROM (
    SELECT day_bucket, source_ip, label,
      row_number() OVER (PARTITION BY day_bucket, source_ip ORDER BY COUNT(*) DESC, label) AS rn
    FROM fe GROUP BY day_bucket, source_ip, label) x WHERE rn = 1
),
sts AS (
  SELECT b.day_bucket, b.source_ip, b.country, b.attack_count, b.distinct_targets, m.primary_attack,
    CAST((2 * CAST(b.attack_count * b.distinct_targets *
      (CASE b.max_severity WHEN 'CRITICAL' THEN 4 WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 ELSE 1 END)
      AS HUGEINT) * 100 + b.n) // (2 * b.n) AS BIGINT) AS score_cents
  FROM sts_base b JOIN sts_mode m USING (day_bucket, source_ip)
),
spd AS (
  SELECT day_bucket, protocol AS protocol_name, COUNT(*) AS total_events,
    COUNT(*) FILTER (WHERE is_attack) AS attack_events
  FROM fe GROUP BY day_bucket, protocol
),
ssd AS (
  SELECT day_bucket, d_severity AS severity, COUNT(*) AS event_count,
    COUNT(DISTINCT (source_ip, source_port)) AS unique_sources
  FROM fe WHERE is_attack GROUP BY day_bucket, d_severity
),
sdp AS (
  SELECT day_bucket, destination_port AS dest_port, service_name, d_category AS attack_category,
    COUNT(*) AS event_count
  FROM fe WHERE is_attack GROUP BY day_bucket, destination_port, service_name, d_category
),
sww AS (
  SELECT is_weekend, d_category AS attack_category, COUNT(*) AS total_events,
    COUNT(*) FILTER (WHERE is_attack) AS attack_events
  FROM fe GROUP BY is_weekend, d_category
),
dhs AS (
  SELECT hour_bucket, label AS attack_label, COUNT(*) AS event_count,
    CAST(SUM(total_bytes) AS BIGINT) AS total_bytes,
    arg_max(attack_category, event_id) AS attack_category
  FROM ev GROUP BY hour_bucket, label
),
dim_time_o AS (
  SELECT DISTINCT minute AS timestamp, CAST(hour(minute) AS INTEGER) AS hour,
    dayname(minute) AS day_of_week, is_weekend,
    CAST(weekofyear(minute) AS INTEGER) AS week, CAST(year(minute) AS INTEGER) AS year,
    CASE WHEN hour(minute) BETWEEN 6 AND 11 THEN 'Morning'
         WHEN hour(minute) BETWEEN 12 AND 17 THEN 'Afternoon'
         WHEN hour(minute) BETWEEN 18 AND 22 THEN 'Evening' ELSE 'Night' END AS time_of_day
  FROM ev
)
"""
