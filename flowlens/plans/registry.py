"""Name -> query over the table dict, for every registered operator.

Models are exposed with natural columns only (surrogate keys are an internal
detail); DECIMAL outputs are shown as DOUBLE.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lookups as L
from ..operators import logs, nested, star
from ..session import scratch_path
from . import common as C
from . import dashboard as D
from . import queries as Q
from . import reconcile as R


def _natural_dims() -> dict[str, Callable]:
    return {
        "dim_time": lambda t: t["dim_time"].drop("time_key"),
        "dim_source": lambda t: t["dim_source"].drop("source_key"),
        "dim_destination": lambda t: t["dim_destination"].drop("dest_key"),
        "dim_attack": lambda t: t["dim_attack"].select("attack_label", "attack_category", "severity"),
        "dim_protocol": lambda t: t["dim_protocol"].drop("protocol_key"),
        "fact_network_event": lambda t: C.decimals_to_double(star.fact_with_natural_keys(t)),
    }


def _clean_stats(t) -> DataFrame:
    """Rows before and after cleaning: as observed while the tables were written,
    else counted."""
    seen = getattr(t, "cleaning", None)
    if seen:
        return t["flow_events"].sparkSession.createDataFrame([tuple(seen.values())], ", ".join(f"{c} bigint" for c in seen))
    raw = t["raw_flows"].select(F.lit(1).alias("b"), F.lit(0).alias("a"))
    kept = t["flow_events"].select(F.lit(0).alias("b"), F.lit(1).alias("a"))
    g = raw.unionByName(kept).agg(F.sum("b").alias("rows_before"), F.sum("a").alias("rows_after"))
    return g.select("rows_before", "rows_after",
                    (F.col("rows_before") - F.col("rows_after")).alias("rows_dropped"))


def _graph_counts(t) -> DataFrame:
    nodes = ["v_source_ip", "v_destination_ip", "v_attack_type", "v_protocol", "v_time_window"]
    rels = ["e_attacked", "e_used_attack", "e_targeted_by", "e_used_protocol", "e_active_in"]
    parts = [t[n].select(F.lit("nodes").alias("kind")) for n in nodes]
    parts += [t[n].select(F.lit("relationships").alias("kind")) for n in rels]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


REFRESHES = 3


def _refreshed(t) -> str:
    """Folder of the summaries after the whole fact has come in by batches, each
    followed by a refresh; made once for a set of tables."""
    if getattr(t, "refreshed", None) is None:
        from ..operators import incremental
        fact = t["fact_network_event"]
        path = scratch_path(fact.sparkSession, f"refreshed-{uuid.uuid4().hex[:12]}")
        facts = fact.withColumn("batch_id", F.pmod(F.xxhash64("event_id"), F.lit(REFRESHES)).cast("int"))
        for batch in range(REFRESHES):
            failed = {n: s for n, s in incremental.refresh_all(t, facts, path, batch).items() if s != "ok"}
            if failed:
                raise RuntimeError(f"not refreshed: {failed}")
        t.refreshed = path
    return t.refreshed


def _refreshed_summary(name: str) -> Callable:
    def run(t) -> DataFrame:
        from ..operators import incremental
        current = incremental.current_summary(t["fact_network_event"].sparkSession, _refreshed(t), name)
        return C.decimals_to_double(current)
    return run


def _two_batches(t, frame: str):
    """Split a table into two batches covering every row (by hour of day)."""
    f = t[frame]
    return f.filter(F.hour("timestamp") < 12), f.filter(F.hour("timestamp") >= 12)


def _summary_hourly_incremental(t) -> DataFrame:
    from ..operators import upsert
    a, b = _two_batches(t, "documents")
    m = upsert.merge_hourly_documents(nested.hourly_document_summary(a),
                                      nested.hourly_document_summary(b))
    return m.select("hour_bucket", "attack_label", "event_count", "total_bytes", "attack_category")


def _edge_merge(t) -> DataFrame:
    from ..operators import graph, upsert
    a, b = _two_batches(t, "graph_input")
    return upsert.merge_edges(graph.e_attacked(a), graph.e_attacked(b), ["src_ip", "dst_ip"]) \
        .select("src_ip", "dst_ip", "count", "total_bytes", "first_seen", "last_seen")


def _dim_upsert(t) -> DataFrame:
    from ..operators import upsert
    a, b = _two_batches(t, "events")
    d1 = star.dim_source(a).drop("source_key")
    d2 = star.dim_source(b).drop("source_key")
    return upsert.insert_new_keys(d1, d2, ["source_ip", "source_port"])


def _source_serials(t) -> DataFrame:
    """Serial keys of all source end points, given in two batches of events."""
    if getattr(t, "serials", None) is None:
        from ..operators import serial
        base = scratch_path(t["events"].sparkSession, f"serials-{uuid.uuid4().hex[:12]}")
        for k, batch in enumerate(_two_batches(t, "events")):
            serial.extend_serials(batch, ["source_ip", "source_port"], "event_id", base, k)
        t.serials = base
    from ..operators import serial
    return serial.serials(t["events"].sparkSession, t.serials)


def _unique_sources(t) -> DataFrame:
    """Distinct source end points by day and label, merged from hourly bitmaps."""
    from ..operators import serial
    numbers = _source_serials(t).select(star.source_key().alias("source_key"), "serial")
    hourly = serial.hourly_source_bitmaps(t["fact_network_event"], numbers)
    daily = hourly.withColumn("day_bucket", F.to_date("hour_bucket"))
    out = serial.distinct_sources(daily, ["day_bucket", "attack_key"])
    return out.join(t["dim_attack"].select("attack_key", "attack_label"), "attack_key").select("day_bucket", "attack_label", "unique_sources")


def _audit(t) -> DataFrame:
    from ..operators import validate
    dims = {"dim_time": "time_key", "dim_source": "source_key", "dim_destination": "dest_key",
            "dim_attack": "attack_key", "dim_protocol": "protocol_key"}
    return validate.audit_keys(t["fact_network_event"], {name: (t[name], key) for name, key in dims.items()})


def _message_round_trip(t) -> DataFrame:
    """Every valid event published as a message and parsed again."""
    from ..sources import messages as M
    return M.good_events(M.parse_messages(M.to_message(t["events"]), "value", "event_id"))


def _fanned_out(t) -> str:
    """Folder of every model after all flow events have come as messages, each sent
    twice, with the unlabelled raw flows as messages that don't parse.  Messages
    are parsed and counted once by a first stream; the fan-out reads its source
    twice, so it streams over the table of those."""
    from ..sources import messages as M
    from ..streaming import fanout
    if getattr(t, "fanned_out", None) is None:
        spark = t["flow_events"].sparkSession
        folder = scratch_path(spark, f"fanout-{uuid.uuid4().hex[:12]}")
        unlabelled = t["raw_flows"].filter(F.col("label_raw").isNull()) \
            .select(F.to_json(F.struct(F.col("event_id").cast("string").alias("message_id"), F.col("ts_raw").alias("timestamp"))).alias("value"))
        for _ in range(2):
            M.to_message(t["flow_events"], "event_id").select("value").unionByName(unlabelled).write.mode("append").text(f"{folder}/in")
        files = len(spark.read.text(f"{folder}/in").inputFiles())
        once = M.counted_once(M.stream_messages(spark, f"{folder}/in", -(-files // 3)))
        arrived = M.store_stream(once, f"{folder}/arrived", f"{folder}/arrived-checkpoint")
        per_batch = max(1, -(-len(arrived.inputFiles()) // 3))
        stream = spark.readStream.schema(arrived.schema).option("maxFilesPerTrigger", per_batch).parquet(f"{folder}/arrived")
        fanout.fanout_stream(stream, f"{folder}/models", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
        t.fanned_out = f"{folder}/models"
    return t.fanned_out


def _fanout_counts(t) -> DataFrame:
    """Rows of every model after the stream."""
    from ..streaming import fanout
    return fanout.model_counts(t["flow_events"].sparkSession, _fanned_out(t))


def _upsert_dim_stream(t) -> DataFrame:
    """Rows and keys in the parts of the dimensions and vertices after the stream."""
    from ..streaming import fanout
    return fanout.key_counts(t["flow_events"].sparkSession, _fanned_out(t))


def _csv_round_trip(t) -> DataFrame:
    """Every raw flow written to CSV files, half of them in each dialect, read
    again and cleaned.  Arrival ids are places in files and are left out."""
    from ..operators import clean
    from ..sources import csv as V
    raw, odd = t["raw_flows"], F.pmod("event_id", F.lit(2)) == 1
    folder = scratch_path(raw.sparkSession, f"flow-files-{uuid.uuid4().hex[:12]}")
    V.write_flows(raw.filter(odd), folder, "standard")
    V.write_flows(raw.filter(~odd), folder, "decimal")
    return clean.clean_flows(V.read_flows(raw.sparkSession, folder)).drop("event_id")


def _log_lines(t) -> DataFrame:
    """Log lines of the raw flows, a service for each destination port; flows
    without a label give lines that are no log records."""
    raw, says = t["raw_flows"], F.concat(F.lit("flow "), "event_id")
    level = F.when(F.col("label_raw") == "BENIGN", "INFO").otherwise("WARNING")
    line = F.concat(F.date_format("ts_raw", "yyyy-MM-dd HH:mm:ss,SSS"), F.lit(" [flows] "), level, F.lit(": "), says)
    return raw.select(F.when(F.col("label_raw").isNull(), says).otherwise(line).alias("line"),
                      F.concat(F.lit("port-"), "dst_port").alias("service"), F.col("event_id").alias("line_no"))


def registry() -> dict[str, Callable]:
    r: dict[str, Callable] = {
        "clean_flows": lambda t: t["flow_events"],
        "validate_flow": lambda t: t["rejected"],
        "clean_stats": _clean_stats,
        **_natural_dims(),
        "flow_document": lambda t: nested.flatten_document(t["documents"]),
        "doc_hourly_summary": lambda t: t["doc_hourly_summary"].select(
            "hour_bucket", "attack_label", "event_count", "total_bytes", "attack_category"),
    }
    for name in ("v_source_ip", "v_destination_ip", "v_attack_type", "v_protocol", "v_time_window",
                 "e_attacked", "e_used_attack", "e_targeted_by", "e_used_protocol", "e_active_in"):
        r[name] = (lambda n: lambda t: t[n])(name)
    r["v_label_set"] = lambda t: t["v_label_set"].drop("labels")
    r["e_has_label_set"] = lambda t: t["e_has_label_set"].drop("labels")
    r["e_connected_to"] = lambda t: C.decimals_to_double(t["e_connected_to"].withColumn("shared_attacks", F.array_join("shared_attacks", ",")))
    r["graph_counts"] = _graph_counts
    r["summary_hourly_incremental"] = _summary_hourly_incremental
    r["edge_merge_two_batches"] = _edge_merge
    r["dim_upsert_two_batches"] = _dim_upsert
    for name in ("summary_attack_hourly", "summary_top_sources", "summary_protocol_daily",
                 "summary_severity_daily", "summary_dest_port_daily", "summary_weekend_weekday"):
        r[name] = (lambda n: lambda t: C.decimals_to_double(t[n]))(name)
        r[f"{name}_refreshed"] = _refreshed_summary(name)
    for fn in (Q.q1_s, Q.q2_s, Q.q3_s, Q.q3_s_avg, Q.q4_s, Q.q5_s, Q.q6_s, Q.q7_s, Q.q9_s,
               Q.q10_s, Q.q11_s, Q.q12_s,
               Q.q1_f, Q.q2_f, Q.q3_f, Q.q4_f, Q.q5_f, Q.q6_f, Q.q7_f, Q.q8_f, Q.q9_f,
               Q.q10_f, Q.q11_f, Q.q12_f,
               Q.q1_d, Q.q1_ds, Q.q2_d, Q.q2_ds, Q.q3_d, Q.q4_d, Q.q4_ds, Q.q5_d, Q.q6_d,
               Q.q7_d, Q.q9_d, Q.q10_d, Q.q11_d, Q.q12_d, Q.q12_ds,
               Q.q1_g, Q.q2_g, Q.q3_g, Q.q4_g, Q.q5_g, Q.q6_g, Q.q7_g, Q.q9_g,
               Q.q10_g, Q.q11_g, Q.q12_g, Q.top_attacked_destinations):
        r[fn.__name__] = fn
    r["q8_f"] = lambda t: C.decimals_to_double(Q.q8_f(t))
    for fn in (Q.q2_s, Q.q2_f, Q.q2_d, Q.q2_ds, Q.q2_g):
        r[f"{fn.__name__}_day"] = (lambda f: lambda t: f(t, L.SAMPLE_DAY))(fn)
    r["surrogate_key"] = lambda t: _source_serials(t).select("source_ip", "source_port", "first_arrival", "serial")
    r["unique_sources_daily"] = _unique_sources
    r["audit_keys"] = _audit
    r["message_round_trip"] = _message_round_trip
    r["csv_round_trip"] = _csv_round_trip
    r["fanout_counts"] = _fanout_counts
    r["upsert_dim_stream"] = _upsert_dim_stream
    r["reconcile_events"] = R.reconcile_events
    for fn in (logs.parse_logs, logs.tail_per_service, logs.merged_logs, logs.log_level_counts):
        r[fn.__name__] = (lambda f: lambda t: f(_log_lines(t)))(fn)
    r.update(D.registry())
    return r
