"""Upserts are idempotent and incremental merges equal one batch; streaming
aggregates in complete mode equal the batch answer."""
from pyspark.sql import functions as F

from flowlens.operators import graph, nested, upsert
from flowlens.streaming import aggregates as A

from conftest import SF_SMALL


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_dimension_insert_only_idempotent(tables):
    d = tables["dim_attack"]
    once = upsert.insert_new_keys(d.limit(0), d, ["attack_label"])
    twice = upsert.insert_new_keys(once, d, ["attack_label"])
    assert rows(once) == rows(twice) == rows(d)


def test_summary_replace_by_key_idempotent(tables):
    s = tables["summary_attack_hourly"]
    once = upsert.replace_by_key(s, s, ["hour_bucket", "attack_label"])
    assert rows(once) == rows(s)


def test_edges_merge_two_batches_equals_one(tables):
    g = graph.graph_input(tables["events"])
    a, b = g.filter(F.hour("timestamp") < 12), g.filter(F.hour("timestamp") >= 12)
    merged = upsert.merge_edges(graph.e_attacked(a), graph.e_attacked(b), ["src_ip", "dst_ip"])
    assert rows(merged.select("src_ip", "dst_ip", "count", "total_bytes", "first_seen", "last_seen")) == \
        rows(graph.e_attacked(g).select("src_ip", "dst_ip", "count", "total_bytes", "first_seen", "last_seen"))


def test_hourly_documents_incremental(tables):
    docs = tables["documents"]
    a, b = docs.filter(F.hour("timestamp") < 12), docs.filter(F.hour("timestamp") >= 12)
    merged = upsert.merge_hourly_documents(nested.hourly_document_summary(a),
                                           nested.hourly_document_summary(b))
    cols = ["hour_bucket", "attack_label", "event_count", "total_bytes", "attack_category"]
    assert rows(merged.select(*cols)) == rows(nested.hourly_document_summary(docs).select(*cols))


def test_stream_equals_batch(spark, tables, tmpdir_path):
    for k, (build, key, opts) in enumerate([(A.attack_rate_1min, "attack_category", {}), (A.protocol_rate_1min, "protocol", {}),
                                            (A.high_volume_sources, "source_ip", {"threshold": 1})]):
        changes, want = build(A.stream_flow_events_from_table(spark, SF_SMALL), **opts), build(tables["events"], **opts)
        A.emit_changes_to_table(changes, f"{tmpdir_path}/{k}", [key, "window_start"], f"{tmpdir_path}/ck{k}") \
            .trigger(availableNow=True).start().awaitTermination()
        assert rows(A.pull_query(spark, f"{tmpdir_path}/{k}", changes.schema).select(*want.columns)) == rows(want)
