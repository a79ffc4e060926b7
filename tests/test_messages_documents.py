"""Event message fields and the nested document (cases from the original
producer / document-writer tests)."""
import datetime
import json

from pyspark.sql import functions as F

from flowlens.operators import graph, nested
from flowlens.sources import messages as M

SAMPLE = {"source_ip": "192.168.1.1", "source_port": 12345, "destination_ip": "10.0.0.1",
          "destination_port": 80, "protocol": "TCP", "timestamp": "2017-07-05T10:30:00",
          "flow_duration": 5000, "fwd_packets": 10, "bwd_packets": 5, "fwd_bytes": 2048,
          "bwd_bytes": 512, "flow_bytes_per_sec": 100.5, "flow_packets_per_sec": 10.0,
          "label": "DoS Hulk", "attack_category": "DoS", "severity": "HIGH",
          "source_country": "China", "source_region": "Asia"}


def _events(spark, variants):
    lines = [json.dumps({**SAMPLE, **v}) for v in variants]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "seq long, value string")
    return M.good_events(M.parse_messages(df, "value", "seq"))


def test_message_has_18_typed_fields(spark):
    ev = _events(spark, [{}])
    msg = M.to_message(ev).first().value
    d = json.loads(msg)
    assert len(d) == 18 and set(d) == set(SAMPLE)
    assert d["timestamp"] == "2017-07-05T10:30:00" and d["fwd_bytes"] == 2048


def test_nested_document(spark):
    ev = _events(spark, [{}, {"destination_port": 55555}, {"timestamp": "2017-07-05T10:30:00Z"},
                         {"timestamp": "2017-07-08T12:00:00"}, {"attack_category": "Normal",
                                                                "label": "BENIGN"}])
    docs = nested.flow_document(ev).orderBy("event_id").collect()
    d0 = docs[0]
    assert d0.time.hour == 10 and d0.time.day == 5 and d0.time.day_of_week == "Wednesday"
    assert d0.time.is_weekend is False and d0.time.time_of_day == "Morning"
    assert d0.destination.service_name == "HTTP" and d0.destination.service_type == "Web"
    assert d0.attack.is_attack is True and d0.protocol.transport_layer == "Transport"
    assert d0.metrics.fwd_bytes == 2048
    assert docs[1].destination.service_name == "Unknown"
    assert docs[2].timestamp == datetime.datetime(2017, 7, 5, 10, 30)
    assert docs[3].time.is_weekend is True and docs[3].time.day_of_week == "Saturday"
    assert docs[4].attack.is_attack is False


def test_edge_partial_aggregate_and_weekday(spark):
    ev = _events(spark, [{"source_ip": "1.1.1.1", "destination_ip": "2.2.2.2", "fwd_bytes": 100,
                          "bwd_bytes": 50},
                         {"source_ip": "1.1.1.1", "destination_ip": "2.2.2.2", "fwd_bytes": 200,
                          "bwd_bytes": 100}])
    g = graph.graph_input(ev)
    e = graph.e_attacked(g).first()
    assert e["count"] == 2 and e["total_bytes"] == 450
    tw = graph.v_time_window(g).first()
    assert tw.day_of_week == 2 and tw.month == 7 and tw.year == 2017   # weekday, not day 5


def test_a_message_is_written_and_parsed_once(spark, tables):
    """Filters on a parsed line don't write its text or parse it again for each field."""
    trip = M.good_events(M.parse_messages(M.to_message(tables["flow_events"]), "value", "event_id"))
    plan = trip._jdf.queryExecution().executedPlan().toString()
    assert plan.count("StructsToJson") == 1, plan
    # the second is that of lines that aren't plain JSON
    assert plan.count("from_json(") == 2 and plan.count("jsonObjectKeys(") == 1, plan
    assert plan.index("Filter (NOT coalesce((m#") < plan.index("Generate inline(transform(array(from_json("), plan


def test_lines_that_are_no_plain_json(spark):
    """They are parsed again: numbers JSON doesn't have, given as text, are read; others tell no object."""
    good = json.dumps(SAMPLE)
    cases = [(good, None), (json.dumps({**SAMPLE, "flow_bytes_per_sec": "NaN"}), None), (json.dumps({**SAMPLE, "label": "NaN"}), None),
             (json.dumps({**SAMPLE, "source_port": "x"}), None), (good.replace('"', "'"), None), (good + " more", None),
             (json.dumps({**SAMPLE, "flow_bytes_per_sec": float("nan")}), "not a JSON object"),
             (json.dumps({**SAMPLE, "other": float("-inf")}), "not a JSON object"), (f"[{good}]", "not a JSON object"),
             (good[:-1], "not a JSON object"), ("null", "not a JSON object"), ("", "not a JSON object"), (None, "not a JSON object"),
             ("{}", "missing timestamp"), (json.dumps({**SAMPLE, "timestamp": "x"}), "timestamp is not parsable"),
             (json.dumps({**SAMPLE, "label": None}), "missing label")]
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(cases)], "seq long, value string")
    got = {r.event_id: r for r in M.parse_messages(df, "value", "seq").collect()}
    assert {i: r._parse_error for i, r in got.items()} == {i: e for i, (_, e) in enumerate(cases)}
    assert str(got[1].flow_bytes_per_sec) == "nan" and got[3].source_port is None and got[4][3:] == got[0][3:]
