"""Row rules for events that arrive from outside (messages, files)."""
import datetime

from flowlens.operators import validate as V

COLS = ("event_id long, source_ip string, source_port int, destination_ip string, "
        "destination_port int, protocol string, timestamp timestamp_ntz, flow_duration long, "
        "fwd_packets int, bwd_packets int, fwd_bytes long, bwd_bytes long, "
        "flow_bytes_per_sec double, flow_packets_per_sec double, label string, "
        "attack_category string, severity string, source_country string, source_region string")
T0 = datetime.datetime(2017, 7, 5, 10, 30)


def row(i, **kw):
    base = dict(event_id=i, source_ip="1.1.1.1", source_port=1, destination_ip="2.2.2.2",
                destination_port=80, protocol="TCP", timestamp=T0, flow_duration=1, fwd_packets=1,
                bwd_packets=1, fwd_bytes=1, bwd_bytes=1, flow_bytes_per_sec=1.0,
                flow_packets_per_sec=1.0, label="BENIGN", attack_category="Normal", severity="LOW",
                source_country="China", source_region="Asia")
    base.update(kw)
    return tuple(base.values())


def test_rules_and_first_failure(spark):
    rows = [row(0), row(1, source_ip="999.1.1.1"), row(2, source_port=70000),
            row(3, destination_port=-1), row(4, label="x" * 101), row(5, source_country="y" * 101),
            row(6, flow_bytes_per_sec=1e12), row(7, timestamp=None), row(8, label=""),
            row(9, source_ip="bad", source_port=70000)]
    df = spark.createDataFrame(rows, COLS)
    got = {r.event_id: r._error for r in V.with_errors(df).collect()}
    assert got[0] is None
    assert got[1] == "source_ip is not an IPv4 address"
    assert got[2] == "source_port out of range 0-65535"
    assert got[3] == "destination_port out of range 0-65535"
    assert got[4] == "label longer than 100"
    assert got[5] == "source_country longer than 100"
    assert got[6] == "flow_bytes_per_sec does not fit NUMERIC(15,4)"
    assert got[7] == "timestamp is not parsable"
    assert got[8] == "label is empty"
    assert got[9] == "source_ip is not an IPv4 address"          # first failing rule wins
    assert V.valid_events(df).count() == 1
    assert V.rejected_events(df).count() == 9
    # trusted lookups skip only the rules on lookup-valued columns
    trusted = {r.event_id: r._error for r in V.with_errors(df, trusted_lookups=True).collect()}
    assert trusted[5] is None and trusted[4] == "label longer than 100"
