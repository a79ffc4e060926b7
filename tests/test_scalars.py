"""Table-driven cases for every scalar (from the original unit tests)."""
import socket
import struct

import pytest
from pyspark.sql import functions as F

from flowlens.functions import lookups as L
from flowlens.functions import scalars as S


def ip_int(s):
    return struct.unpack(">I", socket.inet_aton(s))[0]


def one(spark, col, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(col(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("value,dtype,expected", [
    (ip_int("192.168.1.1"), "bigint", "192.168.1.1"),
    (ip_int("127.0.0.1"), "bigint", "127.0.0.1"),
    (0, "bigint", "0.0.0.0"),
    (-1, "bigint", "0.0.0.0"),
    (0xFFFFFFFF + 1, "bigint", "0.0.0.0"),
    (str(ip_int("10.0.0.1")), "string", "10.0.0.1"),
    (float(ip_int("10.0.0.1")), "double", "10.0.0.1"),
    ("not_a_number", "string", "0.0.0.0"),
    (None, "string", "0.0.0.0"),
])
def test_decimal_to_ip(spark, value, dtype, expected):
    assert one(spark, S.decimal_to_ip, value, dtype) == expected


@pytest.mark.parametrize("code,name", [(6, "TCP"), (17, "UDP"), (1, "ICMP"), (0, "HOPOPT"),
                                       (999, "OTHER"), (-1, "OTHER")])
def test_protocol_name(spark, code, name):
    assert one(spark, S.protocol_name, code, "int") == name


@pytest.mark.parametrize("raw,name", [("6", "TCP"), ("x", "OTHER"), ("6.0", "TCP"), ("0", "HOPOPT")])
def test_protocol_text(spark, raw, name):
    assert one(spark, lambda c: S.protocol_name(S.protocol_code(c)), raw) == name


@pytest.mark.parametrize("name,layer", [("TCP", "Transport"), ("ICMP", "Network"),
                                        ("NONEXISTENT", "Unknown"), ("OTHER", "Unknown")])
def test_transport_layer(spark, name, layer):
    assert one(spark, S.transport_layer, name) == layer


def test_all_protocols_have_layer():
    for name in L.PROTOCOL_NAMES.values():
        assert name in L.TRANSPORT_LAYERS


@pytest.mark.parametrize("raw,canon", [
    ("Web Attack – Brute Force", "Web Attack -- Brute Force"),
    ("Web Attack — XSS", "Web Attack -- XSS"),
    ("Web Attack - Sql Injection", "Web Attack -- Sql Injection"),
    ("  BENIGN ", "BENIGN"),
    ("Web Attack - SQL Injection", "Web Attack - SQL Injection"),
])
def test_normalise_label(spark, raw, canon):
    assert one(spark, S.normalise_label, raw) == canon


@pytest.mark.parametrize("label,expected", [
    ("BENIGN", "Normal"), ("benign", "Normal"), ("DoS Hulk", "DoS"), ("DoS GoldenEye", "DoS"),
    ("DoS slowloris", "DoS"), ("DoS Slowhttptest", "DoS"), ("DDoS", "DDoS"),
    ("PortScan", "Reconnaissance"), ("FTP-Patator", "Brute Force"), ("SSH-Patator", "Brute Force"),
    ("Bot", "Botnet"), ("Web Attack -- Brute Force", "Web Attack"), ("Web Attack -- XSS", "Web Attack"),
    ("Web Attack -- Sql Injection", "Web Attack"), ("Infiltration", "Infiltration"),
    ("Heartbleed", "Exploitation"), ("DoS Hulk - Attempted", "DoS"), ("DoS SomeNewVariant", "DoS"),
    ("DDoS LOIT", "DDoS"), ("Web Attack - Something", "Web Attack"),
    ("CompletelyNewAttack", "Unknown"), ("Botnet - Attempted", "Botnet"),
    ("Port Scan Something", "Reconnaissance"), ("Web Attack - SQL Injection", "Web Attack"),
])
def test_categorize(spark, label, expected):
    assert one(spark, S.categorize_label, label) == expected


@pytest.mark.parametrize("label,category,expected", [
    ("DoS slowloris", "DoS", "MEDIUM"), ("DoS Hulk", "DoS", "HIGH"), ("DDoS", "DDoS", "CRITICAL"),
    ("Web Attack -- Sql Injection", "Web Attack", "HIGH"), ("BENIGN", "Normal", "LOW"),
    ("Whatever", "NoSuchCategory", "LOW"), ("PortScan", "Reconnaissance", "LOW"),
])
def test_severity(spark, label, category, expected):
    df = spark.createDataFrame([(label, category)], "l string, c string")
    assert df.select(S.label_severity("l", "c")).first()[0] == expected


@pytest.mark.parametrize("port,name,kind", [(80, "HTTP", "Web"), (443, "HTTPS", "Web"),
                                            (22, "SSH", "Remote"), (55555, "Unknown", "Unknown")])
def test_service(spark, port, name, kind):
    assert one(spark, S.service_name, port, "int") == name
    assert one(spark, S.service_type, port, "int") == kind


@pytest.mark.parametrize("hour,label", [(0, "Night"), (5, "Night"), (6, "Morning"), (11, "Morning"),
                                        (12, "Afternoon"), (17, "Afternoon"), (18, "Evening"),
                                        (22, "Evening"), (23, "Night")])
def test_time_of_day(spark, hour, label):
    assert one(spark, S.time_of_day, hour, "int") == label


@pytest.mark.parametrize("ip,cls", [("10.0.0.1", "A"), ("127.0.0.1", "A"), ("128.0.0.1", "B"),
                                    ("191.255.0.1", "B"), ("192.168.1.1", "C"), ("224.0.0.1", "D"),
                                    ("240.0.0.1", "E"), ("garbage", "Unknown"), ("", "Unknown")])
def test_ip_class(spark, ip, cls):
    assert one(spark, S.ip_class, ip) == cls


@pytest.mark.parametrize("ip,slot", [("192.168.1.1", 3), ("10.0.0.1", 16), ("0.0.0.0", 8),
                                     ("8.8.8.8", 43), ("", 66)])
def test_geo_slot_matches_md5_modulo(spark, ip, slot):
    import hashlib
    assert int(hashlib.md5(ip.encode()).hexdigest(), 16) % 100 == slot
    assert one(spark, S.geo_slot, ip) == slot


def test_geo_table_rule():
    ends = [0] + [end for end, _, _ in L.geo_thresholds()]
    assert ends[-1] == 100
    assert [b - a for a, b in zip(ends, ends[1:])] == [w for _, _, w in L.COUNTRY_WEIGHTS]


def test_geo_deterministic(spark):
    df = spark.createDataFrame([("1.2.3.4",), ("1.2.3.4",)], "ip string")
    rows = df.select(S.geo_country("ip"), S.geo_region("ip")).collect()
    assert rows[0] == rows[1]


def test_calendar_parts(spark):
    df = spark.createDataFrame([("2017-07-05 10:30:00",), ("2017-07-08 23:00:00",),
                                ("2017-01-01 12:00:00",)], "t string") \
        .select(F.to_timestamp_ntz("t").alias("t"))
    rows = df.select(*[c.alias(k) for k, c in S.calendar_columns("t").items()],
                     S.weekday0("t").alias("wd")).collect()
    assert rows[0]["day_of_week"] == "Wednesday" and rows[0]["wd"] == 2 and not rows[0]["is_weekend"]
    assert rows[1]["is_weekend"] and rows[1]["day_of_week"] == "Saturday"
    assert rows[2]["week"] == 52 and rows[2]["year"] == 2017  # ISO week next to calendar year


@pytest.mark.parametrize("text,expected", [("2017-07-05T10:30:00", "2017-07-05 10:30:00"),
                                           ("2017-07-05T10:30:00Z", "2017-07-05 10:30:00"),
                                           ("2017-07-05T10:30:00+02:00", "2017-07-05 10:30:00"),
                                           ("", None)])
def test_iso_parse(spark, text, expected):
    v = one(spark, S.iso_parse, text)
    assert (None if v is None else str(v)) == expected


@pytest.mark.parametrize("sev,expected", [("HIGH", "HIGH"), ("bogus", "LOW"), (None, "LOW")])
def test_coerce_severity(spark, sev, expected):
    assert one(spark, S.coerce_severity, sev) == expected


def test_lookup_values_fit_declared_lengths():
    from flowlens.operators.validate import LENGTH_LIMITS
    cats = set(L.CATEGORY_OF_LABEL.values()) | {c for _, c in L.CATEGORY_PREFIXES} | {L.UNKNOWN_CATEGORY}
    assert max(map(len, cats)) <= LENGTH_LIMITS["attack_category"]
    assert max(map(len, L.PROTOCOL_NAMES.values())) <= LENGTH_LIMITS["protocol"]
    assert max(map(len, L.VALID_SEVERITIES)) <= LENGTH_LIMITS["severity"]
    assert max(len(c) for c, _, _ in L.COUNTRY_WEIGHTS) <= LENGTH_LIMITS["source_country"]


def test_an_address_is_split_once(spark):
    say = [("0.0.0.0", 0), ("255.255.255.255", 2**32 - 1), ("10.1.2.3", 167838211), ("1.2.3", None), ("1.2.3.4.5", None),
           ("1.2.3.256", None), ("a.b.c.d", None), ("", None), (None, None), (" 1.2.3.4", None), ("01.2.3.4", None)]
    df = spark.createDataFrame(say, "ip string, want bigint").select("want", S.ip_to_decimal("ip").alias("got"))
    assert [r.got for r in df.collect()] == [n for _, n in say]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("split") <= 1
