"""Star schema: five dimensions and the fact table.

Surrogate keys are computed from the natural keys, so the fact is built by a
narrow projection of the events - no join against the dimensions and no
shuffle.  Time has a smart key (minutes since the epoch); an end point packs
its IPv4 address and port into 48 bits (``address << 16 | port``), which is
exact and can be read back; labels and protocols are hashed (``xxhash64``; a
few dozen values).  Dimensions are first-write-wins: attributes come from the
earliest arrival (``min_by(.., event_id)``); seed rows carry a flag and win.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lookups as L
from ..functions import scalars as S

def _first(value) -> F.Column:
    """``value`` of the seed row if there is one, else of the earliest arrival."""
    return F.min_by(value, F.struct("seen", "seq"))


def natural_key(*cols) -> F.Column:
    return F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in cols])


def time_key(ts="timestamp") -> F.Column:
    return S.minute_key(ts)


def endpoint_key(ip, port) -> F.Column:
    """IPv4 address and port in 48 bits; null unless both are valid."""
    port = F.when(S._c(port).between(0, 65535), S._c(port).cast("bigint"))
    return F.shiftleft(S.ip_to_decimal(ip), 16).bitwiseOR(port)


def endpoint_ip(key) -> F.Column:
    return S.dotted_quad(F.shiftright(S._c(key), 16))


def endpoint_port(key) -> F.Column:
    return S._c(key).bitwiseAND(F.lit(65535)).cast("int")


def source_key(ip="source_ip", port="source_port") -> F.Column:
    return endpoint_key(ip, port)


def dest_key(ip="destination_ip", port="destination_port") -> F.Column:
    return endpoint_key(ip, port)


def attack_key(label="label") -> F.Column:
    return natural_key(label)


def protocol_key(name="protocol") -> F.Column:
    return natural_key(name)


# ------------------------------------------------------------------ dims

def time_attributes(minute) -> dict:
    cal = S.calendar_columns(minute)
    return {"timestamp": minute, **cal}


def dim_time(events: DataFrame) -> DataFrame:
    """One row per distinct wall-clock minute with calendar parts."""
    keys = events.select(time_key("timestamp").alias("time_key")).distinct()
    minute = S.key_to_minute("time_key")
    return keys.select("time_key", *[c.alias(n) for n, c in time_attributes(minute).items()])


def dim_source(events: DataFrame) -> DataFrame:
    first = F.min_by(F.struct("source_country", "source_region"), F.col("event_id"))
    return (events.groupBy("source_ip", "source_port").agg(first.alias("a"))
            .select(source_key().alias("source_key"), "source_ip", "source_port",
                    F.col("a.source_country").alias("country"),
                    F.col("a.source_region").alias("region"),
                    S.ip_class("source_ip").alias("ip_class")))


def dim_destination(events: DataFrame) -> DataFrame:
    d = events.select(F.col("destination_ip").alias("dest_ip"),
                      F.col("destination_port").alias("dest_port")).distinct()
    return d.select(dest_key("dest_ip", "dest_port").alias("dest_key"), "dest_ip", "dest_port",
                    S.service_name("dest_port").alias("service_name"),
                    S.service_type("dest_port").alias("service_type"))


def attack_seeds(spark: SparkSession) -> DataFrame:
    rows = [(lab, cat, sev, desc, False, 0) for lab, cat, sev, desc in L.ATTACK_SEEDS]
    return S.literal_table(spark, rows,
                           ["attack_label", "attack_category", "severity", "description", "seen", "seq"],
                           ["string", "string", "string", "string", "boolean", "bigint"])


def protocol_seeds(spark: SparkSession) -> DataFrame:
    rows = [(name, layer, False, 0) for name, layer in L.PROTOCOL_SEEDS]
    return S.literal_table(spark, rows, ["protocol_name", "transport_layer", "seen", "seq"],
                           ["string", "string", "boolean", "bigint"])


def dim_attack(events: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """Seeds plus labels seen in events; a missing category becomes
    'Unknown', an invalid severity 'LOW'; the earliest row wins."""
    spark = spark or events.sparkSession
    seen = events.select(
        F.col("label").alias("attack_label"),
        F.coalesce("attack_category", F.lit("Unknown")).alias("attack_category"),
        S.coerce_severity("severity").alias("severity"),
        F.lit(None).cast("string").alias("description"),
        F.lit(True).alias("seen"), F.col("event_id").alias("seq"))
    both = attack_seeds(spark).unionByName(seen)
    first = _first(F.struct("attack_category", "severity", "description"))
    return (both.groupBy("attack_label").agg(first.alias("a"))
            .select(attack_key("attack_label").alias("attack_key"), "attack_label",
                    "a.attack_category", "a.severity", "a.description"))


def dim_protocol(events: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    spark = spark or events.sparkSession
    seen = events.select(F.col("protocol").alias("protocol_name"),
                         S.transport_layer("protocol").alias("transport_layer"),
                         F.lit(True).alias("seen"), F.col("event_id").alias("seq"))
    both = protocol_seeds(spark).unionByName(seen)
    return (both.groupBy("protocol_name")
            .agg(_first("transport_layer").alias("transport_layer"))
            .select(protocol_key("protocol_name").alias("protocol_key"), "protocol_name",
                    "transport_layer"))


# ------------------------------------------------------------------ fact

def fact_network_event(events: DataFrame) -> DataFrame:
    """Five surrogate keys, the measures and ``is_attack``; narrow projection."""
    return events.select(
        "event_id",
        time_key("timestamp").alias("time_key"),
        source_key().alias("source_key"),
        dest_key().alias("dest_key"),
        attack_key("label").alias("attack_key"),
        protocol_key("protocol").alias("protocol_key"),
        F.coalesce("flow_duration", F.lit(0)).cast("bigint").alias("flow_duration"),
        F.coalesce("fwd_packets", F.lit(0)).cast("int").alias("fwd_packets"),
        F.coalesce("bwd_packets", F.lit(0)).cast("int").alias("bwd_packets"),
        F.coalesce("fwd_bytes", F.lit(0)).cast("bigint").alias("fwd_bytes"),
        F.coalesce("bwd_bytes", F.lit(0)).cast("bigint").alias("bwd_bytes"),
        F.col("flow_bytes_per_sec").cast("decimal(15,4)").alias("flow_bytes_per_sec"),
        F.col("flow_packets_per_sec").cast("decimal(15,4)").alias("flow_pkts_per_sec"),
        S.is_attack("attack_category").alias("is_attack"),
    )


def fact_with_natural_keys(t: dict[str, DataFrame]) -> DataFrame:
    """The fact with natural columns in place of its surrogate keys.

    Minutes, addresses and ports are read from their keys; only labels and
    protocols join their dimensions (a few dozen rows each), so the fact is not
    shuffled.  Used for exports and checks; queries aggregate on keys first.
    """
    f = t["fact_network_event"].withColumns({
        "minute": S.key_to_minute("time_key"),
        "source_ip": endpoint_ip("source_key"), "source_port": endpoint_port("source_key"),
        "dest_ip": endpoint_ip("dest_key"), "dest_port": endpoint_port("dest_key")})
    return (f.join(t["dim_attack"].select("attack_key", "attack_label"), "attack_key")
            .join(t["dim_protocol"].select("protocol_key", "protocol_name"), "protocol_key")
            .drop("time_key", "source_key", "dest_key", "attack_key", "protocol_key"))
