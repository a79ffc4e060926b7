"""Row rules from the declared constraints, and the quarantine split.

Every rule is a native predicate; the first failing rule names the row's
``_error``.  Good and bad rows come from one projection, so the split costs no
extra scan when the caller persists or writes both inside ``foreachBatch``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

INT_MAX = 2_147_483_647
RATE_LIMIT = 1e11          # NUMERIC(15,4): at most 11 integer digits


def _len_over(col: str, n: int) -> Column:
    return F.length(F.col(col)) > n


# Columns whose values come from fixed lookup tables when the events are
# produced by ``clean_flows``; their length rules hold by construction (a
# unit test checks every lookup value against the limits), so they are only
# evaluated for events that arrive from outside (messages, files).
LOOKUP_COLUMNS = ("attack_category", "severity", "protocol", "source_country", "source_region")


def rules(trusted_lookups: bool = False) -> list[tuple[Column, str]]:
    """(failing condition, message) in the order they are checked."""
    def port_bad(c):
        return F.col(c).isNull() | (F.col(c) < 0) | (F.col(c) > 65535)

    def rate_bad(c):
        return F.abs(F.round(F.col(c), 4)) >= F.lit(RATE_LIMIT)

    out = [
        (F.col("source_ip").isNull(), "source_ip is null"),
        (~S.is_ipv4("source_ip"), "source_ip is not an IPv4 address"),
        (F.col("destination_ip").isNull(), "destination_ip is null"),
        (~S.is_ipv4("destination_ip"), "destination_ip is not an IPv4 address"),
        (port_bad("source_port"), "source_port out of range 0-65535"),
        (port_bad("destination_port"), "destination_port out of range 0-65535"),
        (F.col("timestamp").isNull(), "timestamp is not parsable"),
        (F.col("label").isNull() | (F.col("label") == ""), "label is empty"),
        (_len_over("label", 100), "label longer than 100"),
        (_len_over("attack_category", 50), "attack_category longer than 50"),
        (_len_over("protocol", 20), "protocol longer than 20"),
        (_len_over("source_country", 100), "source_country longer than 100"),
        (_len_over("source_region", 100), "source_region longer than 100"),
        (F.col("flow_duration").isNull(), "flow_duration out of BIGINT range"),
        (F.col("fwd_packets").isNull() | (F.col("fwd_packets") < 0), "fwd_packets out of INTEGER range"),
        (F.col("bwd_packets").isNull() | (F.col("bwd_packets") < 0), "bwd_packets out of INTEGER range"),
        (F.col("fwd_bytes").isNull(), "fwd_bytes out of BIGINT range"),
        (F.col("bwd_bytes").isNull(), "bwd_bytes out of BIGINT range"),
        (rate_bad("flow_bytes_per_sec"), "flow_bytes_per_sec does not fit NUMERIC(15,4)"),
        (rate_bad("flow_packets_per_sec"), "flow_packets_per_sec does not fit NUMERIC(15,4)"),
    ]
    if trusted_lookups:
        out = [r for r in out if not any(r[1].startswith(c + " ") for c in LOOKUP_COLUMNS)]
    return out


LENGTH_LIMITS = {"label": 100, "attack_category": 50, "protocol": 20, "severity": 10,
                 "source_country": 100, "source_region": 100}


def error_column(trusted_lookups: bool = False) -> Column:
    """First failing rule's message, or null for a valid row."""
    return F.coalesce(*[F.when(cond, F.lit(msg)) for cond, msg in rules(trusted_lookups)])


def with_errors(events: DataFrame, trusted_lookups: bool = False) -> DataFrame:
    return events.withColumn("_error", error_column(trusted_lookups))


def valid_events(events: DataFrame, trusted_lookups: bool = False) -> DataFrame:
    return with_errors(events, trusted_lookups).filter(F.col("_error").isNull()).drop("_error")


def rejected_events(events: DataFrame, trusted_lookups: bool = False) -> DataFrame:
    """Quarantine rows: event_id, source_ip, label and the first ``_error``."""
    e = with_errors(events, trusted_lookups).filter(F.col("_error").isNotNull())
    return e.select("event_id", "source_ip", "label", "_error")


def validate_flow(events: DataFrame, trusted_lookups: bool = False) -> DataFrame:
    """Rejected rows only: event_id, source_ip, label and the first error."""
    return rejected_events(events, trusted_lookups)


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Natural keys that occur more than once (empty when the key holds)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def check_fk(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key has no dimension row (empty when the FK holds)."""
    return fact.join(dim.select(key), on=key, how="left_anti")


def audit_keys(fact: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Uniqueness and foreign keys of a star schema in one pass: one row for each
    of ``dims`` ({dimension: (its rows, its key)}) with the numbers of its keys,
    of duplicated keys, of fact keys without a row (orphans), of fact rows and of
    those that orphans concern.

    The fact's keys of all dimensions and the dimensions' own keys are one tagged
    union with one shuffle; fact rows are counted by key before it.
    """
    tagged = F.explode(F.array(*[F.struct(F.lit(name).alias("dimension"), F.col(key).cast("bigint").alias("key"))
                                 for name, (_, key) in dims.items()])).alias("k")
    rows = fact.select(tagged).select("k.dimension", "k.key", F.lit(0).alias("held"), F.lit(1).alias("used"))
    for name, (dim, key) in dims.items():
        rows = rows.unionByName(dim.select(F.lit(name).alias("dimension"), F.col(key).cast("bigint").alias("key"),
                                           F.lit(1).alias("held"), F.lit(0).alias("used")))
    keys = rows.groupBy("dimension", "key").agg(F.sum("held").alias("held"), F.sum("used").alias("used"))
    orphan = (F.col("held") == 0) | F.col("key").isNull()
    return keys.groupBy("dimension").agg(
        F.count_if(F.col("held") > 0).alias("n_keys"), F.count_if(F.col("held") > 1).alias("n_duplicated"),
        F.count_if(orphan & (F.col("used") > 0)).alias("n_orphans"), F.sum("used").alias("n_fact_rows"),
        F.coalesce(F.sum(F.when(orphan, F.col("used"))), F.lit(0)).alias("n_orphan_rows"))
