"""Do star, documents and graph hold the same events?

The graph keeps events as counts of its edges, so the models are compared by
what each edge set stands for: its keys, the events on them and (``e_attacked``)
their bytes.  Each model is reduced to sums by bucket of hashed keys, which add
up in any order and are the same whether an event is a row or a part of an
edge's count.  Only the keys of buckets that differ are compared themselves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import star
from ..operators.graph import hour_text

BUCKETS = 4096  # for each view; what is shuffled is at most this by task, model and view

#: The edge sets compared, with the two keys of each.
VIEWS = {"e_attacked": ("src_ip", "dst_ip"), "e_used_attack": ("src_ip", "label"), "e_targeted_by": ("dst_ip", "label"),
         "e_used_protocol": ("src_ip", "protocol"), "e_active_in": ("label", "hour_bucket")}
MODELS = ("star", "document", "graph")


def _by_view(events: DataFrame) -> DataFrame:
    """Events with the keys of all views -> a row for each view."""
    rows = [F.struct(F.lit(v).alias("view"), F.col(a).alias("a"), F.col(b).alias("b"), F.lit(1).cast("bigint").alias("n"),
                     (F.col("bytes") if v == "e_attacked" else F.lit(0)).cast("bigint").alias("bytes")) for v, (a, b) in VIEWS.items()]
    return events.select(F.inline(F.array(*rows)))


def _star(t) -> DataFrame:
    labels, protocols = t["dim_attack"].select("attack_key", "attack_label"), t["dim_protocol"].select("protocol_key", "protocol_name")
    f = t["fact_network_event"].join(labels, "attack_key", "left").join(protocols, "protocol_key", "left")
    return _by_view(f.select(star.endpoint_ip("source_key").alias("src_ip"), star.endpoint_ip("dest_key").alias("dst_ip"),
                             F.col("attack_label").alias("label"), F.col("protocol_name").alias("protocol"),
                             hour_text(S.key_to_minute("time_key")).alias("hour_bucket"), (F.col("fwd_bytes") + F.col("bwd_bytes")).alias("bytes")))


def _document(t) -> DataFrame:
    return _by_view(t["documents"].select(
        F.col("source.ip").alias("src_ip"), F.col("destination.ip").alias("dst_ip"), F.col("attack.label").alias("label"),
        F.col("protocol.name").alias("protocol"), hour_text("timestamp").alias("hour_bucket"),
        (F.coalesce("metrics.fwd_bytes", F.lit(0)) + F.coalesce("metrics.bwd_bytes", F.lit(0))).alias("bytes")))


def _graph(t) -> DataFrame:
    sets = []
    for view, (a, b) in VIEWS.items():
        held = "event_count" if view == "e_active_in" else "count"
        size = F.col("total_bytes") if view == "e_attacked" else F.lit(0)
        sets.append(t[view].select(F.lit(view).alias("view"), F.col(a).alias("a"), F.col(b).alias("b"), F.col(held).cast("bigint").alias("n"),
                                   size.cast("bigint").alias("bytes")))
    return reduce(DataFrame.unionByName, sets)


def _rows(t) -> DataFrame:
    """(model, view, a, b, n, bytes) of all models."""
    return reduce(DataFrame.unionByName, [rows(t).withColumn("model", F.lit(m)) for m, rows in zip(MODELS, (_star, _document, _graph))])


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("view", "a", "b"), F.lit(buckets)).cast("int")


def _differs(*sums: str) -> Column:
    """Some model has another sum than the star (a model without rows has none)."""
    return reduce(Column.__or__, [~F.col(f"{s}_{m}").eqNullSafe(F.col(f"{s}_star")) for s in sums for m in MODELS[1:]])


def _side_by_side(grouped, sums: dict[str, Column]) -> DataFrame:
    """The models' sums of each group as columns ``<sum>_<model>``."""
    out = grouped.pivot("model", list(MODELS)).agg(*[e.alias(s) for s, e in sums.items()])
    return out.withColumnsRenamed({f"{m}_{s}": f"{s}_{m}" for m in MODELS for s in sums})


def bucket_checksums(t, buckets: int = BUCKETS) -> DataFrame:
    """One row for each view and bucket: events, bytes and a checksum of the keys
    in each model, and whether they differ."""
    # the checksum is a sum of 20 bits an event: exact up to 2^43 events a bucket
    of_key = F.pmod(F.xxhash64("b", "a", F.lit(1)), F.lit(1 << 20)) * F.col("n")
    sums = {"n_events": F.sum("n"), "total_bytes": F.sum("bytes"), "check": F.sum("of_key")}
    rows = _rows(t).withColumns({"bucket": _bucket(buckets), "of_key": of_key})
    return _side_by_side(rows.groupBy("view", "bucket"), sums).withColumn("differs", _differs(*sums))


def reconcile_events(t, buckets: int = BUCKETS) -> DataFrame:
    """One row for each view: events and bytes in each model, the number of
    buckets that differ, and whether the models agree."""
    sums = [f"{s}_{m}" for s in ("n_events", "total_bytes") for m in MODELS]
    out = bucket_checksums(t, buckets).groupBy("view").agg(*[F.sum(c).alias(c) for c in sums], F.count_if("differs").alias("n_differing"))
    return out.withColumn("agree", F.col("n_differing") == 0)


def differing_keys(t, buckets: int = BUCKETS) -> DataFrame:
    """The keys (``a``, ``b``) of a view whose events or bytes differ between the
    models.  Rows of buckets that agree are dropped before the shuffle by a join
    with the differing buckets (at most ``buckets`` for each view)."""
    bad = bucket_checksums(t, buckets).filter("differs").select("view", "bucket")
    rows = _rows(t).withColumn("bucket", _bucket(buckets)).join(bad, ["view", "bucket"], "left_semi")
    sums = {"n_events": F.sum("n"), "total_bytes": F.sum("bytes")}
    return _side_by_side(rows.groupBy("view", "a", "b"), sums).filter(_differs(*sums))
