"""Keyed upserts and incremental merges, expressed as DataFrame set logic.

All three shapes are idempotent when the same batch is applied twice:
insert-only dimensions (anti join), replace-by-key summaries (anti join +
union), and additive edge/summary merges keyed by batch (the caller writes
each batch once under its batch id, see ``streaming.fanout``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def insert_new_keys(stored: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Dimension upsert: rows whose key is already stored are skipped
    (first write wins)."""
    fresh = incoming.join(stored.select(*keys), on=keys, how="left_anti")
    return stored.unionByName(fresh.select(*stored.columns))


def replace_by_key(stored: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Summary upsert: incoming rows replace stored rows with the same key."""
    kept = stored.join(incoming.select(*keys), on=keys, how="left_anti").select(*stored.columns)
    return kept.unionByName(incoming)


def merge_additive(stored: DataFrame, incoming: DataFrame, keys: list[str],
                   sums: list[str] = (), mins: list[str] = (), maxs: list[str] = (),
                   latest: dict[str, str] | None = None) -> DataFrame:
    """Additive merge: counts and bytes add up, first/last seen take min/max,
    ``latest`` columns take the value of the row with the highest sequence
    (``{column: sequence_column}``)."""
    u = stored.unionByName(incoming)
    aggs = [F.sum(c).alias(c) for c in sums] + [F.min(c).alias(c) for c in mins] + \
           [F.max(c).alias(c) for c in maxs]
    for col, seq in (latest or {}).items():
        aggs.append(F.max_by(col, seq).alias(col))
    return u.groupBy(*keys).agg(*aggs)


def merge_edges(stored: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Edge merge: ``count``/``total_bytes``/``event_count`` add,
    ``first_seen`` min, ``last_seen`` max (whatever of these exist)."""
    cols = set(incoming.columns)
    sums = [c for c in ("count", "total_bytes", "event_count") if c in cols]
    mins = [c for c in ("first_seen",) if c in cols]
    maxs = [c for c in ("last_seen",) if c in cols]
    return merge_additive(stored, incoming, keys, sums, mins, maxs)


def merge_hourly_documents(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incremental document hourly summary: counts and bytes add up, category
    and severity are last-write-wins by arrival sequence."""
    return merge_additive(stored, incoming, ["hour_bucket", "attack_label"],
                          sums=["event_count", "total_bytes"], maxs=["last_seq"],
                          latest={"attack_category": "last_seq", "severity": "last_seq"})
