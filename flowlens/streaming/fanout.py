"""One micro-batch into every model (the consumer's fan-out).

``foreachBatch`` persists the checked batch once, splits good and quarantined rows,
and writes each model under ``batch_id=<n>``; a replayed batch overwrites the
same directory, so delivery is effectively exactly-once.  A failing model
write does not stop the others; a ledger keeps what each batch has written, so
the replay writes only what failed.

Facts, documents and dead letters of all batches simply add up.  Dimensions
and vertices are first-write-wins: the stream's state knows the keys that have
come in before, and a batch writes the others only (``unseen_keys``), so their
parts hold each key once.  Edges and the hourly document summary are additive
(``merged_edges``, ``merged_hourly_documents``).
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lookups as L
from ..operators import graph, incremental, nested, star, summaries, upsert, validate
from ..session import keep_state_on_disk, read_or_none

log = logging.getLogger(__name__)

#: First-write-wins models and the key of each.
FIRST_WINS = {
    "dim_time": "time_key", "dim_source": "source_key", "dim_destination": "dest_key",
    "dim_attack": "attack_key", "dim_protocol": "protocol_key",
    "v_source_ip": "ip", "v_destination_ip": "ip", "v_attack_type": "label", "v_protocol": "name",
    "v_time_window": "hour_bucket",
}
#: Additive edge sets and the key of each.
EDGES = {"e_attacked": ["src_ip", "dst_ip"], "e_used_attack": ["src_ip", "label"], "e_targeted_by": ["dst_ip", "label"],
         "e_used_protocol": ["src_ip", "protocol"], "e_active_in": ["label", "hour_bucket"]}


#: Seed rows of the dimensions that have some: their column and its seeds.
SEEDS = {"dim_attack": ("attack_label", [row[0] for row in L.ATTACK_SEEDS]),
         "dim_protocol": ("protocol_name", [row[0] for row in L.PROTOCOL_SEEDS])}


def _model_keys() -> dict[str, F.Column]:
    """The key that a valid event has in each first-write-wins model."""
    return {
        "dim_time": star.time_key(), "dim_source": star.source_key(), "dim_destination": star.dest_key(),
        "dim_attack": star.attack_key(), "dim_protocol": star.protocol_key(),
        "v_source_ip": F.col("source_ip"), "v_destination_ip": F.col("destination_ip"), "v_attack_type": F.col("label"),
        "v_protocol": F.coalesce("protocol", F.lit("OTHER")), "v_time_window": graph.hour_text("timestamp"),
    }


#: Arrow batches whose keys are made distinct together before they are shuffled.
DISTINCT_OVER = 16


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_model, _key) of rows that hold the key of each model in a column of its
    name: distinct over ``DISTINCT_OVER`` batches, which are all that is held."""
    while held := list(islice(batches, DISTINCT_OVER)):
        rows = pa.Table.from_batches(held)
        for name in rows.column_names:
            keys = rows[name].unique().cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(name), len(keys)), keys], ["_model", "_key"])


def unseen_keys(events: DataFrame, trusted_lookups: bool = False) -> DataFrame:
    """(_model, _key) of an event stream: the keys of each first-write-wins model
    that no earlier micro-batch has had, told once.

    Only valid events count, as only they are written.  An event is one row with
    its keys as columns until they are made distinct, over some Arrow batches at
    a time and before they are shuffled, so a label of a third of all events
    ships a row for each of these.  The state holds every key of these models
    for good, in RocksDB, and is restored from the checkpoint: a replayed batch is
    told the same keys again.
    """
    keep_state_on_disk(events.sparkSession)
    if "_parse_error" in events.columns:
        events = events.filter(F.col("_parse_error").isNull())
    keys = validate.valid_events(events, trusted_lookups).select(*[key.alias(name) for name, key in _model_keys().items()])
    return keys.mapInArrow(_distinct, "_model string, _key string").dropDuplicates(["_model", "_key"])


def _unwritten(rows: DataFrame, name: str, unseen: DataFrame) -> DataFrame:
    """The rows of a first-write-wins model whose keys are among ``unseen``.  Seeds
    were written with the first batch."""
    if name in SEEDS:
        col, seeds = SEEDS[name]
        rows = rows.filter(F.col(col).isNull() | ~F.col(col).isin(seeds))
    new = unseen.filter(F.col("_model") == name).select("_key")
    return rows.join(new, rows[FIRST_WINS[name]].cast("string") == new["_key"], "left_semi")


def _write(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def written_models(spark, base: str, batch_id: int) -> set[str]:
    """The models that the ledger names for a batch."""
    rows = read_or_none(spark, f"{base}/ledger/batch_id={batch_id}")
    return set() if rows is None else {r["model"] for r in rows.collect()}


def write_models(batch: DataFrame, batch_id: int, base: str, trusted_lookups: bool = False, parallel: int = 4,
                 unseen: DataFrame | None = None) -> dict[str, str]:
    """Write every model of one batch: dead letters, fact, dimensions,
    documents and their hourly summary, vertices and edges.  Returns
    {model: 'ok' | error text}.

    The writes are independent jobs, ``parallel`` of them submitted at a time.
    A ledger under ``base/ledger`` keeps which models a batch has written, so a
    replay writes only those that failed (all of them, over what is there, if
    the driver was lost before the ledger was written).

    ``unseen`` (see ``unseen_keys``) limits dimensions and vertices to the keys
    that it tells; the stream's first batch, 0, has no others.  Without it they
    are written whole with every batch.
    """
    spark = batch.sparkSession
    done = written_models(spark, base, batch_id)
    checked = validate.with_errors(batch, trusted_lookups).persist()
    try:
        good = checked.filter(F.col("_error").isNull()).drop("_error")
        bad = checked.filter(F.col("_error").isNotNull())
        g = graph.graph_input(good)
        docs = nested.flow_document(good)
        models = {
            "dead_letters": bad.select(F.to_json(F.struct(*batch.columns)).alias("value"),
                                       "_error", "source_ip", "label", "event_id"),
            "fact_network_event": star.fact_network_event(good),
            "documents": docs,
            "doc_hourly_summary": nested.hourly_document_summary(docs),
        }
        for name in FIRST_WINS:
            rows = getattr(star, name)(good) if name.startswith("dim_") else getattr(graph, name)(g)
            models[name] = rows if unseen is None or batch_id == 0 else _unwritten(rows, name, unseen)
        for name in EDGES:
            models[name] = getattr(graph, name)(g)

        def write(name: str) -> str:
            try:
                _write(models[name], f"{base}/{name}", batch_id)
                return "ok"
            except Exception as e:  # noqa: BLE001 - one model must not stop the others
                log.warning("model %s failed for batch %s: %s", name, batch_id, e)
                return str(e)

        todo = [name for name in models if name not in done]
        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            status = dict.fromkeys(models, "ok") | dict(zip(todo, pool.map(write, todo)))
        if todo:
            rows = [(name,) for name, what in status.items() if what == "ok"]
            _write(spark.createDataFrame(rows, "model string").coalesce(1), f"{base}/ledger", batch_id)
    finally:
        checked.unpersist()
    return status


def fanout_stream(events: DataFrame, base: str, checkpoint: str, trusted_lookups: bool = False,
                  refresh: summaries.RefreshPolicy | None = None):
    """``writeStream`` that fans every micro-batch out to all models.  Parsed
    messages get their arrival ids here; lines that failed to parse are kept
    under ``parse_dead_letters``.  With a ``refresh`` policy the summaries are
    brought up to date under ``base/summaries`` whenever enough rows have come in; call
    ``refresh_summaries`` once more when the stream has ended.

    A batch is the events and, as rows of their own, the keys that ``unseen_keys``
    tells of them: one query with one checkpoint, for which Spark reads the source
    twice.  ``base`` belongs to its checkpoint: begin both anew together."""
    from ..sources import messages

    def each(batch: DataFrame, batch_id: int):
        batch = batch.persist()
        try:
            unseen = batch.filter(F.col("_model").isNotNull()).select("_model", "_key")
            rows = batch.filter(F.col("_model").isNull()).drop("_model", "_key")
            if "_parse_error" in rows.columns:
                rows = messages.sequenced(rows, batch_id)
                _write(messages.dead_letters(rows), f"{base}/parse_dead_letters", batch_id)
                rows = messages.good_events(rows)
            write(rows, batch_id, unseen)
        finally:
            batch.unpersist()

    def write(batch: DataFrame, batch_id: int, unseen: DataFrame):
        status = write_models(batch, batch_id, base, trusted_lookups, unseen=unseen)
        failed = {k: v for k, v in status.items() if v != "ok"}
        if failed:  # the batch is replayed; writes are keyed by its id
            raise RuntimeError(f"batch {batch_id}: models not written: {failed}")
        if refresh is not None:
            spark = batch.sparkSession
            written = spark.read.parquet(f"{base}/fact_network_event/batch_id={batch_id}").count()
            if refresh.add(written):
                refresh_summaries(spark, base, batch_id)
    both = events.unionByName(unseen_keys(events, trusted_lookups), allowMissingColumns=True)
    return both.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)


def merged_edges(spark, base: str, name: str, keys: list[str]) -> DataFrame:
    """All batches of an edge set merged (count/bytes add, first/last min/max)."""
    parts = spark.read.parquet(f"{base}/{name}").drop("batch_id")
    return upsert.merge_edges(parts.limit(0), parts, keys)


def merged_first(spark, base: str, name: str) -> DataFrame:
    """All batches of a dimension or vertex set: the first batch that has a key
    decides its attributes (seeds are in every batch and win there)."""
    parts, key = spark.read.parquet(f"{base}/{name}"), FIRST_WINS[name]
    cols = [c for c in parts.columns if c != "batch_id"]
    first = F.min_by(F.struct(*cols), "batch_id").alias("first")
    return parts.groupBy(F.col(key).alias("_key")).agg(first).select("first.*")


def merged_hourly_documents(spark, base: str) -> DataFrame:
    """All batches of the hourly document summary merged."""
    parts = spark.read.parquet(f"{base}/doc_hourly_summary").drop("batch_id")
    return upsert.merge_hourly_documents(parts.limit(0), parts)


def model_counts(spark, base: str) -> DataFrame:
    """(model, n_rows, n_events) of every model, all batches merged: its rows and
    the events that they stand for (null for dimensions and vertices)."""
    def merged(name: str) -> DataFrame | None:
        if name in FIRST_WINS:
            return merged_first(spark, base, name)
        if name in EDGES:
            return merged_edges(spark, base, name, EDGES[name])
        return merged_hourly_documents(spark, base) if name == "doc_hourly_summary" else read_or_none(spark, f"{base}/{name}")

    def counted(name: str, rows: DataFrame) -> DataFrame:
        held = [c for c in ("count", "event_count") if c in rows.columns]
        events = F.lit(None) if name in FIRST_WINS else F.coalesce(F.sum(held[0]), F.lit(0)) if held else F.count(F.lit(1))
        return rows.agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("n_rows"), events.cast("bigint").alias("n_events"))

    names = ["parse_dead_letters", "dead_letters", "fact_network_event", "documents", "doc_hourly_summary", *FIRST_WINS, *EDGES]
    found = [(name, merged(name)) for name in names]
    return reduce(DataFrame.unionByName, [counted(name, rows) for name, rows in found if rows is not None])


def key_counts(spark, base: str) -> DataFrame:
    """(model, n_rows, n_keys) of every first-write-wins model: the rows of all its
    parts and their different keys, equal if no batch wrote a key again."""
    return reduce(DataFrame.unionByName, [
        spark.read.parquet(f"{base}/{name}").agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("n_rows"), F.countDistinct(key).alias("n_keys"))
        for name, key in FIRST_WINS.items()])


def refresh_summaries(spark, base: str, refresh: int) -> dict[str, str]:
    """Bring the six summaries up to the batches up to ``refresh``: only the
    facts of new batches and the states of the days they touch are read.  A
    summary that fails keeps what it has; it is logged and catches up the next
    time."""
    t = {name: merged_first(spark, base, name) for name in FIRST_WINS if name.startswith("dim_")}
    facts = spark.read.parquet(f"{base}/fact_network_event")
    status = incremental.refresh_all(t, facts, f"{base}/summaries", refresh)
    for name, what in status.items():
        if what != "ok":
            log.warning("summary %s not refreshed at batch %s: %s", name, refresh, what)
    return status
