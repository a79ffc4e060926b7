"""All data models derived from one events source, as lazy DataFrames.

``build_tables(spark, sf_dir)`` returns every table of the warehouse (clean
events, quarantine, star schema, documents, graph, summaries) as a plan over
the ``events`` parquet.  Nothing is collected; callers that reuse tables many
times either persist them or write them with ``write_tables`` (to a shared
folder) and read them back with ``read_tables``.  ``stored_tables`` writes each
table when a query first reads it.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, graph, nested, star, summaries, validate
from ..sources import adapter

MODEL_ORDER = [
    "events", "rejected",
    "dim_time", "dim_source", "dim_destination", "dim_attack", "dim_protocol",
    "fact_network_event", "documents", "doc_hourly_summary",
    "v_source_ip", "v_destination_ip", "v_attack_type", "v_protocol", "v_time_window",
    "e_attacked", "e_used_attack", "e_targeted_by", "e_used_protocol", "e_active_in",
    "e_has_label_set", "v_label_set", "e_connected_to",
    *summaries.BUILDERS,
]


class Tables(dict):
    """dict of name -> DataFrame that builds each table on first access."""

    def __init__(self, builders: dict):
        super().__init__()
        self._builders = builders

    def __missing__(self, key):
        if key not in self._builders:
            raise KeyError(key)
        df = self._builders[key](self)
        self[key] = df
        return df

    def get(self, key, default=None):
        return self[key] if key in self or key in self._builders else default

    def names(self) -> list[str]:
        return list(self._builders)


def tables_from_events(flow_events: DataFrame, trusted_lookups: bool = False,
                       raw: DataFrame | None = None, validated: bool = False) -> Tables:
    """Models over flow events (18 fields + event_id).  ``trusted_lookups``
    when they come from ``clean_flows`` (lookup-valued columns are valid by
    construction)."""
    b = {
        "flow_events": lambda t: flow_events,
        "raw_flows": lambda t: raw,
        "events": (lambda t: t["flow_events"]) if validated else
                  (lambda t: validate.valid_events(t["flow_events"], trusted_lookups)),
        "rejected": lambda t: validate.rejected_events(t["flow_events"], trusted_lookups),
        "dim_time": lambda t: star.dim_time(t["events"]),
        "dim_source": lambda t: star.dim_source(t["events"]),
        "dim_destination": lambda t: star.dim_destination(t["events"]),
        "dim_attack": lambda t: star.dim_attack(t["events"]),
        "dim_protocol": lambda t: star.dim_protocol(t["events"]),
        "fact_network_event": lambda t: star.fact_network_event(t["events"]),
        "documents": lambda t: nested.flow_document(t["events"]),
        "doc_hourly_summary": lambda t: nested.hourly_document_summary(t["documents"]),
        "graph_input": lambda t: graph.graph_input(t["events"]),
    }
    for name in ("v_source_ip", "v_destination_ip", "v_attack_type", "v_protocol", "v_time_window",
                 "e_attacked", "e_used_attack", "e_targeted_by", "e_used_protocol", "e_active_in"):
        fn = getattr(graph, name)
        b[name] = (lambda fn: lambda t: fn(t["graph_input"]))(fn)
    b["e_has_label_set"] = lambda t: graph.e_has_label_set(t["e_used_attack"])
    b["v_label_set"] = lambda t: graph.v_label_set(t["e_has_label_set"])
    b["e_connected_to"] = lambda t: graph.e_connected_to(t["v_label_set"])
    for name, fn in summaries.BUILDERS.items():
        b[name] = (lambda fn: lambda t: fn(t))(fn)
    tables = Tables(b)
    tables.trusted_lookups = trusted_lookups
    tables.validated = validated
    return tables


def build_tables(spark: SparkSession, sf_dir: str, observations: tuple[Observation, Observation] | None = None) -> Tables:
    """Every model derived from ``{sf_dir}/events.parquet`` via the adapter.
    ``observations`` count the rows before and after cleaning."""
    raw = adapter.raw_flows(spark, sf_dir)
    return tables_from_events(clean.clean_flows(raw, ip_format="decimal", observations=observations), trusted_lookups=True,
                              raw=raw)


#: Stored table of all cleaned events with their first error.
CHECKED = "checked_events"

# Stored layout: daily tables are partitioned by day, so a day filter reads
# only that day's files (the role indexes on the day column played).
PARTITION_BY = {
    "summary_top_sources": "day_bucket",
    "summary_protocol_daily": "day_bucket",
    "summary_severity_daily": "day_bucket",
    "summary_dest_port_daily": "day_bucket",
}

DAY = "_day"  # partition column of the tables of events, kept out of their schema

#: Tables of events are partitioned by day and in time order inside, a busy day in
#: several files: (day, order, columns with a bloom filter).
BY_DAY = {
    "fact_network_event": (lambda: summaries.day_of_key(), "time_key", ["source_key", "dest_key"]),
    "documents": (lambda: F.to_date("timestamp"), "timestamp", ["source.ip", "destination.ip"]),
}

#: Hourly summaries have some thousand rows a year: too few for a file a day, so
#: they are only put in order, by which row groups are skipped.
IN_ORDER = {"summary_attack_hourly": "hour_bucket", "doc_hourly_summary": "hour_bucket"}


def _writer(df: DataFrame, name: str):
    """The writer of a table in its stored layout."""
    if name in IN_ORDER:
        df = df.repartitionByRange(IN_ORDER[name]).sortWithinPartitions(IN_ORDER[name])
    if name not in BY_DAY:
        return df.write.partitionBy(PARTITION_BY[name]) if name in PARTITION_BY else df.write
    day, order, looked_up = BY_DAY[name]
    w = df.withColumn(DAY, day()).repartitionByRange(DAY, order).sortWithinPartitions(DAY, order).write.partitionBy(DAY)
    for col in looked_up:
        w = w.option(f"parquet.bloom.filter.enabled#{col}", "true")
    return w.option("parquet.bloom.filter.adaptive.enabled", "true")


def write_tables(t: Tables, path: str, names: list[str] | None = None, parallel: int = 4) -> None:
    """Materialise tables as parquet under ``path`` (overwrite).

    Every cleaned row is written once, with its first error (null for a valid
    row); valid events and quarantine are two filters on that table.  All
    models are built from it: lineage is cut there (a lost executor recomputes
    from the stored events, not from the raw input) and cleaning runs once.
    """
    names = list(MODEL_ORDER if names is None else names)
    spark = t["flow_events"].sparkSession
    if getattr(t, "validated", False):
        checked = t["events"].withColumn("_error", F.lit(None).cast("string"))
    else:
        checked = validate.with_errors(t["flow_events"], getattr(t, "trusted_lookups", False))
    checked.write.mode("overwrite").parquet(f"{path}/{CHECKED}")
    stored = tables_from_events(read_table(spark, path, "events"), validated=True)
    todo = []
    for name in names:
        if name in ("events", "rejected"):
            continue
        todo.append((name, stored[name]))
    # independent jobs: submitted concurrently so the scheduler can overlap
    # their stages (each job is itself distributed)
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        futures = []
        for name, df in todo:
            futures.append(pool.submit(_writer(df, name).mode("overwrite").parquet, f"{path}/{name}"))
        for f in futures:
            f.result()


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One stored table.  ``flow_events`` (all cleaned rows), ``events`` and
    ``rejected`` are views of the one table of checked events."""
    if name not in ("flow_events", "events", "rejected"):
        return spark.read.parquet(f"{path}/{name}").drop(DAY)
    checked = spark.read.parquet(f"{path}/{CHECKED}")
    if name == "rejected":
        return checked.filter(F.col("_error").isNotNull()).select("event_id", "source_ip", "label", "_error")
    return (checked.filter(F.col("_error").isNull()) if name == "events" else checked).drop("_error")


def read_tables(spark: SparkSession, path: str, names: list[str] | None = None) -> Tables:
    """Stored tables; ``by_day`` holds those partitioned by day with that column,
    by which a query of one day reads that day's files alone."""
    t = Tables({})
    t.update({name: read_table(spark, path, name) for name in names or MODEL_ORDER})
    t.by_day = {name: spark.read.parquet(f"{path}/{name}") for name in BY_DAY if name in t}
    return t


#: Projections of the events: tables built from these read the events themselves.
NARROW = ("events", "fact_network_event", "documents", "graph_input")


class StoredTables(Tables):
    """All models for ``sf_dir``, each written whole under ``path`` when it is first
    read, and read back from there.

    A query pays for the tables that it reads and for what they are built from,
    not for all others: one of raw flows writes none, as these stay lazy (they are
    one projection of the input).  Cleaned events are written once, before the first
    model; dimensions, label sets and edges that other models are built from are
    written before these.  One thread writes at a time.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, path: str):
        self._seen = Observation(), Observation()
        self._lazy = build_tables(spark, sf_dir, self._seen)
        super().__init__(tables_from_events(self._lazy["flow_events"])._builders)
        self._spark, self._path, self._lock, self._models = spark, path, threading.RLock(), None
        self["raw_flows"] = self._lazy["raw_flows"]
        self.by_day = Tables({name: (lambda n: lambda _: self._with_day(n))(name) for name in BY_DAY})

    def __missing__(self, key):
        if key not in self._builders:
            raise KeyError(key)
        with self._lock:
            if key not in self:
                self[key] = self._stored(key)
            return self[key]

    def _events(self) -> Tables:
        """The models over the stored events, which are written at the first call:
        projections of them as such, all others as they are stored."""
        with self._lock:
            if self._models is None:
                write_tables(self._lazy, self._path, [])
                built = tables_from_events(read_table(self._spark, self._path, "events"), validated=True)
                self._models = Tables({n: fn if n in NARROW or n == "flow_events" else (lambda n: lambda _: self[n])(n)
                                       for n, fn in built._builders.items()})
            return self._models

    def _stored(self, name: str) -> DataFrame:
        models = self._events()
        if name == "graph_input":
            return models[name]
        if name not in ("flow_events", "events", "rejected"):
            _writer(self._builders[name](models), name).mode("overwrite").parquet(f"{self._path}/{name}")
        return read_table(self._spark, self._path, name)

    def _with_day(self, name: str) -> DataFrame:
        self[name]
        return self._spark.read.parquet(f"{self._path}/{name}")

    @property
    def cleaning(self) -> dict:
        self._events()
        return clean.clean_stats(self._seen)


_STORED: dict = {}


def stored_tables(spark: SparkSession, sf_dir: str) -> StoredTables:
    """All models for ``sf_dir``, each written once per Spark application under
    the shared checkpoint folder, when first read; later calls reuse them."""
    from ..session import scratch_path
    key = (spark.sparkContext.applicationId, spark._jsparkSession.hashCode(), sf_dir)
    if key not in _STORED:
        import uuid
        _STORED[key] = StoredTables(spark, sf_dir, scratch_path(spark, f"warehouse-{uuid.uuid4().hex[:12]}"))
    return _STORED[key]
