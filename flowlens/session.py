"""Spark session defaults for the library.

The library never hard-codes cluster paths: a job reads ``spark.checkpoint.dir``
from the session it is given, or a folder that its caller names.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # generated methods above 8 KB are never JIT-compiled by HotSpot; let
    # Spark split such stages instead of running them interpreted
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(master: str = "local[*]", shuffle_partitions: int = 8,
                app_name: str = "flowlens", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings every job here assumes."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g"))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Session settings the results depend on (time zone = wall clock, ANSI)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def checkpoint_dir(spark: SparkSession, folder: str | None = None) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    On a cluster this is the folder that ``spark.checkpoint.dir`` names.  Where
    the setting is absent, the caller names one (``folder``, the library's own
    setting ``flowlens.scratch.dir``, or ``SparkContext.setCheckpointDir``).
    Without any of them the call fails: a folder guessed here would be local
    to one machine.
    """
    sc = spark.sparkContext
    found = (spark.conf.get("spark.checkpoint.dir", None) or folder
             or spark.conf.get("flowlens.scratch.dir", None) or sc.getCheckpointDir())
    if not found:
        raise RuntimeError("no shared scratch folder: set spark.checkpoint.dir (or flowlens.scratch.dir) "
                           "to a folder that the driver and all executors can reach")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for a written table.  The
    folder's URI scheme stays: without it a cluster whose default file system
    is another one would write elsewhere."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}"


def keep_state_on_disk(spark: SparkSession) -> None:
    """Streams started from here on keep their state in RocksDB, off the heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """A written table, or None where nothing has been written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
