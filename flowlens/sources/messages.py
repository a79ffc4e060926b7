"""Flow event messages (JSON lines, one event per line).

Broken lines and lines that do not match the event schema go to the dead
letters with their text and an ``_error``; the end-of-stream sentinel record
is recognised and dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import lookups as L
from ..functions import scalars as S
from ..session import keep_state_on_disk
from ..streaming.aggregates import EVENT_SCHEMA

MESSAGE_SCHEMA = T.StructType(EVENT_SCHEMA.fields + [
    T.StructField("_sentinel", T.StringType()), T.StructField("total_records", T.LongType()),
    T.StructField("message_id", T.StringType())])

#: Field of a parsed line that holds its text where the line or one of its values doesn't parse.
BROKEN = "_broken"

# bytes beyond which from_json takes texts that json_object_keys doesn't
LONG_LINE = 1_000_000


def to_message(events: DataFrame, key: str | None = None) -> DataFrame:
    """Events -> JSON text (ISO timestamps), the published form.  ``key`` is a
    column that tells the publisher's messages apart; it is sent as
    ``message_id``, by which :func:`counted_once` knows a message sent again."""
    cols = [c for c in EVENT_SCHEMA.fieldNames()]
    ev = events.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss"))
    if key is not None:
        cols.append(F.col(key).cast("string").alias("message_id"))
    return ev.select("event_id", F.to_json(F.struct(*cols)).alias("value"))


def parse_messages(lines: DataFrame, value_col: str = "value", seq_col: str | None = None) -> DataFrame:
    """JSON text -> typed events + ``_parse_error`` (null when the line is good).
    Without ``seq_col`` the event_id stays null until :func:`sequenced`.

    A line is parsed once: its record is a generated row, since filters are put
    below a projection and would parse the line (and write a message's text) again
    for each field they ask for.  Only a line that isn't plain JSON of this schema is
    parsed again, with NaN and infinity as numbers, and asked for its keys, which tell
    whether it is an object."""
    value, schema = F.col(value_col), T.StructType(MESSAGE_SCHEMA.fields + [T.StructField(BROKEN, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    plain = F.array(F.from_json(value, schema, {**options, "allowNonNumericNumbers": "false"}))

    def looked_at_again(m):
        sure = m[BROKEN].isNull() & m["timestamp"].isNotNull() & (F.octet_length(value) <= LONG_LINE)
        again = F.struct(F.from_json(value, schema, options).alias("m"), F.json_object_keys(value).isNotNull().alias("is_object"))
        return F.when(sure, F.struct(m.alias("m"), F.lit(True).alias("is_object"))).otherwise(again)

    df = lines.select("*", F.inline(F.transform(plain, looked_at_again)))
    is_sentinel = F.col("m._sentinel") == F.lit(L.END_OF_STREAM)
    err = (F.when(F.col("m").isNull() | ~F.col("is_object"), F.lit("not a JSON object"))
           .when(F.col("m.timestamp").isNull(), F.lit("missing timestamp"))
           .when(S.iso_parse(F.col("m.timestamp")).isNull(), F.lit("timestamp is not parsable"))
           .when(F.col("m.label").isNull(), F.lit("missing label")))
    out = df.filter(~F.coalesce(is_sentinel, F.lit(False))).select(
        *( [F.col(seq_col).alias("event_id")] if seq_col else
           [F.lit(None).cast("bigint").alias("event_id")]),
        value.alias("value"), F.col("m.message_id").alias("message_id"),
        *[F.col(f"m.{f}").alias(f) for f in EVENT_SCHEMA.fieldNames() if f != "timestamp"],
        S.iso_parse(F.col("m.timestamp")).alias("timestamp"),
        err.alias("_parse_error"))
    return out


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).withColumn("seq", F.monotonically_increasing_id())
    return parse_messages(lines, "value", "seq")


def sequenced(batch: DataFrame, batch_id: int) -> DataFrame:
    """``batch`` with ``event_id``: the micro-batch (31 bits) and the row's place
    in it (32 bits, without gaps), so ids rise with arrival and never repeat.  At
    a trigger of a second the batches last for 68 years.

    Places come from the sizes of the batch's partitions, which are counted
    first; give a persisted batch if reading it twice is dear.
    """
    part, row = F.spark_partition_id(), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    sizes = {r["part"]: r["n"] for r in batch.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, total = [], 0
    for k in range(max(sizes, default=-1) + 1):
        before.append(total)
        total += sizes.get(k, 0)
    if batch_id >= 1 << 31 or total >= 1 << 32:
        raise ValueError(f"micro-batch {batch_id} of {total} rows: beyond arrival ids")
    starts = F.element_at(F.array(*[F.lit(n).cast("bigint") for n in before or [0]]), part + 1)
    return batch.withColumn("event_id", F.lit(batch_id << 32).cast("bigint") + starts + row)


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("_parse_error").isNotNull()).select(
        "event_id", "value", F.col("_parse_error").alias("_error"))


def good_events(parsed: DataFrame) -> DataFrame:
    from ..operators.clean import EVENT_COLUMNS
    return parsed.filter(F.col("_parse_error").isNull()).select(*EVENT_COLUMNS)


def write_messages(events: DataFrame, path: str, key: str | None = None) -> None:
    """Publish cleaned events as JSON lines (sorted by time within each
    partition, as the producer sorts each chunk)."""
    from ..operators.clean import sort_chunk
    to_message(sort_chunk(events), key).select("value").write.mode("overwrite").text(path)


def stream_messages(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None):
    """Streaming source over a folder of JSON-lines files: parsed events with
    ``_parse_error``; the sentinel record is dropped.  Arrival ids are given to
    each micro-batch by :func:`sequenced`, as the fan-out does.  The text stays
    with the lines that don't parse alone: it is longer than its event, and
    would be shuffled and kept with it."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = r.load(directory)
    return parse_messages(lines, "value").withColumn("value", F.when(F.col("_parse_error").isNotNull(), F.col("value")))


def store_stream(messages: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Appends a stream of parsed messages to a table until its source has no
    more, and returns the table.  Streams over it parse nothing, however
    often they read it."""
    messages.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start().awaitTermination()
    return messages.sparkSession.read.schema(messages.schema).parquet(path)


def counted_once(parsed: DataFrame, horizon: str = "1 day") -> DataFrame:
    """A message stream without messages sent again: of those with one
    ``message_id`` that arrive within ``horizon`` of the first, the first stays.

    The horizon is by arrival (the micro-batch's time, which a replay keeps), not
    by event time, so no message is ever late; one sent again after the horizon
    counts as new.  Lines without an id, broken ones among them, all stay.  The
    state holds the ids of one horizon, in RocksDB (set for the session's streams),
    and is restored from the checkpoint.
    """
    keep_state_on_disk(parsed.sparkSession)
    named = parsed.withColumns({"_arrived": F.current_timestamp(), "_id": F.coalesce("message_id", F.concat(F.lit("-"), F.uuid()))})
    return named.withWatermark("_arrived", horizon).dropDuplicatesWithinWatermark(["_id"]).drop("_arrived", "_id")
