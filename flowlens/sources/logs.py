"""Service log files: ``<dir>/*.log``, service = file stem."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_logs(spark: SparkSession, directory: str) -> DataFrame:
    """Raw lines with service name and position in the file."""
    df = spark.read.option("pathGlobFilter", "*.log").text(directory)
    df = df.select(F.col("value").alias("line"),
                   F.regexp_replace(F.col("_metadata.file_name"), r"\.log$", "").alias("service"),
                   F.col("_metadata.file_block_start").alias("_block"))
    from .csv import with_line_numbers
    return with_line_numbers(df.withColumnRenamed("service", "source_file")) \
        .withColumnRenamed("source_file", "service")
