"""Log analytics: parse, tail per service, merged newest-first view, levels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lookups as L


def browse_limit(n: int) -> int:
    """``n`` if it is a page size that browsing allows; never another size."""
    if not 1 <= int(n) <= L.BROWSE_MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {L.BROWSE_MAX_LIMIT}, not {n}")
    return int(n)


def parse_logs(lines: DataFrame) -> DataFrame:
    """timestamp, service, level, logger, message; non-matching lines dropped."""
    s = F.btrim(F.col("line"))
    pat = L.LOG_LINE_PATTERN
    return (lines.filter(s.rlike(pat)).select(
        F.regexp_extract(s, pat, 1).alias("timestamp"), "service",
        F.regexp_extract(s, pat, 3).alias("level"), F.regexp_extract(s, pat, 2).alias("logger"),
        F.regexp_extract(s, pat, 4).alias("message"), "line_no"))


def tail_per_service(lines: DataFrame, n: int = L.BROWSE_DEFAULT_LIMIT) -> DataFrame:
    """Last ``n`` raw lines of each file (taken before parsing).  The window
    keeps at most ``n`` rows per service before the shuffle."""
    w = Window.partitionBy("service").orderBy(F.desc("line_no"))
    return lines.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= browse_limit(n)).drop("_r")


def merged_logs(lines: DataFrame, n: int = L.BROWSE_DEFAULT_LIMIT, service: str | None = None) -> DataFrame:
    """Tail of each service, parsed, newest first by text timestamp, first n."""
    if service:
        lines = lines.filter(F.col("service") == service)
    parsed = parse_logs(tail_per_service(lines, n))
    return parsed.orderBy(F.desc("timestamp"), "service", F.desc("line_no")).limit(browse_limit(n)).drop("line_no")


def log_level_counts(lines: DataFrame) -> DataFrame:
    return parse_logs(lines).groupBy("service", "level").agg(F.count(F.lit(1)).alias("count"))
