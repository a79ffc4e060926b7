"""Small helpers shared by the query plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dec(x) -> Column:
    """Exact DECIMAL(20,0) view of an integer column (no DOUBLE anywhere)."""
    c = F.col(x) if isinstance(x, str) else x
    return c.cast("decimal(20,0)")


def exact_quotient(num, den) -> Column:
    """num / den on DECIMAL(20,0) operands: Spark keeps 18 fractional digits,
    so the rounding below is exact for any realistic denominator."""
    return dec(num) / F.nullif(dec(den), F.lit(0))


def q_half_up(num, den, scale: int = 2) -> Column:
    """ROUND(num / NULLIF(den, 0), scale), half away from zero, as DOUBLE."""
    return F.round(exact_quotient(num, den), scale).cast("double")


def q_half_even(num, den, scale: int = 2) -> Column:
    """Half-to-even rounding of num / den, as DOUBLE."""
    return F.bround(exact_quotient(num, den), scale).cast("double")


def pct_half_up(part, total, scale: int = 2) -> Column:
    """ROUND(part * 100.0 / NULLIF(total, 0), scale)."""
    return q_half_up(_c(part) * 100, total, scale)


def pct_half_even(part, total, scale: int = 2) -> Column:
    """round-half-even(part / max(total, 1) * 100, scale)."""
    return q_half_even(_c(part) * 100, F.greatest(_c(total), F.lit(1)), scale)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def avg_half_up(x, scale: int = 2) -> Column:
    """ROUND(AVG(x), scale) for an integer column, exact."""
    return q_half_up(F.sum(_c(x)), F.count(_c(x)), scale)


def avg_half_even(x, scale: int = 2) -> Column:
    return q_half_even(F.sum(_c(x)), F.count(_c(x)), scale)


def avg_ms_half_up(duration: str = "flow_duration") -> Column:
    """ROUND(AVG(duration / 1000.0), 2), exact."""
    return q_half_up(F.sum(_c(duration)), F.count(_c(duration)) * 1000, 2)


def avg_ms_half_even(duration: str = "flow_duration") -> Column:
    return q_half_even(F.sum(_c(duration)), F.count(_c(duration)) * 1000, 2)


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """ORDER BY ... LIMIT n (a distributed TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Presentation form: DECIMAL columns as DOUBLE."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
