"""Native Column expressions for cleaning and enrichment.

Every function takes and returns a ``Column`` so the work stays inside
whole-stage codegen; lookups are literal maps that Catalyst constant-folds.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lookups as L


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tc(x, dtype: str) -> Column:
    """TRY_CAST: null instead of an error when the value does not convert."""
    return _c(x).try_cast(dtype)


def literal_map(d: dict) -> Column:
    """A literal MAP column from a python dict."""
    return F.create_map(*[F.lit(v) for v in chain.from_iterable(d.items())])


def lookup(d: dict, key, default=None) -> Column:
    """``d[key]`` with a default for missing keys (null-safe, ANSI-safe)."""
    got = F.try_element_at(literal_map(d), _c(key))
    return got if default is None else F.coalesce(got, F.lit(default))


def literal_table(spark, rows: list[tuple], names: list[str], types: list[str]):
    """Small constant table built JVM-side (``inline`` of a literal array),
    so no Python worker is involved."""
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, n, t in zip(row, names, types)])
               for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


# ---------------------------------------------------------------- addresses

def dotted_quad(n) -> Column:
    """uint32 BIGINT -> 'a.b.c.d'."""
    n = _c(n).cast("bigint")
    parts = [F.shiftright(n, s).bitwiseAND(F.lit(255)) for s in (24, 16, 8, 0)]
    return F.concat_ws(".", *[p.cast("string") for p in parts])


def decimal_to_ip(x, numeric: bool = False) -> Column:
    """Decimal address (number or text) -> dotted quad; anything not in
    1..4294967295 after truncation (null, text, 0, negative, too big) gives
    '0.0.0.0'.  ``numeric`` skips the text parse for numeric input."""
    d = _c(x).cast("double") if numeric else tc(_c(x).cast("string"), "double")
    ok = (d >= F.lit(1.0)) & (d < F.lit(4294967296.0)) & ~F.isnan(d)
    return F.when(ok, dotted_quad(F.floor(d))).otherwise(F.lit("0.0.0.0"))


def ip_to_decimal(ip) -> Column:
    """IPv4 text -> its number as BIGINT; null for anything else.  The text is
    split once: parts taken one by one inside a condition are each split anew."""
    ip = _c(ip)
    total = F.aggregate(F.split(ip, r"\."), F.lit(0).cast("bigint"), lambda n, part: n * 256 + part.cast("bigint"))
    return F.when(is_ipv4(ip), total)


def looks_decimal_ip(x) -> Column:
    """Per-row form of the 'is this column decimal' test: all digits, or a
    number with one dot that is not within its first five characters."""
    s = _c(x).cast("string")
    return s.rlike(r"^[0-9]+$") | (
        s.rlike(r"^[0-9]*\.?[0-9]*$") & s.rlike(r"[0-9]") & ~F.substring(s, 1, 5).contains("."))


def ip_class(ip) -> Column:
    """First octet -> A/B/C/D/E, unparsable -> Unknown."""
    first = tc(F.trim(F.split(_c(ip), r"\.").getItem(0)), "int")
    return (F.when(first.isNull(), "Unknown")
            .when(first < 128, "A").when(first < 192, "B")
            .when(first < 224, "C").when(first < 240, "D").otherwise("E"))


IPV4_PATTERN = r"^(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(\.(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}$"


def is_ipv4(ip) -> Column:
    return F.coalesce(_c(ip).rlike(IPV4_PATTERN), F.lit(False))


# ---------------------------------------------------------------- geo

def geo_slot(ip) -> Column:
    """md5(ip) read as a 128-bit number, modulo 100, computed on the four
    32-bit hex words: 2^96, 2^64, 2^32 are 36, 16, 96 modulo 100."""
    h = F.md5(F.coalesce(_c(ip).cast("string"), F.lit("")))
    words = [F.conv(F.substring(h, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]
    total = words[0] * 36 + words[1] * 16 + words[2] * 96 + words[3]
    return F.pmod(total, F.lit(100))


def geo(ip) -> Column:
    """(country, region) struct for an address: the country after as many
    others as have their cumulative weight at or below the address's slot.
    Every comparison is always made, so the slot is a common subexpression
    and md5 is evaluated once."""
    shares = L.geo_thresholds()
    slot = geo_slot(ip)
    passed = sum(((slot >= end).cast("int") for end, _, _ in shares[:-1]), F.lit(1))
    return F.element_at(F.array(*[F.struct(F.lit(c).alias("country"), F.lit(r).alias("region")) for _, c, r in shares]), passed)


def geo_country(ip) -> Column:
    return geo(ip).getField("country")


def geo_region(ip) -> Column:
    return geo(ip).getField("region")


# ---------------------------------------------------------------- protocol

def protocol_code(raw) -> Column:
    """Raw protocol text/number -> integer code; non-numeric text -> -1."""
    d = tc(F.trim(_c(raw).cast("string")), "double")
    return F.when(d.isNull() | F.isnan(d), F.lit(-1)).otherwise(
        F.coalesce(tc(d, "int"), F.lit(-1)))


def protocol_name(code) -> Column:
    return lookup(L.PROTOCOL_NAMES, _c(code), "OTHER")


def transport_layer(name) -> Column:
    return lookup(L.TRANSPORT_LAYERS, _c(name), "Unknown")


# ---------------------------------------------------------------- labels

WHITESPACE = " \t\n\r\x0b\x0c"


def py_strip(x) -> Column:
    """Strip leading/trailing whitespace like ``str.strip`` (ASCII set)."""
    return F.btrim(_c(x), F.lit(WHITESPACE))


def normalise_label(label) -> Column:
    s = py_strip(label)
    return F.coalesce(lookup(L.LABEL_VARIANTS, s), s)


def label_key(label) -> Column:
    """Lower-cased, stripped label: the lookup key of the category rules."""
    return py_strip(F.lower(_c(label)))


def label_base(key) -> Column:
    """The key without the ' - attempted' suffix."""
    return py_strip(F.replace(_c(key), F.lit(L.ATTEMPTED_SUFFIX), F.lit("")))


def categorize_label(label) -> Column:
    """Exact lower-case lookup, then without ' - attempted', then the first
    matching prefix rule ('bot' matches exactly), else Unknown."""
    key = label_key(label)
    return category_from_key(key, label_base(key))


def category_from_key(key, base) -> Column:
    """Category from precomputed key/base columns (pass column names to let
    the optimizer evaluate them once)."""
    key, base = _c(key), _c(base)
    rule = None
    for prefix, cat in L.CATEGORY_PREFIXES:
        cond = base.startswith(prefix)
        if cat == "Botnet":
            cond = cond | (base == F.lit("bot"))
        rule = F.when(cond, F.lit(cat)) if rule is None else rule.when(cond, F.lit(cat))
    rule = rule.otherwise(F.lit(L.UNKNOWN_CATEGORY))
    return F.coalesce(lookup(L.CATEGORY_OF_LABEL, key), lookup(L.CATEGORY_OF_LABEL, base), rule)


def severity_from_key(key, category) -> Column:
    return F.coalesce(lookup(L.SEVERITY_OF_LABEL, _c(key)),
                      lookup(L.SEVERITY_OF_CATEGORY, _c(category)), F.lit("LOW"))


def label_severity(label, category) -> Column:
    return severity_from_key(label_key(label), category)


def coerce_severity(sev) -> Column:
    s = _c(sev)
    return F.when(s.isin(*L.VALID_SEVERITIES), s).otherwise(F.lit("LOW"))


def is_attack(category) -> Column:
    return F.coalesce(_c(category), F.lit("Normal")) != F.lit("Normal")


# ---------------------------------------------------------------- services

def service_name(port) -> Column:
    return lookup({k: v[0] for k, v in L.SERVICES.items()}, _c(port), "Unknown")


def service_type(port) -> Column:
    return lookup({k: v[1] for k, v in L.SERVICES.items()}, _c(port), "Unknown")


# ---------------------------------------------------------------- time

def time_of_day(hour) -> Column:
    h = _c(hour)
    return (F.when(h.between(6, 11), "Morning").when(h.between(12, 17), "Afternoon")
            .when(h.between(18, 22), "Evening").otherwise("Night"))


def trunc_ntz(unit: str, ts) -> Column:
    """date_trunc that stays TIMESTAMP_NTZ."""
    return F.date_trunc(unit, _c(ts)).cast("timestamp_ntz")


def minute_key(ts) -> Column:
    """Smart time key: minutes since 1970-01-01 of the wall-clock minute."""
    return F.floor(F.unix_micros(_c(ts).cast("timestamp")) / F.lit(60_000_000)).cast("bigint")


def key_to_minute(key) -> Column:
    """Inverse of :func:`minute_key` (TIMESTAMP_NTZ)."""
    return F.timestamp_seconds(_c(key) * F.lit(60)).cast("timestamp_ntz")


def day_name(ts) -> Column:
    return F.date_format(_c(ts), "EEEE")


def weekday0(ts) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(ts))


def is_weekend(ts) -> Column:
    return weekday0(ts) >= F.lit(5)


def calendar_columns(ts) -> dict[str, Column]:
    """hour, day, ISO week, month, year, weekday name, weekend, time of day."""
    t = _c(ts)
    return {
        "hour": F.hour(t),
        "day": F.dayofmonth(t),
        "week": F.weekofyear(t),
        "month": F.month(t),
        "year": F.year(t),
        "day_of_week": day_name(t),
        "is_weekend": is_weekend(t),
        "time_of_day": time_of_day(F.hour(t)),
    }


def iso_parse(text) -> Column:
    """ISO text with 'Z', an offset or extra characters -> wall clock NTZ."""
    s = F.trim(_c(text).cast("string"))
    return F.coalesce(
        tc(s, "timestamp_ntz"),
        F.try_to_timestamp(F.substring(s, 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss")).cast("timestamp_ntz"),
    )


def parse_flow_timestamp(text) -> Column:
    """Day-first flow stamps ('5/7/2017 8:42', with or without seconds) or
    ISO text; unparsable -> null."""
    s = F.trim(_c(text).cast("string"))
    fmts = ["d/M/yyyy H:mm:ss", "d/M/yyyy H:mm", "d/M/yyyy h:mm:ss a", "d/M/yyyy h:mm a",
            "d-M-yyyy H:mm:ss", "d-M-yyyy H:mm"]
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(f)).cast("timestamp_ntz") for f in fmts],
                      tc(s, "timestamp_ntz"))


def is_truncated_stamp(text) -> Column:
    """'MM:SS.S' style stamps: shorter than 12 characters and with a colon."""
    s = F.trim(_c(text).cast("string"))
    return (F.length(s) < 12) & s.contains(":")
