r"""Personal data: patterns propose, checksums confirm, context words score.

For each kind one regular expression marks its leftmost non-overlapping matches
in the whole text; the marked text, split at the marks, alternates between
other text and matches.  Validators (Luhn for cards, mod-97 for account
numbers, ranges and digit counts) drop matches that fail.  A match's place is
the running sum of the lengths before it, a window over the matches of one
text and kind, so texts stay where they are and only matches move.  Words near a
match raise its score; kinds too vague to stand alone need them.
All of it is SQL expressions.

The patterns are the plain ones made possessive and anchored at the start of a
run (or the end of the match before, \G), which finds the same matches without
backtracking over long runs.  An account number ends at its country's length, so
what follows in capitals or digits is not taken with it; only for countries not
in IBAN, and where another letter or digit follows at once, any length is tried,
the longest alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table, unused

MARK = "\x01"
BASE = ("email", "ip", "card", "phone")
KINDS = BASE + ("iban", "ssn")
#: Countries by the length of their account numbers.
IBAN = {15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
        26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
        30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
_OF_LENGTH = "|".join(rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN.items())
PATTERN = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": rf"(?<![A-Za-z0-9])(?:{_OF_LENGTH}|[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}})(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: A text without such a place has no valid match of the kind.
TRIGGER = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]",
           "iban": r"[A-Z]{2}[0-9]{2}[\x20A-Z0-9]", "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}"}
WEIGHT = {"email": 0.9, "ip": 0.5, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.3}
CONTEXT = {"email": "mail|contact|write", "ip": "ip|address|host|server", "card": "card|visa|credit|payment",
           "phone": "phone|call|tel|mobile|fax", "iban": "iban|account|bank", "ssn": "ssn|social|security"}
NEAR, BONUS, LEAST = 48, 0.25, 0.5
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def step(total: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def _mod97(code: Column) -> Column:
    turned = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))

    def step(rest: Column, i: Column) -> Column:
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c >= 65, rest * 100 + c - 55).otherwise(rest * 10 + c - 48) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _valid(kind: Column, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    return (F.when(kind == "ip", found.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$"))
            .when(kind == "card", F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False))
            .when(kind == "phone", F.length(digits).between(9, 15))
            .when(kind == "iban", _mod97(F.replace(found, F.lit(" "), F.lit("")))).otherwise(True))


def _matches(text: Column, kind: str) -> Column:
    """array<struct<kind, nth, skip, found, near>>: skip is the length of the
    text between the match before and this one."""
    pieces = F.split(F.regexp_replace(text, PATTERN[kind], MARK + "$0" + MARK), MARK, -1)
    hit = text.contains("@") if kind == "email" else text.rlike(TRIGGER[kind])

    def told(p: Column, i: Column) -> Column:
        near = F.concat_ws(" ", F.substring(F.element_at(p, i - 1), -NEAR, NEAR), F.substring(F.element_at(p, i + 1), 1, NEAR))
        return F.struct(F.lit(KINDS.index(kind)).alias("kind"), i.alias("nth"), F.length(F.element_at(p, i - 1)).alias("skip"),
                        F.element_at(p, i).alias("found"), near.alias("near"))

    none = F.array().cast("array<struct<kind:int,nth:int,skip:int,found:string,near:string>>")
    # the pieces are computed once, as the only element of an array
    some = F.flatten(F.transform(F.array(pieces), lambda p: F.when(F.size(p) > 2, F.transform(
        F.sequence(F.lit(2), F.size(p) - 1, F.lit(2)), lambda i: told(p, i))).otherwise(none)))
    return F.when(hit, some).otherwise(none)


def proposals(docs: DataFrame, *keep: str) -> DataFrame:
    """The ``keep`` columns of every row with ``m``, all matches before checks."""
    text = F.replace(F.coalesce("text", F.lit("")), F.lit(MARK), F.lit("\x02"))
    return docs.select(*keep, F.concat(*(_matches(text, k) for k in KINDS)).alias("m"))


def spans(found: DataFrame, key: str) -> DataFrame:
    """key, kind (its number in KINDS), start, end (code points, end exclusive)
    and score of every confirmed span of ``found`` (key, m)."""
    rows = found.select(key, F.explode("m").alias("x")).select(key, "x.*")
    so_far = Window.partitionBy(key, "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("skip") + F.length("found")).over(so_far)) \
        .withColumn("start", F.col("end") - F.length("found"))
    kinds = F.array(*map(F.lit, KINDS))
    name = F.element_at(kinds, F.col("kind") + 1)
    weight, words = F.lit(0.0), F.lit("")
    for k in KINDS:
        weight, words = F.when(name == k, WEIGHT[k]).otherwise(weight), F.when(name == k, CONTEXT[k]).otherwise(words)
    close = F.regexp_like(F.lower("near"), F.concat(F.lit("(?<![a-z])(?:"), words, F.lit(")(?![a-z])")))
    rows = rows.withColumn("score", F.least(F.lit(1.0), F.round(weight + F.when(close, BONUS).otherwise(0.0), 2)))
    sure = (F.col("kind") < len(BASE)) | (F.col("score") >= LEAST)
    return rows.where(_valid(name, F.col("found")) & sure).select(key, "kind", "start", "end", "score")


def find(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_email, n_ip,
    n_card, n_phone, base_sha256, spans (kind:start:end of all kinds by kind
    and start, comma-joined), scores (of the same spans) and max_score.

    A null text is empty and has no spans; so have texts without matches
    (counts 0, spans empty, max_score null).  Rows that repeat are each told on
    their own.  An empty table gives an empty result; other columns are not
    read.
    """
    rows = stored(proposals(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                                        F.monotonically_increasing_id().alias("row")), "row", "doc_id"), "pii-matches")
    each = F.array_sort(F.collect_list(F.struct("kind", "start", "end", "score")))
    per_row = spans(rows, "row").groupBy("row").agg(each.alias("s"))
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint,score:double>>")
    rows = rows.select("row", "doc_id").join(per_row, "row", "left").withColumn("s", F.coalesce("s", none))
    kinds = F.array(*map(F.lit, KINDS))
    line = lambda x: F.concat_ws(":", F.element_at(kinds, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))
    base = F.filter("s", lambda x: x["kind"] < len(BASE))
    return rows.select(
        "doc_id", *(F.size(F.filter(F.transform("s", lambda x: x["kind"]), F.lit(k).__eq__)).cast("bigint").alias(f"n_{name}")
                     for k, name in enumerate(BASE)),
        F.sha2(F.array_join(F.transform(base, line), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("s", line), ",").alias("spans"),
        F.array_join(F.transform("s", lambda x: x["score"].cast("string")), ",").alias("scores"),
        F.array_max(F.transform("s", lambda x: x["score"])).alias("max_score"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of personal data replaced by its kind in square
    brackets; overlapping spans become one, named after the first.  Other
    columns stay (n_chars, if there, is counted again); texts without personal
    data, null texts included, stay as they are.

    Spans are found once for each different text and joined back by the text's
    SHA-256, so any row order and any number of copies give the same result.
    """
    key, cuts = unused(docs, "pii_sha"), unused(docs, "pii_cuts")
    sha = F.sha2(F.col("text").cast("binary"), 256)
    found = stored(proposals(docs.where("text is not null").select("text", sha.alias(key)), key).where("size(m) > 0"), "pii-redact")
    tag = F.concat(F.lit("["), F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1), F.lit("]"))
    per_text = _merged(spans(found.dropDuplicates([key]), key), key).groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("start", "end", tag.alias("tag")))).alias(cuts))
    own = docs.withColumn(key, F.coalesce(sha, F.lit("")))
    own = own.join(per_text, key, "left")
    text, at = F.col("text"), F.col(cuts)

    def piece(x: Column, i: Column) -> Column:
        before = F.when(i == 0, F.lit(0)).otherwise(F.get(at, i - 1)["end"]).cast("int")
        return F.concat(F.substring(text, before + 1, x["start"].cast("int") - before), x["tag"])

    last = F.element_at(at, -1)["end"].cast("int")
    clean = F.concat(F.array_join(F.transform(at, piece), ""), F.substring(text, last + 1, F.length(text)))
    own = own.withColumn("text", F.when(at.isNull(), text).otherwise(clean))
    if "n_chars" in docs.columns:
        own = own.withColumn("n_chars", F.when(at.isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint")))
    return own.select(*docs.columns)


def _merged(found: DataFrame, key: str) -> DataFrame:
    """Overlapping spans of one text as one, with the kind of the first."""
    order = Window.partitionBy(key).orderBy("start", F.col("end").desc(), "kind")
    rows = found.withColumn("reach", F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("group", F.sum((F.col("reach").isNull() | (F.col("start") >= F.col("reach"))).cast("int")).over(
        order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(key, "group").agg(F.min("start").alias("start"), F.max("end").alias("end"),
                                          F.min_by("kind", F.struct("start", -F.col("end"), "kind")).alias("kind"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
