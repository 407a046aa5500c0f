"""Audit-log dumps as DataFrames.

A dump is one compressed document of log records. It is framed as text at the records' end tags, so
a malformed record spoils only itself; each block is parsed by from_xml with a schema that keeps
missing, empty and deleted elements apart. ``seq`` is the order of records within a file and is set
before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideweave.functions.scalars import cutoff, decode_entities, element_text, none_if_empty, valid_id, valid_timestamp

#: Fixed values of the input format.
OPEN, CLOSE = "<logitem", "</logitem>"
FILE_NAME = r"^([a-z0-9_]{2,20})wiki-(20[0-9]{6})-pages-logging\.xml(?:\.gz)?$"
NEEDLE = {kind: f"<type>{kind}</type>" for kind in ("thanks", "newusers", "renameuser", "block")}

_FIELD = "struct<_VALUE: string, _deleted: string>"
LOGITEM = (
    f"id {_FIELD}, timestamp {_FIELD}, contributor struct<_deleted: string, username: {_FIELD}, id: {_FIELD}>, "
    f"type {_FIELD}, action {_FIELD}, logtitle {_FIELD}, params {_FIELD}, text {_FIELD}, _corrupt string"
)
XML = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "ignoreSurroundingSpaces": "false", "valueTag": "_VALUE"}


def raw_rows(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """site, dump_date, seq, value: the text of each file cut after each record. Files of other names have null site.

    The end tag without its last character separates rows, so a file that stops right after a record
    still has a last row, which is no record, and one that stops within the tag does not.
    """
    text = spark.read.text(paths, lineSep=CLOSE[:-1]).withColumn("value", F.regexp_replace("value", r"\A\s*>", ""))
    name = F.col("_metadata.file_name")
    part = lambda i: none_if_empty(F.regexp_extract(name, FILE_NAME, i))
    return text.select(part(1).alias("site"), part(2).alias("dump_date"), F.monotonically_increasing_id().alias("seq"), "value")


def misnamed(raw: DataFrame) -> DataFrame:
    """Rows of files whose name gives no site or date: there must be none."""
    return raw.where("site IS NULL OR dump_date IS NULL")


def framed(raw: DataFrame) -> DataFrame:
    """Whole records: site, dump_date, seq, block. What follows a file's last end tag is no record."""
    last = raw.groupBy("site", "dump_date").agg(F.max("seq").alias("last"))  # one row per file
    whole = raw.join(F.broadcast(last), ["site", "dump_date"]).where("seq < last").where(F.col("value").contains(OPEN))
    start = F.instr("value", OPEN)
    return whole.select("site", "dump_date", "seq", F.concat(F.col("value").substr(start, F.length("value")), F.lit(CLOSE)).alias("block"))


def truncated(raw: DataFrame) -> DataFrame:
    """Files whose last record has no end tag."""
    tail = raw.groupBy("site", "dump_date").agg(F.max_by("value", "seq").alias("tail"))
    return tail.where(F.col("tail").contains(OPEN)).select("site", "dump_date")


def needle_counts(raw: DataFrame) -> DataFrame:
    """Per file, how often each type occurs in the raw text, records or not: an independent recount."""
    counts = [F.sum(F.regexp_count("value", F.lit(NEEDLE[k]))).alias(f"{k}_needles") for k in ("thanks", "block")]
    return raw.groupBy("site", "dump_date").agg(*counts)


def namespaces(raw: DataFrame) -> DataFrame:
    """site, dump_date, namespace, is_user, from the header before each file's first record."""
    first = raw.groupBy("site", "dump_date").agg(F.min_by("value", "seq").alias("value"))
    head = F.substring_index("value", OPEN, 1)
    info = F.regexp_extract(head, "(?s)(<siteinfo.*</siteinfo>)", 1)
    schema = "namespaces struct<namespace: array<struct<_VALUE: string, _key: string>>>"
    found = first.select("site", "dump_date", F.from_xml(F.when(info != "", info), schema, XML).alias("x"))
    named = found.select("site", "dump_date", F.explode("x.namespaces.namespace").alias("n")).where("n._VALUE <> ''")
    own = named.select("site", "dump_date", F.col("n._VALUE").alias("namespace"), (F.col("n._key") == "2").alias("is_user"))
    alias = own.where("is_user").select("site", "dump_date", F.lit("User").alias("namespace"), F.lit(True).alias("is_user")).distinct()
    return own.unionByName(alias).groupBy("site", "dump_date", "namespace").agg(F.max(F.coalesce("is_user", F.lit(False))).alias("is_user"))


def before_cutoff(records: DataFrame) -> DataFrame:
    """Records with ``late``: a valid time on or after the dump's date."""
    time = element_text(F.col("block"), "timestamp")
    return records.withColumn("late", valid_timestamp(time) & (time >= cutoff(F.col("dump_date"))))


def candidates(records: DataFrame, kind: str) -> DataFrame:
    """Records that may be of a kind, by a substring test before parsing."""
    return records.where(F.col("block").contains(NEEDLE[kind]))


def _text(c: Column) -> Column:
    """Text of an element; an empty one is '' and a missing one null."""
    return F.when(c.isNotNull(), F.coalesce(c["_VALUE"], F.lit("")))


def _deleted(c: Column) -> Column:
    return F.coalesce(c["_deleted"] == "deleted", F.lit(False))


def parsed(records: DataFrame) -> DataFrame:
    """One row per record: its elements' texts (null if missing or deleted), <name>_deleted, saw_<name>, malformed."""
    x = records.withColumn("x", F.from_xml("block", LOGITEM, XML))
    out = [F.coalesce(F.col("x").isNull() | F.col("x._corrupt").isNotNull(), F.lit(True)).alias("malformed")]
    for name in ("id", "timestamp", "logtitle", "params"):
        c = F.col(f"x.{name}")
        out += [F.when(~_deleted(c), _text(c)).alias("logid" if name == "id" else name), _deleted(c).alias(f"{name}_deleted"), c.isNotNull().alias(f"saw_{name}")]
    for name in ("type", "action"):
        c = F.col(f"x.{name}")
        out += [_text(c).alias(name), _deleted(c).alias(f"{name}_deleted")]
    who = F.col("x.contributor")
    hidden = _deleted(who)
    out += [who.isNotNull().alias("saw_contributor"), hidden.alias("contributor_deleted"), _deleted(F.col("x.text")).alias("text_deleted")]
    for name in ("username", "id"):
        c = who[name]
        out.append(F.when(~hidden & ~_deleted(c), none_if_empty(_text(c))).alias(f"contributor_{name}"))
    return x.select("site", "dump_date", "seq", *out)


def contributor_facts(records: DataFrame) -> DataFrame:
    """site, seq, logid, timestamp, account_id, username of every visible contributor of every record.

    By text rather than by parsing, so malformed records count as well. ``valid`` tells whether the
    ids are canonical.
    """
    tag = r"(?s)<contributor(?=[\s/>])[^>]*>.*?</contributor\s*>|<contributor(?=[\s/>])[^>]*/>"
    rows = records.where(F.col("block").contains("<contributor"))
    rows = rows.select(
        "site",
        "seq",
        element_text(F.col("block"), "id").alias("logid"),
        element_text(F.col("block"), "timestamp").alias("timestamp"),
        F.explode(F.regexp_extract_all("block", F.lit(tag), F.lit(0))).alias("c"),
    )
    rows = rows.where(~F.col("c").rlike(r"""^<contributor[^>]*(/>|\bdeleted\s*=\s*["']deleted["'])"""))
    rows = rows.select(
        "site",
        "seq",
        "logid",
        "timestamp",
        none_if_empty(element_text(F.col("c"), "id")).alias("account_id"),
        decode_entities(none_if_empty(element_text(F.col("c"), "username"))).alias("username"),
    ).where("account_id IS NOT NULL AND username IS NOT NULL")
    return rows.withColumn("valid", valid_id(F.col("account_id")) & valid_id(F.col("logid")))
