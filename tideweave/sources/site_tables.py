"""Site dimension: URL manifests, SQL dumps of site statistics, and their upsert into a base table."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideweave.functions.scalars import none_if_empty, site_of_dbname, trim_ascii
from tideweave.sources.sinks import write_csv
from tideweave.sources.staging import release, replace, staged

STATS = {"ss_total_edits": "contributions", "ss_total_pages": "pages", "ss_users": "users", "ss_active_users": "active_users"}
SITE_KEYS = ("dump_network_site_code", "site", "site_code", "code", "dump_site")
LABEL_KEYS = ("language_label", "label", "language", "name")
URL = r"/([a-z0-9_]{2,20}wiki)/(20[0-9]{6})/[a-z0-9_]+-20[0-9]{6}-pages-logging\.xml\.gz$"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """url, dbname, site, dump_date of each line; comments, blank lines and carriage returns are dropped."""
    return manifest_of(spark.read.text(path))


def manifest_of(lines: DataFrame) -> DataFrame:
    """The manifest in lines of text (value)."""
    line = trim_ascii(F.regexp_replace("value", r"#.*|\r", ""))
    rows = lines.select(line.alias("url")).where("url <> ''").distinct()
    part = lambda i: none_if_empty(F.regexp_extract("url", URL, i))
    return rows.select("url", part(1).alias("dbname"), site_of_dbname(part(1)).alias("site"), part(2).alias("dump_date"))


def manifest_faults(found: DataFrame) -> DataFrame:
    """fault, n: lines that are no dump URL, sites listed twice, and more than one snapshot."""
    bad = found.where("dbname IS NULL").agg(F.count("*").alias("n")).select(F.lit("not_a_dump_url").alias("fault"), "n")
    twice = found.groupBy("dbname").count().where("count > 1 AND dbname IS NOT NULL").agg(F.count("*").alias("n")).select(F.lit("site_repeated").alias("fault"), "n")
    dates = found.select("dump_date").distinct().agg(F.greatest(F.count("dump_date") - 1, F.lit(0)).alias("n")).select(F.lit("more_than_one_snapshot").alias("fault"), "n")
    return bad.unionByName(twice).unionByName(dates)


def stats_url(url: Column) -> Column:
    """The site-statistics dump beside a logging dump."""
    return F.regexp_replace(url, r"-pages-logging\.xml\.gz$", "-site_stats.sql.gz")


def split_tuple(text: str) -> list[str]:
    """Fields of the inside of one SQL tuple; quotes may hold commas, escapes and doubled quotes."""
    return [f.strip() for f in re.findall(r"(?:'(?:\\.|''|[^'\\])*'|[^,'])+", text)]


def sql_tuples(spark: SparkSession, paths: str | list[str], table: str = "site_stats") -> DataFrame:
    """The fields of SQL dumps, see tuples_of; a dump of statistics is a few rows, so a file is a row."""
    return tuples_of(spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value"), table)


def tuples_of(text: DataFrame, table: str = "site_stats") -> DataFrame:
    """file, column, value, row: each field of the INSERT statements of one table, by column name.

    ``text``: file, value. Column places come from the file's own CREATE TABLE. Keywords are matched
    in any case. ``error`` is set, and the statement's rows are left out, where anything but tuples
    stands in it; it is set for rows whose field count differs from the table's, fields that are no
    integer or null, and row ids that are null.
    """

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        create = re.compile(rf"create\s+table\s+`?{table}`?\s*\((.*?)\)\s*(?:engine|;)", re.I | re.S)
        insert = re.compile(rf"insert\s+into\s+`?{table}`?\s+values\s*(.*?);\s*(?:\n|$)", re.I | re.S)
        one = r"\(((?:'(?:\\.|''|[^'\\])*'|[^()'])*)\)"
        row_of, all_rows = re.compile(one), re.compile(rf"\s*{one}(?:\s*,\s*{one})*\s*")
        for frame in frames:
            out = []
            for file, value in zip(frame["file"], frame["value"], strict=True):
                found = create.search(value)
                columns = re.findall(r"^\s*`(\w+)`", found[1], re.M) if found else []
                n = 0
                for statement in insert.finditer(value):
                    if not all_rows.fullmatch(statement[1]):
                        n += 1
                        out.append((file, n, None, None, "not a list of tuples"))
                        continue
                    for row in row_of.finditer(statement[1]):
                        fields = split_tuple(row[1])
                        n += 1
                        if len(fields) != len(columns):
                            out.append((file, n, None, None, "field count differs from the table's"))
                            continue
                        for c, v in zip(columns, fields, strict=True):
                            bad, null = not re.fullmatch(r"\d+|null", v, re.I), v.upper() == "NULL"
                            error = "not an integer" if bad else "no row id" if null and c == "ss_row_id" else None
                            out.append((file, n, c, None if bad or null else v, error))
                if not columns or not n:
                    out.append((file, 0, None, None, "no table or no row"))
            yield pd.DataFrame(out, columns=["file", "row", "column", "value", "error"])

    return text.mapInPandas(parse, "file string, row long, column string, value string, error string")


def site_stats(fields: DataFrame) -> DataFrame:
    """dbname, contributions, pages, users, active_users, error: sums over a site's shards, nulls left out.

    A column that is null in all shards, or a repeated row id, is an error.
    """
    dbname = F.regexp_extract("file", r"^([a-z0-9_]+wiki)-", 1)
    rows = fields.groupBy(dbname.alias("dbname"), "file", "row").agg(
        F.max("error").alias("error"), *(F.max(F.when(F.col("column") == c, F.col("value").cast("decimal(38,0)"))).alias(c) for c in ("ss_row_id", *STATS))
    )
    sums = [F.sum(c).alias(name) for c, name in STATS.items()]
    out = rows.groupBy("dbname").agg(*sums, F.max("error").alias("error"), (F.count("ss_row_id") - F.countDistinct("ss_row_id")).alias("_repeated"))
    missing = F.lit(False)
    for name in STATS.values():
        missing |= F.col(name).isNull()
    error = F.coalesce("error", F.when(F.col("_repeated") > 0, "row id repeated"), F.when(missing, "no value in any shard"))
    return out.select("dbname", *STATS.values(), error.alias("error"))


def first_filled(df: DataFrame, names: tuple[str, ...]) -> Column:
    """The first of these columns that exists and isn't blank."""
    found = [none_if_empty(trim_ascii(F.col(c))) for c in names if c in df.columns]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def upsert(base: DataFrame, stats: DataFrame, labels: DataFrame, wanted: DataFrame) -> DataFrame:
    """The site dimension: base rows with fresh statistics, and rows for wanted sites that base lacks.

    base: any columns, its key under one of SITE_KEYS; extra columns stay. Statistics with an error count
    as missing. labels (site,
    actual_site_code, language_label) is the fallback for what base does not say. wanted: site.
    """
    keyed = base.withColumn("_site", first_filled(base, SITE_KEYS)).withColumn("_label", first_filled(base, LABEL_KEYS))
    sound = stats.where("error IS NULL") if "error" in stats.columns else stats
    fresh = sound.select(site_of_dbname(F.col("dbname")).alias("_site"), *(F.col(c).cast("decimal(38,0)").cast("string").alias(f"_{c}") for c in STATS.values()))
    named = labels.select(F.col("site").alias("_site"), F.col("actual_site_code").alias("_code"), F.col("language_label").alias("_fallback"))
    rows = keyed.join(wanted.select(F.col("site").alias("_site")), "_site", "full_outer").join(fresh, "_site", "left").join(F.broadcast(named), "_site", "left")
    old = lambda c: F.col(c).cast("string") if c in base.columns else F.lit(None).cast("string")
    extra = [c for c in base.columns if c not in (*SITE_KEYS, *LABEL_KEYS, "actual_site_code", *STATS.values())]
    return rows.select(
        F.col("_site").alias("dump_network_site_code"),
        F.coalesce(old("actual_site_code"), "_code", "_site").alias("actual_site_code"),
        F.coalesce("_label", "_fallback").alias("language_label"),
        *(F.coalesce(F.col(f"_{c}"), old(c)).alias(c) for c in STATS.values()),
        *extra,
    )


def dimension_faults(dimension: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows without a label or with statistics that aren't whole numbers, and wanted sites that are missing."""
    bad = F.coalesce("language_label", F.lit("")) == ""
    for c in STATS.values():
        bad |= ~F.coalesce(F.col(c).rlike(r"^\d+$"), F.lit(False))
    rows = dimension.where(bad).select(F.col("dump_network_site_code").alias("site"), F.lit("incomplete").alias("fault"))
    lost = wanted.select("site").join(dimension.select(F.col("dump_network_site_code").alias("site")), "site", "left_anti")
    return rows.unionByName(lost.select("site", F.lit("missing").alias("fault")))


def write_dimension(dimension: DataFrame, wanted: DataFrame, path: str) -> None:
    """Write the site dimension as CSV to ``path``, all or nothing.

    It is staged, so that faults and rows are of the same data, and nothing is written where there are
    faults. The files are written beside ``path`` and renamed: a reader finds the old table, for a
    moment none, or the new one, and a write that fails leaves the old one as it was.
    """
    found = staged(dimension, "dimension")
    try:
        faults = dimension_faults(found, wanted)
        n = faults.count()
        if n:
            shown = ", ".join(f"{r.site} {r.fault}" for r in faults.orderBy("site", "fault").limit(10).collect())
            raise ValueError(f"site dimension has {n} faults: {shown}")
        replace(found.sparkSession, path, lambda new: write_csv(found, new, [F.col("dump_network_site_code")]))
    finally:
        release(found)
