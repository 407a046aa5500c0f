"""Counters of an extraction: one row per site, and totals over sites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideweave.operators.classify import CREATION_ACTIONS
from tideweave.operators.quality import FATAL
from tideweave.operators.resolve import RESOLVED, UNRESOLVED

#: Values of each status column; counts of all of them are columns of the summary.
STATUSES = {
    "thanks": (*FATAL, "excluded", "valid"),
    "newusers": ("parse_failure", "id_invalid", "action_other", "timestamp_missing", "timestamp_invalid", "valid"),
    "renames": ("action_not_renameuser", "timestamp_invalid", "missing_logtitle_or_params", "bad_old_username_logtitle", "bad_new_username_params", "parsed"),
    "blocks": ("parse_failure", "action_not_block", "logid_invalid", "timestamp_missing", "timestamp_invalid", "contributor_deleted_or_missing", "source_id_missing", "valid"),
    "resolved": (*RESOLVED, *UNRESOLVED, "missing_historical_label_confirmation"),
}
COLUMN = {"renames": "parse_status", "resolved": "target_resolution"}


def _counts(rows: DataFrame, prefix: str, column: str, values: tuple[str, ...]) -> DataFrame:
    counted = [F.count_if(F.col(column) == v).alias(f"{prefix}_{v}") for v in values]
    return rows.groupBy("site").agg(F.count("*").alias(prefix), *counted)


def site_summary(x: dict[str, DataFrame]) -> DataFrame:
    """Per site, the rows of each kind and status, sums over statuses, and sizes of the results.

    One pass over each table; the joined tables have one row per site.
    """
    out = x["sites"].select("site", "dump_date")
    for name, values in STATUSES.items():
        out = out.join(_counts(x[name], name, COLUMN.get(name, "status"), values), "site", "left")
    out = out.join(_counts(x["newusers"], "creations", "action", CREATION_ACTIONS), "site", "left")
    deleted = [F.count_if(F.array_contains(F.split("deleted_fields", ";"), f)).alias(f"excluded_{f}_deleted") for f in ("timestamp", "contributor", "logtitle")]
    out = out.join(x["exclusions"].groupBy("site").agg(*deleted), "site", "left")
    accounts = x["accounts"].groupBy("site").agg(
        F.count("*").alias("accounts"),
        F.count("creation_timestamp").alias("accounts_dated"),
        F.count_if(F.col("creation_evidence").startswith("ignored_")).alias("accounts_ignored_after_activity"),
        F.count_if(F.col("creation_evidence").startswith("invalidated_")).alias("accounts_invalidated_by_order"),
    )
    spans = x["intervals"].groupBy("site").agg(F.count("*").alias("intervals"), F.count("end").alias("intervals_closed"), F.count_if(F.col("start_evidence") == "renameuser_interval").alias("intervals_by_rename"))
    sizes = [accounts, spans, x["coverage"], x["needles"].drop("dump_date")]
    for name in ("self_loops", "published", "aliases", "username_only", "late_thanks", "late_blocks"):
        sizes.append(x[name].groupBy("site").agg(F.count("*").alias(f"n_{name}")))
    for table in sizes:
        out = out.join(table, "site", "left")
    out = out.fillna(0)
    unresolved = [F.col(f"resolved_{v}") for v in (*UNRESOLVED, "missing_historical_label_confirmation")]
    return out.withColumn("resolved_to_account", sum((F.col(f"resolved_{v}") for v in RESOLVED), F.lit(0))).withColumn("unresolved", sum(unresolved, F.lit(0)))


def run_totals(summary: DataFrame) -> DataFrame:
    """Sums of all counters over sites, and the number of sites."""
    counters = [c for c, kind in summary.dtypes if kind == "bigint"]
    return summary.agg(F.count("*").alias("sites"), *(F.sum(c).alias(c) for c in counters))


def subset_totals(edges: DataFrame, sites: list[str]) -> DataFrame:
    """Edges, earliest and latest time of some sites together."""
    return edges.where(F.col("site").isin(*sites)).agg(F.count("*").alias("edges"), F.min("timestamp").alias("earliest"), F.max("timestamp").alias("latest"))


def set_faults(found: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """key, fault: keys that are missing, unexpected or repeated."""
    a, b = found.select(key), expected.select(key)
    tag = lambda df, fault: df.distinct().select(key, F.lit(fault).alias("fault"))
    repeated = a.groupBy(key).count().where("count > 1").select(key)
    return tag(b.join(a, key, "left_anti"), "missing").unionByName(tag(a.join(b, key, "left_anti"), "unexpected")).unionByName(tag(repeated, "repeated"))


def header_faults(df: DataFrame, contract: list[str]) -> list[str]:
    """Columns that are missing, unexpected or out of order."""
    if df.columns == contract:
        return []
    return sorted(set(df.columns) ^ set(contract)) or ["order"]
