"""CSV tables of a release, by dump date and site, and of its evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideweave.functions.scalars import id_order, true_false
from tideweave.operators.audit import in_audit_order
from tideweave.operators.graph import edge_order, node_order

#: Quotes only where they are needed, missing as empty, blanks kept.
CSV = {"header": "true", "quote": '"', "escape": '"', "emptyValue": "", "nullValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

NODES = ["site", "id", "node_type", "label", "creation_timestamp", "creation_evidence", "first_block_by_user_timestamp", "sent", "received"]


def write_csv(df: DataFrame, path: str, order: list[Column], force: bool = False, by: tuple[str, ...] = ()) -> None:
    """Write a table in order; what exists is replaced only by ``force``.

    With ``by`` there is a folder for each value and rows are ordered within it; else over all files.
    """
    mode = "overwrite" if force else "errorifexists"
    if by:
        # Range partitions by folder and order split a large site over files that follow each other.
        keyed = df.repartitionByRange(*(F.col(c) for c in by), *order).sortWithinPartitions(*by, *order)
        keyed.write.mode(mode).options(**CSV).partitionBy(*by).csv(path)
    else:
        df.orderBy(*order).write.mode(mode).options(**CSV).csv(path)


def write_release(x: dict[str, DataFrame], out: str, force: bool = False) -> None:
    """edges, nodes and target_resolution_audit, each by dump_date and site."""
    dates = F.broadcast(x["sites"].withColumnRenamed("site", "_site"))

    def dated(df: DataFrame) -> DataFrame:
        found = df if "dump_date" in df.columns else df.join(dates, F.col("site") == F.col("_site")).drop("_site")
        return found.withColumn("folder", F.col("site"))

    by = ("dump_date", "folder")
    write_csv(dated(x["published"]).select("dump_date", "folder", "site", "logid", "timestamp", "source", "target"), f"{out}/edges", edge_order(), force, by)
    write_csv(dated(x["nodes"]).select("dump_date", "folder", *NODES), f"{out}/nodes", node_order(), force, by)
    audit = dated(x["audit"])
    order = [F.col("record_type").desc(), *node_order(), *edge_order()]
    write_csv(audit, f"{out}/target_resolution_audit", order, force, by)


def write_verbose(x: dict[str, DataFrame], out: str, force: bool = False) -> None:
    """The evidence behind a release."""
    tables: dict[str, tuple[DataFrame, list[Column]]] = {
        "observed_edges": (x["edges"].select("site", "logid", "timestamp", F.col("source_id").alias("source_account"), "source_username", "target_username"), edge_order()),
        "resolved_edges": (x["resolved"].select("site", "logid", "timestamp", F.col("source_id").alias("source_account"), "target_account", "target_resolution"), edge_order()),
        "accounts": (all_accounts(x), id_order(F.col("account"))),
        "rename_events": (x["renames"].select("site", "logid", "timestamp", "old_username", "new_username", "parse_status"), edge_order()),
        "excluded_deleted": (x["exclusions"].select("site", "logid", "timestamp", "source_username", "logtitle", "deleted_fields"), edge_order()),
        "username_intervals": (interval_table(x["intervals"]), [*id_order(F.col("account")), F.col("username"), F.col("start_timestamp")]),
        "account_creation_candidates": (creation_candidates(x), [F.col("kind"), F.col("account"), F.col("username"), F.col("timestamp")]),
        "rename_resolution": (rename_resolution(x["renames"]), edge_order()),
    }
    for name, (table, order) in tables.items():
        write_csv(table, f"{out}/verbose/{name}", [F.col("site"), *order], force)


def all_accounts(x: dict[str, DataFrame]) -> DataFrame:
    made = x["accounts"].withColumnRenamed("username", "_made")
    rows = x["names"].select("site", "account_id", "username").join(made, ["site", "account_id"], "full_outer")
    return rows.select(
        "site", F.col("account_id").alias("account"), F.coalesce("username", "_made").alias("current_username"), F.col("creation_timestamp").alias("account_creation_timestamp"), "creation_evidence"
    )


def interval_table(intervals: DataFrame) -> DataFrame:
    sure = F.when(F.col("start_evidence") == "renameuser_interval", "rename_inferred").otherwise("id_level_creation_alias")
    return intervals.select(
        "site", F.col("account_id").alias("account"), "username", F.col("start").alias("start_timestamp"), F.col("end").alias("end_timestamp"), "start_evidence", "start_logid", "end_logid", sure.alias("confidence")
    )


def creation_candidates(x: dict[str, DataFrame]) -> DataFrame:
    """Accounts, creations known by name only, and aliases, one below the other with their kind."""
    none = F.lit(None).cast("string")
    yes = lambda c: true_false(c).alias("accepted")
    accounts = x["accounts"].select(
        "site", F.col("account_id").alias("account"), "username", F.col("creation_timestamp").alias("timestamp"), F.col("creation_evidence").alias("evidence"), none.alias("logid"), yes(F.col("creation_timestamp").isNotNull()), F.lit("account").alias("kind")
    )
    only = x["username_only"].select("site", none.alias("account"), "username", "timestamp", "evidence", "logid", yes(F.lit(False)), F.lit("username_only").alias("kind"))
    aliases = x["aliases"].select("site", F.col("account_id").alias("account"), "username", "timestamp", "evidence", "logid", yes(F.lit(True)), F.lit("alias").alias("kind"))
    return accounts.unionByName(only).unionByName(aliases)


def rename_resolution(renames: DataFrame) -> DataFrame:
    used = F.when(F.col("parse_status") == "parsed", "used_for_intervals").otherwise("not_used")
    return renames.select("site", "logid", "timestamp", "old_username", "new_username", "parse_status", used.alias("resolution_status"))


def audit_csv(audit: DataFrame, path: str, force: bool = False) -> None:
    in_audit_order(audit).write.mode("overwrite" if force else "errorifexists").options(**CSV).csv(path)


def write_report(report: dict[str, DataFrame], path: str) -> None:
    """A report of small tables (one row per site at most) as one JSON file."""
    import json
    from pathlib import Path

    Path(path).write_text(json.dumps({name: [json.loads(r) for r in table.toJSON().collect()] for name, table in report.items()}, indent=1, sort_keys=True))
