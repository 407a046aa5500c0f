"""The published network: keys, nodes and edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideweave.functions.scalars import id_order, stripped_evidence
from tideweave.operators.resolve import RESOLVED, UNRESOLVED

RECEIVED = [f"received_{r}" for r in RESOLVED] + ["received_other_resolved"] + [f"received_synthetic_{u}" for u in UNRESOLVED] + ["received_synthetic_other_unresolved"]


def ranked(values: DataFrame, partition: list[str], order: str, name: str, prefix: int = 3) -> DataFrame:
    """Distinct (partition, order) with their 1-based rank in byte order.

    Values are bucketed by their first ``prefix`` bytes; ranks within a bucket are shifted by the
    sizes of the buckets before it. So no partition's values meet in one task, if the prefix tells
    them apart well enough.
    """
    distinct = values.select(*partition, order).where(F.col(order).isNotNull()).distinct()
    bucket = F.substring(F.hex(F.encode(F.col(order), "UTF-8")), 1, 2 * prefix)
    rows = distinct.withColumn("_bucket", bucket)
    inner = W.partitionBy(*partition, "_bucket").orderBy(order)
    sizes = rows.groupBy(*partition, "_bucket").agg(F.count("*").alias("_n"))
    before = W.partitionBy(*partition).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    rows = rows.withColumn("_in", F.row_number().over(inner)).join(sizes, [*partition, "_bucket"])
    return rows.select(*partition, order, (F.col("_in") + F.col("_before")).cast("long").alias(name))


def places(rows: DataFrame, order: list[Column], bucket: Column, name: str = "place") -> DataFrame:
    """``rows`` with their 1-based place in an order. ``bucket`` must not fall along it: each is a window of its own."""
    rows = rows.withColumn("_bucket", bucket)
    sizes = rows.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)  # one row per bucket
    sizes = sizes.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rows = rows.withColumn("_in", F.row_number().over(W.partitionBy("_bucket").orderBy(*order))).join(sizes, "_bucket")
    return rows.withColumn(name, (F.col("_before") + F.col("_in")).cast("long")).drop("_bucket", "_before", "_in")


def synthetic_ids(resolved: DataFrame) -> DataFrame:
    """site, target_username, synthetic_id: -1, -2 and so on for the site's unresolved names in byte order."""
    names = ranked(resolved.where("target_account IS NULL"), ["site"], "target_username", "_rank")
    return names.select("site", "target_username", (-F.col("_rank")).cast("string").alias("synthetic_id"))


def published_edges(resolved: DataFrame, synthetic: DataFrame) -> DataFrame:
    """site, logid, timestamp, source, target, and the columns that nodes and audit need."""
    rows = resolved.join(synthetic, ["site", "target_username"], "left")
    own = [c for c in ("dump_date",) if c in resolved.columns]
    return rows.select(
        "site", *own, "logid", "timestamp", F.col("source_id").alias("source"), F.coalesce("target_account", "synthetic_id").alias("target"), "target_username", "target_account", "target_resolution"
    )


def edge_order() -> list[Column]:
    return [F.col("timestamp"), *id_order(F.col("logid"))]


def node_order(c: str = "id") -> list[Column]:
    """Accounts by number, then synthetic ids by number (so -3 comes before -1)."""
    synthetic = F.col(c).startswith("-")
    return [synthetic, F.when(synthetic, -F.length(c)).otherwise(F.length(c)), F.when(synthetic, F.lit(None)).otherwise(F.col(c)), F.col(c).desc()]


def resolution_class(c: Column) -> Column:
    """The received_ counter an event adds to."""
    known = F.when(c.isin(*RESOLVED), F.concat(F.lit("received_"), c)).when(c.isin(*UNRESOLVED), F.concat(F.lit("received_synthetic_"), c))
    other = F.when(c.startswith("missing_") | c.startswith("ambiguous_"), "received_synthetic_other_unresolved").otherwise("received_other_resolved")
    return F.coalesce(known, other)


def degrees(edges: DataFrame) -> DataFrame:
    """site, id, sent, received, the split of sent, and the classes of received: out- and in-degrees in one aggregation."""
    unresolved = F.col("target_account").isNull()
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    out = edges.select("site", F.col("source").alias("id"), one.alias("sent"), zero.alias("received"), F.when(unresolved, 0).otherwise(1).cast("long").alias("sent_to_resolved_target"), F.when(unresolved, 1).otherwise(0).cast("long").alias("sent_to_unresolved_or_ambiguous_target"), F.lit(None).cast("string").alias("class"))
    back = edges.select("site", F.col("target").alias("id"), zero.alias("sent"), one.alias("received"), zero.alias("sent_to_resolved_target"), zero.alias("sent_to_unresolved_or_ambiguous_target"), resolution_class(F.col("target_resolution")).alias("class"))
    sums = [F.sum(c).alias(c) for c in ("sent", "received", "sent_to_resolved_target", "sent_to_unresolved_or_ambiguous_target")]
    sums += [F.sum(F.when(F.col("class") == c, 1).otherwise(0)).alias(c) for c in RECEIVED]
    return out.unionByName(back).groupBy("site", "id").agg(*sums)


def codebook(accounts: DataFrame, nodes: DataFrame) -> DataFrame:
    """site, label, code: 1, 2 and so on for the evidence labels of a site's nodes in byte order.

    Labels of invalidated accounts count without their wrapping, though such accounts have code 0.
    """
    used = nodes.where("NOT id LIKE '-%'").select("site", F.col("id").alias("account_id"))
    labels = accounts.join(used, ["site", "account_id"], "left_semi").where("creation_evidence <> ''")
    return ranked(labels.select("site", stripped_evidence(F.col("creation_evidence")).alias("label")), ["site"], "label", "code")


def nodes(edges: DataFrame, names: DataFrame, accounts: DataFrame, first_blocks: DataFrame, synthetic: DataFrame) -> DataFrame:
    """One row per end of an edge: label, creation time and evidence code, first block, degrees."""
    found = degrees(edges)
    made = accounts.select("site", F.col("account_id").alias("id"), F.col("username").alias("_made"), "creation_timestamp", F.col("creation_evidence").alias("_evidence"))
    named = names.select("site", F.col("account_id").alias("id"), F.col("username").alias("_named"))
    unknown = synthetic.select("site", F.col("synthetic_id").alias("id"), F.col("target_username").alias("_label"))
    blocked = first_blocks.select("site", F.col("account_id").alias("id"), F.col("first_block").alias("first_block_by_user_timestamp"))
    codes = codebook(accounts, found).select("site", F.col("label").alias("_evidence"), "code")
    rows = found.join(named, ["site", "id"], "left").join(made, ["site", "id"], "left").join(unknown, ["site", "id"], "left")
    rows = rows.join(blocked, ["site", "id"], "left").join(codes, ["site", "_evidence"], "left")
    return rows.select(
        "site",
        "id",
        F.when(F.col("id").startswith("-"), "synthetic_target_label").otherwise("account").alias("node_type"),
        F.coalesce("_label", "_named", "_made").alias("label"),
        "creation_timestamp",
        F.coalesce("code", F.lit(0)).cast("int").alias("creation_evidence"),
        F.when(F.col("code").isNotNull(), F.col("_evidence")).alias("creation_evidence_label"),
        "first_block_by_user_timestamp",
        "sent",
        "received",
        "sent_to_resolved_target",
        "sent_to_unresolved_or_ambiguous_target",
        *RECEIVED,
    )


def block_coverage(nodes: DataFrame) -> DataFrame:
    """Per site: account nodes, those that blocked someone, and those that did before their creation."""
    first, made = F.col("first_block_by_user_timestamp"), F.col("creation_timestamp")
    return nodes.where("node_type = 'account'").groupBy("site").agg(
        F.count("*").alias("account_nodes"), F.count(first).alias("with_first_block"), F.count_if(first < made).alias("block_before_creation")
    )
