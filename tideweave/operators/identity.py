"""Account identities from contributor facts and creation evidence.

"Earliest wins" keeps the first row in file order among equal times, so ``seq`` breaks ties. Each
window is over the rows of one account or name.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideweave.functions.scalars import id_order, valid_timestamp
from tideweave.sources.staging import staged

ACCOUNT = ["site", "account_id"]


def first_activity(facts: DataFrame) -> DataFrame:
    """site, account_id, first_seen: the least valid time at which an account contributed."""
    return facts.where("valid").where(valid_timestamp(F.col("timestamp"))).groupBy(*ACCOUNT).agg(F.min("timestamp").alias("first_seen"))


def account_names(facts: DataFrame) -> DataFrame:
    """site, account_id, username (the first in file order), conflict: an id should have one name."""
    return (
        facts.where("valid")
        .groupBy(*ACCOUNT)
        .agg(F.min_by("username", "seq").alias("username"), (F.min("username") != F.max("username")).alias("conflict"))
    )


def current_names(facts: DataFrame) -> DataFrame:
    """site, username, account_id of names that exactly one id ever had."""
    found = facts.where("valid").groupBy("site", "username").agg(F.min("account_id").alias("account_id"), F.max("account_id").alias("_last"))
    return found.where("account_id = _last").drop("_last")


def first_by(rows: DataFrame, keys: list[str], values: list[str], order: list[str]) -> DataFrame:
    """Per key the values of the row that comes first; one aggregation with map-side combining."""
    best = F.min_by(F.struct(*values), F.struct(*order)).alias("_best")
    return rows.groupBy(*keys).agg(best).select(*keys, "_best.*")


def username_only(evidence: DataFrame) -> DataFrame:
    """The earliest creation of each name that came without an id."""
    rows = evidence.where("route = 'username_only'")
    return first_by(rows, ["site", "username"], ["timestamp", "evidence", "logid"], ["timestamp", "seq"])


def direct_creations(evidence: DataFrame) -> DataFrame:
    return evidence.where("route = 'account'").select(*ACCOUNT, "username", "timestamp", "evidence", "logid", F.lit(0).alias("phase"), "seq")


def pending_creations(evidence: DataFrame, current: DataFrame, activity: DataFrame) -> DataFrame:
    """Creations that named no id: those whose name has one id that was not active before."""
    rows = evidence.where("route = 'pending'").drop("account_id").join(current, ["site", "username"])
    rows = rows.join(activity, ACCOUNT, "left").where("first_seen IS NULL OR first_seen >= timestamp")
    return rows.select(*ACCOUNT, "username", "timestamp", "evidence", "logid", F.lit(1).alias("phase"), "seq")


def fold_creations(rows: DataFrame) -> DataFrame:
    """site, account_id, username, creation_timestamp, creation_evidence of each account.

    In order of phase and seq an earlier time replaces time and evidence. The name stays as first
    filled; evidence that comes with another name says so.
    """
    order = W.partitionBy(*ACCOUNT).orderBy("phase", "seq")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    records = rows.withColumn("_least", F.min("timestamp").over(before)).where("_least IS NULL OR timestamp < _least")
    filled = F.when(F.col("username") != "", F.col("username"))
    records = records.withColumn("_name", F.first(filled, ignorenulls=True).over(before))
    differs = F.coalesce(filled != F.col("_name"), F.lit(False))
    label = F.concat("evidence", F.when(differs, "_username_differs_from_existing").otherwise(""))
    found = records.select(*ACCOUNT, F.coalesce("_name", filled).alias("username"), F.col("timestamp").alias("creation_timestamp"), label.alias("creation_evidence"))
    # Records get ever earlier, so the last is the earliest.
    return first_by(found, ACCOUNT, ["username", "creation_timestamp", "creation_evidence"], ["creation_timestamp"])


def discard_late(accounts: DataFrame, activity: DataFrame) -> DataFrame:
    """Creations later than the account's first activity lose their time; the evidence says why."""
    late = F.coalesce(F.col("first_seen") < F.col("creation_timestamp"), F.lit(False))
    why = F.concat(F.lit("ignored_"), "creation_evidence", F.lit("_after_observed_activity_at_"), "first_seen")
    return accounts.join(activity, ACCOUNT, "left").select(
        *ACCOUNT,
        "username",
        F.when(~late, F.col("creation_timestamp")).alias("creation_timestamp"),
        F.when(late, why).otherwise(F.col("creation_evidence")).alias("creation_evidence"),
    )


def fill_from_usernames(accounts: DataFrame, only: DataFrame, current: DataFrame, activity: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accounts, new aliases): accounts without a time take that of a creation known by their current name alone."""
    dated = accounts.where("creation_timestamp IS NOT NULL").select(*ACCOUNT)
    found = only.join(current, ["site", "username"]).join(dated, ACCOUNT, "left_anti")
    found = found.join(activity, ACCOUNT, "left").where("first_seen IS NULL OR first_seen >= timestamp").drop("first_seen")
    filled = found.select(
        *ACCOUNT, "username", F.col("timestamp").alias("creation_timestamp"), F.concat("evidence", F.lit("_current_username")).alias("creation_evidence")
    )
    kept = accounts.join(filled.select(*ACCOUNT), ACCOUNT, "left_anti")
    aliases = found.select("site", F.col("username").alias("alias"), "account_id", "timestamp", "evidence", "logid")
    return kept.unionByName(filled), aliases


def creation_aliases(evidence: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """site, username, account_id, timestamp, evidence, logid: names an account had at a time, each once."""
    rows = evidence.where("alias IS NOT NULL").select(
        "site", F.col("alias").alias("username"), "account_id", "timestamp", F.col("alias_evidence").alias("evidence"), "logid", F.lit(0).alias("phase"), "seq"
    )
    if more is not None:
        late = more.select("site", F.col("alias").alias("username"), "account_id", "timestamp", "evidence", "logid", F.lit(1).alias("phase"), F.lit(0).cast("long").alias("seq"))
        rows = rows.unionByName(late)
    return first_by(rows, ["site", "username", "account_id", "timestamp"], ["evidence", "logid"], ["phase", "seq"])


def first_blocks(blocks: DataFrame) -> DataFrame:
    """site, account_id, first_block: when each account first blocked someone."""
    return blocks.where("status = 'valid'").groupBy("site", F.col("contributor_id").alias("account_id")).agg(F.min("timestamp").alias("first_block"))


#: Log ids and account ids that share all digits but so many are a bucket.
BUCKET_DIGITS = 5


def longest_in_order(values: list) -> list[bool]:
    """Which values make the earliest longest non-decreasing subsequence."""
    # From the right: the length of the longest such subsequence that starts at each value.
    tails: list = []  # tails[k]: negated rank of the largest value that starts one of length k + 1
    rank = {v: i for i, v in enumerate(sorted(set(values)))}
    lengths = [0] * len(values)
    for i in range(len(values) - 1, -1, -1):
        r = -rank[values[i]]
        at = bisect_right(tails, r)
        lengths[i] = at + 1
        if at == len(tails):
            tails.append(r)
        else:
            tails[at] = r
    keep, needed, last = [False] * len(values), len(tails), None
    for i, v in enumerate(values):
        if needed and lengths[i] >= needed and (last is None or v >= last):
            keep[i], last, needed = True, v, needed - 1
    return keep


def order_segments(rows: DataFrame, partition: list[str], order: str, value: str) -> DataFrame:
    """``rows`` with pivot and segment, in the order of a canonical decimal.

    A pivot is no less than all before it and no more than all after it, so it belongs to every
    longest non-decreasing subsequence; between pivots the problem falls into segments. A partition
    is split into buckets along the order, which know of each other by a row each.
    """
    width = F.length(order)
    bucket = F.struct(width, F.substring(F.col(order), F.lit(1), F.greatest(F.lit(1), width - BUCKET_DIGITS)))
    rows, key = rows.withColumn("_bucket", bucket), [*partition, "_bucket"]
    inner, outer = W.partitionBy(*key).orderBy(*id_order(F.col(order))), W.partitionBy(*partition).orderBy("_bucket")
    back, ahead = (W.unboundedPreceding, -1), (1, W.unboundedFollowing)
    ends = rows.groupBy(*key).agg(F.max(value).alias("_top"), F.min(value).alias("_low"))
    ends = ends.select(*key, F.max("_top").over(outer.rowsBetween(*back)).alias("_above"), F.min("_low").over(outer.rowsBetween(*ahead)).alias("_below"))
    before = F.greatest(F.max(value).over(inner.rowsBetween(*back)), "_above")
    after = F.least(F.min(value).over(inner.rowsBetween(*ahead)), "_below")
    fits = F.coalesce(F.col(value) >= before, F.lit(True)) & F.coalesce(F.col(value) <= after, F.lit(True))
    rows = rows.join(ends, key).withColumn("pivot", fits).drop("_above", "_below")
    pivot = F.col("pivot").cast("int")
    sums = rows.groupBy(*key).agg(F.sum(pivot).alias("_n"))
    sums = sums.select(*key, F.coalesce(F.sum("_n").over(outer.rowsBetween(*back)), F.lit(0)).alias("_base"))
    rows = rows.withColumn("_in", F.sum(pivot).over(inner.rowsBetween(W.unboundedPreceding, 0))).join(sums, key)
    return rows.withColumn("segment", F.col("_base") + F.col("_in")).drop("_bucket", "_base", "_in")


def keep_in_order(rows: DataFrame, partition: list[str], order: str, value: str) -> DataFrame:
    """``rows`` (unique ``order`` per partition, canonical decimal) with ``in_order``: whether the value stays.

    Only rows that aren't pivots go to Python, two columns of them, by segment.
    """
    marked = order_segments(rows, partition, order, value)
    loose = marked.where("NOT pivot").select(*partition, "segment", order, value)

    def keep(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(order, key=lambda s: s.map(lambda x: (len(x), x)))
        return frame.assign(_keep=longest_in_order(frame[value].tolist()))[[*partition, order, "_keep"]]

    types = dict(rows.dtypes)
    schema = ", ".join([*(f"{c} {types[c]}" for c in (*partition, order)), "_keep boolean"])
    kept = loose.groupBy(*partition, "segment").applyInPandas(keep, schema)
    return marked.join(kept, [*partition, order], "left").withColumn("in_order", F.coalesce("_keep", F.lit(True))).drop("pivot", "segment", "_keep")


def invalidate_out_of_order(accounts: DataFrame) -> DataFrame:
    """Accounts whose creation time does not fit the order of account ids lose it; as few as possible."""
    dated = keep_in_order(accounts.where("creation_timestamp IS NOT NULL"), ["site"], "account_id", "creation_timestamp")
    label = F.when(
        F.coalesce("creation_evidence", F.lit("")) == "", "invalidated_account_id_timestamp_order"
    ).otherwise(F.concat(F.lit("invalidated_"), "creation_evidence", F.lit("_account_id_timestamp_order")))
    dated = dated.select(
        *ACCOUNT,
        "username",
        F.when(F.col("in_order"), F.col("creation_timestamp")).alias("creation_timestamp"),
        F.when(F.col("in_order"), F.col("creation_evidence")).otherwise(label).alias("creation_evidence"),
    )
    return accounts.where("creation_timestamp IS NULL").select(*dated.columns).unionByName(dated)


def all_accounts(names: DataFrame, accounts: DataFrame) -> DataFrame:
    """Every account seen or created, with the contributor's name before the creation's."""
    made = accounts.withColumnRenamed("username", "_made")
    return names.select(*ACCOUNT, "username").join(made, ACCOUNT, "full_outer").select(
        *ACCOUNT, F.coalesce("username", "_made").alias("username"), "creation_timestamp", "creation_evidence"
    )


def resolve_identities(facts: DataFrame, evidence: DataFrame, keep: Callable[[DataFrame], DataFrame] = staged) -> dict[str, DataFrame]:
    """The evidence put together in its fixed order: direct, pending, late ones out, names alone, late ones out, id order."""
    activity, names, current = keep(first_activity(facts)), keep(account_names(facts)), keep(current_names(facts))
    only = username_only(evidence)
    accounts = fold_creations(direct_creations(evidence).unionByName(pending_creations(evidence, current, activity)))
    accounts = keep(discard_late(accounts, activity))
    accounts, more = fill_from_usernames(accounts, only, current, activity)
    accounts = invalidate_out_of_order(keep(discard_late(accounts, activity)))
    return {
        "activity": activity,
        "names": names,
        "current": current,
        "username_only": only,
        "accounts": accounts,
        "aliases": creation_aliases(evidence, more),
    }
