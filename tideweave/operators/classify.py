"""Row classification: each parsed record gets the first status whose rule it meets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideweave.functions.scalars import (
    bad_userid,
    event_timestamp,
    serialised_newuser,
    serialised_userid,
    title_name,
    title_namespace,
    valid_id,
    valid_timestamp,
    zero_userid,
)

#: Actions that create an account.
SELF_CREATION = ("create", "autocreate", "newusers")
BY_OTHERS = ("byemail", "forcecreatelocal")
CREATION_ACTIONS = (*SELF_CREATION, "create2", *BY_OTHERS)


def first_status(rules: list[tuple[str, Column]], otherwise: str) -> Column:
    """The name of the first rule that holds."""
    out = F.lit(otherwise)
    for name, holds in reversed(rules):
        out = F.when(F.coalesce(holds, F.lit(False)), name).otherwise(out)
    return out


def with_namespace(rows: DataFrame, namespaces: DataFrame) -> DataFrame:
    """Rows with ``namespace``, whether it is one of the site's user namespaces (``user_title``), and ``title_user``."""
    users = namespaces.where("is_user").select("site", "dump_date", F.col("namespace").alias("_ns"), F.lit(True).alias("_known"))
    named = rows.withColumn("namespace", title_namespace(F.col("logtitle")))
    # A site has a few dozen namespaces at most.
    on = (named["site"] == users["site"]) & (named["dump_date"] == users["dump_date"]) & (named["namespace"] == users["_ns"])
    out = named.join(F.broadcast(users), on, "left").select(named["*"], F.coalesce("_known", F.lit(False)).alias("user_title"))
    return out.withColumn("title_user", F.when(F.col("user_title"), title_name(F.col("logtitle"))))


def thanks_status(rows: DataFrame) -> DataFrame:
    """Parsed thanks records (with_namespace applied) with ``status``; first in file order wins among equal log ids.

    ``valid`` records are events; ``excluded`` ones hide a field (deleted_fields tells which); every
    other status is a defect.
    """
    text = lambda name: F.coalesce(F.col(name), F.lit(""))
    hidden_target = F.col("logtitle_deleted") | F.col("text_deleted") | F.col("action_deleted")
    early = [
        ("parse_failure", F.col("malformed")),
        ("type_mismatch", text("type") != "thanks"),
        ("action_not_thank", ~F.col("action_deleted") & (text("action") != "thank")),
        ("logid_missing", text("logid") == ""),
        ("logid_invalid", ~valid_id(F.col("logid"))),
    ]
    rows = rows.withColumn("_early", first_status(early, ""))
    # Only records that come this far take part in the duplicate test.
    nth = F.row_number().over(W.partitionBy("site", "dump_date", "logid", "_early").orderBy("seq"))
    rows = rows.withColumn("_nth", F.when(F.col("_early") == "", nth))
    late = [
        ("logid_duplicate", F.col("_nth") > 1),
        ("params_invalid", F.col("saw_params") & ~F.col("params_deleted") & (text("params") != "a:0:{}")),
        ("timestamp_missing", ~F.col("saw_timestamp") | (~F.col("timestamp_deleted") & (text("timestamp") == ""))),
        ("timestamp_invalid", ~F.col("timestamp_deleted") & ~event_timestamp(F.col("timestamp"))),
        ("contributor_missing", ~F.col("saw_contributor")),
        ("source_username_missing", ~F.col("contributor_deleted") & F.col("contributor_username").isNull()),
        ("source_id_missing", ~F.col("contributor_deleted") & F.col("contributor_id").isNull()),
        ("source_id_invalid", ~F.col("contributor_deleted") & ~valid_id(F.col("contributor_id"))),
        ("logtitle_missing", ~F.col("saw_logtitle") & ~hidden_target),
        ("excluded", F.col("timestamp_deleted") | F.col("contributor_deleted") | hidden_target),
        ("title_bad_prefix", F.col("namespace").isNull()),
        ("namespace_unknown", ~F.col("user_title")),
    ]
    status = F.when(F.col("_early") != "", F.col("_early")).otherwise(first_status(late, "titled"))
    rows = rows.withColumn("status", status)
    # A file has one target namespace: that of the first title that gets here. Dumps are few, rows many: aggregate, then join.
    first = rows.where("status = 'titled'").groupBy("site", "dump_date").agg(F.min_by("namespace", "seq").alias("_first"))
    rows = rows.join(F.broadcast(first), ["site", "dump_date"], "left")
    last = [
        ("namespace_inconsistent", F.col("namespace") != F.col("_first")),
        ("target_missing", F.col("title_user").isNull()),
    ]
    status = F.when(F.col("status") == "titled", first_status(last, "valid")).otherwise(F.col("status"))
    fields = F.concat_ws(
        ";",
        F.when(F.col("timestamp_deleted"), "timestamp"),
        F.when(F.col("contributor_deleted"), "contributor"),
        F.when(hidden_target, "logtitle"),
    )
    return rows.withColumn("status", status).withColumn("deleted_fields", F.when(F.col("status") == "excluded", fields)).drop("_early", "_nth", "_first")


def observed_edges(thanks: DataFrame) -> DataFrame:
    return thanks.where("status = 'valid'").select(
        "site",
        "dump_date",
        "logid",
        "timestamp",
        F.col("contributor_id").alias("source_id"),
        F.col("contributor_username").alias("source_username"),
        F.col("title_user").alias("target_username"),
    )


def deleted_exclusions(thanks: DataFrame) -> DataFrame:
    return thanks.where("status = 'excluded'").select(
        "site",
        "dump_date",
        "logid",
        "timestamp",
        F.col("contributor_username").alias("source_username"),
        F.col("contributor_id").alias("source_id"),
        "contributor_deleted",
        "logtitle",
        "deleted_fields",
    )


def renames(rows: DataFrame) -> DataFrame:
    """Rename records (with_namespace applied) of canonical log id, with parse_status, old_username, new_username."""
    new = serialised_newuser(F.col("params"))
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    rules = [
        ("action_not_renameuser", F.coalesce(F.col("action"), F.lit("")) != "renameuser"),
        ("timestamp_invalid", F.col("timestamp_deleted") | ~valid_timestamp(F.col("timestamp"))),
        ("missing_logtitle_or_params", empty("logtitle") | empty("params")),
        ("bad_old_username_logtitle", F.col("title_user").isNull()),
        ("bad_new_username_params", new.isNull()),
    ]
    mine = rows.where(~F.col("malformed") & (F.col("type") == "renameuser") & valid_id(F.col("logid")))
    mine = mine.withColumn("parse_status", first_status(rules, "parsed"))
    done = F.col("parse_status") == "parsed"
    return mine.select(
        "site",
        "dump_date",
        "seq",
        "logid",
        "timestamp",
        F.when(done, F.col("title_user")).alias("old_username"),
        F.when(done, new).alias("new_username"),
        "parse_status",
    )


def blocks(rows: DataFrame) -> DataFrame:
    """Block records with status; ``valid`` ones say that contributor_id blocked someone at timestamp."""
    rules = [
        ("parse_failure", F.col("malformed") | (F.coalesce("type", F.lit("")) != "block")),
        ("action_not_block", F.col("action_deleted") | (F.coalesce("action", F.lit("")) != "block")),
        ("logid_invalid", ~valid_id(F.col("logid"))),
        ("timestamp_missing", F.coalesce("timestamp", F.lit("")) == ""),
        ("timestamp_invalid", ~valid_timestamp(F.col("timestamp"))),
        ("contributor_deleted_or_missing", ~F.col("saw_contributor") | F.col("contributor_deleted")),
        ("source_id_missing", ~valid_id(F.col("contributor_id"))),
    ]
    return rows.withColumn("status", first_status(rules, "valid"))


def creation_evidence(rows: DataFrame) -> DataFrame:
    """Account-creation records (with_namespace applied) with status, evidence, and what they say.

    ``route``: account (account_id and perhaps username), pending (a username whose id must be looked
    up), username_only, or null. ``alias``: the name the account is known to have had.
    """
    c, u = F.col("contributor_id"), F.col("contributor_username")
    title, action = F.col("title_user"), F.col("action")
    p = serialised_userid(F.when(~F.col("params_deleted"), F.col("params")))
    rules = [
        ("parse_failure", F.col("malformed") | (F.coalesce("type", F.lit("")) != "newusers")),
        ("id_invalid", ~valid_id(F.col("logid")) | (c.isNotNull() & ~valid_id(c))),
        ("action_other", ~F.coalesce(action, F.lit("")).isin(*CREATION_ACTIONS)),
        ("timestamp_missing", F.coalesce("timestamp", F.lit("")) == ""),
        ("timestamp_invalid", ~valid_timestamp(F.col("timestamp"))),
    ]
    rows = rows.withColumn("status", first_status(rules, "valid")).withColumn("params_userid", p)
    own, p = action.isin(*SELF_CREATION), F.col("params_userid")
    zero = zero_userid(F.col("params")) & own & valid_id(c) & u.isNotNull()
    rows = rows.withColumn("params_invalid", ~F.col("params_deleted") & bad_userid(F.col("params")) & ~zero & (F.col("status") == "valid"))
    # One entry per line of the decision table: condition, route, account, username, alias, evidence.
    none = F.lit(None).cast("string")
    label = lambda head, tail="": F.concat(F.lit(head), action, F.lit(tail))
    confirmed = F.when(p == c, "_params_confirmed").otherwise("")
    table = [
        (own & c.isNotNull() & u.isNotNull(), "account", c, u, F.coalesce(title, u), F.concat(label("newusers_contributor_"), confirmed)),
        (own & c.isNotNull() & title.isNotNull(), "account", c, title, title, label("newusers_contributor_id_logtitle_username_")),
        (own & c.isNotNull(), "account", c, none, none, label("newusers_contributor_id_only_")),
        (own & p.isNotNull() & u.isNotNull(), "account", p, u, F.coalesce(title, u), label("newusers_params_userid_", "_contributor_username")),
        (own & p.isNotNull() & title.isNotNull(), "account", p, title, title, label("newusers_params_userid_", "_logtitle_username")),
        (own & p.isNull() & u.isNotNull(), "pending", none, u, none, label("newusers_missing_contributor_id_username_")),
        (action.isin("create2", *BY_OTHERS) & title.isNotNull() & p.isNotNull(), "account", p, title, title, label("newusers_logtitle_params_userid_")),
        ((action == "create2") & title.isNotNull() & p.isNull(), "username_only", none, title, none, F.lit("newusers_logtitle_only_create2")),
    ]
    out = {name: F.lit(None).cast("string") for name in ("route", "account_id", "username", "alias", "evidence")}
    for condition, route, account, username, alias, evidence in reversed(table):
        for name, value in zip(out, (F.lit(route), account, username, alias, evidence), strict=True):
            out[name] = F.when(condition, value).otherwise(out[name])
    valid = F.col("status") == "valid"
    alias_kind = F.when(title.isNotNull(), "_logtitle_alias").otherwise("_contributor_username_alias")
    return rows.select(
        "site",
        "dump_date",
        "seq",
        "logid",
        "timestamp",
        "action",
        "status",
        "params_invalid",
        *(F.when(valid, value).alias(name) for name, value in out.items()),
        F.when(valid & out["alias"].isNotNull(), F.concat(out["evidence"], alias_kind)).alias("alias_evidence"),
    )
