"""Queries that read dumps, SQL dumps and releases made of the driver's tables, and the same results in SQL.

The events table becomes an audit-log dump for each of three sites, as text cut after each record:
clicks are thanks, signups account creations, errors blocks, purchases renames, other events
deletions. Every sixteenth record has one of the faults and hidden fields that FAULTS lists, which
the SQL knows by the event's number alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideweave.operators import classify, graph, quality
from tideweave.registry import query
from tideweave.sources import dumps, site_tables

KINDS = {"click": ("thanks", "thank"), "signup": ("newusers", "create"), "error": ("block", "block"), "purchase": ("renameuser", "renameuser")}
DATE = "20990601"
HEAD = """<mediawiki><siteinfo><namespaces><namespace key="0"></namespace><namespace key="2">Benutzer</namespace>
<namespace key="4">Projekt</namespace></namespaces></siteinfo>
"""
#: By event number modulo 16.
FAULTS = {
    0: "no log id",
    1: "log id 0x",
    2: "time hidden",
    3: "contributor hidden",
    4: "title hidden",
    5: "title without a namespace",
    6: "title of another namespace",
    7: "action zap",
    8: "markup not closed",
    9: "time not a time",
    10: "contributor without id",
    11: "no contributor",
    12: "parameters a:1:{}",
    13: "empty time",
    14: "log id of the record three before",
    15: "title without a name",
}


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    of = lambda i: F.coalesce(*(F.when(F.col("event_type") == k, v[i]) for k, v in KINDS.items()), F.lit("delete"))
    return e.select(
        F.concat(F.lit("s"), (F.col("event_id") % 3).cast("string")).alias("site"),
        F.col("event_id").alias("seq"),
        (F.col("event_id") % 16).alias("m"),
        of(0).alias("kind"),
        of(1).alias("action"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"),
        (F.col("user_id") + 1).cast("string").alias("account"),
        F.concat(F.lit("ü"), (F.col("user_id") % 100).cast("string")).alias("name"),
    )


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What raw_rows gives of the three dumps."""
    m = F.col("m")
    tag = lambda name, text: F.concat(F.lit(f"<{name}>"), text, F.lit(f"</{name}>"))
    hidden = lambda name: F.lit(f'<{name} deleted="deleted" />')
    none = F.lit("")
    number = lambda back: (F.col("seq") + 1 - back).cast("string")
    title = F.when(m == 5, F.lit("Main")).when(m == 6, F.concat(F.lit("Projekt:"), F.col("name"))).when(m == 15, F.lit("Benutzer:"))
    title = title.otherwise(F.concat(F.lit("Benutzer:"), F.col("name"), F.lit(" &amp; Co")))
    new = F.concat(F.lit("n"), F.col("name"))
    params = (
        F.when(m == 12, F.lit("a:1:{}"))
        .when(F.col("kind") == "renameuser", F.concat(F.lit('a:1:{s:10:"5::newuser";s:'), F.octet_length(new).cast("string"), F.lit(':"'), new, F.lit('";}')))
        .when((F.col("kind") == "newusers") & (F.col("seq") % 2 == 0), F.concat(F.lit('a:1:{s:9:"4::userid";i:'), F.col("account"), F.lit(";}")))
    )
    record = F.concat(
        F.lit("<logitem>"),
        F.when(m == 0, none).when(m == 1, F.lit("<id>0x</id>")).when(m == 14, tag("id", number(3))).otherwise(tag("id", number(0))),
        F.when(m == 2, hidden("timestamp")).when(m == 9, F.lit("<timestamp>noon</timestamp>")).when(m == 13, F.lit("<timestamp></timestamp>")).otherwise(tag("timestamp", F.col("time"))),
        F.when(m == 3, hidden("contributor"))
        .when(m == 11, none)
        .otherwise(tag("contributor", F.concat(tag("username", F.col("name")), F.when(m == 10, none).otherwise(tag("id", F.col("account")))))),
        tag("type", F.col("kind")),
        F.when(m == 7, F.lit("<action>zap</action>")).otherwise(tag("action", F.col("action"))),
        F.when(m == 4, hidden("logtitle")).otherwise(tag("logtitle", title)),
        F.when(params.isNotNull(), F.concat(F.lit('<params xml:space="preserve">'), params, F.lit("</params>"))).otherwise(none),
        F.when(m == 8, F.lit("<broken>")).otherwise(none),
    )
    events = _events(spark, sf_dir)
    first = F.when(F.col("seq") < 3, F.lit(HEAD)).otherwise(F.lit("\n"))
    rows = events.select("site", F.lit(DATE).alias("dump_date"), "seq", F.concat(first, record).alias("value"))
    # The second site's file stops within a record, the others end as they should.
    ends = events.groupBy("site").agg((F.max("seq") + 1).alias("seq"))
    tail = F.when(F.col("site") == "s1", F.lit("\n<logitem><id>7</id><type>thanks</type>")).otherwise(F.lit("\n</mediawiki>\n"))
    return rows.unionByName(ends.select("site", F.lit(DATE).alias("dump_date"), "seq", tail.alias("value")))


def _records(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    rows = dumps.parsed(dumps.candidates(dumps.framed(raw), kind))
    return classify.with_namespace(rows, dumps.namespaces(raw))


DUMP = """
    WITH d AS (
        SELECT 's' || (event_id % 3) AS site, event_id AS seq, event_id % 16 AS m, CAST(user_id + 1 AS VARCHAR) AS account, 'ü' || (user_id % 100) AS name,
               CASE event_type WHEN 'click' THEN 'thanks' WHEN 'signup' THEN 'newusers' WHEN 'error' THEN 'block' WHEN 'purchase' THEN 'renameuser' ELSE 'delete' END AS kind,
               CASE WHEN event_id % 16 = 7 THEN 'zap' ELSE CASE event_type WHEN 'click' THEN 'thank' WHEN 'signup' THEN 'create' WHEN 'error' THEN 'block' WHEN 'purchase' THEN 'renameuser' ELSE 'delete' END END AS action,
               CASE event_id % 16 WHEN 0 THEN NULL WHEN 1 THEN '0x' WHEN 14 THEN CAST(event_id - 2 AS VARCHAR) ELSE CAST(event_id + 1 AS VARCHAR) END AS logid,
               CASE event_id % 16 WHEN 2 THEN NULL WHEN 9 THEN 'noon' WHEN 13 THEN '' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS timestamp,
               CASE WHEN event_id % 16 NOT IN (3, 11) THEN 'ü' || (user_id % 100) END AS username,
               CASE WHEN event_id % 16 NOT IN (3, 10, 11) THEN CAST(user_id + 1 AS VARCHAR) END AS userid,
               CASE event_id % 16 WHEN 4 THEN NULL WHEN 5 THEN 'Main' WHEN 6 THEN 'Projekt:ü' || (user_id % 100) WHEN 15 THEN 'Benutzer:'
                   ELSE 'Benutzer:ü' || (user_id % 100) || ' & Co' END AS logtitle,
               CASE WHEN event_id % 16 NOT IN (4, 5, 6, 15) THEN 'ü' || (user_id % 100) || ' & Co' END AS title_user,
               CASE WHEN event_id % 16 <> 12 AND event_id % 2 = 0 THEN CAST(user_id + 1 AS VARCHAR) END AS params_userid
        FROM events
    )
"""


@query(
    "dump_records",
    DUMP
    + """SELECT site, seq, kind AS type, action, logid, timestamp, logtitle, username AS contributor_username, userid AS contributor_id,
               m = 2 AS timestamp_deleted, m = 3 AS contributor_deleted, m = 4 AS logtitle_deleted, m <> 11 AS saw_contributor, m <> 0 AS saw_id
        FROM d WHERE m <> 8""",
)
def dump_records(spark, sf_dir):
    """Framing at end tags and parsing of whole records; the header, a cut record and the tail are none."""
    rows = dumps.parsed(dumps.framed(_raw(spark, sf_dir))).where("NOT malformed")
    kept = ["type", "action", "logid", "timestamp", "logtitle", "contributor_username", "contributor_id", "timestamp_deleted", "contributor_deleted", "logtitle_deleted", "saw_contributor", "saw_id"]
    return rows.select("site", "seq", *kept)


@query("dump_malformed", DUMP + "SELECT site, seq FROM d WHERE m = 8")
def dump_malformed(spark, sf_dir):
    """A record whose markup is broken spoils only itself."""
    return dumps.parsed(dumps.framed(_raw(spark, sf_dir))).where("malformed").select("site", "seq")


@query("dump_truncated", "SELECT 's1' AS site, '20990601' AS dump_date")
def dump_truncated(spark, sf_dir):
    """Files that stop within a record."""
    return dumps.truncated(_raw(spark, sf_dir))


@query(
    "dump_namespaces",
    "SELECT s.site, n.namespace, n.namespace IN ('User', 'Benutzer') AS is_user FROM (VALUES ('s0'), ('s1'), ('s2')) s(site), (VALUES ('User'), ('Benutzer'), ('Projekt')) n(namespace)",
)
def dump_namespaces(spark, sf_dir):
    """Namespaces of each site from the dump's header, the general name of the user namespace added."""
    return dumps.namespaces(_raw(spark, sf_dir)).select("site", "namespace", "is_user")


@query(
    "dump_needles",
    DUMP + "SELECT site, count(*) FILTER (kind = 'thanks') + CASE WHEN site = 's1' THEN 1 ELSE 0 END AS thanks_needles, count(*) FILTER (kind = 'block') AS block_needles FROM d GROUP BY site",
)
def dump_needles(spark, sf_dir):
    """A recount of types in the raw text, cut records included."""
    return dumps.needle_counts(_raw(spark, sf_dir)).select("site", "thanks_needles", "block_needles")


@query("dump_contributors", DUMP + "SELECT site, seq, userid AS account_id, username FROM d WHERE userid IS NOT NULL")
def dump_contributors(spark, sf_dir):
    """Visible contributors of every record, malformed ones included."""
    return dumps.contributor_facts(dumps.framed(_raw(spark, sf_dir))).select("site", "seq", "account_id", "username")


THANKS = (
    DUMP
    + """
    , t AS (
        SELECT *, m NOT IN (0, 1, 7, 8) AS counted FROM d WHERE kind = 'thanks'
    ), n AS (
        SELECT *, CASE WHEN counted THEN row_number() OVER (PARTITION BY site, logid, counted ORDER BY seq) END AS nth FROM t
    ), thanks AS (
        SELECT *, CASE
            WHEN m = 8 THEN 'parse_failure' WHEN m = 7 THEN 'action_not_thank' WHEN m = 0 THEN 'logid_missing' WHEN m = 1 THEN 'logid_invalid'
            WHEN nth > 1 THEN 'logid_duplicate' WHEN m = 12 THEN 'params_invalid' WHEN m = 13 THEN 'timestamp_missing' WHEN m = 9 THEN 'timestamp_invalid'
            WHEN m = 11 THEN 'contributor_missing' WHEN m = 10 THEN 'source_id_missing' WHEN m IN (2, 3, 4) THEN 'excluded'
            WHEN m = 5 THEN 'title_bad_prefix' WHEN m = 6 THEN 'namespace_unknown' WHEN m = 15 THEN 'target_missing' ELSE 'valid' END AS status
        FROM n
    )
    """
)


@query("thanks_ladder", THANKS + "SELECT site, seq, status FROM thanks")
def thanks_ladder(spark, sf_dir):
    """Every status of the thanks ladder, duplicates by file order among those that come so far."""
    return classify.thanks_status(_records(spark, sf_dir, "thanks")).select("site", "seq", "status")


@query("observed_edges", THANKS + "SELECT site, logid, timestamp, userid AS source_id, username AS source_username, title_user AS target_username FROM thanks WHERE status = 'valid'")
def observed_edges(spark, sf_dir):
    """Events of valid thanks."""
    return classify.observed_edges(classify.thanks_status(_records(spark, sf_dir, "thanks"))).drop("dump_date")


@query(
    "deleted_exclusions",
    THANKS
    + """SELECT site, logid, timestamp, username AS source_username, userid AS source_id, m = 3 AS contributor_deleted, logtitle,
                CASE m WHEN 2 THEN 'timestamp' WHEN 3 THEN 'contributor' ELSE 'logtitle' END AS deleted_fields
        FROM thanks WHERE status = 'excluded'""",
)
def deleted_exclusions(spark, sf_dir):
    """Thanks that hide a field, and which."""
    return classify.deleted_exclusions(classify.thanks_status(_records(spark, sf_dir, "thanks"))).drop("dump_date")


@query(
    "rename_ladder",
    DUMP
    + """, r AS (
        SELECT *, CASE WHEN m = 7 THEN 'action_not_renameuser' WHEN m IN (2, 9, 13) THEN 'timestamp_invalid' WHEN m = 4 THEN 'missing_logtitle_or_params'
                       WHEN m IN (5, 6, 15) THEN 'bad_old_username_logtitle' WHEN m = 12 THEN 'bad_new_username_params' ELSE 'parsed' END AS parse_status
        FROM d WHERE kind = 'renameuser' AND m NOT IN (0, 1, 8)
    )
    SELECT site, seq, logid, parse_status, CASE WHEN parse_status = 'parsed' THEN title_user END AS old_username, CASE WHEN parse_status = 'parsed' THEN 'n' || name END AS new_username FROM r""",
)
def rename_ladder(spark, sf_dir):
    """Renames with names from titles and byte-counted parameters, and why others have none."""
    return classify.renames(_records(spark, sf_dir, "renameuser")).select("site", "seq", "logid", "parse_status", "old_username", "new_username")


@query(
    "block_ladder",
    DUMP
    + """SELECT site, seq, CASE WHEN m = 8 THEN 'parse_failure' WHEN m = 7 THEN 'action_not_block' WHEN m IN (0, 1) THEN 'logid_invalid' WHEN m IN (2, 13) THEN 'timestamp_missing'
                WHEN m = 9 THEN 'timestamp_invalid' WHEN m IN (3, 11) THEN 'contributor_deleted_or_missing' WHEN m = 10 THEN 'source_id_missing' ELSE 'valid' END AS status
        FROM d WHERE kind = 'block'""",
)
def block_ladder(spark, sf_dir):
    """Every status of block records."""
    return classify.blocks(_records(spark, sf_dir, "block")).select("site", "seq", "status")


@query(
    "creation_table",
    DUMP
    + """, c AS (
        SELECT *, CASE WHEN m = 8 THEN 'parse_failure' WHEN m IN (0, 1) THEN 'id_invalid' WHEN m = 7 THEN 'action_other' WHEN m IN (2, 13) THEN 'timestamp_missing'
                       WHEN m = 9 THEN 'timestamp_invalid' ELSE 'valid' END AS status FROM d WHERE kind = 'newusers'
    ), e AS (
        SELECT *, CASE WHEN status <> 'valid' THEN NULL WHEN userid IS NOT NULL THEN 'account' WHEN params_userid IS NOT NULL AND coalesce(username, title_user) IS NOT NULL THEN 'account'
                       WHEN username IS NOT NULL THEN 'pending' END AS route FROM c
    )
    SELECT site, seq, status, route, CASE WHEN route = 'account' THEN coalesce(userid, params_userid) END AS account_id, CASE WHEN route IS NOT NULL THEN coalesce(username, title_user) END AS username,
           CASE WHEN route = 'account' THEN coalesce(title_user, username) END AS alias,
           CASE WHEN route = 'pending' THEN 'newusers_missing_contributor_id_username_create'
                WHEN route IS NULL THEN NULL
                WHEN userid IS NOT NULL AND params_userid = userid THEN 'newusers_contributor_create_params_confirmed'
                WHEN userid IS NOT NULL THEN 'newusers_contributor_create'
                WHEN username IS NOT NULL THEN 'newusers_params_userid_create_contributor_username'
                ELSE 'newusers_params_userid_create_logtitle_username' END AS evidence
    FROM e""",
)
def creation_table(spark, sf_dir):
    """The decision table of account creations: route, account, names and evidence."""
    rows = classify.creation_evidence(_records(spark, sf_dir, "newusers"))
    return rows.select("site", "seq", "status", "route", "account_id", "username", "alias", "evidence")


@query(
    "sql_dump_stats",
    """WITH s AS (SELECT c_nationkey AS k, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS t FROM customer GROUP BY 1)
    SELECT 'n' || k || 'wiki' AS dbname, CASE WHEN k % 5 <> 1 THEN t + 1 END AS contributions, CASE WHEN k % 5 <> 1 THEN n END AS pages,
           CASE k % 5 WHEN 0 THEN 7 WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE 7 END AS users, CASE WHEN k % 5 <> 1 THEN 3 END AS active_users,
           CASE k % 5 WHEN 1 THEN 'not a list of tuples' WHEN 2 THEN 'no value in any shard' WHEN 3 THEN 'row id repeated' WHEN 4 THEN 'no row id' END AS error
    FROM s""",
)
def sql_dump_stats(spark, sf_dir):
    """Statistics of SQL dumps by column name, summed over shards; every fifth dump has each of four faults."""
    sums = spark.read.parquet(f"{sf_dir}/customer.parquet").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("n"), F.sum("c_custkey").alias("t"))
    k = F.col("k") % 5
    columns = ",\n".join(f"  `{c}` bigint" for c in ("ss_row_id", "ss_users", *(c for c in site_tables.STATS if c != "ss_users")))
    users = F.when(k == 2, "NULL").otherwise("7")
    second = F.when(k == 3, "1").when(k == 4, "NULL").otherwise("2")
    rows = F.concat(F.lit("(1,"), users, F.lit(","), F.col("t").cast("string"), F.lit(","), F.col("n").cast("string"), F.lit(",1),"), F.when(k == 1, "junk,").otherwise(""), F.lit("("), second, F.lit(",NULL,1,0,2)"))
    text = F.concat(F.lit(f"CREATE TABLE `site_stats` (\n{columns},\n  PRIMARY KEY (`ss_row_id`)\n) ENGINE=InnoDB;\nINSERT INTO `site_stats` VALUES "), rows, F.lit(";\n"))
    files = sums.select(F.concat(F.lit("n"), F.col("k").cast("string"), F.lit("wiki-20990601-site_stats.sql")).alias("file"), text.alias("value"))
    found = site_tables.site_stats(site_tables.tuples_of(files))
    return found.select("dbname", *(F.col(c).cast("long").alias(c) for c in site_tables.STATS.values()), "error")


@query(
    "manifest_lines",
    """SELECT 'https://example.org/n' || n_nationkey || '_xwiki/20990601/n' || n_nationkey || '_xwiki-20990601-pages-logging.xml.gz' AS url, 'n' || n_nationkey || '_xwiki' AS dbname,
              'n' || n_nationkey || '-x' AS site, '20990601' AS dump_date FROM nation
    UNION ALL SELECT 'https://example.org/other', NULL, NULL, NULL""",
)
def manifest_lines(spark, sf_dir):
    """A manifest of URLs, with comments, carriage returns, blanks and repeated lines."""
    name = F.concat(F.lit("n"), F.col("n_nationkey").cast("string"), F.lit("_xwiki"))
    url = F.concat(F.lit("https://example.org/"), name, F.lit("/20990601/"), name, F.lit("-20990601-pages-logging.xml.gz"))
    lines = F.explode(F.array(F.concat(url, F.lit("  # one\r")), url, F.lit("# two"), F.lit(" "), F.lit("https://example.org/other"))).alias("value")
    return site_tables.manifest_of(spark.read.parquet(f"{sf_dir}/nation.parquet").select(lines))


@query(
    "unsorted_edges",
    """SELECT o_orderkey FROM (SELECT o_orderkey, o_orderdate, CAST(o_custkey AS VARCHAR) AS c, lag(o_orderdate) OVER w AS d, lag(CAST(o_custkey AS VARCHAR)) OVER w AS l
                               FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderkey))
    WHERE d > o_orderdate OR (d = o_orderdate AND (length(l) > length(c) OR (length(l) = length(c) AND l > c)))""",
)
def unsorted_edges(spark, sf_dir):
    """Rows that come before the one above them, places in buckets."""
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet")
    rows = rows.select(F.col("o_orderstatus").alias("site"), F.col("o_orderkey").alias("position"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("timestamp"), F.col("o_custkey").cast("string").alias("logid"))
    return quality.unsorted(rows, bucket=1000).select(F.col("position").alias("o_orderkey"))


def _release(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """A release of customers (accounts) thanking suppliers (targets, every seventh without an account), with faults by order number."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_linenumber = 1")
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    k = F.col("o_orderkey")
    supplier, customer = F.col("l_suppkey") + 1, (F.col("o_custkey") + 1).cast("string")
    target = F.when(supplier % 7 == 0, F.concat(F.lit("-"), supplier.cast("string"))).otherwise((supplier + 1_000_000).cast("string"))
    edges = o.join(li, k == F.col("l_orderkey")).select(
        F.lit("s").alias("site"),
        F.when(k % 101 == 0, F.lit("0x")).otherwise(k.cast("string")).alias("logid"),
        F.when(k % 103 == 0, F.lit("2099-12-31T00:00:00Z")).otherwise(F.date_format("o_orderdate", "'20'yy-MM-dd'T00:00:00Z'")).alias("timestamp"),
        customer.alias("source"),
        F.when(k % 107 == 0, customer).otherwise(target).alias("target"),
        k.alias("k"),
    )
    return {"edges": edges, "dates": spark.createDataFrame([("s", DATE)], "site string, dump_date string")}


def _faults(nodes: DataFrame, x: dict[str, DataFrame]) -> DataFrame:
    events = x["edges"].where("k % 109 <> 0").select("site", "logid", "timestamp", "source", "target", _resolution().alias("target_resolution"))
    events = events.withColumn("observed_target_label", F.concat(F.lit("l"), F.col("target")))
    events = events.withColumn("target_label_subtype", F.when(F.col("target").endswith("9"), "ip_address").otherwise("username"))
    events = events.withColumn("requires_historical_review", F.when(F.col("target").endswith("8"), "1").otherwise("0"))
    received = [c for c in graph.RECEIVED]
    audit_nodes = nodes.select("*", F.when(F.col("id").endswith("5"), "1").otherwise("0").alias("creation_timestamp_missing"))
    audit_nodes = audit_nodes.withColumn("sent_to_resolved_target", F.col("sent")).withColumn("sent_to_unresolved_or_ambiguous_target", F.when(F.col("id").endswith("3"), 1).otherwise(0))
    audit_nodes = audit_nodes.select("*", *((F.col("received") if c == received[0] else F.lit(0)).alias(c) for c in received)).where("NOT endswith(id, '77')")
    return quality.release_faults(nodes, x["edges"].drop("k"), audit_nodes, events, x["dates"])


def _resolution() -> Column:
    return F.when(F.col("target").startswith("-"), F.lit("missing_no_identity_evidence")).otherwise(F.lit("missing_historical_label_confirmation"))


def _nodes(x: dict[str, DataFrame]) -> DataFrame:
    edges = x["edges"]
    ends = edges.select(F.col("source").alias("id"), F.lit(1).alias("sent"), F.lit(0).alias("received"))
    ends = ends.unionByName(edges.select(F.col("target").alias("id"), F.lit(0).alias("sent"), F.lit(1).alias("received")))
    nodes = ends.groupBy("id").agg(F.sum("sent").alias("sent"), F.sum("received").alias("received"))
    # Faults by the end of the id: lost, of the wrong type, created too late, labelled otherwise.
    nodes = nodes.where("NOT endswith(id, '99')")
    return nodes.select(
        F.lit("s").alias("site"),
        "id",
        F.concat(F.when(F.col("id").endswith("6"), "x").otherwise("l"), "id").alias("label"),
        F.when(F.col("id").startswith("-") | F.col("id").endswith("4"), "synthetic_target_label").otherwise("account").alias("node_type"),
        F.when(F.col("id").endswith("1"), F.lit("2096-01-01T00:00:00Z")).alias("creation_timestamp"),
        F.lit(None).cast("string").alias("first_block_by_user_timestamp"),
        F.lit(0).alias("creation_evidence"),
        (F.col("sent") + F.when(F.col("id").endswith("2"), 1).otherwise(0)).alias("sent"),
        "received",
    )


RULES_SQL = """
    WITH e AS (
        SELECT o_orderkey AS k, CASE WHEN o_orderkey % 101 = 0 THEN '0x' ELSE CAST(o_orderkey AS VARCHAR) END AS logid,
               CASE WHEN o_orderkey % 103 = 0 THEN '2099-12-31T00:00:00Z' ELSE strftime(o_orderdate, '20%y-%m-%dT00:00:00Z') END AS timestamp, CAST(o_custkey + 1 AS VARCHAR) AS source,
               CASE WHEN o_orderkey % 107 = 0 THEN CAST(o_custkey + 1 AS VARCHAR) WHEN (l_suppkey + 1) % 7 = 0 THEN '-' || (l_suppkey + 1) ELSE CAST(l_suppkey + 1000001 AS VARCHAR) END AS target
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_linenumber = 1
    ), d AS (
        SELECT id, sum(s) AS sent, sum(r) AS received FROM (SELECT source AS id, 1 AS s, 0 AS r FROM e UNION ALL SELECT target, 0, 1 FROM e) GROUP BY 1
    ), n AS (
        SELECT *, CASE WHEN ends_with(id, '1') THEN '2096-01-01T00:00:00Z' END AS made, sent + CASE WHEN ends_with(id, '2') THEN 1 ELSE 0 END AS stated FROM d WHERE NOT ends_with(id, '99')
    ), a AS (SELECT * FROM n WHERE NOT ends_with(id, '77')),
    v AS (SELECT * FROM e WHERE k % 109 <> 0)
"""


@query(
    "release_rules",
    RULES_SQL
    + """
    SELECT 'edge_repeated' AS rule, (SELECT count(*) FROM (SELECT logid FROM e GROUP BY 1 HAVING count(*) > 1)) AS n
    UNION ALL SELECT 'edge_ids', (SELECT count(*) FROM e WHERE logid = '0x' OR source = target)
    UNION ALL SELECT 'edge_time', (SELECT count(*) FROM e WHERE timestamp >= '2099-06-01')
    UNION ALL SELECT 'node_type', (SELECT count(*) FROM n WHERE ends_with(id, '4') AND NOT starts_with(id, '-'))
    UNION ALL SELECT 'node_repeated', 0
    UNION ALL SELECT 'node_isolated', 0
    UNION ALL SELECT 'node_time', 0
    UNION ALL SELECT 'synthetic_attributes', (SELECT count(*) FROM n WHERE starts_with(id, '-') AND (stated > 0 OR made IS NOT NULL))
    UNION ALL SELECT 'edge_without_node', (SELECT count(*) FROM d WHERE ends_with(id, '99'))
    UNION ALL SELECT 'source_before_creation', (SELECT count(*) FROM e JOIN n ON e.source = n.id WHERE timestamp < made)
    UNION ALL SELECT 'target_before_creation', (SELECT count(*) FROM e JOIN n ON e.target = n.id WHERE timestamp < made)
    UNION ALL SELECT 'edge_not_audited', (SELECT count(*) FROM e WHERE k % 109 = 0)
    UNION ALL SELECT 'audit_without_edge', 0
    UNION ALL SELECT 'subtype', (SELECT count(*) FROM v WHERE ends_with(target, '9'))
    UNION ALL SELECT 'synthetic_label', (SELECT count(*) FROM v JOIN n ON target = id WHERE starts_with(target, '-') AND ends_with(id, '6'))
    UNION ALL SELECT 'review_flag', (SELECT count(*) FROM v WHERE starts_with(target, '-') = ends_with(target, '8'))
    UNION ALL SELECT 'node_without_audit', (SELECT count(*) FROM n WHERE ends_with(id, '77'))
    UNION ALL SELECT 'audit_without_node', 0
    UNION ALL SELECT 'missing_flag', (SELECT count(*) FROM a WHERE (made IS NULL) <> ends_with(id, '5'))
    UNION ALL SELECT 'received_sum', 0
    UNION ALL SELECT 'sent_split', (SELECT count(*) FROM a WHERE ends_with(id, '3'))
    UNION ALL SELECT 'sent_recount', (SELECT count(*) FROM d LEFT JOIN n USING (id) WHERE d.sent > 0 AND n.stated IS DISTINCT FROM d.sent) + (SELECT count(*) FROM n LEFT JOIN d USING (id) WHERE n.stated > 0 AND n.stated IS DISTINCT FROM d.sent)
    """,
)
def release_rules(spark, sf_dir):
    """Rules over a published release and how many rows break each; the faults are planted."""
    x = _release(spark, sf_dir)
    left_out = ["audit_differs", "recount", "class_sign", "sent_split_recount"]
    return _faults(_nodes(x), x).where(~F.col("rule").isin(left_out))
