"""Queries that apply the operators to the driver's tables, and the same results in SQL.

The events table is read as an audit log: a click is a thank, a signup creates an account, an error
is a block, a purchase a rename. ``site`` splits the log in three; users 100 apart share a name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideweave.functions import scalars
from tideweave import dump_queries  # noqa: F401  registers its queries
from tideweave.operators import audit, classify, graph, identity, intervals, quality, resolve, summary
from tideweave.registry import QUERIES, SQL, Query, query
from tideweave.sources import dumps, site_tables
from tideweave.sources.staging import staged


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("s"), (F.col("event_id") % 3).cast("string")).alias("site"),
        (F.col("event_id") + 1).cast("string").alias("logid"),
        F.col("event_id").alias("seq"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        (F.col("user_id") + 1).cast("string").alias("account_id"),
        F.concat(F.lit("u"), (F.col("user_id") % 100).cast("string")).alias("username"),
        F.concat(F.lit("u"), F.regexp_extract("props", "([0-9]+)", 1)).alias("target_username"),
        "event_type",
        F.lpad(F.floor(F.col("value") * 100).cast("string"), 12, "0").alias("amount"),
    )


LOG = """
    WITH log AS (
        SELECT 's' || (event_id % 3) AS site, CAST(event_id + 1 AS VARCHAR) AS logid, event_id AS seq,
               strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS timestamp, CAST(user_id + 1 AS VARCHAR) AS account_id,
               'u' || (user_id % 100) AS username, 'u' || regexp_extract(props, '([0-9]+)', 1) AS target_username, event_type,
               lpad(CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR), 12, '0') AS amount
        FROM events
    )
"""


def _facts(spark, sf_dir) -> DataFrame:
    return _log(spark, sf_dir).withColumn("valid", scalars.valid_id(F.col("account_id")) & scalars.valid_id(F.col("logid")))


def _creations(spark, sf_dir) -> DataFrame:
    rows = _log(spark, sf_dir).where("event_type = 'signup'")
    return rows.withColumn("evidence", F.lit("newusers_contributor_create")).withColumn("phase", F.lit(0))


def _accounts(spark, sf_dir) -> DataFrame:
    return identity.fold_creations(_creations(spark, sf_dir))


def _aliases(spark, sf_dir) -> DataFrame:
    rows = _creations(spark, sf_dir).withColumn("route", F.lit("account")).withColumn("alias", F.col("username")).withColumn("alias_evidence", F.col("evidence"))
    return identity.creation_aliases(rows)


def _held(spark, sf_dir) -> DataFrame:
    return intervals.closed_form(intervals.eligible_aliases(_aliases(spark, sf_dir), _accounts(spark, sf_dir)))


def _edges(spark, sf_dir) -> DataFrame:
    rows = _log(spark, sf_dir).where("event_type = 'click'")
    return rows.select("site", "logid", "timestamp", F.col("account_id").alias("source_id"), F.col("username").alias("source_username"), "target_username")


def _all_resolved(spark, sf_dir) -> DataFrame:
    current = identity.current_names(_facts(spark, sf_dir))
    return resolve.resolve_targets(_edges(spark, sf_dir), _held(spark, sf_dir), current, _accounts(spark, sf_dir))


def _resolved(spark, sf_dir) -> DataFrame:
    return resolve.drop_self_loops(_all_resolved(spark, sf_dir))


def _published(spark, sf_dir) -> DataFrame:
    rows = _resolved(spark, sf_dir)
    return graph.published_edges(rows, graph.synthetic_ids(rows))


RESOLVED = (
    LOG
    + """
    , current AS (
        SELECT site, username, min(account_id) AS account_id FROM log GROUP BY 1, 2 HAVING min(account_id) = max(account_id)
    ), made AS (
        SELECT site, account_id, min(timestamp) AS creation_timestamp FROM log WHERE event_type = 'signup' GROUP BY 1, 2
    ), held AS (
        SELECT site, username, account_id, min(timestamp) AS start FROM log WHERE event_type = 'signup' GROUP BY 1, 2, 3
    ), edges AS (
        SELECT site, logid, timestamp, account_id AS source_id, username AS source_username, target_username FROM log WHERE event_type = 'click'
    ), active AS (
        SELECT e.site, e.logid, min(h.account_id) AS one, max(h.account_id) AS other
        FROM edges e JOIN held h ON h.site = e.site AND h.username = e.target_username AND h.start <= e.timestamp GROUP BY 1, 2
    ), status AS (
        SELECT e.*, c.account_id AS cur, CASE
            WHEN a.one <> a.other THEN 'ambiguous_multiple_active_intervals'
            WHEN a.one IS NOT NULL AND e.timestamp < om.creation_timestamp THEN 'missing_interval_account_created_after_thank'
            WHEN a.one = c.account_id THEN 'interval_and_current_username_same'
            WHEN a.one IS NOT NULL THEN 'missing_historical_label_confirmation'
            WHEN c.account_id IS NULL THEN 'missing_no_identity_evidence'
            WHEN e.timestamp < cm.creation_timestamp THEN 'missing_current_created_after_thank'
            WHEN cm.creation_timestamp IS NULL THEN 'current_username_no_creation_timestamp'
            ELSE 'current_username_no_interval_conflict' END AS target_resolution
        FROM edges e LEFT JOIN active a ON a.site = e.site AND a.logid = e.logid
        LEFT JOIN current c ON c.site = e.site AND c.username = e.target_username
        LEFT JOIN made om ON om.site = e.site AND om.account_id = a.one
        LEFT JOIN made cm ON cm.site = e.site AND cm.account_id = c.account_id
    ), all_resolved AS (
        SELECT * EXCLUDE (cur), CASE WHEN target_resolution LIKE 'interval%' OR target_resolution LIKE 'current%' THEN cur END AS target_account FROM status
    ), resolved AS (
        SELECT * FROM all_resolved WHERE target_account IS NULL OR source_id <> target_account
    ), names AS (
        SELECT site, target_username, CAST(-row_number() OVER (PARTITION BY site ORDER BY target_username) AS VARCHAR) AS synthetic_id
        FROM (SELECT DISTINCT site, target_username FROM resolved WHERE target_account IS NULL)
    ), published AS (
        SELECT r.site, logid, timestamp, source_id AS source, coalesce(target_account, synthetic_id) AS target, r.target_username, target_account, target_resolution
        FROM resolved r LEFT JOIN names n ON n.site = r.site AND n.target_username = r.target_username
    )
"""
)

CLASS = """CASE WHEN target_resolution = 'interval_and_current_username_same' THEN 'received_interval_and_current_username_same'
    WHEN target_resolution IN ('current_username_no_interval_conflict', 'current_username_no_creation_timestamp') THEN 'received_' || target_resolution
    WHEN target_resolution IN ('missing_no_identity_evidence', 'ambiguous_multiple_active_intervals', 'missing_current_created_after_thank', 'missing_interval_account_created_after_thank')
        THEN 'received_synthetic_' || target_resolution
    ELSE 'received_synthetic_other_unresolved' END"""



@query("resolve_targets", RESOLVED + "SELECT * FROM all_resolved")
def resolve_targets(spark, sf_dir):
    """Interval, current-name and creation-time joins, and the decision over them."""
    return _all_resolved(spark, sf_dir)


@query("unique_identity", LOG + "SELECT site, username, min(account_id) AS account_id FROM log GROUP BY 1, 2 HAVING min(account_id) = max(account_id)")
def unique_identity(spark, sf_dir):
    return identity.current_names(_facts(spark, sf_dir))


@query("account_names", LOG + "SELECT site, account_id, arg_min(username, seq) AS username, min(username) <> max(username) AS conflict FROM log GROUP BY 1, 2")
def account_names(spark, sf_dir):
    return identity.account_names(_facts(spark, sf_dir))


@query("first_activity", LOG + "SELECT site, account_id, min(timestamp) AS first_seen FROM log GROUP BY 1, 2")
def first_activity(spark, sf_dir):
    return identity.first_activity(_facts(spark, sf_dir))


@query("first_block", LOG + "SELECT site, account_id, min(timestamp) AS first_block FROM log WHERE event_type = 'error' GROUP BY 1, 2")
def first_block(spark, sf_dir):
    rows = _log(spark, sf_dir).where("event_type = 'error'")
    return identity.first_blocks(rows.select("site", F.col("account_id").alias("contributor_id"), "timestamp", F.lit("valid").alias("status")))


@query(
    "creation_fold",
    LOG
    + """
    , r AS (
        SELECT *, min(amount) OVER (PARTITION BY site, account_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS least
        FROM log WHERE event_type = 'signup'
    ), rec AS (
        SELECT *, first_value(target_username) OVER (PARTITION BY site, account_id ORDER BY seq) AS name FROM r WHERE least IS NULL OR amount < least
    )
    SELECT site, account_id, name AS username, amount AS creation_timestamp,
           'signup' || CASE WHEN name <> target_username THEN '_username_differs_from_existing' ELSE '' END AS creation_evidence
    FROM rec QUALIFY row_number() OVER (PARTITION BY site, account_id ORDER BY amount) = 1
    """,
)
def creation_fold(spark, sf_dir):
    """The ordered fold of creation evidence, amounts standing for times that are out of order."""
    rows = _log(spark, sf_dir).where("event_type = 'signup'")
    rows = rows.select("site", "account_id", F.col("target_username").alias("username"), F.col("amount").alias("timestamp"), F.lit("signup").alias("evidence"), F.lit(0).alias("phase"), "seq")
    return identity.fold_creations(rows)


@query(
    "creation_discard",
    LOG
    + """
    , made AS (SELECT site, account_id, arg_min(username, seq) AS username, min(timestamp) AS t FROM log WHERE event_type = 'signup' GROUP BY 1, 2),
    seen AS (SELECT site, account_id, min(timestamp) AS first_seen FROM log GROUP BY 1, 2)
    SELECT m.site, m.account_id, username, CASE WHEN first_seen >= t THEN t END AS creation_timestamp,
           CASE WHEN first_seen < t THEN 'ignored_newusers_contributor_create_after_observed_activity_at_' || first_seen ELSE 'newusers_contributor_create' END AS creation_evidence
    FROM made m JOIN seen s ON s.site = m.site AND s.account_id = m.account_id
    """,
)
def creation_discard(spark, sf_dir):
    return identity.discard_late(_accounts(spark, sf_dir), identity.first_activity(_facts(spark, sf_dir)))


_PENDING = """
    , current AS (
        SELECT site, username, min(account_id) AS account_id FROM log GROUP BY 1, 2 HAVING min(account_id) = max(account_id)
    ), seen AS (SELECT site, account_id, min(timestamp) AS first_seen FROM log GROUP BY 1, 2)
"""


@query(
    "creation_pending",
    LOG
    + _PENDING
    + """
    SELECT l.site, c.account_id, l.username, l.timestamp, 'signup' AS evidence, l.logid, 1 AS phase, l.seq
    FROM log l JOIN current c ON c.site = l.site AND c.username = l.username
    JOIN seen s ON s.site = c.site AND s.account_id = c.account_id AND s.first_seen >= l.timestamp WHERE event_type = 'signup'
    """,
)
def creation_pending(spark, sf_dir):
    """Creations that give a name only: looked up, unless the account was active before."""
    rows = _log(spark, sf_dir).where("event_type = 'signup'").withColumn("route", F.lit("pending")).withColumn("evidence", F.lit("signup"))
    facts = _facts(spark, sf_dir)
    return identity.pending_creations(rows, identity.current_names(facts), identity.first_activity(facts))


@query(
    "creation_fallback",
    LOG
    + _PENDING
    + """
    , only_names AS (SELECT site, username, arg_min(struct_pack(t := timestamp, l := logid), struct_pack(t := timestamp, s := seq)) AS b FROM log WHERE event_type = 'view' GROUP BY 1, 2),
    dated AS (SELECT DISTINCT site, account_id FROM log WHERE event_type = 'signup')
    SELECT o.site, c.account_id, o.username, o.b.t AS creation_timestamp, 'view_current_username' AS creation_evidence
    FROM only_names o JOIN current c ON c.site = o.site AND c.username = o.username
    JOIN seen s ON s.site = c.site AND s.account_id = c.account_id AND s.first_seen >= o.b.t
    WHERE NOT EXISTS (SELECT 1 FROM dated d WHERE d.site = c.site AND d.account_id = c.account_id)
    UNION ALL SELECT site, account_id, arg_min(username, seq), min(timestamp), 'newusers_contributor_create' FROM log WHERE event_type = 'signup' GROUP BY 1, 2
    """,
)
def creation_fallback(spark, sf_dir):
    """Accounts without a dated creation take that of their current name."""
    rows = _log(spark, sf_dir).where("event_type = 'view'").withColumn("route", F.lit("username_only")).withColumn("evidence", F.lit("view"))
    facts = _facts(spark, sf_dir)
    found, _ = identity.fill_from_usernames(_accounts(spark, sf_dir), identity.username_only(rows), identity.current_names(facts), identity.first_activity(facts))
    return found.select("site", "account_id", "username", "creation_timestamp", "creation_evidence")


@query(
    "alias_dedupe",
    LOG
    + """SELECT site, username, account_id, timestamp, 'newusers_contributor_create' AS evidence, arg_min(logid, seq) AS logid
    FROM log WHERE event_type = 'signup' GROUP BY 1, 2, 3, 4""",
)
def alias_dedupe(spark, sf_dir):
    return _aliases(spark, sf_dir)


@query(
    "first_line_per_order",
    """SELECT l_orderkey, b.p AS l_partkey, b.s AS l_suppkey FROM (
        SELECT l_orderkey, min(struct_pack(n := l_linenumber, p := l_partkey, s := l_suppkey)) AS b FROM lineitem GROUP BY 1)""",
)
def first_line_per_order(spark, sf_dir):
    """First-wins deduplication as one aggregation, without a window."""
    return identity.first_by(_table(spark, sf_dir, "lineitem"), ["l_orderkey"], ["l_partkey", "l_suppkey"], ["l_linenumber", "l_partkey", "l_suppkey"])


@query(
    "intervals_closed",
    LOG
    + """SELECT site, username, account_id, min(timestamp) AS start, CAST(NULL AS VARCHAR) AS "end", 'newusers_contributor_create' AS start_evidence,
    arg_min(logid, struct_pack(t := timestamp, n := length(logid), l := logid)) AS start_logid, CAST(NULL AS VARCHAR) AS end_logid
    FROM log WHERE event_type = 'signup' GROUP BY 1, 2, 3""",
)
def intervals_closed(spark, sf_dir):
    return _held(spark, sf_dir)


@query("intervals_rename")
def intervals_rename(spark, sf_dir):
    """The full interval builder; purchases rename a name to the target's. A state machine, tested against a sequential model."""
    rows = _log(spark, sf_dir).where("event_type = 'purchase'")
    renames = rows.select("site", "seq", "logid", "timestamp", F.col("username").alias("old_username"), F.col("target_username").alias("new_username"), F.lit("parsed").alias("parse_status"))
    return intervals.build_intervals(_aliases(spark, sf_dir), _accounts(spark, sf_dir), renames)


@query("self_loops", RESOLVED + "SELECT * FROM all_resolved WHERE source_id = target_account")
def self_loops(spark, sf_dir):
    return resolve.self_loops(_all_resolved(spark, sf_dir))


@query("resolution_counts", RESOLVED + "SELECT site, target_resolution, count(*) AS n FROM resolved GROUP BY 1, 2")
def resolution_counts(spark, sf_dir):
    return _resolved(spark, sf_dir).groupBy("site", "target_resolution").agg(F.count("*").alias("n"))


@query("synthetic_ids", RESOLVED + "SELECT * FROM names")
def synthetic_ids(spark, sf_dir):
    return graph.synthetic_ids(_resolved(spark, sf_dir))


@query("published_edges", RESOLVED + "SELECT * FROM published")
def published_edges(spark, sf_dir):
    return _published(spark, sf_dir)


@query(
    "node_degrees",
    RESOLVED
    + f"""
    , ends AS (
        SELECT site, source AS id, 1 AS sent, 0 AS received, CASE WHEN target_account IS NULL THEN 0 ELSE 1 END AS a, CASE WHEN target_account IS NULL THEN 1 ELSE 0 END AS b, NULL AS class FROM published
        UNION ALL SELECT site, target, 0, 1, 0, 0, {CLASS} FROM published
    )
    SELECT site, id, CAST(sum(sent) AS BIGINT) AS sent, CAST(sum(received) AS BIGINT) AS received,
           CAST(sum(a) AS BIGINT) AS sent_to_resolved_target, CAST(sum(b) AS BIGINT) AS sent_to_unresolved_or_ambiguous_target,
           {", ".join(f"count(*) FILTER (class = '{c}') AS {c}" for c in graph.RECEIVED)}
    FROM ends GROUP BY 1, 2
    """,
)
def node_degrees(spark, sf_dir):
    """Out- and in-degrees and the pivot of received by class, in one aggregation."""
    return graph.degrees(_published(spark, sf_dir))


@query(
    "codebook",
    "SELECT o_orderstatus AS site, o_orderpriority AS label, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderpriority) AS code FROM (SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders)",
)
def codebook(spark, sf_dir):
    """Ranks of distinct labels per group."""
    rows = _table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("site"), F.col("o_orderpriority").alias("label"))
    return graph.ranked(rows, ["site"], "label", "code")


@query(
    "audit_union",
    RESOLVED
    + """
    , spans AS (
        SELECT site, username, string_agg(account_id || '|' || start || '||' || l || '||newusers_contributor_create', ';' ORDER BY account_id || '|' || start || '||' || l || '||newusers_contributor_create') AS interval_evidence
        FROM (SELECT site, username, account_id, min(timestamp) AS start, arg_min(logid, struct_pack(t := timestamp, n := length(logid), l := logid)) AS l FROM log WHERE event_type = 'signup' GROUP BY 1, 2, 3) GROUP BY 1, 2
    ), ends AS (
        SELECT site, source AS id, 1 AS sent, 0 AS received FROM published UNION ALL SELECT site, target, 0, 1 FROM published
    )
    SELECT 'node' AS record_type, site, id, CAST(sum(sent) AS VARCHAR) AS sent, CAST(sum(received) AS VARCHAR) AS received,
           NULL AS logid, NULL AS target, NULL AS current_name_account_id, NULL AS current_name_creation_timestamp, NULL AS resolved_account_creation_timestamp, NULL AS interval_evidence, NULL AS requires_historical_review
    FROM ends GROUP BY site, id
    UNION ALL
    SELECT 'event', p.site, NULL, NULL, NULL, p.logid, p.target, c.account_id, cm.creation_timestamp, rm.creation_timestamp, s.interval_evidence,
           CASE WHEN target_resolution = 'missing_historical_label_confirmation' THEN '1' ELSE '0' END
    FROM published p LEFT JOIN current c ON c.site = p.site AND c.username = p.target_username
    LEFT JOIN made cm ON cm.site = p.site AND cm.account_id = c.account_id
    LEFT JOIN made rm ON rm.site = p.site AND rm.account_id = p.target_account
    LEFT JOIN spans s ON s.site = p.site AND s.username = p.target_username
    """,
)
def audit_union(spark, sf_dir):
    """Nodes and audited events in one table of text."""
    # What several parts read is written once, as extract does.
    facts, accounts, resolved = _facts(spark, sf_dir), staged(_accounts(spark, sf_dir)), staged(_resolved(spark, sf_dir))
    synthetic = staged(graph.synthetic_ids(resolved))
    edges, current = staged(graph.published_edges(resolved, synthetic)), identity.current_names(facts)
    events = audit.audit_events(edges, current, accounts, intervals.interval_evidence(_held(spark, sf_dir)))
    blocks = identity.first_blocks(facts.where("event_type = 'error'").select("site", F.col("account_id").alias("contributor_id"), "timestamp", F.lit("valid").alias("status")))
    nodes = graph.nodes(edges, identity.account_names(facts), accounts, blocks, synthetic)
    kept = ["record_type", "site", "id", "sent", "received", "logid", "target", "current_name_account_id", "current_name_creation_timestamp", "resolved_account_creation_timestamp", "interval_evidence", "requires_historical_review"]
    return audit.audit(nodes, events).select(*kept)


@query(
    "order_violations",
    """SELECT o_orderkey, o_orderdate FROM (
        SELECT o_orderkey, o_orderdate, max(o_orderdate) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM orders) WHERE o_orderdate < m""",
)
def order_violations(spark, sf_dir):
    """A running maximum over the whole table, split into buckets along the order."""
    rows = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.lit(1).alias("one"))
    return quality.running_max_violations(rows, ["one"], [F.col("o_orderkey")], "o_orderdate", F.floor(F.col("o_orderkey") / 10_000)).select("o_orderkey", "o_orderdate")


@query("order_repair")
def order_repair(spark, sf_dir):
    """The longest non-decreasing subsequence of amounts in log order per user. Tested against brute force."""
    rows = _log(spark, sf_dir).withColumnRenamed("account_id", "user").select("site", "user", "logid", "amount")
    return identity.keep_in_order(rows, ["site", "user"], "logid", "amount")


@query(
    "conservation",
    RESOLVED
    + """SELECT (SELECT count(*) FROM edges) AS observed, (SELECT count(*) FROM resolved) AS retained,
    (SELECT count(*) FROM all_resolved WHERE source_id = target_account) AS self_loops, true AS ok""",
)
def conservation(spark, sf_dir):
    """Observed events are retained or self-loops; nothing else goes missing."""
    rows = _all_resolved(spark, sf_dir)
    loop = F.coalesce(F.col("source_id") == F.col("target_account"), F.lit(False))
    counts = rows.agg(F.count_if(~loop).alias("retained"), F.count_if(loop).alias("self_loops"))
    observed = _edges(spark, sf_dir).agg(F.count("*").alias("observed"))
    return observed.join(F.broadcast(counts), F.lit(True)).withColumn("ok", F.col("observed") == F.col("retained") + F.col("self_loops"))


@query(
    "before_creation",
    RESOLVED + "SELECT r.* FROM resolved r JOIN made m ON m.site = r.site AND m.account_id = r.source_id WHERE r.timestamp < m.creation_timestamp",
)
def before_creation(spark, sf_dir):
    return resolve.before_creation(_resolved(spark, sf_dir), _accounts(spark, sf_dir), "source_id").select("site", "logid", "timestamp", "source_id", "source_username", "target_username", "target_account", "target_resolution")


@query(
    "block_coverage",
    RESOLVED
    + """
    , accounts AS (SELECT DISTINCT site, id FROM (SELECT site, source AS id FROM published UNION ALL SELECT site, target FROM published) WHERE id NOT LIKE '-%'),
    blocked AS (SELECT site, account_id, min(timestamp) AS t FROM log WHERE event_type = 'error' GROUP BY 1, 2)
    SELECT a.site, count(*) AS account_nodes, count(b.t) AS with_first_block, count(*) FILTER (b.t < m.creation_timestamp) AS block_before_creation
    FROM accounts a LEFT JOIN blocked b ON b.site = a.site AND b.account_id = a.id LEFT JOIN made m ON m.site = a.site AND m.account_id = a.id GROUP BY 1
    """,
)
def block_coverage(spark, sf_dir):
    facts = _facts(spark, sf_dir)
    blocks = identity.first_blocks(facts.where("event_type = 'error'").select("site", F.col("account_id").alias("contributor_id"), "timestamp", F.lit("valid").alias("status")))
    rows = _resolved(spark, sf_dir)
    nodes = graph.nodes(_published(spark, sf_dir), identity.account_names(facts), _accounts(spark, sf_dir), blocks, graph.synthetic_ids(rows))
    return graph.block_coverage(nodes)


@query("site_totals", RESOLVED + "SELECT site, count(*) AS edges, min(timestamp) AS earliest, max(timestamp) AS latest FROM published GROUP BY ROLLUP (site)")
def site_totals(spark, sf_dir):
    return _published(spark, sf_dir).rollup("site").agg(F.count("*").alias("edges"), F.min("timestamp").alias("earliest"), F.max("timestamp").alias("latest"))


@query(
    "top_customers",
    """WITH t AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1), u AS (SELECT * FROM t ORDER BY n DESC, o_custkey LIMIT 20)
    SELECT o_custkey, n, (SELECT sum(n) FROM u) * 100.0 / (SELECT count(*) FROM orders) AS top_percent FROM u""",
)
def top_customers(spark, sf_dir):
    """A top-20 report and its share."""
    orders = _table(spark, sf_dir, "orders")
    top = orders.groupBy("o_custkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "o_custkey").limit(20)
    share = top.agg(F.sum("n").alias("s")).join(F.broadcast(orders.agg(F.count("*").alias("all"))), F.lit(True))
    share = share.select((F.col("s") * 100.0 / F.col("all")).alias("top_percent"))
    return top.join(F.broadcast(share), F.lit(True))


@query("coverage_anti", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def coverage_anti(spark, sf_dir):
    """Keys of one table that another lacks."""
    orders = _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return _table(spark, sf_dir, "customer").select("c_custkey").join(orders, "c_custkey", "left_anti")


@query(
    "dimension_upsert",
    """SELECT replace(n.n_name, '_', '-') AS dump_network_site_code, replace(n.n_name, '_', '-') AS actual_site_code, coalesce(r.r_name, n.n_name) AS language_label,
    CAST(s.n AS VARCHAR) AS contributions, CAST(s.n AS VARCHAR) AS pages, CAST(s.n AS VARCHAR) AS users, CAST(s.n AS VARCHAR) AS active_users, n.n_regionkey
    FROM nation n LEFT JOIN region r ON r.r_regionkey = n.n_regionkey LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) s ON s.c_nationkey = n.n_nationkey""",
)
def dimension_upsert(spark, sf_dir):
    """The site dimension's upsert, with nations as sites and customers as statistics."""
    nation, region = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    nation = nation.withColumn("n_name", F.translate("n_name", "_", "-"))
    base = nation.join(F.broadcast(region), F.col("r_regionkey") == F.col("n_regionkey"), "left").select(F.col("n_name").alias("site"), F.col("r_name").alias("label"), "n_regionkey")
    counted = _table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    stats = nation.join(counted, F.col("n_nationkey") == F.col("c_nationkey")).select(F.col("n_name").alias("dbname"), *(F.col("n").alias(c) for c in site_tables.STATS.values()))
    labels = nation.select(F.col("n_name").alias("site"), F.col("n_name").alias("actual_site_code"), F.col("n_name").alias("language_label"))
    return site_tables.upsert(base, stats, labels, nation.select(F.col("n_name").alias("site")))


@query("needle_counts", "SELECT page_id, CAST(len(regexp_extract_all(html, '<p>')) AS INTEGER) AS n FROM pages WHERE contains(html, '<p>')")
def needle_counts(spark, sf_dir):
    """A substring pre-filter and a recount of the needle."""
    pages = _table(spark, sf_dir, "pages").where(F.col("html").contains("<p>"))
    return pages.select("page_id", scalars.needle_count(F.col("html"), "<p>").cast("int").alias("n"))


@query(
    "markup_titles",
    "SELECT page_id, replace(replace(replace(replace(replace(regexp_extract(html, '(?s)<title(?:[\\s/>])?[^>]*>(.*?)</title\\s*>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&apos;', chr(39)), '&amp;', '&') AS title FROM pages",
)
def markup_titles(spark, sf_dir):
    """Text of the first element of a name, entities decoded."""
    return _table(spark, sf_dir, "pages").select("page_id", scalars.decode_entities(scalars.element_text(F.col("html"), "title")).alias("title"))


@query(
    "address_tokens",
    r"""SELECT doc_id, t AS token FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[0-9][0-9.]*[0-9]')) AS t FROM documents)
    WHERE regexp_full_match(t, '(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(\.(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}')""",
)
def address_tokens(spark, sf_dir):
    """Address literals among the number-like tokens of texts."""
    rows = _table(spark, sf_dir, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[0-9][0-9.]*[0-9]"), F.lit(0))).alias("token"))
    return rows.where(scalars.is_ip(F.col("token")))


@query(
    "valid_ids",
    r"""SELECT p_partkey, regexp_full_match(CAST(p_size - 10 AS VARCHAR), '[1-9][0-9]*') AS valid, split_part(p_name || ':' || p_brand, ':', 1) AS namespace, p_brand AS name FROM part""",
)
def valid_ids(spark, sf_dir):
    """Identifier and title functions."""
    title = F.concat("p_name", F.lit(":"), "p_brand")
    size = (F.col("p_size") - 10).cast("string")
    return _table(spark, sf_dir, "part").select("p_partkey", scalars.valid_id(size).alias("valid"), scalars.title_namespace(title).alias("namespace"), scalars.title_name(title).alias("name"))


@query(
    "classify_first_rule",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity < 5 THEN 'small' WHEN l_discount > 0.05 THEN 'discounted' WHEN l_tax = 0 THEN 'untaxed' ELSE 'valid' END AS status FROM lineitem""",
)
def classify_first_rule(spark, sf_dir):
    """Row classification: the first rule that holds gives the status."""
    rules = [("small", F.col("l_quantity") < 5), ("discounted", F.col("l_discount") > 0.05), ("untaxed", F.col("l_tax") == 0)]
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", classify.first_status(rules, "valid").alias("status"))


@query(
    "asof_orders",
    """WITH spans AS (SELECT o_custkey, o_orderkey, o_orderdate AS start, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS stop FROM orders)
    SELECT e.event_id, s.o_orderkey FROM events e JOIN spans s ON s.o_custkey = e.user_id AND s.start <= e.ts AND (s.stop IS NULL OR e.ts < s.stop)""",
)
def asof_orders(spark, sf_dir):
    """The general interval join: each event with the customer's order in force."""
    from pyspark.sql import Window as W

    orders = _table(spark, sf_dir, "orders")
    stop = F.lead("o_orderdate").over(W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    spans = orders.select(F.col("o_custkey").alias("user_id"), "o_orderkey", F.col("o_orderdate").alias("start"), stop.alias("stop"))
    events = _table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return resolve.as_of(events, spans, ["user_id"], "ts", "start", "stop").select("event_id", "o_orderkey")


@query(
    "candidates_union",
    LOG
    + """SELECT site, account_id AS account, 'account' AS kind, min(timestamp) AS timestamp FROM log WHERE event_type = 'signup' GROUP BY 1, 2
    UNION ALL SELECT DISTINCT site, account_id, 'alias', timestamp FROM log WHERE event_type = 'signup'""",
)
def candidates_union(spark, sf_dir):
    """Tagged union of evidence tables."""
    accounts = _accounts(spark, sf_dir).select("site", F.col("account_id").alias("account"), F.lit("account").alias("kind"), F.col("creation_timestamp").alias("timestamp"))
    aliases = _aliases(spark, sf_dir).select("site", F.col("account_id").alias("account"), F.lit("alias").alias("kind"), "timestamp")
    return accounts.unionByName(aliases)


@query("all_accounts", LOG + "SELECT site, account_id, arg_min(username, seq) AS username, min(timestamp) FILTER (event_type = 'signup') AS creation_timestamp FROM log GROUP BY 1, 2")
def all_accounts(spark, sf_dir):
    """Full outer join of accounts seen and accounts created."""
    return identity.all_accounts(identity.account_names(_facts(spark, sf_dir)), _accounts(spark, sf_dir)).drop("creation_evidence")


@query("late_rows", LOG + "SELECT logid, timestamp >= '2024-01-15T00:00:00Z' AS late FROM log")
def late_rows(spark, sf_dir):
    """The snapshot cutoff: rows on or after a dump's date."""
    block = F.concat(F.lit("<logitem><timestamp>"), "timestamp", F.lit("</timestamp></logitem>"))
    rows = _log(spark, sf_dir).select("logid", block.alias("block"), F.lit("20240115").alias("dump_date"))
    return dumps.before_cutoff(rows).select("logid", "late")


@query(
    "serialised_params",
    """SELECT p_partkey, CASE WHEN p_size > 10 THEN CAST(p_size - 10 AS VARCHAR) END AS userid, p_name || 'é' AS newuser FROM part""",
)
def serialised_params(spark, sf_dir):
    """Account ids and byte-counted names within serialised parameters."""
    name = F.concat("p_name", F.lit("é"))
    userid = F.concat(F.lit('a:1:{s:9:"4::userid";i:'), (F.col("p_size") - 10).cast("string"), F.lit(";}"))
    newuser = F.concat(F.lit('a:1:{s:10:"5::newuser";s:'), F.octet_length(name).cast("string"), F.lit(':"'), name, F.lit('";}'))
    return _table(spark, sf_dir, "part").select("p_partkey", scalars.serialised_userid(userid).alias("userid"), scalars.serialised_newuser(newuser).alias("newuser"))


@query(
    "timestamps_valid",
    """SELECT o_orderkey, o_orderkey % 3 > 0 AND year(o_orderdate) BETWEEN 1990 AND 2099 AS valid, strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') AS cutoff FROM orders""",
)
def timestamps_valid(spark, sf_dir):
    """Timestamps, a third of them on a 31st of February, and cutoffs of dates."""
    broken = F.when(F.col("o_orderkey") % 3 == 0, "2020-02-31T00:00:00Z").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    day = F.date_format("o_orderdate", "yyyyMMdd")
    return _table(spark, sf_dir, "orders").select("o_orderkey", scalars.valid_timestamp(broken, 1990).alias("valid"), scalars.cutoff(day).alias("cutoff"))


@query(
    "order_pivots",
    LOG
    + """SELECT site, account_id, logid, coalesce(amount >= max(amount) OVER b, true) AND coalesce(amount <= min(amount) OVER a, true) AS pivot FROM log
    WINDOW b AS (PARTITION BY site, account_id ORDER BY length(logid), logid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
           a AS (PARTITION BY site, account_id ORDER BY length(logid), logid ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)""",
)
def order_pivots(spark, sf_dir):
    """Rows that belong to every longest non-decreasing subsequence."""
    rows = _log(spark, sf_dir).select("site", "account_id", "logid", "amount")
    return identity.order_segments(rows, ["site", "account_id"], "logid", "amount").drop("amount", "segment")


@query(
    "key_set_equality",
    """SELECT c_nationkey AS k, 'missing' AS fault FROM (SELECT DISTINCT c_nationkey FROM customer) WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier)
    UNION ALL SELECT s_nationkey, 'unexpected' FROM (SELECT DISTINCT s_nationkey FROM supplier) WHERE s_nationkey NOT IN (SELECT c_nationkey FROM customer)
    UNION ALL SELECT s_nationkey, 'repeated' FROM supplier GROUP BY 1, 2 HAVING count(*) > 1""",
)
def key_set_equality(spark, sf_dir):
    """Keys that are missing from, unexpected in or repeated in a table."""
    found = _table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"))
    return summary.set_faults(found, _table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")), "k")


@query(
    "positional_zip",
    """SELECT coalesce(a.n, b.n) AS position, coalesce(a.o_orderkey, -1) AS o_orderkey, coalesce(b.c_custkey, -1) AS c_custkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders) a
    FULL JOIN (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS n FROM customer) b ON a.n = b.n""",
)
def positional_zip(spark, sf_dir):
    """Two tables side by side by position, the longer one to its end; positions by bucketed ranks."""
    one = F.lit("all").alias("one")
    order = lambda c: F.lpad(F.col(c).cast("string"), 12, "0")
    left = _table(spark, sf_dir, "orders").select(one, order("o_orderkey").alias("o"), "o_orderkey")
    right = _table(spark, sf_dir, "customer").select(one, order("c_custkey").alias("c"), "c_custkey")
    left = left.join(graph.ranked(left, ["one"], "o", "position", 9), ["one", "o"]).select("position", "o_orderkey")
    right = right.join(graph.ranked(right, ["one"], "c", "position", 9), ["one", "c"]).select("position", "c_custkey")
    return left.join(right, "position", "full_outer").fillna(-1).select("position", "o_orderkey", "c_custkey")


@query(
    "first_examples",
    LOG + "SELECT site, seq, logid FROM log WHERE event_type = 'error' QUALIFY row_number() OVER (PARTITION BY site ORDER BY seq) <= 30",
)
def first_examples(spark, sf_dir):
    """The first thirty defects of each site: a report."""
    return quality.examples(_log(spark, sf_dir).where("event_type = 'error'").select("site", "seq", "logid"))


@query("code_labels", "SELECT o_orderstatus AS code, string_agg(DISTINCT o_orderpriority, ';' ORDER BY o_orderpriority) AS labels FROM orders GROUP BY 1")
def code_labels(spark, sf_dir):
    """The set of labels of each code."""
    rows = _table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("code"))
    return rows.agg(F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ";").alias("labels"))


@query(
    "numeric_text_order",
    """SELECT s_name, row_number() OVER (ORDER BY length(ltrim(k, '0')), ltrim(k, '0'), k) AS place FROM (SELECT s_name, CAST(s_suppkey * 7919 % 1000 AS VARCHAR) || CAST(s_suppkey AS VARCHAR) AS k FROM supplier)""",
)
def numeric_text_order(spark, sf_dir):
    """Digit strings in numeric order whatever their width."""
    key = F.concat((F.col("s_suppkey") * 7919 % 1000).cast("string"), F.col("s_suppkey").cast("string"))
    order = scalars.numeric_text_order(key)
    bucket = F.struct(order[0].alias("kind"), order[1].alias("width"), F.substring(order[2], 1, 2).alias("start"))
    return graph.places(_table(spark, sf_dir, "supplier"), order, bucket).select("s_name", "place")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
