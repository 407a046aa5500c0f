"""A hand-written dump from text to published tables."""

import gzip
import json

import pytest

from tideweave.operators import audit, quality
from tideweave.plans.extract import InvalidExtraction, extract, publish
from tideweave.sources import dumps, sinks

HEAD = """<mediawiki><siteinfo><sitename>x</sitename><namespaces><namespace key="0"></namespace>
<namespace key="2" case="first-letter">Benutzer</namespace><namespace key="4">Projekt</namespace></namespaces></siteinfo>
"""


def item(logid, time, kind, action, title=None, who=("10", "Ann"), params="", more="", **deleted):
    mark = lambda name: ' deleted="deleted"' if deleted.get(name) else ""
    body = f"<logitem><id>{logid}</id>" if logid is not None else "<logitem>"
    body += f"<timestamp{mark('timestamp')}>{time}</timestamp>" if not deleted.get("timestamp") else '<timestamp deleted="deleted" />'
    if deleted.get("contributor"):
        body += '<contributor deleted="deleted" />'
    elif who:
        body += f"<contributor><username>{who[1]}</username><id>{who[0]}</id></contributor>"
    body += f"<type>{kind}</type><action{mark('action')}>{action}</action>"
    if deleted.get("logtitle"):
        body += '<logtitle deleted="deleted" />'
    elif title is not None:
        body += f"<logtitle>{title}</logtitle>"
    if params is not None:
        body += f'<params xml:space="preserve">{params}</params>' if params else ""
    return body + more + "</logitem>\n"


def php(kind, value):
    return f'a:1:{{s:9:"4::userid";i:{value};}}' if kind == "id" else f'a:1:{{s:10:"5::newuser";s:{len(value.encode())}:"{value}";}}'


T = "2015-0{}-01T00:00:00Z".format
GOOD = (
    item("1", "2010-01-01T00:00:00Z", "newusers", "create", "Benutzer:Ann")
    + item("2", "2011-01-01T00:00:00Z", "newusers", "create", "Spezial:X", ("20", "Bea"), php("id", "20"))
    + item("3", "2011-06-01T00:00:00Z", "newusers", "byemail", "Benutzer:Cid", ("10", "Ann"), php("id", "25"))
    + item("4", "2012-01-01T00:00:00Z", "renameuser", "renameuser", "Benutzer:Cid", ("10", "Ann"), php("name", "Zoé"))
    + item("5", "2013-01-01T00:00:00Z", "block", "block", "Benutzer:Troll", ("10", "Ann"))
    + item("6", T(1), "thanks", "thank", "Benutzer:Bea")
    + item("7", T(2), "thanks", "thank", "Benutzer:Nobody &amp; Co")
    + item("8", T(3), "thanks", "thank", "Benutzer:Zoé")
    + item("9", T(4), "thanks", "thank", "Benutzer:Ann")
    + item("10", T(5), "thanks", "thank", None, logtitle=True)
    + item("11", T(6), "thanks", "thank", "Benutzer:1.2.3.4", ("20", "Bea"), "a:0:{}")
    + item("12", T(7), "delete", "delete", "Projekt:P", ("25", "Zoé"))
    + item("13", "2026-06-01T00:00:00Z", "thanks", "thank", "Benutzer:Bea")
    + "<logitem><id>14</id><type>newusers</type><broken></logitem>\n"
)


def dump(folder, body, head=HEAD, tail="</mediawiki>\n", name="dewiki-20260601-pages-logging.xml.gz"):
    path = folder / name
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write(head + body + tail)
    return str(path)


@pytest.fixture(scope="module")
def good(spark, tmp_path_factory):
    return extract(spark, dump(tmp_path_factory.mktemp("dump"), GOOD))


def test_edges_and_resolution(good):
    rows = {r.logid: (r.source, r.target, r.target_resolution) for r in good["published"].collect()}
    assert rows == {
        "6": ("10", "20", "interval_and_current_username_same"),
        "7": ("10", "-2", "missing_no_identity_evidence"),
        "8": ("10", "25", "interval_and_current_username_same"),
        "11": ("20", "-1", "missing_no_identity_evidence"),
    }
    assert [r.logid for r in good["self_loops"].collect()] == ["9"]
    assert [(r.logid, r.deleted_fields) for r in good["exclusions"].collect()] == [("10", "logtitle")]


def test_nodes_and_audit(good):
    nodes = {r.id: r for r in good["nodes"].collect()}
    assert {k: (n.label, n.sent, n.received, n.node_type) for k, n in nodes.items()} == {
        "10": ("Ann", 3, 0, "account"),
        "20": ("Bea", 1, 1, "account"),
        "25": ("Zoé", 0, 1, "account"),
        "-1": ("1.2.3.4", 0, 1, "synthetic_target_label"),
        "-2": ("Nobody & Co", 0, 1, "synthetic_target_label"),
    }
    assert nodes["10"].first_block_by_user_timestamp == "2013-01-01T00:00:00Z"
    assert nodes["25"].creation_timestamp == "2011-06-01T00:00:00Z"
    table = good["audit"].collect()
    assert len(table) == 9 and [r.record_type for r in audit.in_audit_order(good["audit"]).collect()] == ["node"] * 5 + ["event"] * 4
    events = {r.logid: r for r in good["audit_events"].collect()}
    assert events["11"].target_label_subtype == "ip_address"
    assert events["8"].interval_evidence == "25|2012-01-01T00:00:00Z||4||renameuser_interval"


def test_intervals_of_renamed_account(good):
    rows = {(r.username, r.account_id): (r.start, r.end) for r in good["intervals"].collect()}
    assert rows[("Cid", "25")] == ("2011-06-01T00:00:00Z", "2012-01-01T00:00:00Z")
    assert rows[("Zoé", "25")] == ("2012-01-01T00:00:00Z", None)


def test_invariants_hold_and_release_agrees_with_itself(good, spark):
    assert quality.failed(quality.extraction_invariants(good)).collect() == []
    text = lambda df: df.select(*(df[c].cast("string").alias(c) for c in df.columns))
    faults = quality.release_faults(text(good["nodes"]), text(good["published"]), audit.audit_nodes(good["nodes"]), good["audit_events"], good["sites"])
    assert {r.rule: r.n for r in faults.collect() if r.n} == {}
    changed = text(good["published"]).selectExpr("* EXCEPT (target)", "source AS target")
    faults = quality.release_faults(text(good["nodes"]), changed, audit.audit_nodes(good["nodes"]), good["audit_events"], good["sites"])
    assert {"edge_ids", "edge_not_audited"} <= {r.rule for r in faults.collect() if r.n}


def test_publish_writes_all_or_nothing(good, spark, tmp_path):
    publish(good, str(tmp_path / "out"), verbose=True)
    edges = spark.read.csv(str(tmp_path / "out/edges/dump_date=20260601/folder=de"), header=True)
    assert [r.logid for r in edges.collect()] == ["6", "7", "8", "11"]
    assert (tmp_path / "out/verbose/username_intervals").exists()
    with pytest.raises(Exception, match="(?i)exists"):
        publish(good, str(tmp_path / "out"))
    report = quality.release_report(good["published"], good["audit_events"], good["nodes"])
    sinks.write_report(report, str(tmp_path / "report.json"))
    told = json.loads((tmp_path / "report.json").read_text())
    assert told["top_percent"] == [{"top_percent": 100.0}] and {"edges": 4, "earliest": T(1), "latest": T(6)} in told["totals"]
    bad = extract(spark, dump(tmp_path, GOOD + item("6", T(8), "thanks", "thank", "Benutzer:Bea") + item("30", T(8), "thanks", "nothing", "Benutzer:Bea")))
    with pytest.raises(InvalidExtraction) as failure:
        publish(bad, str(tmp_path / "bad"))
    names = {r.name for r in failure.value.failures}
    assert {"thanks_logid_duplicate", "thanks_action_not_thank", "conservation"} <= names and not (tmp_path / "bad").exists()


STATUSES = {
    "action_not_thank": item("1", T(1), "thanks", "x", "Benutzer:A"),
    "logid_missing": item(None, T(1), "thanks", "thank", "Benutzer:A"),
    "logid_invalid": item("01", T(1), "thanks", "thank", "Benutzer:A"),
    "params_invalid": item("2", T(1), "thanks", "thank", "Benutzer:A", params="x"),
    "timestamp_missing": item("3", "", "thanks", "thank", "Benutzer:A"),
    "timestamp_invalid": item("4", "2015-02-30T00:00:00Z", "thanks", "thank", "Benutzer:A"),
    "contributor_missing": item("5", T(1), "thanks", "thank", "Benutzer:A", who=None),
    "source_username_missing": item("6", T(1), "thanks", "thank", "Benutzer:A", who=("1", "")),
    "source_id_missing": item("7", T(1), "thanks", "thank", "Benutzer:A", who=("", "N")),
    "source_id_invalid": item("8", T(1), "thanks", "thank", "Benutzer:A", who=("0", "N")),
    "logtitle_missing": item("9", T(1), "thanks", "thank"),
    "title_bad_prefix": item("10", T(1), "thanks", "thank", "A"),
    "namespace_unknown": item("11", T(1), "thanks", "thank", "Projekt:A"),
    "target_missing": item("13", T(1), "thanks", "thank", "Benutzer:"),
    "parse_failure": "<logitem><id>20</id><type>thanks</type><oops></logitem>",
}


def test_every_status_of_thanks(spark, tmp_path):
    body = item("12", T(1), "thanks", "thank", "Benutzer:A") + "".join(STATUSES.values()) + item("14", T(1), "thanks", "thank", "User:A")
    rows = extract(spark, dump(tmp_path, body))["thanks"].orderBy("seq").collect()
    assert [r.status for r in rows] == ["valid", *STATUSES, "namespace_inconsistent"]


def test_truncated_and_headless_files(spark, tmp_path):
    raw = dumps.raw_rows(spark, dump(tmp_path, GOOD, tail="<logitem><id>99</id>"))
    assert dumps.truncated(raw).count() == 1 and dumps.framed(raw).count() == 14
    (tmp_path / "b").mkdir()
    headless = dumps.raw_rows(spark, dump(tmp_path / "b", GOOD, head="<mediawiki>"))
    assert dumps.namespaces(headless).count() == 0
    assert dumps.misnamed(dumps.raw_rows(spark, dump(tmp_path / "b", GOOD, name="other.xml.gz"))).count() > 0


@pytest.mark.parametrize("zipped", [True, False])
@pytest.mark.parametrize(("tail", "whole", "cut"), [("</logitem>", 2, 0), ("</logitem>\n", 2, 0), ("</logitem>\n</mediawiki>\n", 2, 0), ("</logitem", 1, 1), ("</logi", 1, 1), ("", 1, 1), ("</logitem >", 2, 0)])
def test_files_without_a_tail(spark, tmp_path, zipped, tail, whole, cut):
    """A record is whole if its end tag is, whatever follows."""
    body = item("1", T(1), "thanks", "thank", "Benutzer:Bea") + item("2", T(2), "thanks", "thank", "Benutzer:Bea")
    text = (HEAD + body).rstrip().removesuffix("</logitem>") + tail
    path = tmp_path / ("dewiki-20260601-pages-logging.xml" + (".gz" if zipped else ""))
    with (gzip.open if zipped else open)(path, "wt", encoding="utf-8") as f:
        f.write(text)
    raw = dumps.raw_rows(spark, str(path))
    assert [r.logid for r in dumps.parsed(dumps.framed(raw)).where("NOT malformed").orderBy("seq").collect()] == ["1", "2"][:whole]
    assert dumps.truncated(raw).count() == cut and dumps.needle_counts(raw).first().thanks_needles == 2
