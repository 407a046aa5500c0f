"""Streams over growing files, site summaries and set checks."""

from tideweave.operators import summary
from tideweave.plans.extract import extract
from tideweave.streaming import follow

from .test_extract import GOOD, dump

SCHEMA = "site string, seq long, logid string, timestamp string, account_id string, username string, valid boolean"


def rows(times):
    return [("s", i, str(i + 1), t, str(i % 2), "n", True) for i, t in enumerate(times)]


def drain(spark, df, name, mode):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(60)
    return spark.table(name).collect()


def test_streams_follow_the_log(spark, tmp_path):
    path = str(tmp_path / "log")
    first = ["2024-01-01T00:10:00Z", "2024-01-01T00:20:00Z", "2024-01-01T01:10:00Z", "bad"]
    spark.createDataFrame(rows(first), SCHEMA).coalesce(1).write.parquet(path)
    spark.createDataFrame(rows(["2024-01-01T00:05:00Z", "2024-01-02T00:00:00Z"]), SCHEMA).coalesce(1).write.mode("append").parquet(path)
    stream = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    least = {r.account_id: r.first_seen for r in drain(spark, follow.activity_stream(stream()), "activity", "complete")}
    assert least == {"0": "2024-01-01T00:05:00Z", "1": "2024-01-01T00:20:00Z"}
    counts = {str(r.start): r.records for r in drain(spark, follow.volumes(stream()), "volumes", "append")}
    assert counts == {"2024-01-01 00:00:00": 3, "2024-01-01 01:00:00": 1}
    bursts = {(r.account_id, r.records) for r in drain(spark, follow.sessions(stream()), "bursts", "append")}
    assert bursts == {("0", 2), ("0", 1), ("1", 1)}


def test_summary_and_totals(spark, tmp_path):
    x = extract(spark, dump(tmp_path, GOOD))
    row = summary.site_summary(x).first()
    assert (row.thanks, row.thanks_valid, row.thanks_excluded, row.excluded_logtitle_deleted, row.n_self_loops) == (6, 5, 1, 1, 1)
    assert (row.resolved_to_account, row.unresolved, row.n_published, row.n_late_thanks) == (2, 2, 4, 1)
    assert (row.creations_create, row.creations_byemail, row.renames_parsed, row.blocks_valid) == (2, 1, 1, 1)
    assert summary.run_totals(summary.site_summary(x)).first().n_published == 4
    assert summary.subset_totals(x["published"], ["de"]).first().edges == 4


def test_set_and_header_checks(spark):
    found = spark.createDataFrame([("a",), ("a",), ("c",)], "k string")
    want = spark.createDataFrame([("a",), ("b",)], "k string")
    assert {(r.k, r.fault) for r in summary.set_faults(found, want, "k").collect()} == {("b", "missing"), ("c", "unexpected"), ("a", "repeated")}
    assert summary.header_faults(found, ["k"]) == [] and summary.header_faults(found, ["k", "x"]) == ["x"]
