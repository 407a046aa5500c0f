"""Manifests, SQL dumps, the site dimension, archives and checksums."""

import zipfile

import pytest

from tideweave.operators import audit
from tideweave.sources import archives, site_tables, staging

URL = "https://example.org/{0}wiki/20260601/{0}wiki-20260601-pages-logging.xml.gz"
CREATE = "CREATE TABLE `site_stats` (\n  `ss_row_id` int NOT NULL,\n  `ss_total_edits` bigint,\n  `ss_total_pages` bigint,\n  `ss_users` bigint,\n  `ss_active_users` bigint,\n  PRIMARY KEY (`ss_row_id`)\n) ENGINE=InnoDB;\n"


def test_manifest(spark, tmp_path):
    (tmp_path / "urls.txt").write_text(f"# list\r\n{URL.format('de')}\r\n\n{URL.format('pt_br')} # x\n{URL.format('de')}\n")
    found = site_tables.manifest(spark, str(tmp_path / "urls.txt"))
    assert sorted((r.dbname, r.site, r.dump_date) for r in found.collect()) == [("dewiki", "de", "20260601"), ("pt_brwiki", "pt-br", "20260601")]
    assert {r.fault: r.n for r in site_tables.manifest_faults(found).collect()} == {"not_a_dump_url": 0, "site_repeated": 0, "more_than_one_snapshot": 0}


@pytest.mark.parametrize(
    ("rows", "want", "error"),
    [
        ("(1,10,20,30,4)", (10, 20, 30, 4), None),
        ("(1,10,20,30,4),(2,1,NULL,3,4)", (11, 20, 33, 8), None),
        ("(1,10,NULL,30,4)", (10, None, 30, 4), "no value in any shard"),
        ("(1,1,1,1,1),(1,2,2,2,2)", (3, 3, 3, 3), "row id repeated"),
        ("(1,1,1,1)", (None, None, None, None), "field count differs from the table's"),
        ("(1,'a,(b''c',1,1,1)", (None, 1, 1, 1), "not an integer"),
        ("(1,10,10,10,10),junk,2,5", (None, None, None, None), "not a list of tuples"),
        ("(NULL,10,10,10,10)", (10, 10, 10, 10), "no row id"),
    ],
)
def test_site_stats(spark, tmp_path, rows, want, error):
    path = tmp_path / "dewiki-20260601-site_stats.sql"
    path.write_text(f"{CREATE}insert into `site_stats` values {rows};\n")
    row = site_tables.site_stats(site_tables.sql_tuples(spark, str(path))).first()
    assert (row.contributions, row.pages, row.users, row.active_users, row.error) == (*want, error) and row.dbname == "dewiki"


def test_upsert(spark):
    base = spark.createDataFrame([("de", "German", "5", "x"), ("fr", None, "7", "y")], "site string, label string, users string, note string")
    stats = spark.createDataFrame([("dewiki", 1, 2, 3, 4), ("itwiki", 9, 9, 9, 9)], "dbname string, contributions long, pages long, users long, active_users long")
    labels = spark.createDataFrame([("it", "it", "Italian"), ("fr", "fr", "French")], "site string, actual_site_code string, language_label string")
    wanted = spark.createDataFrame([("de",), ("it",)], "site string")
    found = site_tables.upsert(base, stats, labels, wanted)
    rows = {r.dump_network_site_code: (r.language_label, r.users, r.note) for r in found.collect()}
    assert rows == {"de": ("German", "3", "x"), "fr": ("French", "7", "y"), "it": ("Italian", "9", None)}
    assert [(r.site, r.fault) for r in site_tables.dimension_faults(found, wanted).collect()] == [("fr", "incomplete")]


def test_statistics_with_errors_do_not_reach_the_dimension(spark):
    base = spark.createDataFrame([("de", "German", "5")], "site string, label string, users string")
    stats = spark.createDataFrame([("dewiki", 1, 2, 3, 4, "no row id")], "dbname string, contributions long, pages long, users long, active_users long, error string")
    labels = spark.createDataFrame([], "site string, actual_site_code string, language_label string")
    wanted = spark.createDataFrame([("de",)], "site string")
    found = site_tables.upsert(base, stats, labels, wanted)
    assert [r.users for r in found.collect()] == ["5"]
    assert [(r.site, r.fault) for r in site_tables.dimension_faults(found, wanted).collect()] == [("de", "incomplete")]


def test_dimension_is_written_whole_or_not_at_all(spark, tmp_path):
    path = str(tmp_path / "sites")
    wanted = spark.createDataFrame([("de",)], "site string")
    columns = "dump_network_site_code string, actual_site_code string, language_label string, contributions string, pages string, users string, active_users string"
    good = spark.createDataFrame([("de", "de", "German", "1", "2", "3", "4")], columns)
    read = lambda: [tuple(r) for r in spark.read.option("header", "true").csv(path).collect()]
    site_tables.write_dimension(good, wanted, path)
    assert read() == [("de", "de", "German", "1", "2", "3", "4")]
    for bad, fault in ((good.selectExpr("* EXCEPT (users)", "'x' AS users"), "de incomplete"), (good.where("1 = 0"), "de missing")):
        with pytest.raises(ValueError, match=fault):
            site_tables.write_dimension(bad, wanted, path)
        assert read() == [("de", "de", "German", "1", "2", "3", "4")]
    newer = good.selectExpr("* EXCEPT (active_users)", "'5' AS active_users")
    site_tables.write_dimension(newer, wanted, path)
    assert read() == [("de", "de", "German", "1", "2", "3", "5")]
    assert [p.name for p in tmp_path.iterdir()] == ["sites"]


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "old").write_text("x")

    def half(new):
        spark.range(1).write.parquet(new)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        staging.replace(spark, str(tmp_path / "t"), half)
    assert [p.name for p in tmp_path.iterdir()] == ["t"] and (tmp_path / "t" / "old").read_text() == "x"


def test_package_and_read_back(spark, tmp_path):
    (tmp_path / "e.csv").write_text("site,logid\nde,1\n")
    header = ",".join(audit.AUDIT)
    empty = "," * (len(audit.AUDIT) - 3)
    (tmp_path / "x.audit.csv").write_text(f'{header}\nnode,de,"a,b"{empty[:-1]},\nevent,de{empty},\nnode,de{empty},\nodd,de{empty},\n')
    files = {"de/e.csv": tmp_path / "e.csv", "de/x.audit.csv": tmp_path / "x.audit.csv"}
    archives.package(files, tmp_path / "r.zip")
    with pytest.raises(FileExistsError):
        archives.package(files, tmp_path / "r.zip")
    assert archives.member_faults(tmp_path / "r.zip", {"de/e.csv", "de/x.audit.csv.xz"}) == []
    assert archives.member_faults(tmp_path / "r.zip", {"de/e.csv"}) == ["de/x.audit.csv.xz"]
    with zipfile.ZipFile(tmp_path / "r.zip") as z:
        assert z.getinfo("de/x.audit.csv.xz").compress_type == zipfile.ZIP_STORED
    rows = archives.member_rows(spark, tmp_path / "r.zip", ["de/x.audit.csv.xz"])
    assert rows.where("record_type = 'node'").first().id == "a,b"
    assert {r.fault: r.n for r in audit.structure_faults(rows).collect()} == {"unknown_record_type": 1, "node_after_event": 1}
    assert audit.records(rows, "event").count() == 1


def test_checksums(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"abc")
    found = archives.checksums(spark, str(tmp_path / "a"))
    expected = spark.createDataFrame([("a", "900150983cd24fb0d6963f7d28e17f72"), ("b", "x")], "file string, md5 string")
    assert [r.file for r in archives.checksum_faults(found, expected).collect()] == ["b"]
