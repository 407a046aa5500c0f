"""Scalar functions against their rules."""

from pyspark.sql import functions as F

from tideweave.functions import scalars as s


def values(spark, texts, make):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in rows.select("i", make(F.col("t")).alias("v")).orderBy("i").collect()]


def test_ids_and_timestamps(spark):
    assert values(spark, ["1", "0", "01", "12345678901234567890123", "", "x", None, "1\n"], s.valid_id) == [True, False, False, True, False, False, False, False]
    times = ["2024-02-29T23:59:59Z", "2023-02-29T00:00:00Z", "1999-01-01T00:00:00Z", "2005-01-01T00:00:00Z", "2024-01-01T24:00:00Z", "2024-01-01", None]
    assert values(spark, times, s.valid_timestamp) == [True, False, False, True, False, False, False]
    assert values(spark, times, s.event_timestamp) == [True, False, False, False, False, False, False]
    assert values(spark, ["20260601"], s.cutoff) == ["2026-06-01T00:00:00Z"]


def test_titles(spark):
    assert values(spark, ["User:A:B", "NoColon", ":x", "User:", "N" * 61 + ":x"], s.title_namespace) == ["User", None, None, "User", None]
    assert values(spark, ["User:A:B", "User:"], s.title_name) == ["A:B", None]


def test_serialised_parameters(spark):
    texts = [" 12 ", "012", "a:0:{}", 'a:1:{s:9:"4::userid";i:123;}', 'a:1:{s:9:"4::userid";i:0;}', 'x::userid";i:5 ::userid";i:7;', ""]
    assert values(spark, texts, s.serialised_userid) == ["12", None, None, "123", None, None, None]
    names = ['a:1:{s:10:"5::newuser";s:6:"Zoé X";}', 'a:1:{s:10:"5::newuser";s:5:"Zoé X";}', "Plain", "a:0:{}", 'a:1:{s:10:"5::newuser";s:4:"a"bc";}', ""]
    assert values(spark, names, s.serialised_newuser) == ["Zoé X", None, "Plain", None, 'a"bc', None]


def test_markup(spark):
    assert values(spark, ["a &lt;b&gt; &amp;lt; &#65;&#x42; &nope; &#0;", "&amp;lt;", "plain", None], s.decode_entities) == ["a <b> &lt; AB &nope; &#0;", "&lt;", "plain", None]
    blocks = ["<id>5</id><id>6</id>", '<id deleted="deleted" /><id>6</id>', "<identity>7</identity>", "<id/>", "<id></id>"]
    assert values(spark, blocks, lambda c: s.element_text(c, "id")) == ["5", None, None, None, ""]


def test_addresses(spark):
    texts = ["1.2.3.4", "256.1.1.1", "01.2.3.4", "::1", "2001:db8::1", "fe80::1%eth0", "user", "a:b:c", None]
    assert values(spark, texts, s.is_ip) == [True, False, False, True, True, False, False, False, False]


def test_labels(spark):
    labels = ["invalidated_x_y_account_id_timestamp_order", "x", None]
    assert values(spark, labels, s.stripped_evidence) == ["x_y", "x", None]
    assert values(spark, ["pt_brwiki"], s.site_of_dbname) == ["pt-br"]
    assert values(spark, ["<a><a>"], lambda c: s.needle_count(c, "<a>")) == [2]


def test_numeric_text_order(spark):
    rows = spark.createDataFrame([(t,) for t in ("10", "9", "010", "x", "2", "")], "t string")
    assert [r.t for r in rows.orderBy(*s.numeric_text_order(F.col("t"))).collect()] == ["2", "9", "010", "10", "", "x"]
