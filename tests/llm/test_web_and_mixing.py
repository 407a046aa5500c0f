"""WARC archives (8), mixing (9), the pipeline, and the queries' shape."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tideweave.llm import mixing, queries, warc

from .conftest import sentence


def pages_brute(pages):
    least = {}
    for key, html in pages:
        data = (html or "").encode()
        if len(data) >= warc.MIN_REVISIT and key is not None:
            least[data] = min(key, least.get(data, key))
    out = []
    for key, html in pages:
        data = (html or "").encode()
        to = least.get(data) if len(data) >= warc.MIN_REVISIT else None
        to = None if to == key else to
        out.append(str((key, len(data), hashlib.sha256(data).hexdigest(), "response" if to is None else "revisit", to, None)))
    return sorted(out)


@pytest.mark.parametrize("segment", [90, 1000, warc.SEGMENT])
def test_archives_round_trip(spark, rng, segment):
    html = [sentence(rng, rng.randint(0, 300)) for _ in range(30)] + [None, "", "x" * 99, "x" * 100, "WARC/1.1\r\n\r\n" * 40, "é" * 60, "\x00\r\n0\r\n\r\n" * 30]
    pages = [(i, rng.choice(html)) for i in range(120)] + [(None, "x" * 100), (5, "y" * 200), (5, "y" * 200), (9, "y" * 200)]
    df = spark.createDataFrame([(k, rng.choice(["http://a/b", None, "http://x y\r\nEvil: 1"]), h, "z") for k, h in pages], "page_id long, url string, html string, digest string")
    found = [str(tuple(r)) for r in warc.archive_round_trip(df.repartition(4), segment).collect()]
    assert sorted(found) == pages_brute(pages)


def test_archives_of_no_pages(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_round_trip(df).count() == 0


def test_chunked_framing(rng):
    for data in (b"", b"a", bytes(rng.randrange(256) for _ in range(5000))):
        assert warc.unchunked(warc.chunked(data, 7)) == data
    for broken in (b"", b"5\r\nabc", b"3\r\nabcX\r\n0\r\n\r\n", b"zz\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(broken)


def test_broken_archives_are_reported(spark, tmp_path):
    payload, digest = b"p" * 500, hashlib.sha256(b"p" * 500).hexdigest()
    make = lambda n: list(warc.records(n, "u", payload, digest, None, 200))
    whole, lost, twice, short = make(1), make(2), make(3), make(4)
    short[-1] = short[-1].replace(b"Total-Length: ", b"Total-Length: 9")
    wrong = list(warc.records(5, "u", payload, "0" * 64, None, 10_000))
    parts = [*reversed(whole), *lost[:1], *lost[2:], *twice, twice[1], *short, *wrong]
    (tmp_path / "a.warc").write_bytes(b"".join(p + b"\r\n\r\n" for p in parts))
    found = {r.page_id: r.error for r in warc.read_archives(spark, str(tmp_path)).collect()}
    assert found == {1: None, 2: "segments missing or repeated", 3: "segments missing or repeated", 4: "total length differs", 5: "payload differs from its digest"}


def targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    out, free = {}, list(names)
    while free:
        left, total = 1.5 * sum(sizes.values()) - sum(out.values()), sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > 2 * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        out |= {s: 2.0 * sizes[s] for s in over}
        free = [s for s in free if s not in out]
    return out


def test_targets_stop_at_twice_the_size(spark, rng):
    many = {f"host{rng.randint(0, 1 << 20)}": rng.randint(0, 10) ** 4 for _ in range(300)}
    for sizes in ({"b": 10, "a": 1000, None: 400, "c": 30}, {}, {"a": 0}, {"a": 0, None: 7}, {"é": 5, "z": 9, "Z": 1}, many):
        rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        found = mixing.with_targets(rows).collect()
        want = targets(sizes)
        assert {r.source: round(r.target, 6) for r in found} == {s: round(t, 6) for s, t in want.items()}
        assert [r.source for r in sorted(found, key=lambda r: r.source_no)] == sorted(sizes, key=lambda s: (s is None, s or ""))


def test_permutations():
    for n in (1, 2, 3, 17, 1000, 4097):
        assert sorted(mixing.shuffled(np.arange(n), n, 5)) == list(range(n))
    assert list(mixing.shuffled(np.arange(50), 50, 5)) != list(mixing.shuffled(np.arange(50), 50, 6))


def test_mix_equals_a_plain_one(spark, rng, monkeypatch):
    """Slots one by one in Python, over streams laid out in the order that the operator gives them."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 10_000)
    docs = [(i, sentence(rng, rng.randint(0, 40)), rng.choice(["x", "x", "x", "y", None])) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3)
    block, got = 16, {r.doc_id: r for r in mixing.mix(df, block=16, shard_slots=8).collect()}
    sizes = {}
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    want = targets(sizes)
    for number, source in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")), 1):
        words = [i for i, text, s in docs if s == source for _ in text.split()]
        blocks = [words[at : at + block] for at in range(0, len(words), block)]
        taken = dict.fromkeys((i for i, _, s in docs if s == source), 0)
        owed = min(2 * len(blocks), int(want[source] * len(blocks) / len(words) + 0.5))
        for slot in range(owed):
            turn, place = divmod(slot, len(blocks))
            key = hash((20, number, turn))
            for i in blocks[int(mixing.shuffled(np.array([place]), len(blocks), key)[0])]:
                taken[i] += 1
        assert {i: got[i].taken for i in taken} == taken
        assert all(got[i].target == pytest.approx(want[source]) for i in taken)


def test_buckets_and_runs_place_documents_without_gaps(spark, rng, monkeypatch):
    """With everything taken once, every word of a source is in exactly one block, however buckets split it."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    monkeypatch.setattr(mixing, "RUN", 4)
    sizes = {i: rng.randint(0, 40) for i in range(300)}
    df = spark.createDataFrame([(i, "w " * n, "s" if i % 3 else None) for i, n in sizes.items()], "doc_id long, text string, source string")
    got = mixing.mix(df, weights=(1,), share=2.0, block=16, shard_slots=8).collect()
    # Both sources stop at twice their size: each block is taken twice, so each document is.
    assert {r.doc_id: r.taken for r in got} == {i: 2 * n for i, n in sizes.items()}


def test_shards_are_samples_of_the_mix(spark):
    sources = spark.createDataFrame([(1, 5000, 9000), (2, 300, 300)], "source_no long, blocks long, owed long")
    slots = mixing._slots(sources, 500, 3).toPandas()
    assert slots.groupby("source_no").size().to_dict() == {1: 9000, 2: 300}
    by_shard = slots.groupby("shard").size()
    assert len(by_shard) == 19 and by_shard.min() > 350 and by_shard.max() < 650
    times = slots[slots.source_no == 1].groupby("block").size()
    assert len(times) == 5000 and times.min() == 1 and times.max() == 2


def test_mix_meets_targets(spark, rng, odd, empty):
    docs = [(i, sentence(rng, rng.randint(0, 400)), "big" if i % 3 == 0 else rng.choice(["x", "y", None])) for i in range(600)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3)
    rows = mixing.mix(df, shard_slots=64, block=32).collect()
    assert len(rows) == 600 and all(0 <= r.taken <= 2 * r.size for r in rows)
    by = {i: s for i, _, s in docs}
    for source in ("big", "x", "y", None):
        mine = [r for r in rows if by[r.doc_id] == source]
        assert sum(r.size for r in mine) == mine[0].source_size
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 64
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix(df, shard_slots=64, block=32).collect()))
    odd_rows = mixing.mix(odd).collect()
    assert len(odd_rows) == odd.count() and all(r.taken <= 2 * r.size for r in odd_rows)
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0
    mixed = mixing.mixed_documents(df, block=32)
    assert mixed.columns == df.columns
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    taken = {r.doc_id: (r.taken, r.size) for r in rows}
    assert max(counts.values()) <= 2 and all(taken[k][1] for k in counts)


def test_pipeline_stages_keep_the_columns_and_clean_documents(spark, rng, tmp_path):
    clean = [(i, sentence(rng, 120), "en", f"s{i % 3}", 0) for i in range(90)]
    copies = [(100 + i, clean[i][1].upper() if i % 2 else clean[i][1], "en", "s0", 0) for i in range(10)]
    near = [(200 + i, clean[20 + i][1].replace(" ", " x ", 1), "en", "s1", 0) for i in range(10)]
    junk = [(300 + i, " ".join(w + "###" for w in sentence(rng, 90).split()), "en", "s2", 0) for i in range(30)] + [(400, None, None, None, None), (401, "", "en", "s0", 0)]
    rows = clean + copies + near + junk
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, int(i < 300), 0) for i, *_ in rows if i % 3 != 1]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs, left = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        left[name] = [r.doc_id for r in docs.collect()]
    assert set(left["quality rules"]) == {i for i, *_ in rows if i < 300}
    # Of equal texts the largest id stays, of near copies the least; upper-case copies equal their originals.
    assert set(left["exact dedup"]) == set(left["quality rules"]) - set(range(10))
    assert set(left["near dedup"]) == set(left["exact dedup"]) - set(range(200, 210))
    assert set(left["mixing"]) <= set(left["near dedup"])
    words = {i: len(t.split()) for i, t, *_ in rows if t}
    total = sum(words[i] for i in left["near dedup"])
    assert abs(sum(words[i] for i in left["mixing"]) / total - 1.5) < 0.2
    packed = corpus_pipeline.run(spark, str(tmp_path))
    fill = packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert max(r.n for r in fill) <= 4096 and sorted(r.doc_id for r in packed.where("piece = 0").collect()) == sorted(left["mixing"])


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.queries())
    assert numbers == list(range(1, 11)) and set(queries.oracle_sql()) <= set(queries.queries())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "exact dedup", "near dedup", "mixing", "packing"]
