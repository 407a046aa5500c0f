"""Exact dedup (3) and near-duplicate classes (1) against brute force."""

import hashlib

from pyspark.sql import functions as F

from tideweave.llm import exact_dedup, minhash
from tideweave.llm.components import components

from .conftest import sentence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def exact_brute(docs):
    groups = {}
    for key, text in docs:
        groups.setdefault((text or "").translate(LOWER), []).append(key)
    out = []
    for text, keys in groups.items():
        keep = max((k for k in keys if k is not None), default=None)
        left = 1
        for k in keys:
            kept = k == keep and left == 1
            left -= kept
            out.append((k, keep, len(keys), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(map(str, out))


def exact_found(df, **options):
    return [tuple(r) for r in exact_dedup.exact_groups(df, **options).collect()]


def test_exact_groups(spark, rng, odd, empty):
    docs = [(i, rng.choice(["A b", "a B", "É", "é", None, "", sentence(rng, 3)])) for i in range(200)] + [(5, "A b"), (None, "a b"), (None, "É")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert sorted(map(str, exact_found(df))) == exact_brute(docs)
    assert sorted(map(str, exact_found(odd))) == exact_brute([(r.doc_id, r.text) for r in odd.collect()])
    assert exact_found(empty) == []


def test_bytes_are_verified_when_digests_collide(spark, rng):
    docs = [(i, sentence(rng, 1)) for i in range(150)] + [(5, "x"), (5, "x"), (None, "y")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    weak = exact_found(df, digest=lambda c: F.substring(exact_dedup.sha256_hex(c), 1, 1))
    want = exact_found(df)
    assert sorted(str(r[:4]) for r in weak) == sorted(str(r[:4]) for r in want)


def test_hit_filter_misses_nothing(spark):
    index = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("digest"), (F.col("id") % 3 + 1).alias("copies"))
    filter = exact_dedup.hit_filter(index)
    rows = exact_dedup.with_hit(index, filter)
    assert filter.bits == 1 << 16
    assert rows.where("copies > 1 AND NOT hit").count() == 0 and rows.where("copies = 1 AND hit").count() < 200


def test_index_finds_digests_and_extreme_ids(spark):
    ids = spark.createDataFrame([(-(1 << 63), "a"), ((1 << 63) - 1, "A"), (0, "b")], "doc_id long, text string")
    assert {r[:2] for r in exact_found(ids)} == {(-(1 << 63), (1 << 63) - 1), ((1 << 63) - 1, (1 << 63) - 1), (0, 0)}
    index = exact_dedup.compact(exact_dedup.memtables(spark.range(1000).select(F.sha2(F.col("id").cast("string"), 256).alias("digest"), F.col("id").alias("ident"))))
    digests = [hashlib.sha256(str(i).encode()).hexdigest() for i in (3, 77, 5000)]
    assert {r.ident for r in exact_dedup.lookup(index, digests).collect()} == {3, 77}


def test_drop_copies(odd, empty):
    kept = exact_dedup.drop_copies(odd)
    assert kept.columns == odd.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(
        map(str, {(r[1], None if r[1] is None else next(x.text for x in odd.collect() if x.doc_id == r[1] and hashlib.sha256((x.text or "").translate(LOWER).encode()).hexdigest() == r[4])) for r in exact_found(odd) if r[3]})
    )
    assert exact_dedup.drop_copies(empty).count() == 0


def test_drop_copies_keeps_whole_rows(spark, rng):
    texts = ["A b", "a B", "c", None, "", *(sentence(rng, 4) for _ in range(60))]
    docs = [(rng.choice([None, *range(90)]), rng.choice(texts)) for _ in range(300)]
    df = spark.createDataFrame([(*d, f"h{d[0]}", 1) for d in docs], "doc_id long, text string, hit string, row int").repartition(7)
    want = {}
    for key, text in docs:
        norm = (text or "").translate(LOWER)
        want[norm] = max(want.get(norm, -1), -1 if key is None else key)
    found = exact_dedup.drop_copies(df).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, (r.text or "").translate(LOWER)) for r in found) == sorted((k, t) for t, k in want.items())
    assert all((r.doc_id, r.text, r.hit, r.row) in {(*d, f"h{d[0]}", 1) for d in docs} for r in found)


def test_components(spark, rng):
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(300)] + [(1000 + i, 1001 + i) for i in range(60)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_brute(docs, weights):
    """Classes by comparing all pairs."""
    memo = minhash.WordHashes()
    words = {k: minhash.words_of(t) for k, t in docs}
    sets = {}
    for k, w in words.items():
        h, c = minhash.shingles(w, memo)
        sets[k] = (h, weights.of(h, c)) if len(h) else (h, c.astype(float))
    root = {k: k for k in words}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(k for k in words if words[k])
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if words[a] == words[b] or minhash.jaccard(sets[a], sets[b]) >= minhash.THRESHOLD:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in words}


def edited(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = sentence(rng, 1)
    return " ".join(words)


def test_near_duplicates_match_all_pairs(spark, rng):
    texts = [sentence(rng, rng.choice((3, 40, 120))) for _ in range(40)]
    for base in list(texts[:12]):
        texts += [edited(rng, base, n) for n in (0, 1, 1, 2, 4)] if len(base.split()) > 30 else [base, base.upper()]
    hub = sentence(rng, 150)
    texts += [edited(rng, hub, rng.randint(1, 6)) for _ in range(70)] + [hub]
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    counters, n = minhash.sketch(df)
    weights = minhash.Weights(minhash.levels(counters, n), n)
    found = {r.doc_id: r for r in minhash.near_duplicates(df).collect()}
    want = near_brute(docs, weights)
    assert {k: r.class_id for k, r in found.items()} == want
    assert {k for k, r in found.items() if r.kept} == set(want.values())
    kept = minhash.keep_one_of_each(df)
    assert {r.doc_id for r in kept.collect()} == set(want.values()) and kept.columns == df.columns


def test_samples_agree_with_weighted_jaccard(rng):
    weights = minhash.Weights(minhash.levels(minhash.np.zeros((2, 1 << 20)), 1000), 1000)
    memo, close = minhash.WordHashes(), []
    for _ in range(150):
        a = sentence(rng, 120)
        b = edited(rng, a, 4)
        sets = [minhash.shingles(minhash.words_of(t), memo) for t in (a, b)]
        weighted = [(h, weights.of(h, c)) for h, c in sets]
        same = (weights.samples(*weighted[0]) == weights.samples(*weighted[1])).mean()
        close.append(same - minhash.jaccard(*weighted))
    assert abs(sum(close) / len(close)) < 0.02


def test_another_text_of_a_dropped_id_stays(spark, rng):
    text = sentence(rng, 80)
    rows = [(1, text), (2, text + " more"), (2, sentence(rng, 80)), (None, text + " other"), (None, sentence(rng, 50)), (None, None)]
    kept = minhash.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, [rows[0], rows[2], rows[4], rows[5]]))


def test_near_duplicates_of_odd_rows(odd, empty):
    rows = {(r.doc_id, r.class_id, r.class_size, r.kept) for r in minhash.near_duplicates(odd).collect()}
    assert rows == {(1, 1, 1, True), (2, 2, 1, True), (4, 4, 1, True), (None, 3, 3, False), (3, 3, 3, True), (5, 5, 1, True), (6, 6, 1, True), (7, 7, 1, True)}
    assert minhash.near_duplicates(empty).count() == 0
