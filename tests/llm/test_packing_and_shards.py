"""Tokens, packing (2) and sorted-string-table shards (10) against the library and brute force."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tideweave.llm import packing, sstable
from tideweave.llm.tokens import WordIds

from .conftest import TOKENIZER, sentence


def ids_of(text, end):
    return np.array(Tokenizer.from_file(TOKENIZER).encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def test_memo_equals_library(rng):
    texts = [sentence(rng, 60) for _ in range(40)]
    marks = ["", ".", ",!", "'s", "!!", "%$", "|", "-x", "́", "½", " y"]
    texts += [" ".join(w + rng.choice(marks) for w in t.upper().split()) for t in texts]
    texts += ["İstanbul K's 'tis it's, '", "A̸ ≠", "<|startoftext|>.<|ENDOFTEXT|>", "\x1c\x85a b"]
    library = Tokenizer.from_file(TOKENIZER)
    memo = WordIds(TOKENIZER)
    for _ in range(2):
        for text, ids in zip(texts, memo.encode([t.encode() for t in texts]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_memo_equals_library_beside_special_tokens(rng):
    pieces = ["<|", "|>", "<|endoftext|>", "<|STARTOFTEXT|>", "|", "||", "<", "Hello", "World", "é", "e\u0301", "\u1e9b\u0323", "İ", "A", "a.B", "'S", "7x", "\x00", "\x85", "\u200b"]
    pieces += [" "] * 8 + ["\n", "\t"] + sentence(rng, 6).split() + sentence(rng, 6).upper().split()
    texts = ["let x = f <| Hello World", "<|im_start|>User Hello there"] + ["".join(rng.choices(pieces, k=rng.randint(1, 24))) for _ in range(20_000)]
    library = Tokenizer.from_file(TOKENIZER).encode_batch(texts, add_special_tokens=False)
    found = WordIds(TOKENIZER).encode([t.encode() for t in texts])
    assert [t for t, ids, e in zip(texts, found, library, strict=True) if np.frombuffer(ids, "<u4").tolist() != e.ids] == []


def test_open_bins_take_the_tightest_and_close_the_fullest():
    bins = packing.OpenBins(10, 2)
    assert [bins.put(n) for n in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    bins = packing.OpenBins(10, 2)
    assert [bins.put(n) for n in (6, 7, 8, 3, 2)] == [(0, 0), (1, 0), (2, 0), (0, 6), (2, 8)]
    model, bins, rng = {}, packing.OpenBins(100, 1 << 30), random.Random(1)
    for n in [rng.randint(1, 99) for _ in range(3000)]:
        fits = [b for b, used in model.items() if used + n <= 100]
        best = max((model[b] for b in fits), default=0)
        got, at = bins.put(n)
        assert at == best
        model[got] = at + n


def check_packed(rows, docs, capacity):
    want = {}
    for key, text in docs:
        ids = ids_of(text, 1)
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            want.setdefault((key, n, at, len(part), zlib.crc32(part.tobytes())), []).append(1)
    assert sorted(map(str, want)) == sorted({str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in rows})
    assert len(rows) == sum(map(len, want.values()))
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pack(spark, rng):
    docs = [(i, sentence(rng, rng.choice((1, 5, 30, 200)))) for i in range(300)] + [(0, None), (0, None), (None, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    least = -(-sum(len(ids_of(t, 1)) for _, t in docs) // 128)
    for options in ({}, {"group_pieces": 40, "open_bins": 8}):
        n = check_packed(packing.pack(df, TOKENIZER, capacity=128, **options).collect(), docs, 128)
        assert n <= 1.1 * least + 1


def test_pack_odd_rows(odd, empty):
    rows = packing.pack(odd, TOKENIZER).collect()
    check_packed(rows, [(r.doc_id, r.text) for r in odd.collect()], 4096)
    assert packing.pack(empty, TOKENIZER).count() == 0


def test_shards_round_trip(spark, rng, odd, empty):
    docs = [(i * 7 - 900, sentence(rng, rng.randint(0, 60))) for i in range(250)]
    rng.shuffle(docs)
    for df in (spark.createDataFrame(docs, "doc_id long, text string"), odd):
        rows = sorted(sstable.round_trip(df, TOKENIZER, shard_text=4000).collect(), key=lambda r: r.start)
        at = 0
        for r in rows:
            assert r.start == at
            at += r.n_tokens
        keys = [r.doc_id if r.doc_id is not None else -(1 << 63) for r in rows]
        assert keys == sorted(keys)
        want = sorted(str((d.doc_id, len(x), zlib.crc32(x.tobytes()))) for d in df.collect() for x in [ids_of(d.text, 2)])
        assert sorted(str((r.doc_id, r.n_tokens, r.ids_crc32)) for r in rows) == want
    assert sstable.round_trip(empty, TOKENIZER).count() == 0


def test_shard_lookup(rng):
    writer = sstable.ShardWriter(2)
    values = {k: np.arange(k % 50, dtype="<u2").tobytes() for k in sorted(rng.sample(range(-5000, 50_000), 3000))}
    frames = [f for f in (writer.add(sstable.key_of(k), v) for k, v in values.items()) if f]
    data = b"".join(f + b"\n" for f in [*frames, *writer.end()])
    reader = sstable.ShardReader(data)
    assert len(reader.blocks) > 1 and [(k, x.tobytes()) for k, x in reader] == list(values.items())
    for k in range(-5100, 50_100, 37):
        found = reader.get(k)
        assert (found is None) == (k not in values) and (found is None or found.tobytes() == values[k])


def test_ids_that_do_not_fit_are_an_error(spark, tmp_path):
    docs = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    sstable.write_shards(docs, str(tmp_path / "wide"), TOKENIZER, end_id=70_000, width=4)
    assert sstable.read_shards(spark, str(tmp_path / "wide")).count() == 1
    with pytest.raises(Exception, match="does not fit 2 bytes"):
        sstable.write_shards(docs, str(tmp_path / "narrow"), TOKENIZER, end_id=70_000)
