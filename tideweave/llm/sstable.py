"""Sorted-string-table shards of token ids.

A shard holds documents in ascending order of doc_id. It is a sequence of frames, each followed by
one line feed (the record end of Spark's writer, which commits whole files, so a lost executor
leaves no partial shard):

* data blocks of about 64 KB. Entry: shared key bytes, own key bytes, value bytes (varints), own
  key bytes, value. Keys are prefix-compressed within a block; the first key of a block is whole.
  A key is the id as 8 big-endian bytes with the sign bit flipped; a null id is the empty key. A
  value is the document's ids, unsigned and little-endian, of the width in the footer.
* index: for each block its first key, offset, length, documents and ids.
* Bloom filter over the keys.
* footer of fixed size: places of index and filter, documents, ids, width, magic.
"""

from __future__ import annotations

import re
import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideweave.llm.common import bound_batches, parts_for, scratch, stored
from tideweave.llm.tokens import WordIds, rows_of

BLOCK = 1 << 16
SHARD_TEXT = 32 << 20
FOOTER = struct.Struct("<QQQQQQB7s")
MAGIC = b"TWSST1\0"
BLOOM_BITS_PER_KEY, BLOOM_HASHES = 10, 7


def key_of(doc_id: int | None) -> bytes:
    return b"" if doc_id is None else struct.pack(">Q", doc_id + (1 << 63))


def id_of(key: bytes) -> int | None:
    return struct.unpack(">Q", key)[0] - (1 << 63) if key else None


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def _probes(key: bytes, bits: int) -> Iterator[int]:
    a, b = zlib.crc32(key), zlib.crc32(key, 0x9E3779B9) | 1
    return ((a + i * b) % bits for i in range(BLOOM_HASHES))


class ShardWriter:
    """Takes documents in key order; gives frames."""

    def __init__(self, width: int):
        self.width, self.at, self.docs, self.ids = width, 0, 0, 0
        self.keys: list[bytes] = []
        self.index: list[bytes] = []
        self._start()

    def _start(self) -> None:
        self.block, self.size, self.first, self.last, self.block_docs, self.block_ids = [], 0, None, b"", 0, 0

    def _frame(self, data: bytes) -> bytes:
        self.at += len(data) + 1
        return data

    def add(self, key: bytes, value: bytes) -> bytes | None:
        """Take a document's ids, already of the shard's width; gives a block when one is full."""
        shared = 0
        if self.first is None:
            self.first = key
        else:
            most = min(len(key), len(self.last))
            while shared < most and key[shared] == self.last[shared]:
                shared += 1
        entry = varint(shared) + varint(len(key) - shared) + varint(len(value)) + key[shared:] + value
        self.block.append(entry)
        self.size += len(entry)
        self.last = key
        self.keys.append(key)
        self.block_docs += 1
        self.block_ids += len(value) // self.width
        return self._close() if self.size >= BLOCK else None

    def _close(self) -> bytes:
        self.index.append(
            varint(len(self.first)) + self.first + b"".join(map(varint, (self.at, self.size, self.block_docs, self.block_ids)))
        )
        self.docs += self.block_docs
        self.ids += self.block_ids
        data = self._frame(b"".join(self.block))
        self._start()
        return data

    def end(self) -> Iterator[bytes]:
        if self.block:
            yield self._close()
        index_at = self.at
        yield self._frame(index := b"".join(self.index))
        bits = max(64, len(self.keys) * BLOOM_BITS_PER_KEY)
        bloom = bytearray(-(-bits // 8))
        for key in self.keys:
            for p in _probes(key, bits):
                bloom[p >> 3] |= 1 << (p & 7)
        bloom_at = self.at
        yield self._frame(bloom := struct.pack("<Q", bits) + bytes(bloom))
        yield FOOTER.pack(index_at, len(index), bloom_at, len(bloom), self.docs, self.ids, self.width, MAGIC)


class ShardReader:
    """Reads a shard's bytes: all documents in order, or one by its id."""

    def __init__(self, data: bytes):
        self.data = data
        at = len(data) - 1 - FOOTER.size
        index_at, index_size, bloom_at, bloom_size, self.docs, self.ids, self.width, magic = FOOTER.unpack_from(data, at)
        if magic != MAGIC:
            raise ValueError("not a shard")
        self.blocks: list[tuple[bytes, int, int]] = []
        at, end = index_at, index_at + index_size
        while at < end:
            n, at = read_varint(data, at)
            first = bytes(data[at : at + n])
            at += n
            place, at = read_varint(data, at)
            size, at = read_varint(data, at)
            _, at = read_varint(data, at)
            _, at = read_varint(data, at)
            self.blocks.append((first, place, size))
        self.bits = struct.unpack_from("<Q", data, bloom_at)[0]
        self.bloom = data[bloom_at + 8 : bloom_at + bloom_size]

    def _entries(self, place: int, size: int) -> Iterator[tuple[bytes, np.ndarray]]:
        at, end, key = place, place + size, b""
        while at < end:
            shared, at = read_varint(self.data, at)
            own, at = read_varint(self.data, at)
            n, at = read_varint(self.data, at)
            key = key[:shared] + bytes(self.data[at : at + own])
            at += own
            yield key, np.frombuffer(self.data, f"<u{self.width}", n // self.width, at)
            at += n

    def __iter__(self) -> Iterator[tuple[int | None, np.ndarray]]:
        for _, place, size in self.blocks:
            for key, ids in self._entries(place, size):
                yield id_of(key), ids

    def get(self, doc_id: int | None) -> np.ndarray | None:
        """The ids of the first document with this id: Bloom filter, then binary search for the block."""
        key = key_of(doc_id)
        if not all(self.bloom[p >> 3] >> (p & 7) & 1 for p in _probes(key, self.bits)):
            return None
        firsts = [b[0] for b in self.blocks]
        at = max(0, bisect_right(firsts, key) - 1)
        while at and firsts[at] == key:  # repeated ids may begin in a block before
            at -= 1
        for _, place, size in self.blocks[at:]:
            for found, ids in self._entries(place, size):
                if found == key:
                    return ids
                if found > key:
                    return None
        return None


def write_shards(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 2,
    width: int = 2,
    shard_text: int = SHARD_TEXT,
    text: str = "text",
    doc_id: str = "doc_id",
) -> None:
    """Write all documents to shards in ``path``, by ascending doc_id (nulls first, equal ids by a hash of text).

    ``width``: bytes of an id, 2 for vocabularies of at most 65,536 ids; an id that does not
    fit is an error. A shard has about
    ``shard_text`` bytes of text. An empty table gives an empty folder.
    """
    end = end_id.to_bytes(4, "little")

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, shard = WordIds.of(tokenizer), None
        for rows in rows_of(batches, keep=True):
            shard = shard or ShardWriter(width)
            ids = [x + end for x in memo.encode(rows["text"])]
            wide = np.frombuffer(b"".join(ids), "<u4")
            if len(wide) and int(wide.max()) >> 8 * width:
                raise ValueError(f"id {wide.max()} does not fit {width} bytes; give a larger width")
            values = wide.astype(f"<u{width}").tobytes()
            at, out = 0, []
            for key, x in zip(rows["doc_id"], ids, strict=True):
                size = len(x) // 4 * width
                if frame := shard.add(key_of(key), values[at : at + size]):
                    out.append(frame)
                at += size
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])
        if shard:
            yield pa.RecordBatch.from_arrays([pa.array(list(shard.end()), pa.binary())], ["frame"])

    bound_batches(docs)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    chars = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0]
    if chars is None:
        chars = 0
    (
        rows.withColumn("h", F.xxhash64("text"))
        .repartitionByRange(parts_for(chars, shard_text), "doc_id", "h")
        .sortWithinPartitions("doc_id", "h")
        .select("doc_id", F.col("text").cast("binary"))
        .mapInArrow(frames, "frame binary")
        .select(F.col("frame").cast("string").alias("value"))
        .write.text(path, lineSep="\n")
    )


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Documents from the shards in ``path``: doc_id, start, n_tokens, ids_crc32 (of 32-bit ids)."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                shard = int(re.search(r"part-(\d+)", name.rsplit("/", 1)[1])[1])
                at, out = 0, []
                for key, ids in ShardReader(data.as_buffer().to_pybytes()):
                    out.append((shard, key, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    at += len(ids)
                if out:
                    names = ["shard", "doc_id", "at", "n_tokens", "ids_crc32"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    docs = stored(files.mapInArrow(decode, "shard long, doc_id long, at long, n_tokens long, ids_crc32 long"), "decoded")
    # One row per shard: a running sum over them gives each shard's first id.
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    shards = docs.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    shards = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return docs.join(F.broadcast(shards), "shard").select(
        "doc_id", (F.col("at") + F.col("base")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2, **options: object) -> DataFrame:
    """Write all documents to shards in the shared folder and read them back."""
    path = scratch(docs.sparkSession, "shards")
    write_shards(docs, path, tokenizer, end_id, **options)
    return read_shards(docs.sparkSession, path)
