"""Exact corpus counts of tokens, token pairs and token triples, as keyed rows in shards.

Each block of text sends the sorted keys it holds and how often its training texts have them to the
shards of the key range; a shard adds up equal keys and sends each block the corpus counts of its
keys, in the same order. Rows and shards grow with the corpus, nothing is broadcast or collected.
Tokens are keyed by 64 bits of XXH3; pairs and triples by 50 bits, of which a block sends 32 and
how many keys each value of the others has (at 30 GB about one key in 200,000 shares another's).
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from xxhash import xxh3_64_digest

from tideweave.llm.common import trim

#: Leading bits of a key, by which keys are dealt to shards.
HEAD = 18
#: Keys of a shard, before equal ones are added.
SHARD_KEYS = 4 << 20
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Keys of the end of a text and of what precedes its start; no token is empty.
END_KEY, START_KEY = np.uint64(0x7C9E3A1B5D2F8E61), np.uint64(0x1D8AF066E2B3C495)


#: Bits of the keys of pairs and triples.
GRAM_BITS = 50


_ZSTD = pa.Codec("zstd", compression_level=1)
_HEAD = struct.Struct("<BQ")


def pack(x: np.ndarray) -> bytes:
    """Whole numbers of 0 or more: as many byte planes as the largest needs, each value's low byte first."""
    planes = (int(x.max()).bit_length() + 7) // 8 if len(x) else 0
    head = _HEAD.pack(planes, len(x))
    if not planes:
        return head
    low = x.astype("<u8").view(np.uint8).reshape(-1, 8)
    return head + _ZSTD.compress(low[:, :planes].T.tobytes(), asbytes=True)


def unpack(blob: bytes) -> np.ndarray:
    planes, n = _HEAD.unpack_from(blob)
    out = np.zeros((n, 8), np.uint8)
    if planes:
        data = _ZSTD.decompress(pa.py_buffer(blob)[_HEAD.size :], planes * n)
        out[:, :planes] = np.frombuffer(data, np.uint8).reshape(planes, n).T
    return out.view("<i8").ravel()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * M2
    return h ^ (h >> np.uint64(29))


def token_keys(tokens: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxh3_64_digest, tokens)), np.uint64)


class Block:
    """A stored block: its distinct tokens, and the running token numbers of its texts, each closed by its end."""

    def __init__(self, tokens: bytes, ids: bytes, sizes: np.ndarray, held: np.ndarray):
        self.tokens = tokens.split()
        lengths = np.asarray(sizes, np.int64) + 1
        self.starts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)
        self.lengths, self.end = lengths, len(self.tokens)
        self.numbers = np.full(int(lengths.sum()), self.end, np.int64)
        inside = np.ones(len(self.numbers), bool)
        inside[self.starts + lengths - 1] = False
        self.numbers[inside] = unpack(ids)
        self.train = np.repeat(~np.asarray(held, bool), lengths)
        self.place = np.arange(len(self.numbers)) - np.repeat(self.starts, lengths)

    def token_keys(self) -> np.ndarray:
        return token_keys(self.tokens)

    def gram_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the pair and of the triple that end at each place, of 50 bits."""
        h = np.append(self.token_keys(), END_KEY)[self.numbers]
        one, two = np.full_like(h, START_KEY), np.full_like(h, START_KEY)
        one[1:] = h[:-1]
        one[self.place < 1] = START_KEY
        two[2:] = h[:-2]
        two[self.place < 2] = START_KEY
        with np.errstate(over="ignore"):
            pair = _mix(one * M1 + h)
            triple = _mix(_mix(two * M1 + one) * M1 + h)
        return pair >> np.uint64(64 - GRAM_BITS), triple >> np.uint64(64 - GRAM_BITS)


def block_of(row: dict) -> Block:
    return Block(row["tokens"], row["ids"], row["sizes"], row["held"])


#: By kind: bits of a key below its head, and how they are sent.
TAIL = {"token": (64 - HEAD, np.uint64), "gram": (GRAM_BITS - HEAD, np.uint32)}


def keys_of(block: Block, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The block's keys in order and how often training texts have each."""
    if kind == "token":
        keys = block.token_keys()
        counts = np.bincount(block.numbers[block.train], minlength=block.end + 1)[: block.end]
        order = np.argsort(keys)
        return keys[order], counts[order]
    # Sorted with the fold in the low bit; np.unique hashes, which is far slower on so many.
    keys = np.concatenate(block.gram_keys()) << np.uint64(1)
    keys |= np.concatenate((block.train, block.train))
    keys.sort()
    taught = (keys & np.uint64(1)).astype(np.int64)
    keys >>= np.uint64(1)
    starts = starts_of(keys)
    return keys[starts], np.add.reduceat(taught, starts) if len(starts) else taught


def starts_of(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate((ordered[:1] == ordered[:1], ordered[1:] != ordered[:-1])))


def order_of(keys: np.ndarray, key_bits: int = GRAM_BITS) -> np.ndarray:
    """The places of keys in their order, equal ones as they came: sorting numbers that hold both is far faster than sorting places."""
    bits = len(keys).bit_length()
    spare = np.uint64(max(0, key_bits + bits - 64))
    both = (keys >> spare) << np.uint64(bits) | np.arange(len(keys), dtype=np.uint64)
    both.sort()
    order = (both & np.uint64((1 << bits) - 1)).astype(np.int64)
    if spare:  # few keys differ in the spare bits alone
        order = order[np.argsort(keys[order], kind="stable")]
    return order


def at_places(keys: np.ndarray, by_key: np.ndarray) -> np.ndarray:
    """For each of ``keys`` its value, given the values of the distinct keys in order."""
    order = order_of(keys)
    ranked = keys[order]
    run = np.cumsum(np.concatenate((ranked[:1] != ranked[:1], ranked[1:] != ranked[:-1])))
    out = np.empty(len(keys), np.int64)
    out[order] = by_key[run]
    return out


_PIECES = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("heads", pa.binary()), ("tails", pa.binary()), ("counts", pa.binary())])


FOUND = "block long, shard int, found binary"


def corpus_counts(blocks: DataFrame, kind: str, keys: int) -> DataFrame:
    """(block, shard, found): for each block's keys of a shard in order, twice the corpus count, plus 1 where the block is the first to teach the key.

    ``keys``: about how many keys all blocks send.
    """
    shards = 1
    while shards < 1 << HEAD and shards * SHARD_KEYS < keys:
        shards *= 2
    per = (1 << HEAD) // shards
    bits, tail = TAIL[kind]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                every, counts = keys_of(block_of(row), kind)
                head = (every >> np.uint64(bits)).astype(np.int64)
                tails = (every & np.uint64((1 << bits) - 1)).astype(tail)
                cuts = np.searchsorted(head, np.arange(shards + 1) * per)
                out = []
                for s in range(shards):
                    a, b = cuts[s], cuts[s + 1]
                    if a < b:
                        heads = np.bincount(head[a:b] - s * per, minlength=per)
                        out.append((s, row["block"], pack(heads), tails[a:b].tobytes(), pack(counts[a:b])))
                del every, counts, head, tails
                for i in range(0, len(out), 64):
                    columns = zip(*out[i : i + 64], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECES, strict=True)], schema=_PIECES)

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block")
        heads = np.concatenate([np.repeat(np.arange(per, dtype=np.uint64), unpack(x)) for x in frame["heads"]])
        tails = np.concatenate([np.frombuffer(x, tail) for x in frame["tails"]])
        sizes = [len(x) // np.dtype(tail).itemsize for x in frame["tails"]]
        counts = [unpack(x) for x in frame["counts"]]
        every, counts = heads << np.uint64(bits) | tails, np.concatenate(counts)
        del heads, tails
        order = order_of(every, bits + HEAD)
        every, counts = every[order], counts[order]
        starts = starts_of(every)
        run = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(every)))
        sums = np.add.reduceat(counts, starts)
        before = np.cumsum(counts) - counts
        owner = (counts > 0) & (before == before[starts][run])
        found = np.empty(len(every), np.int64)
        found[order] = sums[run] * 2 + owner
        parts = np.split(found, np.cumsum(sizes)[:-1])
        return pd.DataFrame({"block": frame["block"].to_numpy(), "shard": frame["shard"].to_numpy(), "found": list(map(pack, parts))})

    sent = blocks.select("block", "tokens", "ids", "sizes", "held").mapInArrow(pieces, "shard int, block long, heads binary, tails binary, counts binary")
    return sent.groupBy("shard").applyInPandas(add, FOUND)


def merged(frame: pd.DataFrame) -> np.ndarray:
    """All counts that a block got, in the order of its keys."""
    frame = frame.sort_values("shard")
    return np.concatenate([np.zeros(0, np.int64), *map(unpack, frame["found"])])
