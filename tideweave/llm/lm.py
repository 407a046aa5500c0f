"""Language-model scores by context mixing over the whole corpus, in text order.

A token is coded by binary decisions: was it taught after the last two tokens, after the last one, at
all (``decisions``); and if it was not, by its spelling. Texts begin with a start mark and close with
their end. All that may follow a place shares probability 1 at most.

Spelling codes a token bit by bit: its bytes and an end mark, each along the path of a Huffman code.
For every bit several predictors look up counters by a hash of their context (the last two to four
bytes of the word, or all of its beginning); their log-odds are mixed with weights
chosen by a gate, trained online, and refined by an adaptive table of observed rates.

* blocks: each task numbers the distinct tokens of blocks of text of bounded size.
* counts: tokens, pairs and triples of training documents are counted as keyed rows (``grams``).
* spelling: every training token adds its count to hashed counters, whose size is fixed. Online steps
  run through the tokens of each bucket of the vocabulary in order, so tasks don't matter.
* gathering: blocks meet the counts of what they hold.
* passes over the gathered counts learn the decisions' counters, weights and rates, then score.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideweave.llm import grams
from tideweave.llm.common import SPACES, bound_batches, fold_of, parts_for, stored, trim
from tideweave.llm.decisions import Mixer as Decisions
from tideweave.llm.decisions import Places
from tideweave.sources.staging import release

#: Characters of text in a block.
BLOCK_CHARS = 16 << 20
#: The end of a text, and the mark after a word; a space never occurs within one.
END, MARK = 256, 32
SYMBOLS = 257
#: Bits of the counters of each predictor: orders 2 to 4, and the word so far.
TABLE_BITS = (18, 20, 21, 22)
OFFSETS = np.concatenate(([0], np.cumsum([1 << b for b in TABLE_BITS])))
K = len(TABLE_BITS)
#: Counts are kept in a byte: exact to 15, then in steps of 13 %.
VALUES = np.concatenate((np.arange(16.0), 16 * 1.13 ** np.arange(240)))
PRIOR = 0.4
GATES, RATES, LIMIT = 20, 33, 8.0
RATE_PRIOR = 8.0
WORDS_AT_ONCE = 4096
CHUNKS = 64
#: Tokens of the vocabulary that one task learns from in order.
BUCKET_TOKENS = 1 << 19
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

BLOCKS = "block long, doc_ids array<long>, held array<boolean>, bytes array<long>, sizes array<int>, ids binary, tokens binary"
_BLOCKS = pa.schema(
    [("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("bytes", pa.list_(pa.int64()))]
    + [("sizes", pa.list_(pa.int32())), ("ids", pa.binary()), ("tokens", pa.binary())]
)


class Numbers(dict):
    """The number of each token, in order of first sight."""

    def __missing__(self, token: bytes) -> int:
        found = self[token] = len(self)
        return found


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block: its documents, their running token numbers, and its distinct tokens."""
    from pyspark import TaskContext

    trim()
    base, done = TaskContext.get().partitionId() << 24, 0
    numbers = Numbers()
    docs: list[tuple] = []
    ids: list[np.ndarray] = []
    chars = 0

    def flush() -> pa.RecordBatch:
        columns = zip(*docs, strict=True)
        row = [[base + done], *([list(c)] for c in columns), [grams.pack(np.concatenate(ids))], [b" ".join(numbers)]]
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(row, _BLOCKS, strict=True)], schema=_BLOCKS)

    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            rows = batch.slice(at, 64).to_pydict()
            for key, held, data in zip(rows["doc_id"], rows["held_out"], rows["text"], strict=True):
                words = data.lower().split()  # of bytes: A-Z only
                ids.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                docs.append((key, held, len(data.translate(None, SPACES)) + len(words), len(words)))
                chars += len(data) + 64
                if chars > BLOCK_CHARS:
                    yield flush()
                    numbers, docs, ids, chars, done = Numbers(), [], [], 0, done + 1
    if docs:
        yield flush()


@dataclass
class Code:
    """A Huffman code: for each symbol its length, and on its path the inner nodes and bits."""

    lengths: np.ndarray
    nodes: np.ndarray
    bits: np.ndarray


def huffman(counts: np.ndarray) -> Code:
    heap = [(int(c) + 1, s, (s,)) for s, c in enumerate(counts)]
    paths: list[list[tuple[int, int]]] = [[] for _ in counts]
    heapq.heapify(heap)
    node = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        for bit, part in ((0, a), (1, b)):
            for s in part[2]:
                paths[s].append((node, bit))
        heapq.heappush(heap, (a[0] + b[0], min(a[1], b[1]), a[2] + b[2]))
        node += 1
    longest = max(map(len, paths))
    nodes, bits = np.zeros((len(paths), longest), np.uint64), np.zeros((len(paths), longest), bool)
    for s, path in enumerate(paths):
        for i, (n, bit) in enumerate(reversed(path)):
            nodes[s, i], bits[s, i] = n + 1, bit
    return Code(np.array(list(map(len, paths))), nodes, bits)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * M2
    return h ^ (h >> np.uint64(29))


def symbols(tokens: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbol, token number, place in the token) of all tokens; None is the end of a text."""
    data = np.frombuffer(b"".join(t + b" " if t is not None else b" " for t in tokens), np.uint8).astype(np.int64)
    sizes = np.fromiter((1 if t is None else len(t) + 1 for t in tokens), np.int64, len(tokens))
    owner = np.repeat(np.arange(len(tokens)), sizes)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    for i, t in enumerate(tokens):
        if t is None:
            data[starts[i]] = END
    return data, owner, np.arange(len(data)) - starts[owner]


def contexts(data: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
    """A hash of each predictor's context at each symbol."""
    with np.errstate(over="ignore"):
        value = data.astype(np.uint64) + np.uint64(1)
        out, h = [], np.full(len(data), 7, np.uint64)
        for n in range(1, 5):
            back = np.zeros(len(data), np.uint64)
            back[n:] = value[:-n]
            back[place < n] = 0
            h = h * M1 + back
            if n > 1:
                out.append(_mix(h + np.uint64(n)))
        # All symbols before this one: differences of a running sum of mixed symbols and places.
        mixed = _mix(value * M1 + (place.astype(np.uint64) + np.uint64(1)) * M2)
        run = np.concatenate(([np.uint64(0)], np.cumsum(mixed)))[:-1]
        first = np.arange(len(data)) - place
        out.append(_mix(run - run[first] + place.astype(np.uint64)))
    return out


def _slots(k: int, context: np.ndarray, node: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (((context + node * M1) * M2) >> np.uint64(64 - TABLE_BITS[k])).astype(np.int64) + OFFSETS[k]


def steps(tokens: list[bytes | None], code: Code) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """For each place on the code's paths: (token number, bit, slot for each predictor) of the symbols that get so far."""
    data, owner, place = symbols(tokens)
    hashed = contexts(data, place)
    for depth in range(code.nodes.shape[1]):
        alive = code.lengths[data] > depth
        if not alive.all():
            data, owner, hashed = data[alive], owner[alive], [h[alive] for h in hashed]
        if not len(data):
            return
        node = code.nodes[data, depth]
        yield owner, code.bits[data, depth], [_slots(k, h, node) for k, h in enumerate(hashed)]


def quantise(counts: np.ndarray) -> np.ndarray:
    return (np.searchsorted(VALUES, counts, side="right") - 1).clip(0, 255).astype(np.uint8)


def _log_odds(less0: int, less1: int) -> np.ndarray:
    """Log-odds of a one by counter (byte of zeros, byte of ones), with one occurrence taken away from either."""
    zeros = np.log(np.maximum(VALUES - less0, 0) + PRIOR)
    ones = np.log(np.maximum(VALUES - less1, 0) + PRIOR)
    # A counter is read as one number: ones in the high byte.
    return (ones[:, None] - zeros[None, :]).astype(np.float32).ravel()


#: As they are, with a zero taken away, with a one taken away.
ODDS = np.concatenate((_log_odds(0, 0), _log_odds(1, 0), _log_odds(0, 1)))


def _seen(less: int) -> np.ndarray:
    """How much a counter has seen, in five steps."""
    total = np.maximum(VALUES[:, None] + VALUES[None, :] - less, 0).ravel()
    return np.searchsorted([1, 2, 4, 16], total, side="right").astype(np.int8)


SEEN = np.concatenate((_seen(0), _seen(1), _seen(1)))


@dataclass
class Mixer:
    """Weights and observed rates by gate."""

    weights: np.ndarray
    rates: np.ndarray  # gate x rate bucket x (zeros, ones)

    @classmethod
    def new(cls) -> Mixer:
        return cls(np.full((GATES, K), 0.3), np.zeros((GATES, RATES, 2)))


def _inputs(counters: np.ndarray, slots: list[np.ndarray], bit: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(log-odds of each predictor, gate); with ``bit``, as if this occurrence had not been counted."""
    odds = np.empty((K, len(slots[0])), np.float32)
    gate = None
    variant = np.int32(0) if bit is None else (bit + np.int32(1)) << 16
    for k, slot in enumerate(slots):
        found = counters[slot] + variant
        odds[k] = ODDS[found]
        if k == 2:
            gate = np.minimum(SEEN[found], 3).astype(np.int64)
        elif k == 3:
            gate = gate * 5 + SEEN[found]
    return odds, gate


def _mixed(odds: np.ndarray, gate: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return np.einsum("kn,nk->n", odds, weights.astype(np.float32)[gate]).clip(-LIMIT, LIMIT)


def _bucket(x: np.ndarray) -> np.ndarray:
    return np.rint((x + LIMIT) * ((RATES - 1) / (2 * LIMIT))).astype(np.int64)


CENTRES = 1 / (1 + np.exp(-np.linspace(-LIMIT, LIMIT, RATES)))


def log10_probabilities(tokens: list[bytes | None], code: Code, counters: np.ndarray, mixer: Mixer, less: bool = False) -> np.ndarray:
    """log10 of the spelling model's probability of each token; ``less``: as if one occurrence had not been counted."""
    ones = mixer.rates[:, :, 1] + RATE_PRIOR * CENTRES
    refined = (ones / (mixer.rates.sum(axis=2) + RATE_PRIOR)).ravel()
    total = np.zeros(len(tokens))
    for owner, bit, slots in steps(tokens, code):
        odds, gate = _inputs(counters, slots, bit if less else None)
        x = _mixed(odds, gate, mixer.weights)
        p = 0.5 / (1 + np.exp(-x)) + 0.5 * refined[gate * RATES + _bucket(x)]
        total += np.bincount(owner, np.log10(np.where(bit, p, 1 - p)), len(tokens))
    return total


def learn(tokens: list[bytes | None], counts: np.ndarray, code: Code, counters: np.ndarray, mixer: Mixer, squares: np.ndarray) -> None:
    """Online step over a batch: weights by gradient of the coding cost, and the rates seen at each output."""
    share = np.sqrt(counts)
    for owner, bit, slots in steps(tokens, code):
        odds, gate = _inputs(counters, slots, bit)
        x = _mixed(odds, gate, mixer.weights)
        error = (bit - 1 / (1 + np.exp(-x))) * share[owner]
        weight = np.bincount(gate, share[owner], GATES)[:, None] + 1e-9
        slope = np.stack([np.bincount(gate, error * odds[k], GATES) for k in range(K)], 1) / weight
        squares += slope**2
        mixer.weights += 0.15 * slope / np.sqrt(squares + 1e-8)
        flat = (gate * RATES + _bucket(x)) * 2 + bit
        mixer.rates += np.bincount(flat, counts[owner], GATES * RATES * 2).reshape(mixer.rates.shape)


@dataclass
class Model:
    code: Code
    counters: np.ndarray  # one number for each slot: ones in the high byte, zeros in the low
    mixer: Mixer


def _token_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Tokens and their counts, about WORDS_AT_ONCE at a time."""
    trim()
    tokens, counts = [], []
    for batch in batches:
        tokens += batch.column("token").to_pylist()
        counts.append(batch.column("n").to_numpy(zero_copy_only=False).astype(float))
        if len(tokens) >= WORDS_AT_ONCE:
            yield tokens, np.concatenate(counts)
            tokens, counts = [], []
    if tokens:
        yield tokens, np.concatenate(counts)


def _parts(frame: pd.DataFrame) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Tokens of a bucket and their counts, WORDS_AT_ONCE at a time."""
    trim()
    for at in range(0, len(frame), WORDS_AT_ONCE):
        part = frame.iloc[at : at + WORDS_AT_ONCE]
        yield list(part["token"]), part["n"].to_numpy(float)


def train(vocabulary: DataFrame, end_count: int) -> Model:
    """The model of all training tokens: ``vocabulary`` (token, n) with n > 0, and the number of texts."""
    spark = vocabulary.sparkSession
    buckets = parts_for(vocabulary.count(), BUCKET_TOKENS)
    dealt = vocabulary.withColumn("bucket", F.pmod(F.xxhash64("token"), F.lit(buckets))).groupBy("bucket")

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS)
        for tokens, n in _token_batches(batches):
            data, owner, _ = symbols(tokens)
            total += np.bincount(data, n[owner], SYMBOLS)
        yield pa.RecordBatch.from_arrays([pa.array(range(SYMBOLS), pa.int32()), pa.array(total)], ["symbol", "n"])

    found = vocabulary.mapInArrow(histogram, "symbol int, n double").groupBy("symbol").agg(F.sum("n").alias("n")).collect()
    by_symbol = np.zeros(SYMBOLS)
    for row in found:  # one row per symbol
        by_symbol[row.symbol] = row.n
    by_symbol[END] = end_count
    code = huffman(by_symbol)

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((2, OFFSETS[-1]), np.float32)
        for tokens, n in _parts(frame):
            for owner, bit, slots in steps(tokens, code):
                for slot in slots:
                    np.add.at(total.reshape(-1), slot + bit * OFFSETS[-1], n[owner].astype(np.float32))
        parts = [zlib.compress(np.ascontiguousarray(x).tobytes(), 1) for x in np.array_split(total, CHUNKS, axis=1)]
        return pd.DataFrame({"chunk": np.arange(CHUNKS, dtype=np.int32), "counts": parts})

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for frame in frames:
            for chunk, blob in zip(frame["chunk"], frame["counts"], strict=True):
                new = np.frombuffer(zlib.decompress(blob), np.float32)
                sums[chunk] = sums[chunk] + new if chunk in sums else new.astype(np.float64)
        for chunk, x in sums.items():
            zeros, ones = quantise(x.reshape(2, -1))
            yield pd.DataFrame({"chunk": [chunk], "counts": [(ones.astype(np.uint16) << 8 | zeros).tobytes()]})

    parts = dealt.applyInPandas(count, "chunk int, counts binary").repartition(16, "chunk")
    counters = np.zeros(OFFSETS[-1], np.uint16)
    pieces = np.array_split(np.arange(OFFSETS[-1]), CHUNKS)
    for row in parts.mapInPandas(add, "chunk int, counts binary").toLocalIterator():  # CHUNKS rows of fixed size
        counters[pieces[row.chunk]] = np.frombuffer(row.counts, np.uint16)
    _count_end(counters, code, end_count)
    shared = spark.sparkContext.broadcast(counters)  # 15 MB, whatever the input

    def mix(frame: pd.DataFrame) -> pd.DataFrame:
        mixer, squares = Mixer.new(), np.zeros((GATES, K))
        for tokens, counts in _parts(frame.sort_values("token")):
            learn(tokens, counts, code, shared.value, mixer, squares)
        out = np.concatenate((mixer.weights.ravel() * len(frame), mixer.rates.ravel(), [len(frame)]))
        return pd.DataFrame({"at": np.arange(len(out), dtype=np.int32), "x": out})

    mixer = Mixer.new()
    summed = dealt.applyInPandas(mix, "at int, x double").groupBy("at").agg(F.sum("x").alias("x")).collect()
    flat = np.zeros(GATES * K + GATES * RATES * 2 + 1)
    for row in summed:  # the mixer's size
        flat[row.at] = row.x
    if flat[-1]:
        mixer.weights = (flat[: GATES * K].reshape(GATES, K) / flat[-1]).round(6)
        mixer.rates = flat[GATES * K : -1].reshape(GATES, RATES, 2)
    model = Model(code, counters, mixer)
    shared.unpersist()
    return model


def _count_end(counters: np.ndarray, code: Code, n: int) -> None:
    """Add the ends of ``n`` texts."""
    for _, bit, slots in steps([None], code):
        for slot in slots:
            zeros, ones = VALUES[counters[slot] & 255], VALUES[counters[slot] >> 8]
            zeros, ones = zeros + n * ~bit, ones + n * bit
            counters[slot] = quantise(ones).astype(np.uint16) << 8 | quantise(zeros)


FEATURES = "doc_ids array<long>, held array<boolean>, bytes array<long>, sizes array<int>, c1 binary, c2 binary, c3 binary, new binary, once binary"
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, score_unseen double, bits_per_byte double"
NAMES = [c.split()[0] for c in RESULT.split(", ")]
DOCS_AT_ONCE = 256


class Texts:
    """Some texts with the corpus counts of what they hold."""

    def __init__(self, row: dict):
        self.held, self.lengths = np.array(row["held"], bool), np.array(row["sizes"], np.int64) + 1
        self.starts = np.cumsum(self.lengths) - self.lengths
        n = int(self.lengths.sum())
        self.counts = [grams.unpack(row[c]) for c in ("c1", "c2", "c3")]
        self.place = np.arange(n) - np.repeat(self.starts, self.lengths)
        self.train = np.repeat(~self.held, self.lengths)
        self.spelled = np.ones(n, np.float32)
        self.spelled[self.counts[0] == 0] = np.frombuffer(row["new"], np.float32)
        self.spelled[self.train & (self.counts[0] == 1)] = np.frombuffer(row["once"], np.float32)

    def places(self, texts: int, total: int) -> Places:
        """Training places as if not counted once."""
        return Places(*self.counts, self.place, texts, total, self.train)

    def sums(self, x: np.ndarray) -> np.ndarray:
        return np.add.reduceat(x, self.starts)

    def scores(self, mixer: Decisions, texts: int, total: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each text as it is, and as if its places had not been counted once."""
        spelled = np.log10(np.maximum(self.spelled, 1e-300, dtype=np.float64))

        def score(at: np.ndarray | slice, starts: np.ndarray, less: np.ndarray) -> np.ndarray:
            places = Places(*(c[at] for c in self.counts), self.place[at], texts, total, less)
            return np.add.reduceat(mixer.log10_probabilities(places) + np.where(places.new, spelled[at], 0.0), starts)

        full = score(slice(None), self.starts, np.zeros_like(self.train))
        unseen, mine = full.copy(), ~self.held
        if mine.any():  # the scores of held-out texts are the same
            lengths = self.lengths[mine]
            unseen[mine] = score(np.flatnonzero(self.train), np.cumsum(lengths) - lengths, np.ones(lengths.sum(), bool))
        return full, unseen


def score(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", held_fold: int = 1) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, score_unseen, bits_per_byte.

    Documents whose fold is ``held_fold`` teach nothing. Null text is empty: one token, its end.
    base_score and score are log10 probabilities of the text by unigrams and by the model.
    score_unseen takes each place of a training text as if it had not been counted, so that it compares
    with held-out texts, whose two scores are equal; of a training text that score tells how well the
    rest of the corpus predicts it (a token that it alone taught costs its length in the Huffman code). bits_per_byte is by score, over the bytes that are coded: those of
    the words, one for white space after each, and one for the end. Repeated rows are documents of their
    own; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    bound_batches(docs)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (fold_of(F.col(doc_id)) == held_fold).alias("held_out"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )
    blocks = stored(rows.mapInArrow(_blocks, BLOCKS), "blocks")
    sizes = blocks.select(F.explode(F.arrays_zip("held", "sizes")).alias("d")).select("d.held", "d.sizes")
    taught = F.when(~F.col("held"), F.col("sizes"))
    ends, words, occurrences = sizes.agg(F.count(taught), F.coalesce(F.sum(taught), F.lit(0)), F.coalesce(F.sum(F.col("sizes") + 1), F.lit(0))).first()
    total = words + ends
    # Blocks repeat few of their tokens' keys: a fifth of the occurrences is ample for the number of shards.
    token_counts = stored(grams.corpus_counts(blocks, "token", occurrences // 5), "tokens")
    gram_counts = stored(grams.corpus_counts(blocks, "gram", 2 * occurrences), "grams")

    def own(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """The tokens that this block is the first to teach, and their corpus counts."""
        tokens = left["tokens"].iloc[0].split()
        found = grams.merged(right)
        mine = np.flatnonzero(found & 1)
        order = np.argsort(grams.token_keys(tokens))
        return pd.DataFrame({"token": [tokens[i] for i in order[mine]], "n": found[mine] >> 1})

    by_block = lambda df: df.groupBy("block")
    vocabulary = by_block(blocks.select("block", "tokens")).cogroup(by_block(token_counts)).applyInPandas(own, "token binary, n long")
    known = stored(vocabulary, "vocabulary")
    distinct = known.count() + (ends > 0)
    model = train(known, ends)
    code, mixer = model.code, model.mixer
    shared = spark.sparkContext.broadcast(model.counters)
    end_spelled = float(10 ** log10_probabilities([None], code, model.counters, mixer)[0])

    def mass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = sum((float((10 ** log10_probabilities(words, code, shared.value, mixer)).sum()) for words, _ in _token_batches(batches)), 0.0)
        yield pa.RecordBatch.from_arrays([pa.array([x])], ["x"])

    # Only unknown tokens are spelled, so they share what spelling leaves to them; what tokens taught once would
    # have is left out, being small and most of the work.
    spent = known.where("n > 1").mapInArrow(mass, "x double").agg(F.coalesce(F.sum("x"), F.lit(0.0))).first()[0]
    left_over = max(1 - spent - (end_spelled if ends else 0), 1e-9)

    def gather(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """The counts of each token of the block's texts and of the pair and triple that end there."""
        row = left.iloc[0]
        block = grams.block_of(row)
        names = block.tokens
        known_n = np.full(block.end + 1, ends)
        known_n[np.argsort(block.token_keys())] = grams.merged(right[right["kind"] == 1]) >> 1
        c1 = known_n[block.numbers]
        keys = np.concatenate(block.gram_keys())
        c2, c3 = np.split(grams.at_places(keys, grams.merged(right[right["kind"] == 2]) >> 1), 2)
        del keys

        def spelled(at: np.ndarray) -> np.ndarray:
            """Spelling's probability of the tokens at some places."""
            which, place = np.unique(block.numbers[at], return_inverse=True)
            out = np.zeros(len(which), np.float32)
            for i in range(0, len(which), WORDS_AT_ONCE):
                tokens = [None if t == block.end else names[t] for t in which[i : i + WORDS_AT_ONCE]]
                out[i : i + WORDS_AT_ONCE] = np.minimum(10 ** log10_probabilities(tokens, code, shared.value, mixer) / left_over, 1)
            return out[place]

        def plain(at: np.ndarray) -> np.ndarray:
            """The probability of the tokens at some places by the Huffman code alone."""
            which, place = np.unique(block.numbers[at], return_inverse=True)
            if not len(which):
                return np.zeros(0, np.float32)
            data, owner, _ = symbols([None if t == block.end else names[t] for t in which])
            return (0.5 ** np.bincount(owner, code.lengths[data])).astype(np.float32)[place]

        new, once = np.flatnonzero(c1 == 0), np.flatnonzero(block.train & (c1 == 1))
        columns = [(new, spelled(new)), (once, plain(once))]
        out = []
        limits = np.append(block.starts, len(c1))
        lists = [list(row[c]) for c in ("doc_ids", "held", "bytes", "sizes")]
        for i in range(0, len(block.starts), DOCS_AT_ONCE):
            j = min(i + DOCS_AT_ONCE, len(block.starts))
            a, b = limits[i], limits[j]
            ids = [None if k is None or k != k else int(k) for k in lists[0][i:j]]
            spell = [p[np.searchsorted(at, a) : np.searchsorted(at, b)].tobytes() for at, p in columns]
            out.append((ids, *(x[i:j] for x in lists[1:]), *(grams.pack(x[a:b]) for x in (c1, c2, c3)), *spell))
        return pd.DataFrame(out, columns=["doc_ids", "held", "bytes", "sizes", "c1", "c2", "c3", "new", "once"])

    sent = ["block", "shard", "found"]
    counts = token_counts.select(*sent, F.lit(1).alias("kind")).unionAll(gram_counts.select(*sent, F.lit(2).alias("kind")))
    features = stored(by_block(blocks).cogroup(by_block(counts)).applyInPandas(gather, FEATURES), "features")
    release(blocks, token_counts, gram_counts, known)

    def summed(give: Callable[[Places], np.ndarray], size: int) -> np.ndarray:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trim()
            out = np.zeros(size)
            for batch in batches:
                for row in batch.to_pylist():
                    out += give(Texts(row).places(ends, total)).ravel()
            at = np.flatnonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(out[at])], ["at", "x"])

        out = np.zeros(size)
        for r in features.mapInArrow(add, "at int, x double").groupBy("at").agg(F.sum("x").alias("x")).collect():  # of the mixer's size
            out[r.at] = r.x
        return out

    decisions = Decisions.new()
    decisions.learn(summed)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        for batch in batches:
            for row in batch.to_pylist():
                yield _scored(row, decisions, total, distinct, ends)

    return features.mapInArrow(weigh, RESULT)


def _scored(row: dict, decisions: Decisions, total: int, distinct: int, ends: int) -> pa.RecordBatch:
    texts = Texts(row)
    c1, lengths = texts.counts[0], texts.lengths
    score, unseen = texts.scores(decisions, ends, total)
    base = texts.sums(np.log10((c1 + 0.5) / (total + 0.5 * (distinct + 1))))
    bits = -score / np.log10(2) / (np.array(row["bytes"]) + 1)
    columns = [row["doc_ids"], row["held"], lengths, texts.sums((c1 > 0).astype(np.int64)), np.full(len(lengths), total), base, score, unseen, bits]
    kinds = [pa.int64(), pa.bool_(), *[pa.int64()] * 3, *[pa.float64()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], NAMES)
