"""Quality rules: text statistics with fixed limits, then a calibrated n-gram classifier.

The classifier is a logistic regression over hashed word unigrams, word bigrams and character
n-grams within words, each family averaged over its occurrences. It is fitted on a bounded sample
of labelled rows, its probabilities are calibrated on a held-out part of the sample (Platt), and
whole texts are scored in Arrow batches. The score is linear, so what a word adds by itself is
computed once per distinct word and batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideweave.llm.common import bound_batches, trim
from tideweave.llm.tokens import rows_of

#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\x0c"
MIN_WORDS = 50
REPEAT_PERCENT = 50

#: A document is kept at this calibrated probability of quality 1 or more.
KEEP_AT = 0.5

#: Bounds of the training sample: labelled rows, characters of text among them, and of one text.
SAMPLE_ROWS = 4000
SAMPLE_CHARS = 24_000_000
SAMPLE_TEXT = 1_000_000

BUCKETS = 1 << 18
CHAR_NGRAMS = (2, 3, 4)
EPOCHS, RATE, CALIBRATE_EVERY = 6, 0.5, 4
WORD_SEED, PAIR, CHAR_SEED = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
MEMO_WORDS = 1 << 19


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _buckets(h: np.ndarray) -> np.ndarray:
    return (_mix(h) % np.uint64(BUCKETS)).astype(np.int32)


def char_features(words: list[bytes], sizes: tuple[int, ...] = CHAR_NGRAMS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, bucket) of each character n-gram of ``words``, word ends included, and each word's hash."""
    points = np.frombuffer((" " + " ".join(w.decode() for w in words) + " ").encode("utf-32-le"), "<u4").astype(np.uint64)
    gap = points == 32
    number = np.cumsum(gap) - 1
    starts = np.flatnonzero(gap)[:-1] + 1
    lengths = np.diff(np.flatnonzero(gap)) - 1
    at = np.arange(len(points), dtype=np.int64)
    offset = (at - (starts[np.minimum(number, len(starts) - 1)])).astype(np.uint64)
    with np.errstate(over="ignore"):
        mixed = _mix((points + np.uint64(1)) * WORD_SEED + (offset + np.uint64(3)) * PAIR)
        mixed[gap] = 0
        total = np.concatenate(([np.uint64(0)], np.cumsum(mixed)))
        hashes = total[starts + lengths] - total[starts]
        who, what = [], []
        rolled = np.zeros(len(points), np.uint64)
        for n in range(1, max(sizes) + 1):
            # rolled[i]: hash of the n characters from i
            rolled = rolled[: len(points) - n + 1] * CHAR_SEED + points[n - 1 :] + np.uint64(n)
            if n in sizes:
                inside = np.ones(len(rolled), bool)
                for j in range(1, n - 1):
                    inside &= ~gap[j : j + len(rolled)]
                if n == 2:
                    inside &= ~(gap[:-1] & gap[1:])
                i = np.flatnonzero(inside)
                i = i[i < len(points) - 1]
                who.append(number[i])
                what.append(_buckets(rolled[i]))
    return np.concatenate(who), np.concatenate(what), hashes


class Words(dict):
    """Number of each distinct word, with what is known about it: hash, and sums over its n-grams."""

    def __init__(self, model: Model | None = None):
        super().__init__()
        self.model = model
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.hash = np.zeros(0, np.uint64)
        self.own = np.zeros((0, 3))  # unigram weight, sum and number of character n-grams

    def numbers(self, words: list[list[bytes]]) -> list[np.ndarray]:
        new = list(set().union(*words).difference(self))
        if new:
            at = len(self)
            self.update(zip(new, range(at, at + len(new)), strict=True))
            if self.model:
                who, what, hashes = char_features(new)
                own = np.empty((len(new), 3))
                own[:, 0] = self.model.weights[_buckets(hashes)]
                own[:, 1] = np.bincount(who, self.model.weights[what], len(new))
                own[:, 2] = np.bincount(who, minlength=len(new))
                if at + len(new) > len(self.hash):  # at least doubled, so growing costs little
                    more = max(len(new), len(self.hash))
                    self.hash = np.concatenate((self.hash, np.zeros(more, np.uint64)))
                    self.own = np.concatenate((self.own, np.zeros((more, 3))))
                self.hash[at : at + len(new)] = hashes
                self.own[at : at + len(new)] = own
        get = self.__getitem__
        return [np.fromiter(map(get, w), np.int64, len(w)) for w in words]


@dataclass
class Model:
    weights: np.ndarray
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, numbers: np.ndarray, words: Words) -> float:
        if not len(numbers):
            return self.bias
        uni, chars, n = words.own[numbers].sum(axis=0)
        out = self.bias + uni / len(numbers) + chars / max(1.0, n)
        if len(numbers) > 1:
            h = words.hash[numbers]
            with np.errstate(over="ignore"):
                out += self.weights[_buckets(h[:-1] * PAIR + h[1:])].mean()
        return float(out)

    def probability(self, margin: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30))))


def _features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of one text: each family is averaged."""
    words = (text or "").encode().split()
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    _, chars, h = char_features(words)
    families = [_buckets(h), chars]
    if len(words) > 1:
        with np.errstate(over="ignore"):
            families.append(_buckets(h[:-1] * PAIR + h[1:]))
    found = [np.unique(f, return_counts=True) for f in families if len(f)]
    return np.concatenate([f for f, _ in found]), np.concatenate([(n / n.sum()).astype(np.float32) for _, n in found])


def fit(texts: list[str | None], labels: list[int]) -> Model | None:
    """The calibrated classifier of these rows; None unless both labels occur among them."""
    return _fit([_features(t) for t in texts], labels)


def _fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int]) -> Model | None:
    y = np.asarray(labels, float)
    if len(y) < 8 or y.min() == y.max():
        return None
    model = Model(np.zeros(BUCKETS))
    squares, bias_square = np.full(BUCKETS, 1e-8), 1e-8
    held = np.arange(len(rows)) % CALIBRATE_EVERY == 0
    if len(set(y[~held])) < 2 or len(set(y[held])) < 2:
        held[:] = False
    order, rng = np.flatnonzero(~held), np.random.default_rng(7)
    for _ in range(EPOCHS):
        rng.shuffle(order)
        for at in range(0, len(order), 32):
            batch = order[at : at + 32]
            which = np.repeat(np.arange(len(batch)), [len(rows[i][0]) for i in batch])
            index = np.concatenate([rows[i][0] for i in batch])
            value = np.concatenate([rows[i][1] for i in batch])
            margin = model.bias + np.bincount(which, model.weights[index] * value, len(batch))
            error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[batch]
            touched, inverse = np.unique(index, return_inverse=True)
            slope = np.bincount(inverse, error[which] * value, len(touched)) / len(batch)
            squares[touched] += slope**2
            model.weights[touched] -= RATE * slope / np.sqrt(squares[touched])
            bias_square += error.mean() ** 2
            model.bias -= RATE * error.mean() / np.sqrt(bias_square)
    _calibrate(model, [rows[i] for i in np.flatnonzero(held)], y[held])
    return model


def _calibrate(model: Model, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> None:
    """Platt scaling: Newton steps for slope and shift on smoothed targets."""
    if not len(rows):
        return
    m = np.array([model.bias + model.weights[i] @ v for i, v in rows])
    positives = y.sum()
    target = np.where(y > 0, (positives + 1) / (positives + 2), 1 / (len(y) - positives + 2))
    x = np.stack((m, np.ones_like(m)), 1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        theta -= np.clip(np.linalg.solve(hessian, x.T @ (p - target) + 1e-3 * (theta - [1.0, 0.0])), -2, 2)
    if theta[0] > 0:
        model.slope, model.shift = theta


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> Model | None:
    """Fit on at most ``rows`` labelled rows and ``chars`` characters, chosen by a hash of the id.

    ``labels``: doc_id, quality (0 or 1; other values and nulls are left out, and of repeated ids
    the least value counts). Texts of more than SAMPLE_TEXT characters, or that would pass ``chars``,
    are skipped. One task fits, so the driver gets the model alone.
    """
    wanted = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    short = docs.select("doc_id", "text").where(F.coalesce(F.length("text"), F.lit(0)) <= SAMPLE_TEXT)
    texts = short.join(F.broadcast(wanted), "doc_id").withColumn("h", F.xxhash64("doc_id", "text"))
    sample = texts.orderBy("h", "doc_id").limit(rows).select("text", F.col("quality").cast("long").alias("quality"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, verdicts, used = [], [], 0
        for part in rows_of(batches, 64):
            for text, verdict in zip(part["text"], part["quality"], strict=True):
                if used + len(text or "") <= chars:
                    used += len(text or "")
                    found.append(_features(text))
                    verdicts.append(verdict)
        model = _fit(found, verdicts)
        if model:
            fields = [[model.weights.tobytes()], [model.bias], [model.slope], [model.shift]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in fields], ["weights", "bias", "slope", "shift"])
        del found
        trim()

    bound_batches(docs)
    fitted = sample.mapInArrow(learn, "weights binary, bias double, slope double, shift double").collect()  # a row of fixed size, or none
    return Model(np.frombuffer(fitted[0].weights), *fitted[0][1:]) if fitted else None


def repeated_words(numbers: np.ndarray) -> int:
    """Words in 3-word windows that occur twice or more."""
    if len(numbers) < 4:
        return 0
    if numbers.max() < 1 << 21:
        windows = (numbers[:-2] << 42) | (numbers[1:-1] << 21) | numbers[2:]
    else:
        _, pairs = np.unique((numbers[:-1] << 31) | numbers[1:], return_inverse=True)
        windows = (pairs[:-1] << 31) | numbers[2:]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(numbers), bool)
    for j in range(3):
        covered[j : j + len(windows)] |= twice
    return int(covered.sum())


def repeated_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in data.split(b"\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def quality(docs: DataFrame, model: Model | None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, quality_p (null where there is no model), kept.

    Null text has no words and fails the base rules. Without a model the base rules decide.
    Repeated rows are judged alike; an empty table gives no rows; other columns are ignored.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(model)
        for rows in rows_of(batches, 64):
            if len(words) > MEMO_WORDS:
                words.reset()
            data = [(t or "").encode() for t in rows["text"]]
            split = [d.split() for d in data]
            out = []
            for key, t, d, numbers in zip(rows["doc_id"], rows["text"], data, words.numbers(split), strict=True):
                n, repeats = len(numbers), repeated_words(numbers)
                failed = n < MIN_WORDS or 100 * repeats > REPEAT_PERCENT * n
                p = model.probability(model.margin(numbers, words)) if model else None
                out.append(
                    (
                        key,
                        n,
                        len(t or "") - len(d) + len(d.translate(None, SPACES)),
                        len(d) - len(d.translate(None, SYMBOLS)),
                        repeated_lines(d),
                        repeats,
                        failed,
                        p,
                        not failed and (p is None or p >= KEEP_AT),
                    )
                )
            kinds = [pa.int64()] * 6 + [pa.bool_(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], NAMES)

    bound_batches(docs)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(score, SCHEMA)


NAMES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "quality_p", "kept"]
SCHEMA = ", ".join(f"{n} {'boolean' if n in ('base_failed', 'kept') else 'double' if n == 'quality_p' else 'long'}" for n in NAMES)


def keep_good(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns: the verdict joins by no key, so repeated ids are safe."""
    bound_batches(docs)
    fields = docs.schema
    at = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        words = Words(model)
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                if len(words) > MEMO_WORDS:
                    words.reset()
                mask = []
                for numbers in words.numbers([(t or "").encode().split() for t in part.column(at).to_pylist()]):
                    failed = len(numbers) < MIN_WORDS or 100 * repeated_words(numbers) > REPEAT_PERCENT * len(numbers)
                    mask.append(not failed and (model is None or model.probability(model.margin(numbers, words)) >= KEEP_AT))
                yield part.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(keep, fields)
