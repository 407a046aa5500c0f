"""Language identification by a linear-chain conditional random field over words.

Each word has features: itself (lexicon), the n-grams anchored at its ends (affixes) and those
within it. The labels of neighbouring words are tied by learned transitions, and forward-backward
gives each word's posterior, so code-switched text gets word-level labels. A document's language is
the one with the largest mean posterior over its words with a letter.

Training documents carry one language each. To learn transitions, sequences are made by joining
stretches of different documents, with a switch of document after each word at a fixed rate.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideweave.llm.common import bound_batches, fold_of
from tideweave.llm.quality import BUCKETS, _buckets, char_features
from tideweave.llm.tokens import rows_of

#: Bounds of the training sample: documents per language, and characters in all.
SAMPLE_DOCS = 150
SAMPLE_CHARS = 8_000_000

NGRAMS = (2, 3, 4, 5)
SWITCH, SEQUENCE, BATCH, EPOCHS, RATE = 0.05, 48, 64, 4, 0.3
MEMO_WORDS = 1 << 19
#: Documents read at once, and cells (words x documents) of one padded forward-backward.
ROWS, CELLS = 1024, 1 << 20


def has_letter(word: str) -> bool:
    return any(map(str.isalpha, word))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().split()


@dataclass
class Crf:
    langs: list[str]
    weights: np.ndarray  # bucket x label
    moves: np.ndarray  # label x label, from and to

    def emissions(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Score of each label for each word (zero for words without a letter), and whether it has a letter."""
        letters = np.array([has_letter(w.decode()) for w in words], bool)
        rows, starts, _ = _sparse(words)
        sizes = np.diff(starts)[:, None]
        # The last feature of a word is the word itself; the others are averaged.
        found = self.weights[rows]
        total = np.add.reduceat(found, starts[:-1], axis=0) if len(words) else np.zeros((0, len(self.langs)))
        own = found[starts[1:] - 1]
        return ((total - own) / np.maximum(1, sizes - 1) + own) * letters[:, None], letters


def _sparse(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all words' features, where each word's begin, and their values."""
    who, what, hashes = char_features(words, NGRAMS)
    n = len(words)
    who = np.concatenate((who, np.arange(n)))
    what = np.concatenate((what, _buckets(hashes)))
    order = np.argsort(who, kind="stable")
    starts = np.concatenate(([0], np.cumsum(np.bincount(who, minlength=n))))
    sizes = np.diff(starts)
    values = 1 / np.maximum(1, np.repeat(sizes, sizes) - 1)
    values[starts[1:] - 1] = 1
    return what[order], starts, values


def forward_backward(e: np.ndarray, moves: np.ndarray, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors (steps x documents x labels), and the scaled forward messages.

    ``e``: emissions as factors; ``moves``: transitions as factors; ``alive``: documents that still
    have a word at each step, which come first.
    """
    steps, docs, labels = e.shape
    forward = np.zeros_like(e)
    back = np.ones((docs, labels), e.dtype)
    forward[0] = e[0] / e[0].sum(axis=1, keepdims=True)
    for t in range(1, steps):
        n = alive[t]
        a = (forward[t - 1, :n] @ moves) * e[t, :n]
        forward[t, :n] = a / a.sum(axis=1, keepdims=True)
    posterior = np.zeros_like(e)
    for t in range(steps - 1, -1, -1):
        n = alive[t]
        p = forward[t, :n] * back[:n]
        posterior[t, :n] = p / p.sum(axis=1, keepdims=True)
        b = (e[t, :n] * back[:n]) @ moves.T
        back[:n] = b / b.sum(axis=1, keepdims=True)
    return posterior, forward


def fit(texts: list[str], langs: list[str]) -> Crf | None:
    """Maximise the likelihood of the labels of joined stretches, by Adagrad over mini-batches."""
    labels = sorted(set(langs))
    docs = [([w for w in words_of(t) if has_letter(w.decode())], labels.index(g)) for t, g in zip(texts, langs, strict=True)]
    docs = [d for d in docs if d[0]]
    if not docs:
        return None
    names = sorted({w for d, _ in docs for w in d})
    number = dict(zip(names, range(len(names)), strict=True))
    what, starts, values = _sparse(names)
    rng = np.random.default_rng(11)
    by_label = [np.concatenate([np.array([number[w] for w in d]) for d, y in docs if y == k] or [np.zeros(0, np.int64)]) for k in range(len(labels))]
    present = [k for k in range(len(labels)) if len(by_label[k])]
    crf = Crf([labels[k] for k in present], np.zeros((BUCKETS, len(present)), np.float32), np.zeros((len(present), len(present))))
    by_label = [by_label[k] for k in present]
    n_labels = len(present)
    squares, move_squares = np.full(crf.weights.shape, 1e-6, np.float32), np.full(crf.moves.shape, 1e-6)
    rounds = max(1, EPOCHS * sum(map(len, by_label)) // (SEQUENCE * BATCH))
    for _ in range(rounds):
        # Words and labels of a batch: each place keeps its label or switches to another at the fixed rate.
        y = np.empty((SEQUENCE, BATCH), np.int64)
        y[0] = rng.integers(n_labels, size=BATCH)
        for t in range(1, SEQUENCE):
            y[t] = np.where(rng.random(BATCH) < SWITCH, rng.integers(n_labels, size=BATCH), y[t - 1])
        x = np.empty_like(y)
        for k in range(n_labels):
            here = np.flatnonzero(y == k)
            # consecutive words of the label's documents, from a random place for each sequence
            place = rng.integers(len(by_label[k]), size=BATCH)[here % BATCH] + here // BATCH
            x.flat[here] = by_label[k][place % len(by_label[k])]
        used, inverse = np.unique(x, return_inverse=True)
        sizes = starts[used + 1] - starts[used]
        flat = np.repeat(starts[used] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
        rows, share = what[flat], values[flat].astype(np.float32)
        begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        scores = np.add.reduceat(crf.weights[rows] * share[:, None], begins, axis=0)[inverse].reshape(SEQUENCE, BATCH, n_labels)
        e = np.exp(scores - scores.max(axis=2, keepdims=True)).astype(np.float64)
        factors = np.exp(crf.moves)
        posterior, forward = forward_backward(e, factors, np.full(SEQUENCE, BATCH))
        slope = posterior.copy()
        np.put_along_axis(slope, y[..., None], np.take_along_axis(slope, y[..., None], 2) - 1, 2)
        # Expected moves: forward message, move, and the next word's posterior over what it received.
        received = np.maximum(forward[:-1] @ factors, 1e-300)
        expected = np.einsum("tbi,tbj->ij", forward[:-1], posterior[1:] / received) * factors
        seen = np.zeros_like(factors)
        np.add.at(seen, (y[:-1].ravel(), y[1:].ravel()), 1)
        step = (expected - seen) / BATCH
        move_squares += step**2
        crf.moves -= RATE * step / np.sqrt(move_squares)
        by_word = np.zeros((len(used), n_labels), np.float32)
        for k in range(n_labels):
            by_word[:, k] = np.bincount(inverse.ravel(), slope[..., k].ravel(), len(used))
        touched, at = np.unique(rows, return_inverse=True)
        spread = np.repeat(by_word, sizes, axis=0) * share[:, None] / BATCH
        gradient = np.stack([np.bincount(at, spread[:, k], len(touched)) for k in range(n_labels)], 1)
        squares[touched] += gradient**2
        crf.weights[touched] -= RATE * gradient / np.sqrt(squares[touched])
    return crf


def train(docs: DataFrame, per_lang: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> Crf | None:
    """Fit on about ``per_lang`` documents of each language (chosen by a hash of the id), ``chars`` characters at most.

    Each language has an equal share of the characters; a text that would pass it, or half of it alone,
    is skipped. Only text and lang of documents whose fold is not 0 are used; null languages and texts
    are left out.
    """
    rows = docs.select("doc_id", "text", "lang").where((fold_of(F.col("doc_id")) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.join(F.broadcast(counts), "lang").where(share < F.lit(1.0 * per_lang) / F.col("n"))
    each = chars // max(1, counts.count())
    sample, used = [], Counter()
    for row in chosen.where(F.length("text") <= each // 2).select("text", "lang").orderBy(F.xxhash64("doc_id"), "text").toLocalIterator():
        if used[row.lang] + len(row.text) <= each:
            used[row.lang] += len(row.text)
            sample.append((row.text, row.lang))
    return fit([t for t, _ in sample], [g for _, g in sample])


class Emissions(dict):
    """Number of each distinct word; its emission factors and whether it has a letter."""

    def __init__(self, crf: Crf):
        super().__init__()
        self.crf = crf
        self.factors, self.letters = np.zeros((0, len(crf.langs)), np.float32), np.zeros(0, bool)

    def numbers(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self) > MEMO_WORDS:
            self.clear()
        words = [words_of(t) for t in texts]
        new = list(set().union(*words).difference(self))
        if new:
            at = len(self)
            self.update(zip(new, range(at, at + len(new)), strict=True))
            scores, letters = self.crf.emissions(new)
            factors = np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -30))
            self.factors = np.concatenate((self.factors[:at], factors.astype(np.float32)))
            self.letters = np.concatenate((self.letters[:at], letters))
        return [np.fromiter(map(self.__getitem__, w), np.int64, len(w)) for w in words]


def posteriors(crf: Crf, words: Emissions, docs: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """(position in ``docs``, posterior of each word and label), documents without a word left out."""
    moves = np.exp(crf.moves).astype(np.float32)
    order = sorted((i for i in range(len(docs)) if len(docs[i])), key=lambda i: -len(docs[i]))
    while order:
        steps = len(docs[order[0]])
        group = order[: max(1, CELLS // steps)]
        order = order[len(group) :]
        lengths = np.array([len(docs[i]) for i in group])
        alive = np.searchsorted(-lengths, -np.arange(steps), side="left")
        e = np.ones((steps, len(group), len(crf.langs)), np.float32)
        for j, i in enumerate(group):
            e[: lengths[j], j] = words.factors[docs[i]]
        posterior, _ = forward_backward(e, moves, alive)
        for j, i in enumerate(group):
            yield i, posterior[: lengths[j], j]


def identify(docs: DataFrame, crf: Crf | None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out (fold 0), lang_pred, score.

    ``und`` with score 0 if the text is null or has no letter, or if nothing was learned. Prediction
    reads the text alone. Repeated rows are judged alike; an empty table gives no rows.
    """

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Emissions(crf) if crf else None
        for rows in rows_of(batches, ROWS):
            names, scores = ["und"] * len(rows["text"]), [0.0] * len(rows["text"])
            if crf:
                numbers = words.numbers(rows["text"])
                for i, posterior in posteriors(crf, words, numbers):
                    letters = words.letters[numbers[i]]
                    if letters.any():
                        mean = posterior[letters].mean(axis=0, dtype=np.float64)
                        names[i], scores[i] = crf.langs[int(mean.argmax())], min(1.0, float(mean.max()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["doc_id"], pa.int64()), pa.array(rows["held_out"], pa.bool_()), pa.array(names), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    bound_batches(docs)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), (fold_of(F.col(doc_id)) == 0).alias("held_out"), F.col(text).alias("text"))
    return rows.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double")


def label_words(text: str, crf: Crf) -> list[tuple[str, str, float]]:
    """(word, language, posterior) of each word of one text, for code-switched text."""
    words = Emissions(crf)
    numbers = words.numbers([text])
    out: list[tuple[str, str, float]] = []
    for _, posterior in posteriors(crf, words, numbers):
        best = posterior.argmax(axis=1)
        out = [(w.decode(), crf.langs[k], float(p[k])) for w, k, p in zip(words_of(text), best, posterior, strict=True)]
    return out
