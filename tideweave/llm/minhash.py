"""Near-duplicate classes by consistent weighted sampling.

A document is a weighted set of 5-word shingles: weight = occurrences x damped inverse document
frequency. Improved consistent weighted sampling draws, for each of BANDS x ROWS hash functions, one
(shingle, step) that two documents share with probability equal to their weighted Jaccard
similarity. ROWS samples make a band; documents that share a band are candidates, and candidates
are verified by the weighted Jaccard similarity of their whole shingle sets.

Document frequencies come from a count sketch of fixed size over all documents: it is exact enough
where it matters, since only shingles in one of IDF_SHARE documents or more are damped.

Equal word sequences share a key and are one node. Within a bucket of equal bands no pairs are
spelled out: each member is compared with at most four pivots, which connects most of what belongs
together. Members of buckets that are not one component then meet by prefix filtering, which is
exact: of two components, only members that may still reach the threshold are compared. So no link
between members of a bucket is lost.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideweave.llm.common import bound_batches, join_by_size, stored, trim
from tideweave.llm.components import components
from tideweave.llm.exact_dedup import hit_filter, with_hit
from tideweave.llm.tokens import rows_of

WORDS, THRESHOLD = 5, 0.8
#: At similarity 0.8 a pair shares no band with probability 0.0002.
BANDS, ROWS = 16, 4
SAMPLES = BANDS * ROWS

#: Weight of a rare shingle above one in every document is 1 + IDF_GAIN; see idf().
IDF_GAIN, IDF_SHARE = 0.25, 1024
#: The sketch: two rows of counters, whatever the input.
SKETCH_BITS, SKETCH_ROWS, CHUNKS = 20, 2, 32
MEMO_WORDS = 400_000

#: The sampling variates: gamma(2, 1) r and c, uniform beta, for 65,536 hash values.
_rng = np.random.default_rng(40_961)
R = _rng.gamma(2, 1, 1 << 16)
LN_C = np.log(_rng.gamma(2, 1, 1 << 16))
BETA = _rng.random(1 << 16)
ODD = _rng.integers(1 << 62, size=SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SKETCH_ODD = _rng.integers(1 << 62, size=SKETCH_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
del _rng
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * M2
    h = (h ^ (h >> np.uint64(29))) * M1
    return h ^ (h >> np.uint64(32))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMO_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().split()


def key_of(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def shingles(words: list[bytes], memo: dict) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the distinct shingles and their occurrences; fewer words than five are one shingle."""
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    if not len(h):
        return h, np.zeros(0, np.int64)
    n = min(WORDS, len(h))
    with np.errstate(over="ignore"):
        out = np.full(len(h) - n + 1, n, np.uint64)
        for i in range(n):
            out = out * M1 + h[i : len(h) - n + 1 + i]
        return np.unique(_mix(out), return_counts=True)


def _places(hashes: np.ndarray) -> Iterator[np.ndarray]:
    with np.errstate(over="ignore"):
        for odd in SKETCH_ODD:
            yield ((hashes * odd) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def sketch(docs: DataFrame) -> tuple[np.ndarray, int]:
    """(counters, documents): in how many rows of ``docs`` (text) a shingle of each place occurs."""
    return _sketch(docs.select("text"), lambda rows, memo: [shingles(words_of(t), memo)[0] for t in rows["text"]])


def _sketch(docs: DataFrame, hashes_of: Callable) -> tuple[np.ndarray, int]:

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, total = WordHashes(), np.zeros((SKETCH_ROWS, 1 << SKETCH_BITS), np.uint32)
        n = 0
        for rows in rows_of(batches):
            found = hashes_of(rows, memo)
            n += len(found)
            for row, place in enumerate(_places(np.concatenate(found))):
                total[row] += np.bincount(place, minlength=1 << SKETCH_BITS).astype(np.uint32)
        if n:
            blobs = [zlib.compress(x.tobytes(), 1) for x in np.split(total.ravel(), CHUNKS)]
            yield pa.RecordBatch.from_arrays([pa.array([*range(CHUNKS), -1]), pa.array([*blobs, str(n).encode()], pa.binary())], ["chunk", "counts"])

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray | int] = {}
        for frame in frames:
            for chunk, blob in zip(frame["chunk"], frame["counts"], strict=True):
                new = int(blob) if chunk < 0 else np.frombuffer(zlib.decompress(blob), np.uint32).astype(np.uint64)
                sums[chunk] = sums.get(chunk, 0) + new
        for chunk, x in sums.items():
            yield pd.DataFrame({"chunk": [chunk], "counts": [str(x).encode() if chunk < 0 else zlib.compress(x.tobytes(), 1)]})

    parts = docs.mapInArrow(count, "chunk long, counts binary")
    summed = parts.repartition(CHUNKS, "chunk").mapInPandas(add, "chunk long, counts binary")
    total = np.zeros((CHUNKS, SKETCH_ROWS << SKETCH_BITS - 5), np.uint64)
    n = 0
    for row in summed.collect():  # CHUNKS rows of fixed size
        if row.chunk < 0:
            n = int(row.counts)
        else:
            total[row.chunk] = np.frombuffer(zlib.decompress(row.counts), np.uint64)
    return total.reshape(SKETCH_ROWS, -1), n


def levels(counters: np.ndarray, n: int) -> np.ndarray:
    """0 for places below the share of documents that is damped, then 1 more for each doubling."""
    least = max(2, n // IDF_SHARE)
    return np.where(counters < least, 0, 1 + np.log2(np.maximum(counters, 1) / least).clip(0, 40)).astype(np.uint8)


def idf(n: int) -> np.ndarray:
    """Weight by level: 1 + IDF_GAIN for rare shingles, falling to 1 with the logarithm of the frequency."""
    least = max(2, n // IDF_SHARE)
    df = np.concatenate(([1.0], np.minimum(least * 2.0 ** np.arange(41), max(n, 1))))
    return 1 + IDF_GAIN * (1 - np.log(df) / np.log(max(n, 2)))


class Weights:
    """Weights of shingles, and the consistent samples of a weighted set."""

    def __init__(self, level: np.ndarray, n: int):
        self.level, self.idf = level, idf(n)
        # ln a and step of a shingle of the commonest weight, by hash value.
        self.base = self.idf[0]
        self.base_step, self.base_a = self._draw(np.arange(1 << 16), np.log(self.base))
        self.base_a32 = self.base_a.astype(np.float32)

    @staticmethod
    def _draw(value: np.ndarray, ln_weight: np.ndarray | float) -> tuple[np.ndarray, np.ndarray]:
        step = np.floor(ln_weight / R[value] + BETA[value])
        return step, LN_C[value] - R[value] * (step - BETA[value] + 1)

    def of(self, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        level = None
        for row, place in zip(self.level, _places(hashes), strict=True):
            found = row[place]
            level = found if level is None else np.minimum(level, found)
        return counts * self.idf[level]

    def samples(self, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """One 64-bit sample for each hash function; equal between two sets with their weighted Jaccard similarity."""
        with np.errstate(over="ignore"):
            value = ((hashes[:, None] * ODD) >> np.uint64(48)).astype(np.uint16)
            a = self.base_a32[value]
            other = np.flatnonzero(weights != self.base)
            steps = None
            if len(other):
                steps, exact = self._draw(value[other], np.log(weights[other])[:, None])
                a[other] = exact
            best = a.argmin(axis=0)
            column = np.arange(SAMPLES)
            step = self.base_step[value[best, column]]
            if len(other):
                at = np.searchsorted(other, best).clip(0, len(other) - 1)
                mine = other[at] == best
                step[mine] = steps[at[mine], column[mine]]
            return _mix(hashes[best] + step.astype(np.int64).astype(np.uint64) * M1 + column.astype(np.uint64))

    def bands(self, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        s = self.samples(hashes, weights).reshape(BANDS, ROWS)
        with np.errstate(over="ignore"):
            out = np.arange(BANDS).astype(np.uint64)
            for j in range(ROWS):
                out = _mix(out * M2 + s[:, j])
        return out.astype(np.int64)


def jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two (sorted hashes, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    wa, wb = a[1][i], b[1][j]
    least = np.minimum(wa, wb).sum()
    return float(least / (a[1].sum() + b[1].sum() - least)) if least else 0.0


def _signatures(docs: DataFrame, weights: Weights) -> DataFrame:
    """doc_id, text_hash, key, words, bands (null for texts without a word)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for rows in rows_of(batches):
            keys, sizes, bands = [], [], []
            for t in rows["text"]:
                words = words_of(t)
                hashes, counts = shingles(words, memo)
                keys.append(key_of(words))
                sizes.append(len(words))
                bands.append(weights.bands(hashes, weights.of(hashes, counts)) if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(rows[c], pa.int64()) for c in ("doc_id", "text_hash")), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "text_hash", "key", "words", "bands"],
            )

    return docs.mapInArrow(sign, "doc_id long, text_hash long, key binary, words long, bands array<long>")


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(blob) // 12
    return np.frombuffer(blob, np.uint64, n), np.frombuffer(blob, np.uint32, n, 8 * n)


def _sets(docs: DataFrame) -> DataFrame:
    """key, hashes and counts of the shingles of each row."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for rows in rows_of(batches):
            keys, blobs = [], []
            for t in rows["text"]:
                words = words_of(t)
                hashes, counts = shingles(words, memo)
                keys.append(key_of(words))
                blobs.append(hashes.tobytes() + counts.astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(blobs, pa.binary())], ["key", "shingles"])

    return docs.mapInArrow(pack, "key binary, shingles binary")


def _verify(pairs: DataFrame, sets: DataFrame, weights: Weights) -> DataFrame:
    """(a, b, similarity) of pairs (a, b)."""

    def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
        hashes, counts = _unpack(blob)
        return hashes, weights.of(hashes, counts)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        for batch in batches:
            a, b = batch.column("a"), batch.column("b")
            left, right = batch.column("left"), batch.column("right")
            last, mine, out = None, None, []
            for i in range(batch.num_rows):
                blob = left[i].as_buffer().to_pybytes()
                if blob != last:
                    last, mine = blob, unpack(blob)
                out.append(jaccard(mine, unpack(right[i].as_buffer().to_pybytes())))
            yield pa.RecordBatch.from_arrays([a, b, pa.array(out, pa.float64())], ["a", "b", "similarity"])

    joined = (
        pairs.join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("left")), "a")
        .join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("right")), "b")
        .select("a", "b", "left", "right")
    )
    return stored(joined.mapInArrow(compare, "a binary, b binary, similarity double"), "similar")


def _prefix_pairs(loose: DataFrame, weights: Weights, threshold: float) -> DataFrame:
    """(a, b) of different roots that may reach the threshold, of ``loose`` (key, root, shingles).

    In one order of all shingles, rarest first, the first shingle that two sets share leaves at least
    their overlap behind it. So if their similarity reaches the threshold, that shingle lies in both
    prefixes, where what is left from it on weighs at least the threshold times the set; and what is
    left in either weighs at least the overlap that the two sets' weights ask for. Any order is
    right; a good one, here by a sketch over these sets, puts what a text has to itself first.
    """
    counters = _sketch(loose.select("shingles"), lambda rows, memo: [_unpack(b)[0] for b in rows["shingles"]])[0]

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(batches):
            for key, root, blob in zip(rows["key"], rows["root"], rows["shingles"], strict=True):
                hashes, counts = _unpack(blob)
                weight = weights.of(hashes, counts)
                seen = np.min([c[p] for c, p in zip(counters, _places(hashes), strict=True)], axis=0)
                order = np.lexsort((hashes, seen))
                left = weight[order][::-1].cumsum()[::-1]
                total = weight.sum()
                inside = left >= threshold * total * (1 - 1e-9)
                prefix = hashes[order[inside]].astype(np.int64)
                n = len(prefix)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array(x) for x in (prefix, left[inside], np.full(n, total))),
                        *(pa.array([x] * n, pa.binary()) for x in (key, root)),
                    ],
                    ["shingle", "left", "total", "key", "root"],
                )

    found = stored(loose.mapInArrow(prefixes, "shingle long, left double, total double, key binary, root binary"), "prefixes")
    spread = found.groupBy("shingle").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("shingle")
    some = found.join(spread, "shingle")
    x, y = some.alias("x"), some.alias("y")
    # Sets of weights X and Y reach the threshold t if they share t / (1 + t) * (X + Y) or more.
    shared = threshold / (1 + threshold) * (1 - 1e-9)
    enough = F.least("x.left", "y.left") >= shared * (F.col("x.total") + F.col("y.total"))
    joined = x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.root") < F.col("y.root")) & enough)
    return joined.select(*_pairs(F.col("x.key"), F.col("y.key"))).distinct()


def _pairs(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, class_size, links, kept.

    class_id is the least doc_id of the class (null only if all its ids are null) and class_size its
    rows. Rows with equal words (case aside) are of one class. ``links``: pairs of the row's text
    with others that were compared and verified; members of a class already connected are not compared,
    so it may be far below the number of its near copies. ``kept``: the row with the class's least doc_id; of repeated ids the row is
    kept each time. Rows without a word are in no class with others: class_id is their own doc_id.
    An empty table gives no rows; other columns are ignored.
    """
    return _near_duplicates(docs, text, doc_id, threshold).drop("text_hash")


def _near_duplicates(docs: DataFrame, text: str, doc_id: str, threshold: float) -> DataFrame:
    bound_batches(docs)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), _text_hash(F.col(text)).alias("text_hash"))
    counters, n = sketch(rows)
    weights = Weights(levels(counters, n), n)
    signed = stored(_signatures(rows, weights), "signatures")
    worded = signed.where("words > 0")
    # One node per distinct word sequence, in the order of its key.
    nodes = worded.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))
    bands = nodes.select("key", "doc_id", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(bands.join(shared, "band"), "members")
    # The member with the most company is the likeliest to be near all others: the first pivot.
    degrees = members.groupBy("key").agg(F.sum("n").alias("degree"))
    second = lambda c: F.xxhash64(c)  # noqa: E731  another order of the members
    pivots = members.join(degrees, "key").groupBy("band").agg(
        F.max_by("key", F.struct("degree", "key")).alias("p0"),
        F.min("key").alias("p1"),
        F.max("key").alias("p2"),
        F.min_by("key", second("key")).alias("p3"),
        F.count("*").alias("size"),
    )
    # By size, as the bucket of a large group of near copies may hold a third of all members.
    pivots = stored(pivots.select("band", F.array("p0", "p1", "p2", "p3").alias("pivots"), "size"), "pivots")
    paired = join_by_size(members.select("key", "band"), pivots, "band", "size")

    first = paired.select("key", F.explode(F.array_distinct("pivots")).alias("pivot")).where("key <> pivot")
    first = stored(first.select(*_pairs(F.col("key"), F.col("pivot"))).distinct(), "pairs")
    # Shingle sets of candidates only: a bitmap of bounded size picks their rows out of the documents.
    wanted = members.select("doc_id", "key").distinct()
    named = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    hits = hit_filter(wanted.select(named.alias("digest"), F.lit(2).alias("copies")))
    chosen = with_hit(rows.withColumn("digest", named), hits).where("hit").select("text")
    sets = stored(_sets(chosen).dropDuplicates(["key"]), "sets")
    near = _verify(first, sets, weights)

    labels = components(near.where(F.col("similarity") >= threshold).select("a", "b"))
    roots = members.select("band", "key").join(labels.withColumnRenamed("node", "key"), "key", "left")
    roots = roots.withColumn("root", F.coalesce("root", "key"))
    mixed = roots.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("band")
    loose = stored(roots.join(mixed, "band").select("key", "root").distinct().join(sets, "key"), "loose")
    rest = _prefix_pairs(loose, weights, threshold)
    more = _verify(rest.join(near.select("a", "b"), ["a", "b"], "left_anti"), sets, weights)

    links = near.unionByName(more).where(F.col("similarity") >= threshold).select("a", "b")
    roots = components(links)
    degree = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(F.count("*").alias("links"))
    classes = (
        nodes.select("key")
        .join(roots.withColumnRenamed("node", "key"), "key", "left")
        .join(degree.withColumnRenamed("a", "key"), "key", "left")
        .select("key", F.coalesce("root", "key").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    )
    placed = stored(worded.select("doc_id", "text_hash", "key").join(classes, "key"), "classes")
    sizes = stored(placed.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size")), "class-sizes")
    found = join_by_size(placed, sizes, "root", "class_size").select("doc_id", "text_hash", "class_id", "class_size", "links")
    none = signed.where("words = 0").select("doc_id", "text_hash", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(0).cast("long").alias("links"))
    return found.unionByName(none).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")), F.length(text))


def keep_one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; rows of equal id and text go together."""
    dropped = _near_duplicates(docs, text, doc_id, THRESHOLD).where(~F.col("kept"))
    dropped = dropped.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_text_hash")).distinct()
    rows = docs.withColumn("_hash", _text_hash(docs[text]))
    same = rows[doc_id].eqNullSafe(dropped["_id"]) & (rows["_hash"] == dropped["_text_hash"])
    return rows.join(dropped, same, "left_anti").select(*docs.columns)
