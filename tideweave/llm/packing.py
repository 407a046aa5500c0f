"""Best-fit packing of token ids into sequences of fixed capacity.

Bounded-space online best fit: a fixed number of bins is open. A bitset has a bit for each amount
of free space that some open bin has, so the tightest bin that fits is found by one shift. When
nothing fits and no bin may be opened, the fullest bin closes.

Documents are cut into pieces of at most the capacity. Full pieces are sequences already. The
others are dealt by a hash of their row into groups of bounded size, each packed as a stream with
constant memory; what each group leaves open is packed again as items, until one group is left.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideweave.llm.common import bound_batches, parts_for, stored
from tideweave.llm.tokens import WordIds, rows_of

CAPACITY = 4096
OPEN_BINS = 1024
GROUP_PIECES = 1 << 16
#: Sequence numbers of a group start at multiples of this.
STRIDE = 1 << 36

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class OpenBins:
    """Open bins by free space; ``put`` gives the bin and the offset of an item, in arrival order."""

    def __init__(self, capacity: int, most: int, first: int = 0):
        self.capacity, self.most, self.next = capacity, most, first
        self.mask, self.open, self.by_free = 0, 0, defaultdict(list)

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        found = stack.pop()
        if not stack:
            self.mask ^= 1 << free
        return found

    def _keep(self, found: int, free: int) -> None:
        self.by_free[free].append(found)
        self.mask |= 1 << free

    def put(self, length: int) -> tuple[int, int]:
        fits = self.mask >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            found = self._take(free)
        else:
            if self.open == self.most:
                self._take((self.mask & -self.mask).bit_length() - 1)
                self.open -= 1
            found, free = self.next, self.capacity
            self.next += 1
            self.open += 1
        if free > length:
            self._keep(found, free - length)
        else:
            self.open -= 1
        return found, self.capacity - free

    def left(self) -> list[tuple[int, int]]:
        """(bin, fill) of the bins still open."""
        return [(b, self.capacity - free) for free, stack in self.by_free.items() for b in stack]


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Pieces of at most ``capacity`` ids of each document, its end id included."""
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordIds.of(tokenizer)
        for rows in rows_of(batches, keep=True):
            out: list[tuple] = []
            for key, ids in zip(rows["doc_id"], memo.encode(rows["text"]), strict=True):
                ids += end
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    out.append((key, n, at // 4, len(part) // 4, zlib.crc32(part)))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ("doc_id", "piece", "start", "length", "ids_crc32")
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], list(names))

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text")).mapInArrow(cut, PIECES)


def best_fit(items: DataFrame, capacity: int, open_bins: int = OPEN_BINS, group_items: int = GROUP_PIECES) -> DataFrame:
    """Places stored items (item long unique, length long of 1 to capacity): item, bin long, offset long."""
    groups = parts_for(items.count(), group_items)
    item_hash = F.xxhash64("item")
    dealt = (
        items.select("item", "length", F.pmod(item_hash, F.lit(groups)).alias("g"), item_hash.alias("h"))
        .repartition(groups, "g")
        .sortWithinPartitions("g", "h", "item")
    )

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins, group = None, None

        def rest() -> pd.DataFrame:
            return pd.DataFrame([(None, b, fill) for b, fill in bins.left()], columns=["item", "bin", "offset"]).astype(
                {"item": "Int64", "bin": "int64", "offset": "int64"}
            )

        for frame in frames:
            for g, part in frame.groupby("g", sort=True):
                if g != group:
                    if bins:
                        yield rest()
                    bins, group = OpenBins(capacity, open_bins, int(g) * STRIDE), g
                put = [bins.put(n) for n in part["length"].tolist()]
                yield pd.DataFrame({"item": part["item"].to_numpy(), "bin": [b for b, _ in put], "offset": [o for _, o in put]})
        if bins:
            yield rest()

    placed = stored(dealt.mapInPandas(place, "item long, bin long, offset long"), "placed")
    inside = placed.where("item IS NOT NULL")
    if groups == 1:
        return inside
    left = placed.where("item IS NULL").select(F.col("bin").alias("item"), F.col("offset").alias("length"))
    # Each level has at most open_bins / group_items of the items of the one before.
    outer = best_fit(left, capacity, open_bins, max(group_items, 8 * open_bins))
    outer = outer.select(F.col("item").alias("bin"), F.col("bin").alias("outer"), F.col("offset").alias("base"))
    return inside.join(outer, "bin", "left").select(
        "item",
        # Bins that were open at the end of a group move as a whole; the others keep their numbers.
        F.coalesce(F.col("outer") + F.lit(1 << 60), "bin").alias("bin"),
        (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset"),
    )


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS,
    group_pieces: int = GROUP_PIECES,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is a piece with the end id only. Rows that repeat a doc_id are documents of
    their own. An empty table gives no rows. Other columns are ignored.
    """
    bound_batches(docs)
    cut = stored(
        pieces(docs, tokenizer, end_id, capacity, text, doc_id).withColumn("item", F.monotonically_increasing_id()), "pieces"
    )
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    full = cut.where(F.col("length") == capacity).select(
        *columns, (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    part = cut.where(F.col("length") < capacity)
    placed = best_fit(part, capacity, open_bins, group_pieces)
    return part.join(placed, "item").select(*columns, F.col("bin").alias("sequence_id"), "offset").unionByName(full)
