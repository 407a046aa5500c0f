"""Mixing sources to target weights by blocks.

Each source's documents form a stream of words, cut into blocks of fixed length. The budget is split
over sources by weight, no source taking more than a fixed multiple of its size; what a source is to
give is a number of slots, each filled by a block. The slots are dealt to the output shards by
multinomial draws, so every shard is a sample of the mix, and totals meet the targets exactly. A
source's slots run through its blocks in the order of a pseudorandom permutation, a new one for each
pass, so a block is taken as often as there are passes, give or take one. Slots and blocks then join
by source and block index.

Words are counted, not copied: the result says how many words of each document the mix takes.
Sources are rows of a DataFrame throughout; the driver gets sums over them only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideweave.llm.common import WORD, parts_for, stored
from tideweave.operators.graph import ranked

#: Weights of the sources in order of their code points, null last; they repeat.
WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2.0
BLOCK = 128
SHARD_SLOTS = 1 << 13
#: Rows of one source and bucket, which one task sums.
BUCKET_ROWS = 1_000
#: Buckets of one source whose sums one task adds up; their totals are added up in turn.
RUN = 1 << 10
#: Slots of one source that are dealt at once.
AT_ONCE = 1 << 16
#: Sources are ranked in buckets of equal first bytes.
PREFIX = 8


def with_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``sources`` (source, source_size) with source_no, their rank by code point (null last), and target.

    ``share`` of all words is dealt by weight; targets above ``most`` times a source's size stop
    there, and the excess is dealt anew by weight until none is above. What stops once stays stopped,
    since every deal anew raises the others.
    """
    n, total = sources.agg(F.count("*"), F.coalesce(F.sum("source_size"), F.lit(0))).first()
    ranks = ranked(sources, [], "source", "_rank", PREFIX)
    rows = sources.join(ranks, "source", "left").withColumn("source_no", F.coalesce("_rank", F.lit(n)).cast("long")).drop("_rank")
    rows = stored(rows, "sources")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), F.pmod(F.col("source_no") - 1, F.lit(len(weights))).cast("int") + 1)
    most_of = F.lit(float(most)) * F.col("source_size")
    over = F.lit(False)
    while True:
        held, of, stopped = rows.agg(*(F.coalesce(F.sum(F.when(c, x)), F.lit(0.0)) for c, x in ((over, most_of), (~over, weight), (over, F.lit(1.0))))).first()
        if not of:
            return rows.withColumn("target", most_of)
        dealt = F.lit(share * total - held) * weight / F.lit(of)
        more = rows.where(dealt > most_of).count()
        if more <= stopped:
            return rows.withColumn("target", F.when(over, most_of).otherwise(dealt))
        over = dealt > most_of


def shuffled(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Where a keyed pseudorandom permutation of 0 to n - 1 takes each index (Feistel, cycle walking)."""
    half = max(1, (max(2, n) - 1).bit_length() + 1 >> 1)
    mask = np.uint64((1 << half) - 1)
    out = index.astype(np.uint64)
    todo = np.ones(len(out), bool)
    with np.errstate(over="ignore"):
        while todo.any():
            x = out[todo]
            left, right = x >> np.uint64(half), x & mask
            for r in range(4):
                h = (right + np.uint64((key * 4 + r) & (1 << 63) - 1)) * np.uint64(0x9E3779B97F4A7C15)
                h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
                left, right = right, left ^ ((h ^ (h >> np.uint64(29))) & mask)
            out[todo] = left << np.uint64(half) | right
            todo[todo] = out[todo] >= n
    return out.astype(np.int64)


def _slots(sources: DataFrame, shard_slots: int, seed: int) -> DataFrame:
    """shard, source_no, block of every slot of ``sources`` (source_no, blocks, owed)."""
    total = sources.agg(F.sum("owed")).first()[0]
    shards = parts_for(total, shard_slots)

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                slot = np.arange(row.first, min(row.first + AT_ONCE, row.owed))
                turn, place = np.divmod(slot, row.blocks)
                block = np.empty_like(place)
                for e in np.unique(turn):
                    block[turn == e] = shuffled(place[turn == e], row.blocks, hash((seed, row.source_no, int(e))))
                # The counts of a multinomial draw over the shards, in order of the slots.
                shard = np.sort(np.random.default_rng([seed, row.source_no, row.first]).integers(shards, size=len(slot)))
                yield pd.DataFrame({"shard": shard, "source_no": row.source_no, "block": block})

    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("owed") - 1, F.lit(AT_ONCE).cast("long"))).alias("first")
    ranges = sources.where("owed > 0").select("source_no", "blocks", "owed", first)
    return ranges.repartition(parts_for(total, 2 * AT_ONCE), "source_no", "first").mapInPandas(deal, "shard long, source_no long, block long")


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    block: int = BLOCK,
    shard_slots: int = SHARD_SLOTS,
    seed: int = 20,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken.

    Null text has no words; such rows and empty texts are taken 0 times. Null is a source of its own.
    No document gives more than ``most`` (a whole number of passes) times its size. Rows that repeat
    a doc_id are documents of their own. An empty table gives no rows; other columns are ignored.
    """
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    rows = stored(
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).alias("source"), size.alias("size")).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "sizes",
    )
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    sources = with_targets(sources, weights, share, most)
    # Slots are of the mean length of the source's blocks.
    blocks = F.ceil(F.col("source_size") / block)
    owed = F.least(F.lit(int(most)) * F.col("blocks"), F.round(F.col("target") * F.col("blocks") / F.greatest("source_size", F.lit(1))).cast("long"))
    sources = stored(sources.withColumn("blocks", blocks).withColumn("owed", owed), "targets")
    known = sources.select("source_no", F.col("source").alias("_source"), "source_size", "target")
    rows = rows.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("source", "_source")
    slots, most_docs = sources.agg(F.sum("owed"), F.max("docs")).first()
    if not slots:
        return rows.select("doc_id", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"))

    # Place of each document in its source's stream: by bucket, then by id. Buckets split large sources.
    buckets = parts_for(most_docs, BUCKET_ROWS)
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size"), F.lit(buckets)))
    sums = dealt.groupBy("source_no", "bucket").agg(F.sum("size").alias("n")).withColumn("run", F.floor(F.col("bucket") / RUN))
    up_to = lambda by, at: F.coalesce(F.sum("n").over(W.partitionBy(*by).orderBy(at).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    runs = sums.groupBy("source_no", "run").agg(F.sum("n").alias("n")).withColumn("base", up_to(["source_no"], "run"))
    sums = sums.withColumn("_in_run", up_to(["source_no", "run"], "bucket")).join(runs.select("source_no", "run", "base"), ["source_no", "run"])
    sums = sums.select("source_no", "bucket", (F.col("base") + F.col("_in_run")).alias("base"))
    within = W.partitionBy("source_no", "bucket").orderBy("doc_id", "size", "row").rowsBetween(W.unboundedPreceding, -1)
    placed = (
        dealt.withColumn("at", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .join(sums, ["source_no", "bucket"])
        .withColumn("at", F.col("at") + F.col("base"))
    )
    spans = placed.where("size > 0").select(
        "row",
        "source_no",
        "at",
        (F.col("at") + F.col("size")).alias("end"),
        F.explode(F.sequence((F.col("at") / block).cast("long"), ((F.col("at") + F.col("size") - 1) / block).cast("long"))).alias("block"),
    )
    times = _slots(sources, shard_slots, seed).groupBy("source_no", "block").agg(F.count("*").alias("times"))
    words = F.least("end", (F.col("block") + 1) * block) - F.greatest("at", F.col("block") * block)
    # Both grow with the documents, which Spark cannot see from the few sources they come from.
    taken = spans.join(times.hint("merge"), ["source_no", "block"]).groupBy("row").agg(F.sum(words * F.col("times")).alias("taken"))
    return rows.join(taken.hint("merge"), "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mixed_documents(docs: DataFrame, seed: int = 20, text: str = "text", doc_id: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, whole.

    A document of which the mix takes t times its size is repeated floor(t) times, and once more
    with probability t - floor(t), by a hash of its id; so expected words meet the targets.
    """
    share = mix(docs, seed=seed, text=text, doc_id=doc_id, source=source, **options)
    ratio = share.where("taken > 0").select(F.col("doc_id").alias("_id"), F.col("size").alias("_size"), (F.col("taken") / F.col("size")).alias("_ratio"))
    ratio = ratio.groupBy("_id", "_size").agg(F.avg("_ratio").alias("_ratio"))
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    coin = F.pmod(F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)), F.lit(1 << 30)) / float(1 << 30)
    copies = F.floor(F.col("_ratio") + coin).cast("int")
    rows = docs.withColumn("_n", size)
    joined = rows.join(ratio, rows[doc_id].eqNullSafe(ratio["_id"]) & (rows["_n"] == ratio["_size"]))
    return joined.where(copies > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).select(*docs.columns)
