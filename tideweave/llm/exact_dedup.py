"""Exact deduplication through a log-structured merge index, with DataFrame functions only.

* memtable: each task sorts its entries ``(digest, identifier)`` and flushes them as runs, without a
  shuffle. A run is a Parquet file sorted by digest, with a Bloom filter on it (level 0).
* compaction: runs merge into sorted runs that keep, per digest, the smallest identifier (level 1).
  The identifier ranks rows by preference: the complement of doc_id, as the largest is to stay.
  The digests that it finds more than once make up the hit filter: a bitmap of 16 bits for each and
  at most 128 MB. ``lookup`` finds digests in the runs, whose filters let most of them be passed over.
* probing: entries that the filter rules out are alone with their text; they are not shuffled again.
  The others are hits, whose texts are grouped by their bytes, so equal digests of different texts
  stay apart. A full bitmap lets more entries through, which costs time and changes nothing.

A group of copies collapses in the map-side part of each aggregation, so a group that holds a third
of all rows costs one row per task. Groups of 1/1024 of the hits or more, of which there can be 1,024
at most, are broadcast to their ids; so no digest brings more than that to one task of a join.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideweave.llm.common import ascii_lower, join_by_size, stored

#: Bits of the hit filter for each repeated digest, and their bounds: 4 KB and 128 MB.
HIT_BITS, LEAST_BITS, MOST_BITS = 16, 1 << 15, 1 << 30
#: Rows of a run, about 8 MB, and bytes of its Bloom filter (about 1 % false positives in a full run).
RUN_ROWS, RUN_FILTER_BYTES = 1 << 17, 1 << 17


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _flush(entries: DataFrame, name: str) -> DataFrame:
    """Write runs sorted by digest, each with a Bloom filter, and read them."""
    options = {
        "maxRecordsPerFile": str(RUN_ROWS),
        "parquet.bloom.filter.enabled#digest": "true",
        "parquet.bloom.filter.adaptive.enabled": "true",
        "parquet.bloom.filter.max.bytes": str(RUN_FILTER_BYTES),
    }
    return stored(entries.sortWithinPartitions("digest", "ident"), name, **options)


def memtables(rows: DataFrame) -> DataFrame:
    """Level 0 of rows (digest, ident): one entry per row, in sorted runs of the task that read it."""
    return _flush(rows.select("digest", "ident"), "runs0")


def compact(runs: DataFrame) -> DataFrame:
    """Level 1: per digest the smallest identifier (nulls last) and the number of rows."""
    merged = runs.groupBy("digest").agg(F.min("ident").alias("ident"), F.count("*").alias("copies"))
    return _flush(merged, "runs1")


def lookup(runs: DataFrame, digests: list[str]) -> DataFrame:
    """The entries of a few digests: runs and row groups whose filters or ranges rule them out are not read."""
    return runs.where(F.col("digest").isin(digests))


def _slot(digest: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(bits))


@dataclass
class HitFilter:
    """Bitmaps (bucket, bits) of 4 KB each over ``bits`` slots."""

    bitmaps: DataFrame
    bits: int


def hit_filter(index: DataFrame) -> HitFilter:
    """Bitmaps of the digests of ``index`` (digest, copies) that occur more than once: at most 128 MB."""
    hits = index.where("copies > 1")
    wanted, bits = HIT_BITS * hits.count(), LEAST_BITS
    while bits < min(wanted, MOST_BITS):
        bits *= 2
    slots = hits.select(_slot(F.col("digest"), bits).alias("slot"))
    bitmaps = slots.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )
    return HitFilter(bitmaps, bits)


def with_hit(rows: DataFrame, filter: HitFilter) -> DataFrame:
    """``rows`` with a boolean ``hit``: true wherever the digest occurs more than once, and rarely elsewhere.

    The filter's size is bounded, so it is broadcast.
    """
    slot = _slot(F.col("digest"), filter.bits)
    at = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.pmod(F.call_function("shiftright", byte, F.pmod(at, F.lit(8)).cast("int")), F.lit(2))
    named = filter.bitmaps.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))
    return rows.join(F.broadcast(named), F.bitmap_bucket_number(slot) == F.col("_bucket"), "left").select(
        *rows.columns, (F.col("_bits").isNotNull() & (bit == 1)).alias("hit")
    )


@dataclass
class Probed:
    """What the index tells of a table's rows.

    ``alone`` (doc_id, digest) has the rows that the filter rules out. ``hits`` (doc_id, keep_id,
    group_size, digest, copies) has one row per id and text of all others, with its number of rows.
    """

    alone: DataFrame
    hits: DataFrame
    filter: HitFilter


def probe(docs: DataFrame, text: str, doc_id: str, normalise: Callable[[Column], Column], digest: Callable[[Column], Column]) -> Probed:
    """Build the index over ``docs``, probe it with every row, and verify hits by their bytes."""
    norm = normalise(F.col(text))
    rows = docs.select(F.col(doc_id).alias("doc_id"), norm.alias("norm")).withColumn("digest", digest(F.col("norm")))
    ident = F.bitwise_not(F.col("doc_id"))
    runs = memtables(rows.select("digest", ident.alias("ident")))
    filter = hit_filter(compact(runs))
    entries = with_hit(runs, filter)
    alone = entries.where("NOT hit").select(F.bitwise_not("ident").alias("doc_id"), "digest")
    groups = (
        with_hit(rows, filter)
        .where("hit")
        .groupBy("digest", "norm")
        .agg(F.min(ident).alias("first"), F.count("*").alias("size"))
        .select("digest", "first", "size")
    )
    groups = stored(groups, "groups")
    verified = groups.groupBy("digest").agg(F.count("*").alias("texts"), F.min("first").alias("first"), F.sum("size").alias("size"))
    ids = entries.where("hit").groupBy("digest", "ident").agg(F.count("*").alias("copies"))
    found = join_by_size(ids, verified.where("texts = 1"), "digest", "size")
    hits = found.select(
        F.bitwise_not("ident").alias("doc_id"), F.bitwise_not("first").alias("keep_id"), F.col("size").alias("group_size"), "digest", "copies"
    )
    mixed = verified.where("texts > 1").select("digest")
    if not mixed.isEmpty():
        # Different texts with one digest: group these rows by the texts themselves.
        own = rows.join(mixed, "digest", "left_semi").groupBy("digest", "norm", "doc_id").agg(F.count("*").alias("copies"))
        sums = own.groupBy("digest", "norm").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
        hits = hits.unionByName(own.join(sums, ["digest", "norm"]).select(*hits.columns))
    return Probed(alone, hits, filter)


def exact_groups(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    normalise: Callable[[Column], Column] = ascii_lower,
    digest: Callable[[Column], Column] = sha256_hex,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, digest.

    Null text equals empty text. The largest id of equal texts stays; null ids come last. Of rows
    that repeat id and text, one is kept. An empty table gives no rows. Other columns are ignored.
    """
    found = probe(docs, text, doc_id, normalise, digest)
    one = F.lit(1).cast("long")
    alone = found.alone.select("doc_id", F.col("doc_id").alias("keep_id"), one.alias("group_size"), F.lit(True).alias("kept"), "digest")
    copy = F.explode(F.sequence(one, F.col("copies"))).alias("copy")
    hits = found.hits.select("*", copy).select(
        "doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "digest"
    )
    return alone.unionByName(hits)


def drop_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; see exact_groups for the rule.

    Rows that the filter rules out stay where they are; only hits are shuffled.
    """
    found = probe(docs, text, doc_id, ascii_lower, sha256_hex)
    stay = found.hits.where("doc_id <=> keep_id").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "copies")
    stay = stored(stay, "stay")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = with_hit(docs.select(row, F.col(doc_id).alias("id"), sha256_hex(ascii_lower(F.col(text))).alias("digest")), found.filter)
    alone, hits = rows.where("NOT hit"), rows.where("hit")

    def among(kept: DataFrame) -> DataFrame:
        return hits.join(kept, hits["id"].eqNullSafe(kept["_id"]) & (hits["digest"] == kept["_digest"]), "left_semi")

    repeated = stay.where("copies > 1")
    out = alone.select("row").union(among(stay.where("copies = 1")).select("row"))
    if not repeated.isEmpty():
        out = out.union(among(repeated).dropDuplicates(["id", "digest"]).select("row"))
    return out.select("row.*")
