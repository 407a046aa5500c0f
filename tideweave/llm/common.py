"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideweave.sources.staging import new_path, staged

#: A new path in the folder that driver and executors share.
scratch = new_path

#: The ASCII alphabets of case folding, and the six white-space characters that end a word.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"
SPACES = b" \t\n\v\f\r"


#: Rows of an Arrow batch of texts: the session's default of 10,000 may mean hundreds of MB.
BATCH_ROWS = 1024


def bound_batches(df: DataFrame) -> None:
    """Lower the session's Arrow batch size for texts, unless the session chose one of its own."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(key) == "10000":
        conf.set(key, str(BATCH_ROWS))


#: What this Python worker keeps over tasks of one operator.
CACHES: list[dict] = []


def trim(keep: bool = False) -> None:
    """Give back what earlier tasks of this Python worker have freed, and what other operators kept unless ``keep``."""
    for cache in () if keep else CACHES:
        cache.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage, survives executors."""
    return staged(df, name, **{"compression": "zstd"} | options)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as decimal text, mod 5; a null id counts as the text ``null``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % 5


def parts_for(rows: int, per_part: int) -> int:
    """So many partitions that each holds about ``per_part`` rows."""
    return max(1, -(-rows // per_part))


#: A key of at least one in so many rows is heavy; there are no more such keys than this.
HEAVY = 1 << 10


def join_by_size(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """Inner join of ``rows`` with ``groups``, which has one row a key; ``size`` counts its rows in ``rows``, or bounds their share.

    Heavy keys, 1,024 at most, are broadcast, so no key brings more than a 1024th of the rows to one
    task. ``rows`` and ``groups`` are read twice: they should be stored tables.
    """
    total = groups.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    is_heavy = F.col(size) * HEAVY >= total
    heavy, light = F.broadcast(groups.where(is_heavy)), groups.where(~is_heavy)
    return rows.join(heavy, key).unionByName(rows.join(heavy.select(key), key, "left_anti").join(light, key))
