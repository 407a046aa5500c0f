"""Following an audit log as it grows.

The log's records arrive as a stream of (site, timestamp, account_id, username, valid). First
activity is a running minimum per account; volumes are windowed counts with a watermark, so late
records within it still count and state is dropped behind it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideweave.operators.identity import first_activity


def activity_stream(facts: DataFrame) -> DataFrame:
    """Per account the least valid time so far; write with output mode ``update`` or ``complete``."""
    return first_activity(facts)


def volumes(facts: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """site, start, records: records per tumbling window, final once the watermark has passed (mode ``append``)."""
    time = F.try_to_timestamp("timestamp", F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))
    rows = facts.withColumn("time", time).where("time IS NOT NULL").withWatermark("time", late)
    counted = rows.groupBy("site", F.window("time", window).alias("w")).agg(F.count("*").alias("records"))
    return counted.select("site", F.col("w.start").alias("start"), "records")


def sessions(facts: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """site, account_id, start, end, records: bursts of activity of an account."""
    time = F.try_to_timestamp("timestamp", F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))
    rows = facts.withColumn("time", time).where("time IS NOT NULL").withWatermark("time", late)
    counted = rows.groupBy("site", "account_id", F.session_window("time", gap).alias("w")).agg(F.count("*").alias("records"))
    return counted.select("site", "account_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "records")
