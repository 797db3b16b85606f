"""Event-time windows per class: tumbling, sliding and session counts, late rows in a table of their own.

A stream is first split by the watermark that stood when a micro-batch began: rows behind it go
to a side table with the watermark they missed, the others to the landing folder of the
windows. So no row is lost without a trace: a row is in the windows it belongs to, or in the
side table. Windows are written once, when the watermark has passed their end.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

KINDS = ("tumbling", "sliding", "session")
UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400}


def micros(interval: str) -> int:
    """Microseconds of a plain interval as ``10 minutes``."""
    found = re.fullmatch(r"\s*(\d+)\s+(second|minute|hour|day)s?\s*", interval)
    if not found:
        raise ValueError(f"not a plain interval: {interval!r}")
    return int(found[1]) * UNITS[found[2]] * 1_000_000


def window_of(kind: str, at: str, size: str, slide: str | None = None) -> Column:
    """The window column of a kind; ``size`` is a session's gap."""
    if kind == "tumbling":
        return F.window(at, size)
    if kind == "sliding":
        return F.window(at, size, slide or size)
    if kind == "session":
        return F.session_window(at, size)
    raise ValueError(f"windows are one of {', '.join(KINDS)}")


def windowed(events: DataFrame, kind: str, by: list[str], size: str, slide: str | None = None, at: str = "at",
             delay: str = "1 hour", value: str | None = None) -> DataFrame:
    """``by, window_start, window_end, n`` (and ``total`` of a value) per window; on a stream in append mode, on a table at once."""
    rows = events.withWatermark(at, delay) if events.isStreaming else events
    measures = [F.count(F.lit(1)).alias("n"), *([F.sum(value).alias("total")] if value else [])]
    out = rows.groupBy(window_of(kind, at, size, slide).alias("_w"), *by).agg(*measures)
    return out.select(*by, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *(["n", "total"] if value else ["n"]))


def split_late(events: DataFrame, on_time: str, late: str, marks: str, checkpoint: str, at: str = "at", delay: str = "1 hour") -> StreamingQuery:
    """Deals a stream to rows in time and late rows, a folder per micro-batch, and keeps the watermark between batches.

    A row is late if its time lies before the newest time of all earlier batches less ``delay``.
    Late rows carry that watermark as ``missed``. A batch that runs again reads the watermark of
    the batch before it and replaces its own folders, so a restart changes nothing.
    """
    behind = micros(delay)

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        mark = spark.read.schema("newest long").parquet(f"{marks}/batch={number - 1}").first()[0] if number else None
        limit = None if mark is None else mark - behind
        time = F.unix_micros(at)
        missed = F.lit(False) if limit is None else F.coalesce(time < limit, F.lit(False))
        df = df.persist()  # three outputs from one read of the batch's files
        try:
            df.filter(~missed).write.mode("overwrite").parquet(f"{on_time}/batch={number}")
            df.filter(missed).withColumn("missed", F.timestamp_micros(F.lit(limit))).write.mode("overwrite").parquet(f"{late}/batch={number}")
            newest = F.greatest(F.max(time), F.lit(mark).cast("long"))
            df.agg(newest.alias("newest")).write.mode("overwrite").parquet(f"{marks}/batch={number}")
        finally:
            df.unpersist()

    return events.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_windows(spark: SparkSession, arrivals: list[DataFrame], kind: str, by: list[str], size: str, folder: str,
                slide: str | None = None, at: str = "at", delay: str = "1 hour", value: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(closed windows, late rows) after arrivals that come one by one; each is run to its end from the checkpoints."""
    schema = arrivals[0].schema
    for number, rows in enumerate(arrivals):
        rows.write.parquet(f"{folder}/landing/arrival-{number}")
        source = spark.readStream.schema(schema).option("recursiveFileLookup", True)
        split_late(source.parquet(f"{folder}/landing"), f"{folder}/on-time", f"{folder}/late", f"{folder}/marks", f"{folder}/split-progress", at, delay).awaitTermination()
        closed = windowed(source.parquet(f"{folder}/on-time"), kind, by, size, slide, at, delay, value)
        closed.writeStream.format("parquet").option("path", f"{folder}/windows").option("checkpointLocation", f"{folder}/windows-progress") \
            .outputMode("append").trigger(availableNow=True).start().awaitTermination()
    late = spark.read.schema(schema.add("missed", "timestamp")).option("recursiveFileLookup", True).parquet(f"{folder}/late")
    return spark.read.schema(closed.schema).parquet(f"{folder}/windows"), late
