"""Webhook events as a stream: gate, challenges, duplicates, classes, archive, feed, latest."""

from __future__ import annotations

import hashlib
import hmac
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from prospectra.functions.text import contains_token, strip_controls
from prospectra.operators.topk import latest
from prospectra.schemas import EVENT
from prospectra.session import new_path

# Event families, events never shown, the default warm-up tag.
KNOWN_PREFIXES = ("contact", "campaign", "email", "webhook")
SUPPRESSED = ("EMAIL_UPDATED",)
WARMUP_TAGS = ("33153D9",)
MAX_BODY_BYTES = 1_048_576
SUMMARY_KEYS = ("email", "name", "subject", "id", "contact_id", "campaign_id")


def event_stream(spark: SparkSession, folder: str, schema: str = EVENT, files_per_trigger: int | None = None) -> DataFrame:
    """Typed events from JSON files; ``created_at`` is cut to microseconds."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return with_time(reader.json(folder))


def with_time(events: DataFrame) -> DataFrame:
    """Adds ``at``, the event time; nanoseconds beyond micros are dropped."""
    micros = F.regexp_replace("created_at", r"(\.\d{6})\d+", "$1")
    return events.withColumn("at", F.to_timestamp(micros))


def signature_parts(header: Column) -> tuple[Column, Column]:
    """(first timestamp, all digests) of a ``t=..,v1=..`` header."""
    stamp = F.get(F.regexp_extract_all(header, F.lit(r"(?:^|,)\s*t\s*=\s*([^,]*?)\s*(?:,|$)"), F.lit(1)), F.lit(0))
    parts = F.transform(F.split(header, ","), lambda p: F.trim(p))
    digests = F.transform(
        F.filter(parts, lambda p: p.rlike(r"^v1\s*=")), lambda p: F.trim(F.regexp_replace(p, r"^v1\s*=", ""))
    )
    return stamp, digests


def gate(raw: DataFrame, secret: str, now: Column, max_age: int | None = None, max_bytes: int = MAX_BODY_BYTES) -> DataFrame:
    """Adds ``reject_reason`` to raw (header, body) rows; NULL for a valid delivery.

    The digest is the one thing Spark has no function for. It is computed in an
    Arrow UDF, which also keeps the secret out of the query plan. A timestamp in
    the future is clock skew, never expiry.
    """
    key = secret.encode()

    @F.pandas_udf("string")
    def digest(signed: pd.Series) -> pd.Series:
        return signed.map(lambda s: None if s is None else hmac.new(key, s.encode(), hashlib.sha256).hexdigest())

    stamp, digests = signature_parts(F.col("header"))
    signed = raw.withColumn("_t", stamp).withColumn("_d", digests) \
        .withColumn("_e", digest(F.when(F.coalesce("_t", F.lit("")) != "", F.concat_ws(".", "_t", "body")).otherwise(F.col("body"))))
    age = F.unix_seconds(now) - F.col("_t").try_cast("bigint")
    too_old = F.lit(False) if max_age is None else F.coalesce(age > max_age, F.lit(False))
    reason = (
        F.when(F.octet_length("body") > max_bytes, "payload too large")
        .when(F.coalesce("header", F.lit("")) == "", "no signature header")
        .when(F.size("_d") == 0, "no digest in header")
        .when(~F.array_contains("_d", F.col("_e")), "digest mismatch")
        .when(too_old, "signature too old")
        .when(F.try_parse_json("body").isNull(), "invalid JSON")
    )
    return signed.withColumn("reject_reason", reason).drop("_t", "_d", "_e")


def parsed(valid: DataFrame, schema: str = EVENT) -> DataFrame:
    """Event columns of accepted bodies, control characters removed."""
    return valid.select(F.from_json(strip_controls("body", ""), schema).alias("_e")).select("_e.*")


def is_challenge(events: DataFrame) -> Column:
    """True for a verification ping, told by the presence of its field."""
    return F.coalesce(F.col("data.challenge"), F.lit("")) != ""


def classify(event_type: Column, known: tuple[str, ...] = KNOWN_PREFIXES) -> Column:
    """Prefix before the first dot when it is a known family, else other."""
    prefix = F.split_part(F.coalesce(event_type, F.lit("")), F.lit("."), F.lit(1))
    return F.when(prefix.isin(*known), prefix).otherwise("other")


def deduplicate(events: DataFrame, key: str = "id", at: str = "at", delay: str = "1 hour") -> DataFrame:
    """First event of each id within the watermark; events without an id all pass."""
    marked = events.withWatermark(at, delay)
    with_id = marked.filter(F.col(key).isNotNull()).dropDuplicatesWithinWatermark([key])
    return with_id.unionByName(marked.filter(F.col(key).isNull()))


def is_warmup(subject: Column, preview: Column, tags: tuple[str, ...] = WARMUP_TAGS) -> Column:
    """True when a warm-up tag stands in subject or preview as a whole token."""
    text = F.concat_ws(" ", subject, preview)
    hit = F.lit(False)
    for tag in tags:
        hit = hit | contains_token(text, tag)
    return hit


def in_families(event_type: Column, families: str | None) -> Column:
    """True when the type contains one of the comma-separated tokens; no tokens means no filter."""
    tokens = [t.strip().upper() for t in (families or "").split(",") if t.strip()]
    hit = F.lit(not tokens)
    for t in tokens:
        hit = hit | F.contains(F.upper(event_type), F.lit(t))
    return hit


def visible(events: DataFrame, muted: DataFrame | None = None, tags: tuple[str, ...] = WARMUP_TAGS) -> DataFrame:
    """Events for the feed: not suppressed, not muted, no warm-up mail."""
    warm = (F.col("event_type") == "EMAIL_RECEIVED") & is_warmup(F.col("data.subject"), F.col("data.preview"), tags)
    shown = events.filter(~F.col("event_type").isin(*SUPPRESSED) & ~F.coalesce(warm, F.lit(False)))
    return shown if muted is None else shown.join(muted.select("event_type").distinct(), "event_type", "left_anti")


def summary(event: Column, topic: Column, payload: dict[str, Column]) -> Column:
    """The one line a feed shows: event, topic, first identifier there is."""
    hint = F.coalesce(*[
        F.when(F.coalesce(payload[k], F.lit("")) != "", F.concat(F.lit(f" · {k}=`"), F.substring(payload[k], 1, 120), F.lit("`")))
        for k in SUMMARY_KEYS if k in payload
    ], F.lit(""))
    return F.concat(F.lit("**"), event, F.lit("** `"), topic, F.lit("`"), hint)


def check_formatter(sample: DataFrame, expression: str) -> str | None:
    """None when a formatter expression fits the event schema, else what is wrong with it."""
    try:
        sample.select(F.expr(expression)).schema
    except Exception as error:  # the analyser's message is the answer
        return str(error).splitlines()[0]
    return None


def formatted(events: DataFrame, formatters: dict[str, str], default: Column) -> Column:
    """Summary by each event type's own expression, the default elsewhere."""
    out = F
    for event_type, expression in formatters.items():
        out = out.when(F.col("event_type") == event_type, F.expr(expression).cast("string"))
    return out.otherwise(default) if formatters else default


def archive_and_feed(
    events: DataFrame, archive: str, feed: str, settings: Callable[[], DataFrame | None], checkpoint: str,
) -> StreamingQuery:
    """Archives every event and publishes the visible ones, settings re-read per micro-batch.

    Each batch writes its own folder, so a batch that runs again replaces itself.
    """
    def batch(df: DataFrame, number: int) -> None:
        df = df.persist()  # both tables come from one read of the batch's files
        try:
            df.withColumn("date", F.to_date("at")).write.mode("overwrite") \
                .partitionBy("event_type", "date").parquet(f"{archive}/batch={number}")
            visible(df, settings()).write.mode("overwrite").parquet(f"{feed}/batch={number}")
        finally:
            df.unpersist()

    return events.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()


def latest_per_type(events: DataFrame, at: str, values: list[str], tie: str) -> DataFrame:
    """Newest payload per event type; works on batches and, in update mode, on streams."""
    return latest(events, ["event_type"], at, values, tie)


def file_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream with a proper event time."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return stream.withColumn("at", F.col("ts").cast("timestamp"))


def run_to_files(stream: DataFrame, spark: SparkSession, label: str) -> DataFrame:
    """Runs a stream over everything available into files and reads them back."""
    out, mark = new_path(spark, label), new_path(spark, f"{label}-progress")
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark) \
        .outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def run_updates(stream: DataFrame, spark: SparkSession, label: str, keys: list[str]) -> DataFrame:
    """Runs an updating aggregation; each batch's rows are kept and the newest per key returned."""
    out, mark = new_path(spark, label), new_path(spark, f"{label}-progress")

    def batch(df: DataFrame, number: int) -> None:
        df.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/b={number}")

    query = stream.writeStream.foreachBatch(batch).outputMode("update") \
        .option("checkpointLocation", mark).trigger(availableNow=True).start()
    query.awaitTermination()
    rows = spark.read.parquet(out).drop("b")
    values = [c for c in rows.columns if c not in keys and c != "_batch"]
    return latest(rows, keys, "_batch", values)


def run_arrivals(spark: SparkSession, arrivals: list[DataFrame], build: Callable[[DataFrame], DataFrame], label: str) -> DataFrame:
    """Runs an appending stream over tables that arrive one after the other and reads all it wrote.

    Each arrival lands in a folder of its own and is run to its end from the checkpoint, as a
    scheduled job would: a micro-batch per arrival, and one without rows that moves the watermark.
    """
    landing, out, mark = (new_path(spark, f"{label}{x}") for x in ("-landing", "", "-progress"))
    for number, rows in enumerate(arrivals):
        rows.write.parquet(f"{landing}/arrival-{number}")
        stream = build(spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).parquet(landing))
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark).outputMode("append") \
            .trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
