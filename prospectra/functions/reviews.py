"""Dates: review growth, epoch fields, recency windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from prospectra.functions.identity import let

DAY_SECONDS = 86400.0
# Fixed value: the last second that a stored answer's date is believed, that of 2100.
LATEST_EPOCH = 4102444800

# Points by age of the newest review in days, and by reviews per month.
RECENCY_STEPS = ((30, 50), (90, 40), (180, 28), (365, 15), (730, 5))
CADENCE_STEPS = ((4.0, 50), (2.0, 40), (1.0, 30), (0.5, 20), (0.25, 10))

# Formats a scraped review date may come in, each with the shape that selects it.
DATE_FORMATS = (
    (r"^\d{4}-\d{2}-\d{2}T.*(?:Z|[+-]\d{2}:\d{2})$", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX"),
    (r"^\d{4}-\d{2}-\d{2}T[\d:]+$", "yyyy-MM-dd'T'HH:mm:ss"),
    (r"^\d{4}-\d{2}-\d{2} [\d:.]+$", "yyyy-MM-dd HH:mm:ss[.SSSSSS]"),
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^[A-Z][a-z]{2} \d{1,2}, \d{4}$", "MMM d, yyyy"),
    (r"^[A-Z][a-z]{3,8} \d{1,2}, \d{4}$", "MMMM d, yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
)


def as_time(now: Column | dt.datetime | str) -> Column:
    """A fixed instant as a column."""
    return now if isinstance(now, Column) else F.lit(str(now)).cast("timestamp")


def parse_date(text: Column, formats: tuple[tuple[str, str], ...] = DATE_FORMATS) -> Column:
    """A date by the first format whose shape fits; NULL when none does."""
    chain = F
    for shape, fmt in formats:
        chain = chain.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(fmt)))
    return chain.otherwise(F.lit(None))


def days_between(later: Column, earlier: Column) -> Column:
    """Days with fraction."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6 * DAY_SECONDS)


def growth(n: Column, oldest: Column, newest: Column, now: Column, sample_cap: int = 8) -> dict[str, Column]:
    """Growth score, signal text and rate from count, oldest and newest review date.

    The capture window never counts as shorter than 30 days. Fewer than three
    dated reviews give NULL rather than a made-up score.
    """
    since = days_between(now, newest)
    span = days_between(newest, oldest)
    capped = (n >= sample_cap) & (span < 30)
    per_month = n / (F.greatest(span, F.lit(30.0)) / F.lit(30.44))
    recency, cadence = F, F
    for limit, points in RECENCY_STEPS:
        recency = recency.when(since <= limit, points)
    for limit, points in CADENCE_STEPS:
        cadence = cadence.when(per_month >= limit, points)
    score = recency.otherwise(0) + cadence.otherwise(4)
    signal = F.concat(
        n.cast("string"), F.lit(" recent reviews "),
        F.date_format(oldest, "yyyy-MM-dd"), F.lit(".."), F.date_format(newest, "yyyy-MM-dd"),
        F.lit(" ("), F.when(capped, ">=").otherwise("~"),
        F.format_string("%.1f", per_month), F.lit("/mo, newest "),
        F.round(since).cast("long").cast("string"), F.lit("d ago)"),
        F.when(capped, " [capped sample]").otherwise(""),
    )
    enough = n >= 3
    return {
        "growth_score": F.when(enough, score),
        "growth_signal": F.when(enough, signal),
        "reviews_per_month": F.when(enough, per_month),
        "capped": F.when(enough, capped),
    }


def review_window(published: Column, now: Column) -> Column:
    """Count, oldest and newest of an array of date texts; unreadable and future dates do not count."""
    dates = F.filter(F.transform(published, lambda d: parse_date(d)), lambda d: d.isNotNull() & (d <= now))
    return let(dates, lambda d: F.struct(
        F.size(d).alias("n"), F.array_min(d).alias("oldest"), F.array_max(d).alias("newest")
    ))


def epoch_seconds(text: Column, latest: int = LATEST_EPOCH) -> Column:
    """Epoch seconds as text -> timestamp; NULL before 2000 and after ``latest``, which is 2100 unless told otherwise."""
    seconds = text.try_cast("double")
    return F.when(
        seconds.between(946684800, latest), F.timestamp_seconds(seconds.cast("long"))
    )


def within_days(at: Column, now: Column, days: int = 30) -> Column:
    """True when ``at`` is at most ``days`` before ``now``; NULL dates are not recent."""
    return F.coalesce(days_between(now, at) <= days, F.lit(False))


def is_stale(checked_at: Column, now: Column, days: int) -> Column:
    """True when a check is older than ``days``, or never happened."""
    return F.coalesce(checked_at <= now - F.make_dt_interval(F.lit(days)), F.lit(True))


def histogram_bucket(score: Column, width: int = 20, top: int = 80) -> Column:
    """Lower edge of a fixed-width bucket, the top one closed."""
    return F.when(score.isNotNull(), F.least(F.lit(top), (F.floor(score / width) * width).cast("int")))
