"""Queries over keyed state with timers and over event-time windows, from events that arrive out of order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from prospectra.catalog.registry import query
from prospectra.catalog.world import table, world
from prospectra.session import new_path
from prospectra.streaming import events as ev, keyed, windows

DAY = 86_400


def arrivals(rows: DataFrame, at: str, ident: str, count: int = 3) -> list[DataFrame]:
    """Rows as they arrive: up to a day late, every tenth once more with the next arrival."""
    first, last = rows.agg(F.unix_micros(F.min(at)), F.unix_micros(F.max(at))).first()
    step = (last - first + DAY * 1_000_000) // count + 1
    delay = (F.col(ident) * 7919 % 1440) * 60_000_000
    number = F.floor((F.unix_micros(at) + delay - first) / step)
    again = (F.col(ident) % 10 == 0).cast("int")
    return [rows.filter((number == k) | ((number == k - 1) & (again == 1))) for k in range(count)]


def late_arrivals(spark: SparkSession, sf: str) -> list[DataFrame]:
    """The events in three arrivals by a fixed rule: thirds of the time, every 23rd event one or two arrivals too late."""
    rows = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("at"), "event_type", "value")
    first, last = rows.agg(F.unix_micros(F.min("at")), F.unix_micros(F.max("at"))).first()
    third = F.floor((F.unix_micros("at") - first) * 3 / (last - first + 1))
    number = F.least(F.lit(2), third + F.when(F.col("event_id") % 23 == 0, 1 + F.col("event_id") % 2).otherwise(0))
    return [rows.filter(number == k) for k in range(3)]


# Arrival, and whether the watermark of two hours had passed an event when it came.
_LATE = """
    a AS (SELECT event_id, ts, event_type, value, least(2, CAST(floor((epoch_us(ts) - lo) * 3 / (hi - lo + 1)) AS BIGINT) + CASE WHEN event_id % 23 = 0 THEN 1 + event_id % 2 ELSE 0 END) AS k
          FROM events, (SELECT MIN(epoch_us(ts)) AS lo, MAX(epoch_us(ts)) AS hi FROM events)),
    b AS (SELECT k, MAX(MAX(ts)) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 2 HOUR AS mark FROM a GROUP BY k),
    r AS (SELECT a.*, mark, coalesce(ts < mark, FALSE) AS late FROM a JOIN b USING (k)),
    o AS (SELECT * FROM r WHERE NOT late),
    p AS (SELECT date_trunc('milliseconds', MAX(ts)) - INTERVAL 2 HOUR AS passed FROM a)
"""
_WINDOWS = {
    "tumbling": f"""WITH {_LATE}, w AS (SELECT event_type, time_bucket(INTERVAL 6 HOUR, ts) AS s, COUNT(*) AS n, SUM(CAST(round(value * 100) AS BIGINT)) AS total FROM o GROUP BY 1, 2)
        SELECT event_type, epoch_us(s) AS start_us, epoch_us(s + INTERVAL 6 HOUR) AS end_us, n, CAST(total AS BIGINT) AS total FROM w, p WHERE s + INTERVAL 6 HOUR <= passed""",
    "sliding": f"""WITH {_LATE}, w AS (SELECT event_type, time_bucket(INTERVAL 2 HOUR, ts) - to_hours(2 * j) AS s, COUNT(*) AS n, SUM(CAST(round(value * 100) AS BIGINT)) AS total FROM o, range(3) x(j) GROUP BY 1, 2)
        SELECT event_type, epoch_us(s) AS start_us, epoch_us(s + INTERVAL 6 HOUR) AS end_us, n, CAST(total AS BIGINT) AS total FROM w, p WHERE s + INTERVAL 6 HOUR <= passed""",
    "session": f"""WITH {_LATE}, g AS (SELECT *, coalesce(ts >= lag(ts) OVER (PARTITION BY event_type ORDER BY ts) + INTERVAL 30 MINUTE, TRUE) AS opens FROM o),
        h AS (SELECT *, SUM(CAST(opens AS INT)) OVER (PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS number FROM g),
        w AS (SELECT event_type, number, MIN(ts) AS s, MAX(ts) + INTERVAL 30 MINUTE AS f, COUNT(*) AS n, SUM(CAST(round(value * 100) AS BIGINT)) AS total FROM h GROUP BY 1, 2)
        SELECT event_type, epoch_us(s) AS start_us, epoch_us(f) AS end_us, n, CAST(total AS BIGINT) AS total FROM w, p WHERE f <= passed""",
}


def _windows(spark: SparkSession, sf: str, kind: str, size: str, slide: str | None = None) -> DataFrame:
    cents = lambda df: df.withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    closed, _ = windows.run_windows(spark, [cents(df) for df in late_arrivals(spark, sf)], kind, ["event_type"], size, new_path(spark, f"{kind}-windows"),
                                    slide, delay="2 hours", value="cents")
    return closed.select("event_type", F.unix_micros("window_start").alias("start_us"), F.unix_micros("window_end").alias("end_us"), "n", "total")


@query("ST01 ST05", _WINDOWS["tumbling"])
def stream_tumbling_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Events and their value per type and six hours, each window written when the watermark passed it."""
    return _windows(spark, sf, "tumbling", "6 hours")


@query("ST01 ST05", _WINDOWS["sliding"])
def stream_sliding_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The same over six hours that begin every two."""
    return _windows(spark, sf, "sliding", "6 hours", "2 hours")


@query("ST01 ST05", _WINDOWS["session"])
def stream_session_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions of a type that half an hour without an event ends."""
    return _windows(spark, sf, "session", "30 minutes")


@query("ST01 ST02", f"WITH {_LATE} SELECT event_id, event_type, epoch_us(mark) - epoch_us(ts) AS behind_us FROM r WHERE late")
def stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every event that came after the watermark had passed it, and by how much."""
    _, late = windows.run_windows(spark, late_arrivals(spark, sf), "tumbling", ["event_type"], "6 hours", new_path(spark, "late-rows"), delay="2 hours")
    return late.select("event_id", "event_type", (F.unix_micros("missed") - F.unix_micros("at")).alias("behind_us"))


_PASSED = "(SELECT date_trunc('milliseconds', MAX(ts)) - INTERVAL 1 DAY FROM events)"

_ORDERED = f"""
    t AS (SELECT *, row_number() OVER (PARTITION BY fleet ORDER BY checked_at, tick_id) AS rn,
                 row_number() OVER (PARTITION BY fleet, verdict ORDER BY checked_at, tick_id) AS rv FROM ticks WHERE checked_at <= {_PASSED}),
    i AS (SELECT *, least(10, row_number() OVER (PARTITION BY fleet, verdict, rn - rv ORDER BY rn)) AS streak,
                 MAX(checked_at) FILTER (WHERE action = 'restart' AND action_ok) OVER w AS restarted,
                 MAX(checked_at) FILTER (WHERE action = 'proxy_refresh' AND action_ok) OVER w AS refreshed,
                 lead(checked_at) OVER (PARTITION BY fleet ORDER BY rn) AS following
          FROM t WINDOW w AS (PARTITION BY fleet ORDER BY rn ROWS UNBOUNDED PRECEDING)),
    c AS (SELECT *, CASE verdict WHEN 'PROXY_DEGRADED' THEN 'proxy_refresh' WHEN 'WEDGED' THEN 'restart' END AS want,
                 CASE verdict WHEN 'PROXY_DEGRADED' THEN 30 ELSE 15 END AS cd, CASE verdict WHEN 'PROXY_DEGRADED' THEN refreshed ELSE restarted END AS done FROM i),
    s AS (SELECT *, coalesce(CAST(round((epoch_us(checked_at) - epoch_us(done)) / 60e6) AS BIGINT), 99999) AS since FROM c),
    d AS (SELECT *, CASE WHEN want IS NULL THEN 'none' WHEN streak < 3 THEN 'suppressed:' || verdict || ' seen ' || streak || '/3 consecutive ticks'
                 WHEN since < cd THEN 'suppressed:' || want || ' in cooldown (' || since || 'm of ' || cd || 'm)' ELSE want END AS decision FROM s),
    e AS (SELECT *, done + to_minutes(CAST(cd AS BIGINT)) AS until FROM d WHERE contains(decision, 'cooldown'))
"""


@query("ST10 D33 W02 W03", f"""
    WITH {_ORDERED} SELECT fleet, tick_id, epoch_us(checked_at) AS at_us, 'tick' AS kind, CAST(streak AS INTEGER) AS streak, decision FROM d
    UNION ALL SELECT fleet, NULL, epoch_us(until), 'cooldown over', CAST(streak AS INTEGER), want FROM e WHERE until < coalesce(following, {_PASSED})
""", ("ticks",))
def stream_keyed_actions(spark: SparkSession, sf: str) -> DataFrame:
    """The action at every tick of every fleet, and at the end of a cooldown by timer, from ticks out of order and repeated."""
    with keyed.keyed_state(spark):
        ticks = world(spark, sf, "ticks").withColumn("checked_at", F.col("checked_at").cast("timestamp"))
        out = ev.run_arrivals(spark, arrivals(ticks, "checked_at", "tick_id"), lambda s: keyed.fleet_decisions(s, "fleet", 3, "1 day"), "keyed-actions")
    return out.select("fleet", "tick_id", F.unix_micros("at").alias("at_us"), "kind", "streak", "decision")


_CLAIMS = f"""
    q AS (SELECT event_id, user_id, epoch_us(ts) AS us, CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'imported' ELSE 'claim' END AS kind, 'r' || event_id % 2 AS run,
                 row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events WHERE ts <= {_PASSED}),
    m AS (SELECT user_id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS BIGINT) AS us, CAST(NULL AS VARCHAR) AS outcome, CAST(NULL AS VARCHAR) AS run,
                 CAST(NULL AS VARCHAR) AS status, CAST(NULL AS VARCHAR) AS holder, CAST(NULL AS BIGINT) AS claimed, CAST(NULL AS BIGINT) AS gone_at, CAST(NULL AS VARCHAR) AS gone
          FROM q WHERE rn = 1
          UNION ALL
          SELECT user_id, rn, event_id, us, outcome, run,
                 CASE outcome WHEN 'granted' THEN 'claimed' WHEN 'failed' THEN 'failed' WHEN 'imported' THEN 'imported' ELSE now END,
                 CASE WHEN outcome = 'granted' THEN run WHEN outcome IN ('failed', 'imported') THEN run WHEN stale THEN NULL ELSE holder END,
                 CASE WHEN outcome = 'granted' THEN us WHEN outcome IN ('failed', 'imported') OR stale THEN NULL ELSE claimed END,
                 CASE WHEN stale THEN claimed + 21600000000 END, CASE WHEN stale THEN holder END
          FROM (SELECT p.*, CASE WHEN kind = 'claim' THEN CASE WHEN now IS NULL OR now = 'failed' THEN 'granted' ELSE 'refused' END
                                 WHEN now = 'claimed' AND holder = run THEN kind ELSE 'not held' END AS outcome
                FROM (SELECT q.user_id, q.rn, q.event_id, q.us, q.kind, q.run, m.holder, m.claimed, coalesce(m.status = 'claimed' AND m.claimed + 21600000000 < q.us, FALSE) AS stale,
                             CASE WHEN m.status = 'claimed' AND m.claimed + 21600000000 < q.us THEN 'failed' ELSE m.status END AS now
                      FROM m JOIN q ON q.user_id = m.user_id AND q.rn = m.rn + 1) p))
"""


@query("ST11 D25 P06", f"""
    WITH RECURSIVE {_CLAIMS}
    SELECT user_id, event_id AS request_id, us AS at_us, outcome, run AS run_id FROM m WHERE rn > 0
    UNION ALL SELECT user_id, NULL, gone_at, 'expired', gone FROM m WHERE gone_at IS NOT NULL
    UNION ALL SELECT user_id, NULL, claimed + 21600000000, 'expired', holder FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rn DESC) AS back FROM m)
              WHERE back = 1 AND status = 'claimed' AND claimed + 21600000000 < epoch_us({_PASSED})
""")
def stream_claim_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """What becomes of every claim and report on a user, in event order; a claim of six hours expires without new input."""
    kind = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "imported").otherwise("claim")
    requests = table(spark, sf, "events").select(
        "user_id", F.col("event_id").alias("request_id"), F.col("ts").cast("timestamp").alias("at"), kind.alias("kind"),
        F.concat(F.lit("r"), F.col("event_id") % 2).alias("run_id"))
    with keyed.keyed_state(spark):
        out = ev.run_arrivals(spark, arrivals(requests, "at", "request_id"), lambda s: keyed.claim_outcomes(s, "user_id", "1 day"), "keyed-claims")
    return out.select("user_id", "request_id", F.unix_micros("at").alias("at_us"), "outcome", "run_id")


@query("ST09 T05", f"""
    SELECT event_type, max_by(event_id, ts) AS event_id, max_by(props, ts) AS payload FROM events WHERE ts <= {_PASSED} GROUP BY 1
""")
def stream_keyed_latest(spark: SparkSession, sf: str) -> DataFrame:
    """The newest payload of every event type as value state, over arrivals out of order."""
    rows = table(spark, sf, "events").select("event_type", "event_id", F.col("ts").cast("timestamp").alias("at"), "props")
    with keyed.keyed_state(spark):
        out = ev.run_arrivals(spark, arrivals(rows, "at", "event_id"), lambda s: keyed.latest_payloads(s, "event_type", "props", "1 day"), "keyed-latest")
    newest = F.max_by(F.struct("event_id", "payload"), F.struct("at", "event_id"))
    return out.groupBy("event_type").agg(newest.alias("v")).select("event_type", "v.*")
