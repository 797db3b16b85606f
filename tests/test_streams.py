"""Keyed state with timers and event-time windows: arrival order, repeats, late rows, restarts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from prospectra.functions.reviews import as_time
from prospectra.plans import health
from prospectra.session import new_path
from prospectra.streaming import events as ev, keyed, windows

T0 = dt.datetime(2024, 1, 1, 12)
TICKS = "fleet long, checked_at timestamp, tick_id long, verdict string, action string, action_ok boolean"


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def ticks(seed, count=150):
    pick = random.Random(seed)
    return [(pick.choice([1, 1, 2, 3]), at(pick.randrange(600) / 2), i, pick.choice(["WEDGED", "WEDGED", "WEDGED", "PROXY_DEGRADED", "IDLE", None]),
             pick.choice(["restart", "proxy_refresh", "none", None]), pick.choice([True, False, None])) for i in range(count)]


def decisions(spark, rows, parts, label="t"):
    frames = [spark.createDataFrame(p, TICKS) for p in parts]
    end = spark.createDataFrame([(99, at(10_000), 10**6, "IDLE", "none", False)], TICKS)
    with keyed.keyed_state(spark):
        out = ev.run_arrivals(spark, [*frames, end], lambda s: keyed.fleet_decisions(s, "fleet", 3, "7 hours"), label)
    return out.filter("fleet <> 99").collect()


def test_arrivals_in_any_order_equal_the_batch_form(spark):
    rows = ticks(1)
    shuffled = random.Random(2).sample(rows, len(rows))
    got = decisions(spark, rows, [shuffled[:40], shuffled[30:90] + shuffled[:5], shuffled[90:] + shuffled[60:70]])
    plain = decisions(spark, rows, [sorted(rows, key=lambda r: r[1])])
    assert sorted(map(str, got)) == sorted(map(str, plain))
    ticked = [r for r in got if r.kind == "tick"]
    assert sorted(r.tick_id for r in ticked) == [r[2] for r in rows]
    # The last tick of a fleet against the batch form over its whole log, as of that tick.
    log = spark.createDataFrame(rows, TICKS)
    for fleet in (1, 2, 3):
        own = log.filter(F.col("fleet") == fleet)
        now = own.agg(F.max("checked_at")).first()[0]
        want = health.decide(own, "fleet", as_time(now.isoformat(sep=" ")), F.lit(3)).first()
        last = max((r for r in ticked if r.fleet == fleet), key=lambda r: (r["at"], r.tick_id))
        assert (last.verdict, last.streak, last.decision) == (want.verdict, want.streak, want.decision)


def test_a_cooldown_ends_by_timer(spark):
    rows = [(1, at(5 * i), i, "WEDGED", "restart" if i == 2 else "none", i == 2) for i in range(5)]
    got = decisions(spark, rows, [rows[:4], rows[4:]])
    over = [r for r in got if r.kind == "cooldown over"]
    assert [(r.tick_id, r["at"], r.decision) for r in over] == [(None, at(25), "restart")]


def test_a_claim_expires_without_new_input(spark):
    schema = "business_id long, at timestamp, request_id long, kind string, run_id string"
    first = [(1, at(0), 1, "claim", "a"), (1, at(60), 2, "claim", "b"), (2, at(1), 3, "claim", "a"), (2, at(2), 4, "imported", "a"), (3, at(5), 5, "claim", "a"), (3, at(9), 6, "failed", "z")]
    later = [(2, at(500), 7, "claim", "b"), (3, at(10), 8, "failed", "a"), (3, at(11), 9, "claim", "c"), (3, at(12), 10, "force", "d"), (9, at(900), 11, "claim", "x")]
    with keyed.keyed_state(spark):
        out = ev.run_arrivals(spark, [spark.createDataFrame(r, schema) for r in (first, later)], lambda s: keyed.claim_outcomes(s, "business_id", "1 hour"), "claims")
    got = sorted(((r.business_id, r["at"], r.outcome, r.run_id) for r in out.collect()), key=str)
    assert got == sorted([
        (1, at(0), "granted", "a"), (1, at(60), "refused", "b"), (1, at(360), "expired", "a"),
        (2, at(1), "granted", "a"), (2, at(2), "imported", "a"), (2, at(500), "refused", "b"),
        (3, at(5), "granted", "a"), (3, at(9), "not held", "z"), (3, at(10), "failed", "a"), (3, at(11), "granted", "c"), (3, at(12), "granted", "d"), (3, at(372), "expired", "d"),
    ], key=str)


EVENTS = "event_id long, at timestamp, event_type string"


@pytest.mark.parametrize("kind, size, slide", [("tumbling", "1 hour", None), ("sliding", "1 hour", "20 minutes"), ("session", "10 minutes", None)])
def test_rows_are_in_windows_or_late(spark, kind, size, slide):
    pick = random.Random(3)
    rows = [(i, at(i + pick.randrange(-40, 40)) if i % 17 else None, pick.choice("ab")) for i in range(400)]
    parts = [rows[:150], rows[150:300] + [(900, at(20), "a"), (901, at(21), "b")], rows[300:], [(999, at(5000), "z")]]
    frames = [spark.createDataFrame(p, EVENTS) for p in parts]
    closed, late = windows.run_windows(spark, frames, kind, ["event_type"], size, new_path(spark, "w"), slide, delay="1 hour")
    missed, newest = set(), None
    for p in parts:
        limit = None if newest is None else newest - dt.timedelta(hours=1)
        missed |= {r[0] for r in p if limit and r[1] and r[1] < limit}
        newest = max([r[1] for r in p if r[1]] + ([newest] if newest else []))
    assert {r.event_id for r in late.collect()} == missed and {900, 901} <= missed
    timed = frames[0].unionByName(frames[1]).unionByName(frames[2]).filter(~F.col("event_id").isin(*missed))
    whole = windows.windowed(timed.filter("at IS NOT NULL"), kind, ["event_type"], size, slide)
    assert sorted(map(tuple, closed.collect())) == sorted(map(tuple, whole.collect()))


def test_windows_take_plain_arguments_only():
    assert windows.micros("90 minutes") == 5_400_000_000
    with pytest.raises(ValueError):
        windows.micros("a while")
    with pytest.raises(ValueError):
        windows.window_of("round", "at", "1 hour")


def test_rows_that_wait_are_only_appended():
    class Store:
        """List and value state, timers and the watermark of one key; ``calls`` counts what the store is asked."""

        def __init__(self):
            self.rows, self.value, self.timers, self.mark, self.calls = [], None, set(), 0, []

        getListState = getValueState = lambda self, *a: self
        getCurrentWatermarkInMs = lambda self: self.mark
        appendList = lambda self, new: (self.calls.append("append"), self.rows.extend(new))
        put = lambda self, new: self.rows.__init__(new)
        clear = lambda self: self.rows.clear()
        update = lambda self, value: setattr(self, "value", value)
        registerTimer = lambda self, at: self.timers.add(at)
        deleteTimer = lambda self, at: self.timers.remove(at)

    store = Store()
    store.get = lambda: store.calls.append("get") or (store.value if store.calls[-2:-1] != ["get"] else list(store.rows))
    own = keyed.InOrder(keyed.LatestMachine(), ["k"])
    own.init(store)
    rows = lambda *at: [dict(us=a, id=a, payload=str(a)) for a in at]
    assert list(own.handleInputRows(("a",), rows(5000, 3000), store)) == [] and store.calls == ["get", "append"] and store.timers == {4}
    store.calls.clear()
    store.mark = 4
    assert [r.payload for r in own.handleInputRows(("a",), rows(4000, 9000), store)] == ["4000"]
    assert sorted(r[0] for r in store.rows) == [5000, 9000] and store.timers == {6}


def test_latest_payloads_of_a_type_are_dealt_to_shards(spark):
    frame = spark.createDataFrame([(i, at(i), "a", str(i)) for i in range(64)] + [(99, at(5000), "b", "end")], "event_id long, at timestamp, event_type string, props string")
    with keyed.keyed_state(spark):
        out = ev.run_arrivals(spark, [frame], lambda s: keyed.latest_payloads(s, "event_type", "props", "1 hour", shards=4), "latest")
    got = out.collect()
    assert len(got) == 4 and max(got, key=lambda r: r["at"]).payload == "63"
