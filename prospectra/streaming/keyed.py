"""Keyed state with timers: rows of a key in event order, whatever order they arrive in.

A row waits in its key's state until the watermark has passed it. Then the key's machine
takes the waiting rows in order of time, and a deadline of the machine that the watermark
has passed fires between them, also where no row of the key ever follows. So the outcome
depends neither on how rows are cut into micro-batches nor on the order of arrival, and
equals the batch form over the same rows. Rows that come again, and rows behind the last one
taken, are left out; rows behind the watermark Spark drops itself (see ``windows.split_late``
for a table of those).

A key's state holds its waiting rows, those of one watermark delay, and the machine's few
figures. A micro-batch brings all rows of a key, or of a shard of it, to one task, as state
requires; the source's files per trigger bound that.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from prospectra.plans.candidates import STALE_CLAIM_HOURS
from prospectra.plans.health import ACTIONS, REQUIRED_TICKS, action

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT = "at_us long, id long"
MINUTE, HOUR = 60_000_000, 3_600_000_000


class Machine:
    """What a key does with its rows: figures kept between rows, and what each row or deadline gives.

    ``takes`` names the input columns beside key, time and id, ``keeps`` the figures, ``gives``
    the output columns beside key, time and id; all as DDL. Times are microseconds.
    """

    takes = keeps = gives = ""
    #: Whether a micro-batch gives only the last of a key's rows.
    only_last = False

    def start(self) -> tuple:
        raise NotImplementedError

    def step(self, kept: tuple, at: int, row: tuple) -> tuple[tuple, list[tuple]]:
        """The figures after a row, and its output rows."""
        raise NotImplementedError

    def deadline(self, kept: tuple) -> int | None:
        """When something happens without a row."""
        return None

    def expire(self, kept: tuple, at: int) -> tuple[tuple, list[tuple]]:
        """The figures after the deadline, and its output rows."""
        raise NotImplementedError


class InOrder(StatefulProcessor):
    """Runs a machine over the rows of each key in order of (time, id).

    A call to the state store costs more than a row's work, so new rows of which none has passed
    are only appended, and a timer is touched only if it moves.
    """

    def __init__(self, machine: Machine, keys: list[str]):
        self.machine = machine
        self.takes = ["us", "id", *names_of(machine.takes)]
        self.out = Row(*keys, *names_of(f"{OUT}, {machine.gives}"))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", f"us long, id long, {self.machine.takes}")
        self.kept = handle.getValueState("kept", f"us long, id long, first long, timer long, {self.machine.keeps}")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        yield from self._advance(key, timerValues, [tuple(r[c] for c in self.takes) for r in rows], False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._advance(key, timerValues, [], True)

    def _advance(self, key, timers, new: list[tuple], fired: bool) -> Iterator[Row]:
        passed = max(0, timers.getCurrentWatermarkInMs()) * 1000
        machine, out = self.machine, []
        last = self.kept.get()
        place, first, timer, kept = (tuple(last[:2]), last[2], last[3], tuple(last[4:])) if last else ((-1, -1), None, None, machine.start())
        timer = None if fired else timer
        due = machine.deadline(kept)
        first = min((x for x in (first, *(r[0] for r in new)) if x is not None), default=None)
        if (first is None or first > passed) and (due is None or due >= passed):
            if new:
                self.waiting.appendList(new)
        else:
            def expired(limit: int) -> None:
                nonlocal kept
                while (due := machine.deadline(kept)) is not None and due < limit:
                    kept, made = machine.expire(kept, due)
                    out.extend((due, None, *m) for m in made)

            rest = []
            for where, row in sorted({tuple(r[:2]): tuple(r[2:]) for r in chain(self.waiting.get(), new)}.items()):
                if where[0] > passed:
                    rest.append((*where, *row))
                elif where > place:
                    expired(where[0])
                    kept, made = machine.step(kept, where[0], row)
                    if machine.only_last:
                        out.clear()
                    out.extend((*where, *m) for m in made)
                    place = where
            expired(passed)
            self.waiting.put(rest) if rest else self.waiting.clear()
            first, due = rest[0][0] if rest else None, machine.deadline(kept)
        wanted = [x for x in (first, due) if x is not None]
        at = max(min(wanted) // 1000 + 1, passed // 1000 + 1) if wanted else None
        if at != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if at is not None:
                self.handle.registerTimer(at)
        self.kept.update((*place, first, at, *kept))
        for o in out[-1:] if machine.only_last else out:
            yield self.out(*key, *o)

    def close(self) -> None:
        pass


def names_of(ddl: str) -> list[str]:
    """Column names of a DDL text."""
    return [c.split()[0] for c in ddl.split(", ")]


def in_event_order(stream: DataFrame, machine: Machine, key: str, at: str, ident: str, delay: str, shards: int = 1) -> DataFrame:
    """``key, at, id`` and what the machine gives, of a stream; rows of deadlines have no id.

    With several ``shards`` the rows of a key are dealt to as many states by their id, each with
    a machine of its own: for machines whose outputs a later aggregate brings together.
    """
    names = names_of(machine.takes)
    kind = dict(stream.dtypes)[key]
    rows = stream.withWatermark(at, delay).select(key, at, F.unix_micros(at).alias("us"), F.col(ident).cast("long").alias("id"), *names)
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    out = rows.groupBy(key, "shard").transformWithState(
        InOrder(machine, [key, "shard"]), f"{key} {kind}, shard int, {OUT}, {machine.gives}", "append", "eventTime",
    )
    return out.withColumn("at", F.timestamp_micros("at_us")).drop("at_us", "shard")


@contextmanager
def keyed_state(spark: SparkSession):
    """The state store that keyed state with timers needs, for queries started inside."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(name, before)


class FleetMachine(Machine):
    """Hysteresis over health ticks: streak of the verdict, last good actions, and the end of a cooldown."""

    takes = "verdict string, action string, action_ok boolean"
    keeps = "verdict string, streak int, restart long, proxy_refresh long, until long"
    gives = "kind string, verdict string, streak int, since_restart long, since_refresh long"

    def __init__(self, required: int = REQUIRED_TICKS, last: int = 10, actions: dict = ACTIONS, never: int = 99999):
        self.required, self.last, self.actions, self.never = required, last, actions, never

    def start(self):
        return None, 0, None, None, None

    def _since(self, at: int, when: int | None) -> int:
        return self.never if when is None else (at - when + MINUTE // 2) // MINUTE

    def _row(self, kind: str, kept: tuple, at: int) -> tuple:
        return kind, kept[0], kept[1], self._since(at, kept[2]), self._since(at, kept[3])

    def step(self, kept, at, row):
        verdict, did, ok = row
        streak = min(self.last, kept[1] + 1) if verdict == kept[0] else 1
        good = {"restart": kept[2], "proxy_refresh": kept[3]}
        if ok and did in good:
            good[did] = at
        want, minutes = self.actions.get(verdict, (None, 0))
        end = good[want] + minutes * MINUTE if want and good[want] is not None else None
        until = end if end is not None and streak >= self.required and self._since(at, good[want]) < minutes else None
        kept = (verdict, streak, good["restart"], good["proxy_refresh"], until)
        return kept, [self._row("tick", kept, at)]

    def deadline(self, kept):
        return kept[4]

    def expire(self, kept, at):
        return (*kept[:4], None), [self._row("cooldown over", kept, at)]


def fleet_decisions(ticks: DataFrame, key: str, workers: int, delay: str, at: str = "checked_at", tie: str = "tick_id") -> DataFrame:
    """A stream of decisions: one per tick as of its time, and one when a cooldown ends that held an action back."""
    rows = in_event_order(ticks, FleetMachine(), key, at, tie, delay)
    decided = action(F.col("verdict"), F.col("streak"), F.col("since_restart"), F.col("since_refresh"), F.lit(workers))
    return rows.withColumnRenamed("id", tie).withColumn("decision", decided)


class ClaimMachine(Machine):
    """Claims on an entity: granted if it is free, failed or its claim has gone stale; stale claims expire by timer."""

    takes = "kind string, run_id string"
    keeps = "status string, holder string, claimed long"
    gives = "outcome string, run_id string"

    def __init__(self, hours: int = STALE_CLAIM_HOURS):
        self.stale = hours * HOUR

    def start(self):
        return None, None, None

    def step(self, kept, at, row):
        kind, run = row
        status, holder, _ = kept
        if kind == "claim":
            if status in (None, "failed"):
                return ("claimed", run, at), [("granted", run)]
            return kept, [("refused", run)]
        if status == "claimed" and holder == run or kind == "force":
            return (("claimed", run, at), [("granted", run)]) if kind == "force" else ((kind, run, None), [(kind, run)])
        return kept, [("not held", run)]

    def deadline(self, kept):
        return kept[2] + self.stale if kept[0] == "claimed" else None

    def expire(self, kept, at):
        return ("failed", None, None), [("expired", kept[1])]


def claim_outcomes(requests: DataFrame, key: str, delay: str, at: str = "at", tie: str = "request_id") -> DataFrame:
    """A stream of what becomes of requests: ``claim``, ``force``, or a final status that the holder reports.

    Outcomes are granted, refused, expired, not held, or the reported status; ``failed`` frees
    the entity, any other keeps it taken.
    """
    return in_event_order(requests, ClaimMachine(), key, at, tie, delay).withColumnRenamed("id", tie)


class LatestMachine(Machine):
    """The newest payload of a type, by event time and then id."""

    takes = "payload string"
    keeps = "payload string"
    gives = "payload string"
    only_last = True

    def start(self):
        return (None,)

    def step(self, kept, at, row):
        return row, [row]


def latest_payloads(events: DataFrame, key: str, payload: str, delay: str, at: str = "at", tie: str = "event_id", shards: int = 128) -> DataFrame:
    """A stream of each type's newest payloads: whenever a micro-batch brings a newer one of a shard, a row.

    Types are few and their rows many, so a type has ``shards`` states and the greatest of its rows
    by (time, id) is its newest; one shard gives only rows that are newer than all before.
    """
    return in_event_order(events.withColumnRenamed(payload, "payload"), LatestMachine(), key, at, tie, delay, shards).withColumnRenamed("id", tie)
