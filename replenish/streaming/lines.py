"""Keyed state of execution lines: what a trigger does depends on its events, not on the history.

Each line keeps, in the state store: digests of the keys of its events, the totals of its fold, the
highest cumulative quantities in external time (for each type a staircase of the events that are
no corrections), and whether it is reported as idle. Every access to the store is a message
between two processes, so all of this is one value, and only a line of many events has more buckets
of digests beside it. A trigger makes a few accesses for a line, not some for each event.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta
from decimal import Decimal
from hashlib import blake2b

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, BooleanType, DecimalType, LongType, StringType, StructField, StructType

from replenish.operators.execution import QUANTITY_KINDS
from replenish.params import UNKNOWN_STATUS
from replenish.schemas import EXECUTION_EVENTS

_UNITS = DecimalType(28, 6)
KINDS = [kind.lower() for kind in QUANTITY_KINDS]

# The totals of a line; times are microseconds, as the state store keeps them.
TOTALS = StructType(
    [
        *[StructField(f"{k}_{mode}", _UNITS) for k in KINDS for mode in ("delta", "cumulative")],
        StructField("last_at", LongType()),
        StructField("last_key", StringType()),
        StructField("last_status", StringType()),
        StructField("event_count", LongType()),
        StructField("unknown_events", LongType()),
    ]
)
# Behind the totals: when the line is due to be reported as idle and whether it is, its staircases as
# JSON, and the first bucket of the digests of its keys.
LINE = StructType(
    [
        *TOTALS.fields,
        StructField("due", LongType()),
        StructField("idle", BooleanType()),
        StructField("steps", StringType()),
        StructField("digests", BinaryType()),
    ]
)
# What a trigger puts out: new events, corrections, and lines that become idle or active.
EVENT, CORRECTED, IDLE, ACTIVE = "EVENT", "CORRECTED", "IDLE", "ACTIVE"
CHANGES = StructType([StructField("kind", StringType()), *EXECUTION_EVENTS.fields])

_NAMES = EXECUTION_EVENTS.names
_CHANGE = Row("kind", *_NAMES)

# Between Spark and its Python workers every value of a row costs a conversion of its own, so that an
# event crosses as one JSON text of strings.
PACKED = StructType([StructField("kind", StringType()), StructField("event", StringType())])
_PACKED = Row(*PACKED.names)


def packed() -> Column:
    """An event with its normalized status as one text; the casts to and from strings are exact."""
    strings = [F.col(n).cast("string").alias(n) for n in (*_NAMES, "normalized_status")]
    return F.to_json(F.struct(*strings), {"ignoreNullFields": "false"})


def unpacked(changes: DataFrame) -> DataFrame:
    """Rows of PACKED as rows of CHANGES."""
    strings = StructType([StructField(n, StringType()) for n in _NAMES])
    read = changes.select("kind", F.from_json("event", strings).alias("event"))
    return read.select(
        "kind", *[F.col(f"event.{f.name}").cast(f.dataType).alias(f.name) for f in EXECUTION_EVENTS.fields]
    )

_EPOCH = datetime(1970, 1, 1)
_BEFORE_ALL = -(1 << 62)

# A row or a dict with the columns of an event and its normalized status.
Event = Row | dict
# Where a dict keeps the text that it was read from.
_TEXT = "text of the event"


def micros(at: datetime | None) -> int | None:
    return None if at is None else (at - _EPOCH) // timedelta(microseconds=1)


def _ordered(row: Event) -> tuple:
    """The order in which `execution.dedup` prefers copies: null first."""
    names = ("received_at", "occurred_at", "line_id", "event_type", "quantity")
    return tuple((row[n] is not None, row[n]) for n in names)


def climb(
    stairs: list[tuple[int, str, Decimal]], at: int, key: str, quantity: Decimal
) -> list[tuple[int, str, Decimal]]:
    """Puts a cumulative quantity into a staircase; returns what is a correction from now on.

    `stairs` holds the events that are not below an earlier one, in external time. A new event is a
    correction if it is; otherwise it makes the lower ones after it corrections. No event
    becomes valid again, so each is returned at most once.
    """
    place = bisect_left(stairs, (at, key))
    if quantity < (stairs[place - 1][2] if place else 0):
        return [(at, key, quantity)]
    end = place
    while end < len(stairs) and stairs[end][2] < quantity:
        end += 1
    lower = stairs[place:end]
    stairs[place:end] = [(at, key, quantity)]
    return lower


# A digest of a key, and how many of them a bucket holds on average.
_DIGEST = 16
PER_BUCKET = 1024


def digest(key: str | None) -> bytes:
    """Stands for a key; two keys with one digest are not to be expected at any size."""
    return blake2b(b"" if key is None else b"=" + key.encode(), digest_size=_DIGEST).digest()


def bucket_of(name: bytes, buckets: int) -> int:
    """The bucket of a digest by linear hashing, which grows by one bucket at a time."""
    number, level = int.from_bytes(name[:8], "little"), 1 << (buckets.bit_length() - 1)
    place = number % (2 * level)
    return place if place < buckets else number % level


def add_digests(
    names: list[bytes], count: int, load: Callable[[int], bytes | None]
) -> tuple[list[bytes], dict[int, bytes]]:
    """The digests that are new to a set of `count`, and the buckets of the set that change.

    `load` reads a bucket. Only buckets of the given digests are read, and those that are split
    because the set grows: one for PER_BUCKET new ones.
    """
    buckets, held, changed = 1 + count // PER_BUCKET, {}, set()

    def bucket(place: int) -> set[bytes]:
        if place not in held:
            stored = load(place) or b""
            held[place] = {stored[n : n + _DIGEST] for n in range(0, len(stored), _DIGEST)}
        return held[place]

    fresh = []
    for name in names:
        place = bucket_of(name, buckets)
        if name not in bucket(place):
            held[place].add(name)
            changed.add(place)
            fresh.append(name)
    for added in range(buckets, 1 + (count + len(fresh)) // PER_BUCKET):
        old = added - (1 << (added.bit_length() - 1))
        held[added] = {n for n in bucket(old) if bucket_of(n, added + 1) == added}
        held[old] -= held[added]
        changed |= {old, added}
    return fresh, {place: b"".join(sorted(held[place])) for place in changed}


class LineProcessor(StatefulProcessor):
    """Events of one line -> its changes. `idle_days` without activity make an imported line idle."""

    def __init__(self, idle_days: int) -> None:
        self.idle_days = idle_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "bucket bigint", "digests binary")
        self.totals = handle.getValueState("totals", LINE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        events: dict[str, Event] = {}
        for event in map(self._read, rows):
            name = event["dedup_key"]
            if name not in events or _ordered(event) < _ordered(events[name]):
                events[name] = event
        stored = self.totals.get()
        totals = dict(zip(LINE.names, stored)) if stored else dict.fromkeys(LINE.names)
        fresh = self._unseen(events, totals)
        if not fresh:
            return
        for event in fresh:
            yield self._event(event)
        yield from self._judged(key[0], totals, fresh)
        self._add(totals, fresh)
        yield from self._watched(key[0], totals, timerValues.getCurrentWatermarkInMs())
        self.totals.update(tuple(totals.values()))

    # How events come in and changes go out.

    def _read(self, row: Row) -> Event:
        return row

    def _event(self, event: Event) -> Row:
        return self._change(EVENT, {n: event[n] for n in _NAMES})

    def _change(self, kind: str, found: dict) -> Row:
        return _CHANGE(kind, *[found.get(n) for n in _NAMES])

    def _unseen(self, events: dict[str, Event], totals: dict) -> list[Event]:
        """The events whose keys are new to the line; they are stored."""

        def load(place: int) -> bytes | None:
            stored = (totals["digests"],) if place == 0 else self.seen.getValue((place,))
            return bytes(stored[0]) if stored and stored[0] else None

        named = {digest(name): event for name, event in events.items()}
        fresh, changed = add_digests(list(named), totals["event_count"] or 0, load)
        for place, digests in changed.items():
            if place == 0:
                totals["digests"] = digests
            else:
                self.seen.updateValue((place,), (digests,))
        return [named[n] for n in fresh]

    def _judged(self, line: str | None, totals: dict, fresh: list[Event]) -> Iterator[Row]:
        by_type: dict[str, list[Event]] = {}
        for event in fresh:
            known = line is not None and event["event_type"] is not None and event["quantity"] is not None
            if known and event["quantity_mode"] == "CUMULATIVE":
                by_type.setdefault(event["event_type"], []).append(event)
        if not by_type:
            return
        steps = json.loads(totals["steps"] or "{}")
        for kind, events in by_type.items():
            stairs = [(a, k, Decimal(q)) for a, k, q in steps.get(kind, [])]
            for event in events:
                at = micros(event["occurred_at"])
                lower = climb(
                    stairs, _BEFORE_ALL if at is None else at, event["dedup_key"], event["quantity"]
                )
                for when, name, quantity in lower:
                    found = {
                        "dedup_key": name, "line_id": line, "event_type": kind, "quantity": quantity,
                        "occurred_at": None if when == _BEFORE_ALL else _EPOCH + timedelta(microseconds=when),
                    }
                    yield self._change(CORRECTED, found)
            steps[kind] = [(a, k, str(q)) for a, k, q in stairs]
        totals["steps"] = json.dumps(steps)

    @staticmethod
    def _add(totals: dict, fresh: list[Event]) -> None:
        last = _last(totals["last_at"], totals["last_key"]) if totals["event_count"] else None
        for event in fresh:
            kind, mode, quantity = event["event_type"], event["quantity_mode"], event["quantity"]
            if kind in QUANTITY_KINDS and quantity is not None and mode in ("DELTA", "CUMULATIVE"):
                name = f"{kind}_{mode}".lower()
                before = totals[name]
                if before is None:
                    totals[name] = quantity
                else:
                    totals[name] = before + quantity if mode == "DELTA" else max(before, quantity)
            at = micros(event["occurred_at"])
            if last is None or _last(at, event["dedup_key"]) > last:
                last = _last(at, event["dedup_key"])
                totals |= {
                    "last_at": at, "last_key": event["dedup_key"], "last_status": event["normalized_status"],
                }
            totals["event_count"] = (totals["event_count"] or 0) + 1
            unknown = event["normalized_status"] == UNKNOWN_STATUS
            totals["unknown_events"] = (totals["unknown_events"] or 0) + unknown

    def _watched(self, line: str | None, totals: dict, now: int) -> Iterator[Row]:
        """Moves the timer of a line to the first instant at which it counts as idle."""
        due, idle = totals["due"], bool(totals["idle"])
        waits = _total(totals, "imported") > _total(totals, "prepared")
        wanted = self._due(totals["last_at"]) if waits and totals["last_at"] is not None else None
        if wanted != due:
            if due is not None:
                self.handle.deleteTimer(due)
            if wanted is not None:
                self.handle.registerTimer(wanted)
        if idle and (wanted is None or wanted >= now):
            idle = False
            yield self._report(ACTIVE, line, totals)
        elif idle and wanted != due:
            # Late activity, but still idle: reported again with its new time.
            self.handle.deleteTimer(wanted)
            yield self._report(IDLE, line, totals)
        totals |= {"due": wanted, "idle": idle}

    def _due(self, last_at: int) -> int:
        """Two milliseconds before the day on which the line is idle: the watermark stands one
        behind the clock, and has to be past a timer."""
        day = last_at // 86_400_000_000 + self.idle_days + 1
        return day * 86_400_000 - 2

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        totals = dict(zip(LINE.names, self.totals.get()))
        if not totals["idle"] and totals["due"] == expiredTimerInfo.getExpiryTimeInMs():
            totals["idle"] = True
            self.totals.update(tuple(totals.values()))
            yield self._report(IDLE, key[0], totals)

    def _report(self, kind: str, line: str | None, totals: dict) -> Row:
        found = {
            "line_id": line, "dedup_key": totals["last_key"],
            "occurred_at": _EPOCH + timedelta(microseconds=totals["last_at"] or 0),
        }
        return self._change(kind, found)

    def close(self) -> None:
        pass


class PackedLineProcessor(LineProcessor):
    """The same over rows that hold an event as one text (`packed`); puts out rows of PACKED."""

    def _read(self, row: Row) -> Event:
        text = row["event"]
        event = json.loads(text)
        for name in ("occurred_at", "received_at"):
            if event[name] is not None:
                event[name] = datetime.fromisoformat(event[name])
        if event["quantity"] is not None:
            event["quantity"] = Decimal(event["quantity"])
        event[_TEXT] = text
        return event

    def _event(self, event: Event) -> Row:
        return _PACKED(EVENT, event[_TEXT])

    def _change(self, kind: str, found: dict) -> Row:
        return _PACKED(kind, json.dumps({n: None if v is None else str(v) for n, v in found.items()}))


def _last(at: int | None, key: str | None) -> tuple:
    return (at is not None, at or 0, key is not None, key or "")


def _total(totals: dict, kind: str) -> Decimal:
    return sum((totals[f"{kind}_{mode}"] or Decimal(0)) for mode in ("delta", "cumulative"))
