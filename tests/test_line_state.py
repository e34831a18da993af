"""The keyed state of a line: few accesses to the store, exact keys over many buckets."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import Row

from replenish import schemas
from replenish.streaming import lines

NAMES = [*schemas.EXECUTION_EVENTS.names]
EVENT = Row(*NAMES, *({"normalized_status"} - set(NAMES)))


class Store:
    """Stands for the handle, its variables and the timers; counts the accesses."""

    def __init__(self):
        self.value, self.map, self.accesses = None, {}, 0

    def getValueState(self, name, schema):
        return self

    def getMapState(self, name, key, value):
        return Buckets(self)

    def get(self):
        self.accesses += 1
        return self.value

    def update(self, value):
        self.accesses += 1
        self.value = value

    def registerTimer(self, at):
        self.accesses += 1

    deleteTimer = registerTimer

    def getCurrentWatermarkInMs(self):
        return 0


class Buckets:
    def __init__(self, store):
        self.store = store

    def getValue(self, key):
        self.store.accesses += 1
        return self.store.map.get(key)

    def updateValue(self, key, value):
        self.store.accesses += 1
        self.store.map[key] = value


def events(numbers):
    at = datetime(2026, 8, 3)
    for n in numbers:
        given = {
            "dedup_key": f"E{n}", "line_id": "A", "event_type": "IMPORTED", "quantity_mode": "CUMULATIVE",
            "quantity": Decimal(n % 13), "occurred_at": at + timedelta(seconds=n), "received_at": at,
            "normalized_status": "CREATED",
        }
        yield EVENT(*[given.get(name) for name in EVENT])


def run(store, numbers):
    line = lines.LineProcessor(1)
    line.init(store)
    before = store.accesses
    out = list(line.handleInputRows(("A",), events(numbers), store))
    return sorted(r["dedup_key"] for r in out if r["kind"] == lines.EVENT), store.accesses - before


def test_a_trigger_makes_a_few_accesses_for_a_line():
    store = Store()
    fresh, accesses = run(store, range(500))
    assert len(fresh) == 500 and accesses <= 4
    fresh, accesses = run(store, range(400, 600))
    assert fresh == sorted(f"E{n}" for n in range(500, 600)) and accesses <= 4
    assert run(store, range(600)) == ([], 1)


def test_keys_of_a_long_line_stay_exact_over_many_buckets():
    store, rng, seen = Store(), random.Random(5), set()
    for _ in range(40):
        numbers = [rng.randrange(12000) for _ in range(rng.choice([1, 30, 900]))]
        fresh, accesses = run(store, numbers)
        assert fresh == sorted(f"E{n}" for n in set(numbers) - seen)
        assert accesses <= 4 + 2 * min(len(set(numbers)), len(store.map)) + 4
        seen |= set(numbers)
    assert len(store.map) == len(seen) // lines.PER_BUCKET > 4
    sizes = [len(v[0]) // 16 for v in store.map.values()]
    assert sum(sizes) < len(seen) and max(sizes) <= 4 * lines.PER_BUCKET
