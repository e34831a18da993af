"""Events that cross to the Python workers as one text: exact both ways, the same changes as from columns."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import Row
from pyspark.sql import functions as F
from test_line_state import NAMES, Store, events

from replenish import schemas
from replenish.streaming import lines

ODD = [
    ("K1", "I", "line \"1\"\n,é", "IMPORTED", "TER", "CUMULATIVE", Decimal("0.000001"), None,
     datetime(2026, 3, 29, 2, 30, 0, 123456), datetime(1, 1, 1), "v1"),
    ("", None, "", None, None, "DELTA", Decimal("-999999999999.999999"), "null", datetime(9999, 12, 31, 23, 59, 59, 999999),
     None, ""),
    (None,) * 11,
]


def test_packed_events_come_back_exactly(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # 02:30 does not exist there on that day
        given = spark.createDataFrame(ODD, schemas.EXECUTION_EVENTS).withColumn("normalized_status", F.lit("X"))
        packed = given.select(F.lit(lines.EVENT).alias("kind"), lines.packed().alias("event"))
        assert packed.schema.simpleString() == lines.PACKED.simpleString()
        back = lines.unpacked(packed)
        assert back.schema.simpleString() == lines.CHANGES.simpleString()
        key = str
        assert sorted((tuple(r)[1:] for r in back.collect()), key=key) == sorted(ODD, key=key)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_packed_lines_change_as_plain_ones(spark):
    later = datetime(2026, 8, 3) + timedelta(days=1)
    rows = [e.asDict() for e in events([3, 40, 5, 5, 17, 200, 8])]
    rows += [r | {"received_at": later, "quantity": Decimal("1.5")} for r in rows[:3]]
    rows = [r | {"quantity": r["quantity"].quantize(Decimal("0.000001"))} for r in rows]
    plain = [Row(*r)(*r.values()) for r in rows]
    texts = spark.createDataFrame(
        [tuple(r[n] for n in NAMES) for r in rows], schemas.EXECUTION_EVENTS
    ).withColumn("normalized_status", F.lit("CREATED")).coalesce(1).select(lines.packed().alias("event")).collect()
    found, states = [], []
    for processor, given in ((lines.LineProcessor(1), plain), (lines.PackedLineProcessor(1), texts)):
        store = Store()
        processor.init(store)
        found.append(list(processor.handleInputRows(("A",), iter(given), store)))
        states.append(store.value)
    assert states[0] == states[1]
    assert {r["kind"] for r in found[0]} == {lines.EVENT, lines.CORRECTED}
    back = lines.unpacked(spark.createDataFrame(found[1], lines.PACKED))
    wanted = spark.createDataFrame(found[0], lines.CHANGES)
    assert sorted(map(str, back.collect())) == sorted(map(str, wanted.collect()))
