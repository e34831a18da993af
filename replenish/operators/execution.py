"""Import confirmations and execution events, in batch."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from replenish.functions.exprs import any_of, codes, dec, earliest, num
from replenish.operators.scale import look_up, materialise, running_before
from replenish.params import STATUS_MAP, UNKNOWN_STATUS

ALERTS = ArrayType(StringType(), False)
QUANTITY_KINDS = ("IMPORTED", "PREPARED", "DISPATCHED", "CANCELLED")


def confirm_imports(
    requests: DataFrame, lines: DataFrame, accepted: DataFrame
) -> DataFrame:
    """Outcome of every (adapter, key, line): the first request counts, later ones are replays.

    `lines` holds `line_id`, `line_version` and `open_quantity`; `accepted` the keys accepted
    earlier. A replay gets the earlier result again, and an accepted import reduces no backlog.
    """
    key = ["adapter", "idempotency_key", "line_id"]
    payload = F.struct("line_version", "quantity", "requested_at", "snapshot_version", "operator")
    first = (
        requests.groupBy(*key)
        .agg(
            earliest(payload, "requested_at", "line_version", "quantity").alias("request"),
            F.count(F.lit(1)).alias("requests"),
        )
        .select(*key, "request.*", "requests")
    )
    known = lines.select(
        "line_id", F.col("line_version").alias("current_version"), "open_quantity"
    )
    before = accepted.select(*key).distinct().withColumn("was_accepted", F.lit(True))
    joined = first.join(known, "line_id", "left").join(before, key, "left")
    valid = (
        (F.col("quantity") > 0) & F.col("line_version").isNotNull()
        & F.col("line_id").isNotNull() & F.col("idempotency_key").isNotNull()
    )
    outcome = (
        F.when(F.col("was_accepted"), "ALREADY_ACCEPTED")
        .when(~F.coalesce(valid, F.lit(False)), "INVALID")
        .when(F.col("current_version").isNull(), "NOT_FOUND")
        .when(F.col("line_version") != F.col("current_version"), "STALE_VERSION")
        .when(F.col("quantity") > F.col("open_quantity"), "QUANTITY_EXCEEDS_OPEN")
        .otherwise("ACCEPTED")
    )
    return joined.withColumns(
        {"outcome": outcome, "replays": F.col("requests") - 1}
    ).drop("was_accepted", "requests")


def import_totals(lines: DataFrame) -> DataFrame:
    """Header totals of each import."""
    return lines.groupBy("import_id").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum("imported_quantity").alias("total_imported_quantity"),
        F.sum("prepared_quantity").alias("total_prepared_quantity"),
    )


def dedup(events: DataFrame) -> DataFrame:
    """The first received copy of every event; copies combine on the map side."""
    rest = [c for c in events.columns if c != "dedup_key"]
    order = ["received_at", "occurred_at", "line_id", "event_type", "quantity"]
    return (
        events.groupBy("dedup_key")
        .agg(earliest(F.struct(*rest), *order).alias("event"))
        .select("dedup_key", "event.*")
    )


def new_events(events: DataFrame, stored: DataFrame) -> DataFrame:
    """Events whose key has not been stored yet: the durable side of deduplication."""
    return dedup(events).join(stored.select("dedup_key"), "dedup_key", "left_anti")


def status_lookup(mapping: Mapping[str, str] = STATUS_MAP) -> Column:
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.create_map(*pairs)


def normalize(
    events: DataFrame, mapping: Mapping[str, str] | DataFrame = STATUS_MAP
) -> DataFrame:
    """Normalised status next to the external one; an unmapped code is UNKNOWN and alerts.

    `mapping` is a fixed dictionary, or a table with one row per mapping version and code.
    """
    if isinstance(mapping, DataFrame):
        table = mapping.select(
            "mapping_version", "external_status", F.col("normalized_status").alias("mapped")
        )
        looked_up = events.join(table, ["mapping_version", "external_status"], "left")
    else:
        looked_up = events.withColumn(
            "mapped", F.try_element_at(status_lookup(mapping), F.col("external_status"))
        )
    return looked_up.withColumns(
        {
            "normalized_status": F.coalesce("mapped", F.lit(UNKNOWN_STATUS)),
            "alert_codes": codes((F.col("mapped").isNull(), "UNKNOWN_EXTERNAL_STATUS")),
        }
    ).drop("mapped")


def to_delta(events: DataFrame) -> DataFrame:
    """Every event with the quantity it adds. The mode is stated by the event, never inferred.

    A cumulative event adds what exceeds the highest cumulative quantity before it, in external
    time order. A lower one adds nothing, and is marked as a correction.
    """
    cumulative = F.col("quantity_mode") == "CUMULATIVE"
    ordered = running_before(
        events,
        ["line_id", "event_type"],
        [F.col("occurred_at"), F.col("dedup_key")],
        {"highest": ("max", F.when(cumulative, F.col("quantity")))},
    )
    before = F.coalesce("highest", num(0))
    lower = cumulative & (F.col("quantity") < before)
    return ordered.withColumns(
        {
            "delta_quantity": F.when(
                cumulative, dec(F.greatest(F.col("quantity") - before, num(0, 19, 6)))
            ).otherwise(F.col("quantity")),
            "record_type": F.when(lower, "CORRECTED").otherwise(F.col("event_type")),
            "correction_alert": codes((lower, "CUMULATIVE_DECREASED")),
        }
    ).drop("highest")


def line_parts(events: DataFrame) -> DataFrame:
    """What a set of normalised events adds to the state of its lines: sums of deltas, highest
    cumulative quantities, the last event and counts. Parts of disjoint sets can be merged in any
    order, so batch and stream agree."""
    measures = []
    for kind in QUANTITY_KINDS:
        here = F.col("event_type") == kind
        for mode, total in (("DELTA", F.sum), ("CUMULATIVE", F.max)):
            value = F.when(here & (F.col("quantity_mode") == mode), F.col("quantity"))
            measures.append(total(value).cast("decimal(28,6)").alias(f"{kind}_{mode}".lower()))
    return events.groupBy("line_id").agg(
        *measures,
        F.max(F.struct("occurred_at", "dedup_key", "normalized_status")).alias("last"),
        F.count(F.lit(1)).alias("event_count"),
        F.count_if(F.col("normalized_status") == UNKNOWN_STATUS).alias("unknown_events"),
    )


def merged_parts(parts: DataFrame) -> DataFrame:
    """Parts of disjoint sets of events as one row per line."""
    kinds = [k.lower() for k in QUANTITY_KINDS]
    return parts.groupBy("line_id").agg(
        *[F.sum(f"{k}_delta").cast("decimal(28,6)").alias(f"{k}_delta") for k in kinds],
        *[F.max(f"{k}_cumulative").alias(f"{k}_cumulative") for k in kinds],
        F.max("last").alias("last"),
        F.sum("event_count").alias("event_count"),
        F.sum("unknown_events").alias("unknown_events"),
    )


def line_state(parts: DataFrame) -> DataFrame:
    """State of every line from one row of parts: quantities, last status and counts."""
    none = num(0, 28, 6)
    return parts.select(
        "line_id",
        *[
            dec(
                F.coalesce(F.col(f"{k}_delta"), none) + F.coalesce(F.col(f"{k}_cumulative"), none), 28, 6
            ).alias(f"{k}_quantity")
            for k in (kind.lower() for kind in QUANTITY_KINDS)
        ],
        F.col("last.normalized_status").alias("last_status"),
        F.col("last.occurred_at").alias("last_activity"),
        "event_count",
        "unknown_events",
    )


def fold(events: DataFrame) -> DataFrame:
    """State of every line from its deduplicated, normalised events.

    Unknown states are shown, and close nothing.
    """
    return line_state(line_parts(events))


def quarantine(events: DataFrame, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid events, and events set aside with their reasons.

    Unknown references, invalid data and all preparation events of a line that prepared more than
    it imported are set aside until reconciled.
    """
    known = lines.select("line_id").distinct().withColumn("known_line", F.lit(True))
    # One row per line: whether it is known, and whether it prepared more than it imported.
    events = materialise(events)
    facts = materialise(
        fold(events)
        .select(
            "line_id", (F.col("prepared_quantity") > F.col("imported_quantity")).alias("exceeds")
        )
        .join(known, "line_id", "left")
    )
    checked = (
        look_up(events, facts, ["line_id"])
        .withColumn(
            "isolation_codes",
            codes(
                (F.col("known_line").isNull(), "UNKNOWN_REFERENCE"),
                (
                    any_of(
                        F.col("quantity").isNull(), F.coalesce(F.col("quantity") < 0, F.lit(True)),
                        F.col("occurred_at").isNull(),
                        ~F.coalesce(
                            F.col("quantity_mode").isin("DELTA", "CUMULATIVE"), F.lit(False)
                        ),
                    ),
                    "INVALID_DATA",
                ),
                (
                    F.col("exceeds") & (F.col("event_type") == "PREPARED"),
                    "PREPARED_EXCEEDS_IMPORTED",
                ),
            ),
        )
        .drop("known_line", "exceeds")
    )
    clean = F.size("isolation_codes") == 0
    return checked.filter(clean).drop("isolation_codes"), checked.filter(~clean)


def remaining(state: DataFrame, need: str = "need_quantity") -> DataFrame:
    """Open need and imported-but-unprepared quantity: two views of one demand, never added.

    Importing reduces nothing; preparation or dispatch (whichever is further) and cancellation do.
    """
    done = F.greatest("prepared_quantity", "dispatched_quantity") + F.col("cancelled_quantity")
    return state.withColumns(
        {
            "open_quantity": dec(F.greatest(F.col(need) - done, num(0, 30, 6))),
            "import_unprepared": dec(
                F.greatest(F.col("imported_quantity") - F.col("prepared_quantity"), num(0, 29, 6))
            ),
        }
    )


def idle(state: DataFrame, as_of: date, days: int) -> DataFrame:
    """Imported lines that are not fully prepared and saw no activity for `days` days."""
    return state.filter(
        (F.col("imported_quantity") > F.col("prepared_quantity"))
        & (F.to_date("last_activity") < F.date_sub(F.lit(as_of), days))
    ).withColumn("idle_days", F.datediff(F.lit(as_of), F.to_date("last_activity")))


def daily_counts(events: DataFrame) -> DataFrame:
    """Events per business day and type with their quantity and reporting lag."""
    lag = F.timestamp_diff("SECOND", F.col("occurred_at"), F.col("received_at"))
    return (
        events.groupBy(F.window("occurred_at", "1 day").alias("day"), "event_type")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.sum("quantity").alias("quantity"),
            F.max(lag).alias("max_lag_seconds"),
        )
        .select(F.to_date("day.start").alias("day"), "event_type", "events", "quantity",
                "max_lag_seconds")
    )


def version_check(import_lines: DataFrame, backlog_versions: DataFrame) -> DataFrame:
    """Import lines next to the current version of their backlog line."""
    current = backlog_versions.groupBy("line_id").agg(
        F.max("line_version").alias("current_version")
    )
    return import_lines.join(current, "line_id", "left").withColumn(
        "version_status",
        F.when(F.col("current_version").isNull(), "NOT_FOUND")
        .when(F.col("line_version") < F.col("current_version"), "STALE_VERSION")
        .otherwise("CURRENT"),
    )


def orphans(events: DataFrame, lines: DataFrame) -> DataFrame:
    """Events whose line is unknown."""
    return events.join(lines.select("line_id"), "line_id", "left_anti")
