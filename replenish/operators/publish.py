"""Staged publication of estimates, the current projection and the run registry."""

from __future__ import annotations

import json
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)
from pyspark.sql.utils import AnalysisException

from replenish.functions.exprs import checksum, codes, latest
from replenish.operators import reconcile
from replenish.schemas import DEMAND_ESTIMATE
from replenish.sources import files

PAIR = ["article_id", "branch_id"]
CHECKED = ["business_date", *PAIR, "status", "basal_daily_demand", "input_checksum"]
CHECKED_VALUES = [c for c in CHECKED if c not in PAIR]
STAGED = [f.name for f in DEMAND_ESTIMATE]

RUN = StructType(
    [
        StructField("run_id", StringType()),
        StructField("run_type", StringType()),
        StructField("business_date", DateType()),
        StructField("cutoff_date", DateType()),
        StructField("scope_id", StringType()),
        StructField("attempt_no", IntegerType()),
        StructField("status", StringType()),
        StructField("input_rows", LongType()),
        StructField("output_rows", LongType()),
        StructField("warnings", LongType()),
        StructField("errors", LongType()),
        StructField("recorded_at", TimestampNTZType()),
    ]
)
RUN_KEY = ["run_type", "business_date", "scope_id"]


class PublicationRejected(RuntimeError):
    """The staged rows differ from their source; the last good projection stays in force."""


def control_totals(estimates: DataFrame) -> DataFrame:
    """Rows, distinct pairs and checksum of a set of estimates."""
    per_pair = estimates.groupBy(*PAIR).agg(
        F.count(F.lit(1)).alias("copies"), checksum(*CHECKED).alias("part")
    )
    return per_pair.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("pairs"),
        F.sum("part").alias("checksum"),
        F.count_if(F.col("copies") > 1).alias("duplicate_pairs"),
    )


def outside_scope(rows: DataFrame, scope_pairs: DataFrame) -> DataFrame:
    """Rows whose pair is not part of the scope."""
    return rows.join(scope_pairs.select(*PAIR), PAIR, "left_anti")


def next_current(current: DataFrame, estimates: DataFrame, scope_pairs: DataFrame) -> DataFrame:
    """The projection after a publication.

    A new usable estimate replaces the pair's row unless that has a later business date. A blocked
    pair keeps its last usable estimate, with its own date. Pairs that left the scope are retired.
    """
    rest = [c for c in current.columns if c not in PAIR]
    kept = current.join(scope_pairs.select(*PAIR), PAIR, "left_semi")
    usable = estimates.filter(F.col("status") != "BLOCKED").select(*current.columns)
    both = kept.withColumn("_new", F.lit(0)).unionByName(usable.withColumn("_new", F.lit(1)))
    return (
        both.groupBy(*PAIR)
        .agg(latest(F.struct(*rest), "business_date", "_new").alias("row"))
        .select(*PAIR, "row.*")
        .select(*current.columns)
    )


def retired(current: DataFrame, scope_pairs: DataFrame) -> DataFrame:
    return outside_scope(current, scope_pairs)


def unexplained(before: DataFrame, stage: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of the projection that changed but are not what was staged for their pair.

    The projection is compared with the one in force by their trees, so only pairs that changed
    meet their staged rows.
    """
    changed = reconcile.differences(before, after, PAIR, CHECKED_VALUES).filter("stage_rows > 0")
    wanted = stage.select(*PAIR, F.struct(*CHECKED_VALUES).alias("wanted"))
    return (
        changed.join(wanted, PAIR, "left")
        .filter((F.col("stage_rows") > 1) | ~F.col("stage").eqNullSafe(F.col("wanted")))
        .select(*PAIR, "stage", "wanted")
    )


def _read(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], schema)


def register_run(spark: SparkSession, root: str, **record: object) -> str:
    """Append one line to the run registry; records are never changed."""
    run_id = str(record.get("run_id") or uuid.uuid4())
    filled = {**record, "run_id": run_id, "recorded_at": datetime.now()}
    if record.get("cutoff_date") and record["cutoff_date"] >= record["business_date"]:
        raise ValueError("the cutoff has to lie before the business date")
    row = tuple(filled.get(f.name) for f in RUN)
    spark.createDataFrame([row], RUN).coalesce(1).write.mode("append").json(f"{root}/runs")
    return run_id


def runs(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, f"{root}/runs", RUN, "json")


def current_runs(all_runs: DataFrame) -> DataFrame:
    """The one run in force per type, date and scope: the newest successful attempt."""
    rest = [c for c in RUN.names if c not in RUN_KEY]
    return (
        all_runs.filter(F.col("status") == "SUCCEEDED")
        .groupBy(*RUN_KEY)
        .agg(latest(F.struct(*rest), "attempt_no", "recorded_at").alias("run"))
        .select(*RUN_KEY, "run.*")
    )


def next_attempt(all_runs: DataFrame, run_type: str, business_date, scope_id: str) -> int:
    found = all_runs.filter(
        (F.col("run_type") == run_type) & (F.col("business_date") == F.lit(business_date))
        & (F.col("scope_id") == scope_id)
    ).agg(F.max("attempt_no"))
    return int(found.first()[0] or 0) + 1


# The states of a publication, in the order they are reached.
STATES = ("PENDING", "STAGING", "VALIDATED", "PUBLISHED")
# Start of the names of the records that switch the projection.
_SWITCH = "published-"
_PUBLICATION = StructType(
    [
        StructField("sequence", LongType()),
        StructField("batch_id", StringType()),
        StructField("attempt", StringType()),
        StructField("status", StringType()),
        StructField("rows", LongType()),
        StructField("checksum", StringType()),
        StructField("is_empty", BooleanType()),
        StructField("recorded_at", TimestampNTZType()),
    ]
)


def publications(spark: SparkSession, root: str) -> DataFrame:
    """The log: one record per state that an attempt reached; records are never changed."""
    return _read(spark, f"{root}/publications", _PUBLICATION, "json")


def in_force(spark: SparkSession, root: str) -> Row | None:
    """The record of the last completed publication. It is the pointer to the projection."""
    return (
        publications(spark, root)
        .filter(F.col("status") == "PUBLISHED")
        .orderBy(F.col("sequence").desc())
        .first()
    )


def history(spark: SparkSession, root: str) -> DataFrame:
    """All completed publications with their state now: PUBLISHED or SUPERSEDED."""
    done = publications(spark, root).filter(F.col("status") == "PUBLISHED")
    last = done.agg(F.max("sequence").alias("last"))  # one row
    return done.join(F.broadcast(last)).select(
        "sequence", "batch_id", "attempt", "rows", "checksum", "is_empty", "recorded_at",
        F.when(F.col("sequence") == F.col("last"), "PUBLISHED").otherwise("SUPERSEDED").alias("status"),
    )


def published_rows(spark: SparkSession, root: str, batch_id: str) -> DataFrame:
    """The rows of a batch as they were published last."""
    record = (
        history(spark, root).filter(F.col("batch_id") == batch_id)
        .orderBy(F.col("sequence").desc()).first()
    )
    if record is None:
        return spark.createDataFrame([], DEMAND_ESTIMATE)
    return spark.read.schema(DEMAND_ESTIMATE).parquet(
        f"{root}/estimates/{record['batch_id']}/{record['attempt']}"
    )


def current(spark: SparkSession, root: str) -> DataFrame:
    """The projection of the last completed publication."""
    return _projection(spark, root, in_force(spark, root))


def _projection(spark: SparkSession, root: str, last: Row | None) -> DataFrame:
    if last is None:
        return spark.createDataFrame([], DEMAND_ESTIMATE)
    return spark.read.schema(DEMAND_ESTIMATE).parquet(
        f"{root}/current/{last['batch_id']}/{last['attempt']}"
    )


def _next_number(spark: SparkSession, root: str) -> int:
    """The number that the next publication takes. A record that is still empty is being written,
    or its writer died; it has to be settled before anything is built on the projection."""
    names = [n for n in files.files_in(spark, f"{root}/publications") if n.startswith(_SWITCH)]
    if not names:
        return 1
    newest = names[-1]
    if not files.read_text(spark, f"{root}/publications/{newest}").strip():
        raise PublicationRejected(f"{newest} is being written; remove it if its writer has died")
    return int(newest.removeprefix(_SWITCH).removesuffix(".json")) + 1


def _record(spark: SparkSession, root: str, **values: object) -> None:
    """Adds a record; its sequence is the number of the publication and the state. The record that
    switches is a file named by its number, which must not exist, so of two publishers that built on
    the same projection only one switches it."""
    now = datetime.now().isoformat(timespec="microseconds")
    number, status = values["number"], values["status"]
    step = STATES.index(status) if status in STATES else len(STATES)
    filled = {**values, "sequence": number * (len(STATES) + 1) + step, "recorded_at": now}
    switch = status == "PUBLISHED"
    name = f"{_SWITCH}{number:010d}" if switch else f"state-{now.replace(':', '')}-{uuid.uuid4().hex}"
    text = json.dumps({f.name: filled.get(f.name) for f in _PUBLICATION}) + "\n"
    if not files.write_new(spark, f"{root}/publications/{name}.json", text):
        raise PublicationRejected(f"publication {number} was made by another attempt meanwhile")


def publish(
    spark: SparkSession, root: str, estimates: DataFrame, scope_pairs: DataFrame, batch_id: str
) -> dict[str, int]:
    """Stage, verify, publish and switch the projection; the PUBLISHED record is the switch.

    Every attempt writes to folders of its own, so nothing that a reader uses is ever overwritten:
    a failed, repeated or broken-off attempt leaves the projection in force as it is. A batch that
    is published again with the same rows changes nothing.
    """
    attempt = uuid.uuid4().hex
    # The projection that this attempt builds on; its number is free as long as that is in force.
    number = _next_number(spark, root)
    last = in_force(spark, root)

    def record(status: str, rows: int = 0, checksum_: object = None) -> None:
        _record(
            spark, root, number=number, batch_id=batch_id, attempt=attempt, status=status, rows=rows,
            checksum=None if checksum_ is None else str(checksum_), is_empty=rows == 0,
        )

    record("PENDING")
    # Rows and checksum of the source are taken while it is written.
    seen = Observation()
    staged = f"{root}/estimates/{batch_id}/{attempt}"
    estimates.select(*STAGED).observe(
        seen, F.count(F.lit(1)).alias("rows"), checksum(*CHECKED).alias("checksum")
    ).write.parquet(staged)
    source = seen.get
    record("STAGING", source["rows"], source["checksum"])
    stage = spark.read.schema(DEMAND_ESTIMATE).parquet(staged)
    found = control_totals(stage).first()
    total = found["checksum"] if found["checksum"] is not None else 0
    strangers = not outside_scope(stage, scope_pairs).isEmpty()
    differs = (source["rows"], source["checksum"]) != (found["rows"], total)
    if differs or found["duplicate_pairs"] or strangers:
        record("FAILED", found["rows"], total)
        raise PublicationRejected(
            f"batch {batch_id}: expected {source}, staged {found}, outside scope: {strangers}"
        )
    record("VALIDATED", found["rows"], total)
    if last is not None and (last["batch_id"], last["rows"], last["checksum"]) == (
        batch_id, found["rows"], str(total)
    ):
        return {"rows": found["rows"], "retired": 0}
    before = _projection(spark, root, last)
    leaving = retired(before, scope_pairs).count()
    switched = f"{root}/current/{batch_id}/{attempt}"
    next_current(before, stage, scope_pairs).write.parquet(switched)
    after = spark.read.schema(DEMAND_ESTIMATE).parquet(switched)
    wrong = unexplained(before, stage, after)
    if not wrong.isEmpty():
        record("FAILED", found["rows"], total)
        raise PublicationRejected(f"batch {batch_id}: rows of the projection without a source")
    record("PUBLISHED", found["rows"], total)
    return {"rows": found["rows"], "retired": leaving}


def source_gate(profiles: DataFrame) -> DataFrame:
    """Source snapshots that stop a run, with the reason."""
    return profiles.withColumn(
        "reason", codes((F.col("status") != "VALID", "SOURCE_NOT_VALID"))
    ).filter(F.size("reason") > 0)
