"""Tables by month with atomic commits: pruned reads, change-hash upsert, append of new keys."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replenish.functions.exprs import any_of, bar_hash, month_of, text_or_blank
from replenish.functions.windows import Span, month_labels
from replenish.operators.scale import duplicate_keys, materialise
from replenish.schemas import TABLES, TableSpec
from replenish.sources.files import files_in, read_text, remove, subfolders, write_new


@dataclass(frozen=True)
class JobResult:
    """What a load changed."""

    job: str
    start: date
    end: date
    inserted: int
    updated: int
    months: tuple[str, ...]

    @property
    def rows(self) -> int:
        return self.inserted + self.updated


class ConcurrentWrite(RuntimeError):
    """Another writer committed first; nothing of this write is visible."""


class MonthlyStore:
    """Tables under one folder; every month of a table is a list of immutable data folders.

    A commit is one small file that names the folders of every month. It is written last and must
    not exist before, so readers see the table before or after a write, never a mix, a broken-off
    write leaves no trace, and of two writers at the same time one fails. `vacuum` removes folders
    that no commit names any more.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root

    def spec(self, table: str | TableSpec) -> TableSpec:
        name = table.name if isinstance(table, TableSpec) else table
        if name not in TABLES:
            raise ValueError(f"unknown table {name}")
        return TABLES[name]

    def path(self, table: str | TableSpec) -> str:
        return f"{self.root}/{self.spec(table).name}"

    def commits(self, table: str | TableSpec) -> list[int]:
        """Numbers of the commits, oldest first."""
        names = files_in(self.spark, f"{self.path(table)}/commits")
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]

    def folders(self, table: str | TableSpec, commit: int | None = None) -> dict[str, list[str]]:
        """Data folders of every month, as of a commit or now."""
        numbers = self.commits(table) if commit is None else [commit]
        if not numbers:
            return {}
        return json.loads(read_text(self.spark, f"{self.path(table)}/commits/{numbers[-1]:010d}.json"))

    def _commit(self, spec: TableSpec, after: int, folders: dict[str, list[str]]) -> None:
        path = f"{self.path(spec)}/commits/{after + 1:010d}.json"
        if not write_new(self.spark, path, json.dumps(folders, sort_keys=True)):
            raise ConcurrentWrite(f"{spec.name}: commit {after + 1} exists")

    def _months(self, spec: TableSpec, folders: dict[str, list[str]], months: Iterable[str]) -> DataFrame:
        """Rows of the given months, with their month. Other months are not even listed."""
        paths = [f"{self.path(spec)}/{f}" for m in sorted(set(months)) for f in folders.get(m, [])]
        rows = (
            self.spark.read.schema(spec.schema).parquet(*paths)
            if paths
            else self.spark.createDataFrame([], spec.schema)
        )
        return rows.withColumn("month", month_of(spec.date_column))

    def read(self, table: str | TableSpec, *spans: Span, commit: int | None = None) -> DataFrame:
        """Rows of the given date ranges, or all; as of a commit, or now."""
        spec = self.spec(table)
        folders = self.folders(spec, commit)
        wanted = month_labels(*spans) if spans else folders
        rows = self._months(spec, folders, wanted)
        if spans:
            rows = rows.filter(any_of(*[s.holds(F.col(spec.date_column)) for s in spans]))
        return rows.drop("month")

    def newest(self, table: str | TableSpec) -> DataFrame:
        """Rows of the newest month."""
        spec = self.spec(table)
        folders = self.folders(spec)
        return self._months(spec, folders, sorted(folders)[-1:]).drop("month")

    def bounds(self, table: str | TableSpec) -> DataFrame:
        """One row: first and last date and number of rows of a table.

        Answered from the statistics in the footers of its files, no column is read: a session of its
        own reads Parquet through the interface that pushes aggregates down to them.
        """
        spec = self.spec(table)
        side = self.spark.newSession()
        side.conf.set("spark.sql.sources.useV1SourceList", "")
        side.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        day = spec.date_column
        folders = self.folders(spec)
        paths = [f"{self.path(spec)}/{f}" for m in folders for f in folders[m]]
        rows = (
            side.read.schema(spec.schema).parquet(*paths)
            if paths
            else side.createDataFrame([], spec.schema)
        )
        return rows.agg(
            F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count(F.lit(1)).alias("rows")
        )

    def months(self, table: str | TableSpec) -> list[str]:
        return sorted(self.folders(table))

    def _shaped(self, spec: TableSpec, incoming: DataFrame) -> DataFrame:
        named = incoming.withColumns(
            {
                f.name: F.lit(None).cast(f.dataType)
                for f in spec.schema.fields
                if f.name not in incoming.columns
            }
        )
        return named.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields],
            month_of(spec.date_column).alias("month"),
        )

    def _write(self, spec: TableSpec, rows: DataFrame, months: Iterable[str]) -> dict[str, str]:
        """Writes rows of the given months to new folders; the folder of every month."""
        name = f"data/{uuid.uuid4().hex}"
        # Adaptive execution sizes the files: a large month is split, small ones are merged. The
        # order inside a file gives its row groups narrow ranges of articles.
        keys = [k for k in ("article_id", "branch_id") if k in spec.keys]
        (
            rows.hint("rebalance", "month")
            .sortWithinPartitions("month", *keys, spec.date_column)
            .write.partitionBy("month")
            .parquet(f"{self.path(spec)}/{name}")
        )
        return {m: f"{name}/month={m}" for m in months}

    def upsert(self, table: str | TableSpec, incoming: DataFrame, *spans: Span) -> JobResult:
        """Insert new keys and replace rows whose change columns differ; never deletes.

        Only keys and change columns of the touched months are compared. Months without a change
        are not rewritten. Changes have to differ in their keys; a row that equals the stored one is
        no change.
        """
        spec = self.spec(table)
        if not spec.change_columns:
            raise ValueError(f"{spec.name} is append-only")
        keys = list(spec.keys)
        number = max(self.commits(spec), default=0)
        folders = self.folders(spec, number or None)
        shaped = self._shaped(spec, incoming)
        existing = self._months(spec, folders, month_labels(*spans))
        known = existing.select(
            "month", *keys, F.lit(True).alias("_known"),
            *[F.col(c).alias(f"_old_{c}") for c in spec.change_columns],
        )
        differs = any_of(
            *[~F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in spec.change_columns]
        )
        changes = materialise(
            shaped.join(known, ["month", *keys], "left")
            .filter(F.col("_known").isNull() | differs)
            .withColumn("_action", F.when(F.col("_known").isNull(), "I").otherwise("U"))
            .select(*shaped.columns, "_action")
        )
        # At most one row per month and action.
        counts = changes.groupBy("month", "_action").count().collect()
        if not duplicate_keys(changes, keys).isEmpty():
            raise ValueError(f"{spec.name}: several incoming rows have the same key")
        touched = sorted({r["month"] for r in counts})
        if touched:
            kept = self._months(spec, folders, touched).join(
                changes.select("month", *keys), ["month", *keys], "left_anti"
            )
            written = self._write(
                spec, kept.select(*shaped.columns).unionByName(changes.drop("_action")), touched
            )
            self._commit(spec, number, folders | {m: [f] for m, f in written.items()})
        done = {a: sum(r["count"] for r in counts if r["_action"] == a) for a in ("I", "U")}
        return JobResult(
            spec.name, min(s.start for s in spans), max(s.end for s in spans),
            done["I"], done["U"], tuple(touched),
        )

    def append_new(self, table: str | TableSpec, incoming: DataFrame, *spans: Span) -> JobResult:
        """Insert the rows whose key is not stored yet; stored rows never change.

        Among incoming rows of one key, the one with the smallest digest is kept.
        """
        spec = self.spec(table)
        keys = list(spec.keys)
        number = max(self.commits(spec), default=0)
        folders = self.folders(spec, number or None)
        shaped = self._shaped(spec, incoming)
        plain = [
            f.name for f in spec.schema.fields
            if f.name not in keys and f.dataType.typeName() not in ("array", "struct")
        ]
        rest = [c for c in shaped.columns if c not in keys]
        single = (
            shaped.groupBy(*keys)
            .agg(
                F.min_by(F.struct(*rest), bar_hash(*[text_or_blank(c) for c in plain])).alias("r")
            )
            .select(*keys, "r.*")
        )
        stored = self._months(spec, folders, month_labels(*spans))
        fresh = materialise(
            single.join(stored.select(*keys), keys, "left_anti").select(*shaped.columns)
        )
        counts = fresh.groupBy("month").count().collect()
        if counts:
            written = self._write(spec, fresh, [r["month"] for r in counts])
            self._commit(
                spec, number, folders | {m: [*folders.get(m, []), f] for m, f in written.items()}
            )
        return JobResult(
            spec.name, min(s.start for s in spans), max(s.end for s in spans),
            sum(r["count"] for r in counts), 0, tuple(sorted(r["month"] for r in counts)),
        )

    def prune(self, table: str | TableSpec, keep_months: int, as_of: date) -> list[str]:
        """Drop whole months older than the retention; returns the months dropped."""
        spec = self.spec(table)
        first = as_of.year * 12 + as_of.month - 1 - (keep_months - 1)
        oldest = f"{first // 12:04d}-{first % 12 + 1:02d}"
        number = max(self.commits(spec), default=0)
        folders = self.folders(spec, number or None)
        expired = sorted(m for m in folders if m < oldest)
        if expired:
            self._commit(spec, number, {m: f for m, f in folders.items() if m >= oldest})
        return expired

    def vacuum(self, table: str | TableSpec, keep_commits: int = 2) -> list[str]:
        """Remove data that the last `keep_commits` commits do not name; returns its folders."""
        spec = self.spec(table)
        numbers = self.commits(spec)
        named = {
            f for n in numbers[-keep_commits:] for m in self.folders(spec, n).values() for f in m
        }
        removed = []
        for write in subfolders(self.spark, f"{self.path(spec)}/data"):
            for month in subfolders(self.spark, f"{self.path(spec)}/data/{write}"):
                if f"data/{write}/{month}" not in named:
                    remove(self.spark, f"{self.path(spec)}/data/{write}/{month}")
                    removed.append(f"data/{write}/{month}")
        for number in numbers[:-keep_commits]:
            remove(self.spark, f"{self.path(spec)}/commits/{number:010d}.json")
        return removed
