"""Helpers shared by the text operators."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that separates words, and a word.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

# Arrow batches handed to Python hold at most so many rows and bytes, whatever the text lengths.
BATCH_ROWS = 1_000
BATCH_BYTES = 8 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def prepare_python(spark: SparkSession) -> None:
    """Readies a session for Python workers: long texts make short batches, which bounds memory,
    and this package is sent to executors that do not have it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    name = f"{package.name}-{os.getpid()}"
    if package.is_dir() and f"{name}.zip" not in context._python_includes:
        # The driver serves the file to executors for as long as it lives.
        folder = tempfile.mkdtemp(prefix=f"{package.name}-code-")
        context.addPyFile(shutil.make_archive(f"{folder}/{name}", "zip", package.parent, package.name))


def col(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, wanted: str) -> str:
    """`wanted`, with underscores added until no column of `df` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def held_out(id_column: str = "doc_id") -> Column:
    """Whether a document belongs to the quarter that training never sees."""
    remainder = F.pmod(F.crc32(col(id_column).cast("string").cast("binary")), F.lit(4))
    return F.coalesce(remainder == 2, F.lit(False))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")
