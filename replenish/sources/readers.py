"""Parquet, JDBC, CSV and JSON readers for the input relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from replenish import schemas
from replenish.functions.exprs import codes

SOURCES = {
    "catalog": schemas.CATALOG,
    "raw_sales": schemas.RAW_SALES,
    "enriched_sales": schemas.ENRICHED_SALES,
    "wide_stock": schemas.WIDE_STOCK,
    "daily_inputs": schemas.POSITION_INPUTS,
    "parameters": schemas.PARAMETERS,
    "center_inputs": schemas.CENTER_INPUTS,
    "purchase_orders": schemas.PURCHASE_ORDERS,
    "item_logistics": schemas.ITEM_LOGISTICS,
    "directed_needs": schemas.DIRECTED_NEEDS,
    "import_requests": schemas.IMPORT_REQUESTS,
    "execution_events": schemas.EXECUTION_EVENTS,
}


def read_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """One input relation with its declared schema from a columnar folder."""
    return spark.read.format(fmt).schema(SOURCES[name]).load(path)


def read_jdbc(
    spark: SparkSession,
    name: str,
    url: str,
    relation: str,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 64,
    **options: str,
) -> DataFrame:
    """One input relation from a database, read in parallel ranges of `partition_column`.

    Filters and column pruning reach the database; `relation` may be a table or a subquery.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", relation)
    if partition_column is not None:
        low, high = bounds or ("0", "0")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", low)
            .option("upperBound", high)
            .option("numPartitions", partitions)
        )
    loaded = reader.options(**options).load()
    return loaded.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in SOURCES[name].fields]
    )


def catalog(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, "catalog", path)


def raw_sales(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, "raw_sales", path)


def enriched_sales(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, "enriched_sales", path)


def wide_stock(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, "wide_stock", path)


def daily_inputs(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, "daily_inputs", path)


def parameters(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, "parameters", path)


def center_inputs(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, "center_inputs", path)


def purchase_orders(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, "purchase_orders", path)


def item_logistics(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, "item_logistics", path)


def execution_events(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    if streaming:
        return spark.readStream.schema(schemas.EXECUTION_EVENTS).parquet(path)
    return read_table(spark, "execution_events", path)


def _text_file(
    spark: SparkSession, path: str, fmt: str, schema: StructType, **options: str
) -> DataFrame:
    with_bad = StructType([*schema.fields, StructField("bad_line", StringType())])
    return (
        spark.read.format(fmt)
        .schema(with_bad)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "bad_line")
        .options(**options)
        .load(path)
    )


def directed_needs(spark: SparkSession, path: str) -> DataFrame:
    """Bulk upload of directed needs (CSV with header); every line keeps its rejection codes."""
    lines = _text_file(spark, path, "csv", schemas.DIRECTED_NEEDS, header="true")
    return lines.withColumn(
        "reject_codes",
        codes(
            (F.col("bad_line").isNotNull(), "UNREADABLE_LINE"),
            (F.col("branch_id").isNull(), "MISSING_BRANCH"),
            (F.col("article_id").isNull(), "MISSING_ARTICLE"),
            (~F.coalesce(F.col("need_type").isin("E", "C", "A"), F.lit(False)), "INVALID_TYPE"),
            (~F.coalesce(F.col("original_quantity") > 0, F.lit(False)), "INVALID_QUANTITY"),
            (F.col("valid_to") < F.col("valid_from"), "INVALID_VALIDITY"),
        ),
    )


def exchange_file(spark: SparkSession, path: str, kind: str, fmt: str = "json") -> DataFrame:
    """Contingency file with the same ids and keys as the interface: import requests or events."""
    if kind not in ("import_requests", "execution_events"):
        raise ValueError(f"no exchange file for {kind}")
    options = {"header": "true"} if fmt == "csv" else {}
    return _text_file(spark, path, fmt, SOURCES[kind], **options)
