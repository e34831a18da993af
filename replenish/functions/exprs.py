"""Column expressions with the numeric and text rules the whole package relies on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dec(c: str | Column, precision: int = 18, scale: int = 6) -> Column:
    """Cast to a fixed decimal; Spark rounds half away from zero."""
    return col(c).cast(f"decimal({precision},{scale})")


def num(value: object, precision: int = 18, scale: int = 6) -> Column:
    return F.lit(str(value)).cast(f"decimal({precision},{scale})")


def count_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio of two counts, 0 when there is nothing to divide by."""
    top = numerator.cast("decimal(20,0)")
    bottom = denominator.cast("decimal(10,0)")
    return F.coalesce(F.try_divide(top, bottom), F.lit(0).cast("decimal(31,11)"))


def text(c: str | Column) -> Column:
    return col(c).cast("string")


def text_or_blank(c: str | Column) -> Column:
    return F.coalesce(text(c), F.lit(""))


def bar_text(*fields: Column) -> Column:
    """Fields joined with a vertical bar."""
    return F.concat_ws("|", *fields)


def bar_hash(*fields: Column) -> Column:
    """SHA-256 (hex) of the fields joined with a vertical bar."""
    return F.sha2(bar_text(*fields), 256)


def codes(*flags: tuple[Column, str]) -> Column:
    """Array of the codes whose condition holds; a NULL condition counts as not held."""
    if not flags:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(cond, F.lit(code)) for cond, code in flags]))


def all_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def month_of(c: str | Column) -> Column:
    return F.date_format(col(c), "yyyy-MM")


def digest_number(*columns: str | Column) -> Column:
    """A 60-bit number drawn from the MD5 of the columns; summing it gives an order-free checksum."""
    line = F.concat_ws("|", *[text_or_blank(c) for c in columns])
    return F.conv(F.substring(F.md5(line), 1, 15), 16, 10).cast("decimal(38,0)")


def checksum(*columns: str | Column) -> Column:
    """Aggregate: order-independent checksum, combinable on the map side at any volume."""
    return F.coalesce(F.sum(digest_number(*columns)), F.lit(0).cast("decimal(38,0)"))


def latest(value: Column | str, *order: Column | str) -> Column:
    """Aggregate: value of the row that is last in `order`; a NULL order value sorts lowest.

    It combines on the map side, so a key with a large share of the rows costs no extra shuffle.
    """
    return F.max_by(col(value), F.struct(*[col(o).alias(f"o{i}") for i, o in enumerate(order)]))


def earliest(value: Column | str, *order: Column | str) -> Column:
    return F.min_by(col(value), F.struct(*[col(o).alias(f"o{i}") for i, o in enumerate(order)]))
