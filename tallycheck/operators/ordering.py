"""A global order without one task that holds it all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallycheck.session import shared_folder


def _fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, lengthened until no column of ``df`` has them."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        found.append(name)
    return found


def with_positions(df: DataFrame, keys: Sequence[str], name: str = "POSITION", folder: str | None = None) -> DataFrame:
    """``df`` with each row's 1-based place in the order of ``keys`` (nulls last),
    equal keys by the remaining columns, which must be of types that can be ordered.

    The rows are dealt to ranges of the order and sorted there; a row's place is its
    place in the range after the prefix sum of the ranges' sizes. A repeated row is
    dealt by its place in the input as well, so a key, or a whole row, that holds a
    third of the table is spread over as many ranges as it needs. The input and the
    sorted ranges are written once to ``folder`` (by default one in the cluster's
    shared folder): a repeated task finds the same rows in the same places."""
    if name in df.columns:
        raise ValueError(f"the table has a column {name} already")
    spark = df.sparkSession
    folder = folder or shared_folder(spark)
    at, part, of, size, base = _fresh(df, "_at", "_part", "_of", "_size", "_base")
    df.write.parquet(f"{folder}/input")
    rows = spark.read.schema(df.schema).parquet(f"{folder}/input").withColumn(at, F.monotonically_increasing_id())
    rest = [c for c in df.columns if c not in keys]
    order = [F.col(f"`{c}`").asc_nulls_last() for c in (*keys, *rest)] + [F.col(at).asc()]
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop(at)
    ranges.withColumn(at, F.monotonically_increasing_id()).write.parquet(f"{folder}/ranges")
    schema = ranges.schema.add(at, "long")
    placed = spark.read.schema(schema).parquet(f"{folder}/ranges").withColumn(part, F.shiftright(at, 33))
    sizes = placed.groupBy(F.col(part).alias(of)).agg(F.count(F.lit(1)).alias(size))
    before = Window.orderBy(of).rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    bases = sizes.select(of, F.coalesce(F.sum(size).over(before), F.lit(0)).alias(base))
    place = F.col(base) + F.col(at) - F.shiftleft(part, 33) + 1
    return placed.join(bases, F.col(part) == F.col(of)).select(*[f"`{c}`" for c in df.columns], place.alias(name))
