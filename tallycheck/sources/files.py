"""Reading untrusted all-text sources.

Nothing is inferred: every column arrives as text (codes keep leading zeros) and
is typed later by the cleaning functions.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


class MissingReference(RuntimeError):
    """An approved reference file (or one of its required columns) is missing."""


def hadoop_fs(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` (local, HDFS and object stores alike), and the path in it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_fs(spark, path)
    return bool(fs.exists(p))


def spanning_files(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """The files below ``path`` without and with records that span lines. A record
    goes on over a line end only inside quotes, so that some line of the file holds an
    odd number of quotes. One pass over the lines, an aggregate per file."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    odd = lines.groupBy("file").agg(F.max(quotes % 2).alias("odd")).collect()  # a row per file, as in Spark's own listing
    files = [(unquote(r["file"]), bool(r["odd"])) for r in odd]
    return sorted(f for f, spans in files if not spans), sorted(f for f, spans in files if spans)


def read_text_csv(spark: SparkSession, path: str, na_tokens: Sequence[str] = (),
                  multiline: bool | None = None, with_source_file: str | None = None,
                  empty_is_null: bool = True) -> DataFrame:
    """Header CSV, every column as text. Quoted fields may hold commas and line
    breaks; missing trailing fields and empty fields are null; a row with data
    beyond the header's fields fails the read, as that can't be placed.

    Spark can split a file only if no record spans lines. ``multiline`` says whether
    some do; by default the files are looked at, and only those with such a record
    are read whole. ``na_tokens`` (e.g. 'NA', 'N/A') become null too.
    ``empty_is_null=False`` keeps quoted empty text apart from null.
    ``with_source_file`` names a column that receives the file name.
    """
    options = {"header": True, "escape": '"', "mode": "PERMISSIVE"}
    if not empty_is_null:
        options["nullValue"] = "\ufdd0"  # a noncharacter: stands for fields without text or quotes
    names = spark.read.options(**options, multiLine=True).csv(path).columns
    beyond = "_beyond_header"
    schema = StructType([StructField(n, StringType()) for n in [*names, beyond]])
    if multiline is None:
        split, whole = spanning_files(spark, path)
        parts = [(files, many) for files, many in ((split, False), (whole, True)) if files] or [(path, True)]
    else:
        parts = [(path, multiline)]
    message = F.concat(F.lit("a row has more fields than the header, first: "), F.coalesce(F.col(names[0]), F.lit("")))
    placed = F.when(F.col(beyond).isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    nothing = [*([""] if empty_is_null else []), *na_tokens]
    out = [(F.when(~F.col(n).isin(*nothing), F.col(n)) if nothing else F.col(n)).alias(n) for n in names]
    if with_source_file:
        out.append(F.col("_metadata.file_name").alias(with_source_file))
    found = [spark.read.options(**options, multiLine=many).schema(schema).csv(files).filter(placed).select(*out)
             for files, many in parts]
    return reduce(DataFrame.unionByName, found)


def _struct_type(schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """Small inline table (fallbacks, fixed lists), built JVM-side as literal
    structs: no Python RDD, no Python worker."""
    st = _struct_type(schema)
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in st.fields])
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, st.fields)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def empty_table(spark: SparkSession, schema: StructType | str) -> DataFrame:
    """Typed, empty stand-in for an optional source that is absent."""
    return literal_table(spark, [], schema)


def read_with_policy(spark: SparkSession, path: str, on_missing: str = "raise",
                     fallback: DataFrame | None = None, **read_opts) -> tuple[DataFrame, bool]:
    """Read ``path`` if it exists. Missing: ``"raise"`` -> MissingReference;
    ``"fallback"`` -> ``fallback`` (returned with ``True`` so callers can mark it)."""
    if _exists(spark, path):
        return read_text_csv(spark, path, **read_opts), False
    if on_missing == "raise" or fallback is None:
        raise MissingReference(f"the approved reference {os.path.basename(path.rstrip('/'))} is absent")
    return fallback, True
