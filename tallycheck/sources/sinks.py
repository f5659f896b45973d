"""Writing result tables, and publishing the tables of a run together."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycheck.sources.files import _exists, hadoop_fs, read_text_csv

log = logging.getLogger(__name__)

#: Quotes are doubled inside quoted fields (RFC 4180), as every CSV reader expects;
#: null is an empty field, empty text a quoted one; white space at the ends stays.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "nullValue": "", "emptyValue": '""',
               "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                compression: str | None = None) -> None:
    """Write ``df`` to ``path`` (CSV with a header), by default with the format's usual
    compression (CSV: none). A failure is the caller's."""
    w = df.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    if fmt == "csv":
        w = w.options(**CSV_OPTIONS)
    w.format(fmt).save(path)


def try_write(df: DataFrame, path: str, fmt: str = "parquet", compression: str | None = None) -> str | None:
    """Like :func:`write_table`, but a failed export is logged and its reason returned."""
    try:
        write_table(df, path, fmt, **({"compression": compression} if compression else {}))
        return None
    except Exception as exc:  # noqa: BLE001 - the run goes on and reports which exports failed
        log.error("export of %s failed: %s", path, exc)
        return str(exc).splitlines()[0]


class Publication:
    """The tables of one run, written to a folder of their own below ``root`` and
    published by one row of the manifest. Readers look the folder up in the
    manifest (:func:`published`), so they see all tables of one run or all of
    another; a run that dies, or lacks a table, leaves the old publication as it was."""

    MANIFEST = "_manifest"

    def __init__(self, spark: SparkSession, root: str, fmt: str = "csv", run: str | None = None):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt
        self.run = run or uuid.uuid4().hex
        self.written: dict[str, str] = {}
        self.failed: dict[str, str] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/runs/{self.run}/{name}"

    def add(self, name: str, df: DataFrame, compression: str | None = None) -> str | None:
        """Writes a table; the reason if that failed."""
        reason = try_write(df, self.path(name), self.fmt, compression)
        if reason:
            self.failed[name] = reason
        else:
            self.written[name] = self.path(name)
        return reason

    def publish(self, keep: int | None = None) -> bool:
        """Makes this run the one that readers see, unless a table failed. ``keep``:
        so many runs (this one included) stay, older ones are deleted."""
        if self.failed or not self.written:
            return False
        past = manifest(self.spark, self.root)
        last = past.agg(F.max("sequence")).first()[0] or 0
        tables = F.array(*map(F.lit, sorted(self.written)))
        row = self.spark.range(1).select(F.lit(last + 1).cast("long").alias("sequence"), F.lit(self.run).alias("run"),
                                         F.lit(self.fmt).alias("format"), tables.alias("tables"))
        write_table(row.coalesce(1), f"{self.root}/{self.MANIFEST}", "json", mode="append")
        if keep is not None:
            old = past.filter(F.col("sequence") <= last + 1 - keep).select("run").collect()
            for (run,) in old:
                fs, path = hadoop_fs(self.spark, f"{self.root}/runs/{run}")
                fs.delete(path, True)
        return True


MANIFEST_SCHEMA = "sequence long, run string, format string, tables array<string>"


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """A row per publication, the latest with the greatest ``sequence``."""
    path = f"{root.rstrip('/')}/{Publication.MANIFEST}"
    if not _exists(spark, path):
        return spark.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in (x.split(" ") for x in MANIFEST_SCHEMA.split(", "))])
    return spark.read.schema(MANIFEST_SCHEMA).json(path)


class Published(Mapping):
    """Table name -> DataFrame, each looked at and read when it is asked for."""

    def __init__(self, names: Iterable[str], read: Callable[[str], DataFrame]):
        self._names, self._read, self._tables = list(names), read, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._tables:
            self._tables[name] = self._read(name)
        return self._tables[name]

    def __contains__(self, name: object) -> bool:
        return name in self._names

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def published(spark: SparkSession, root: str, schemas: Mapping[str, object] | None = None) -> Mapping[str, DataFrame]:
    """The tables of the latest publication; empty if there is none. CSV tables are
    text, or cast to the schema given for them. The publication is chosen now; a
    table's files are looked at when it is asked for."""
    last = manifest(spark, root).orderBy(F.desc("sequence"), F.desc("run")).first()
    if last is None:
        return Published([], None)

    def read(name: str) -> DataFrame:
        path = f"{root.rstrip('/')}/runs/{last['run']}/{name}"
        if last["format"] != "csv":
            return spark.read.format(last["format"]).load(path)
        df = read_text_csv(spark, path, empty_is_null=False)
        if schemas and name in schemas:
            df = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schemas[name]])
        return df

    return Published(last["tables"], read)
