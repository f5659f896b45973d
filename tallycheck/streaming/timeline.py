"""Coverage timeline kept current from a stream of ER files.

Each micro-batch is cleaned with the batch jobs and reduced to the first
canonical receipt per precinct. What it changes is merged into state of two kinds:

* ``receipts``: the first receipt of each precinct, by ``buckets`` of the
  precinct's hash. A batch reads and rewrites only the buckets of its precincts.
* ``minutes``: precincts per minute of their first receipt, by local day. A
  precinct seen first, or earlier than before, counts in its new minute and no
  longer in the old one; a batch rewrites only the days of such minutes.

So what a batch writes follows the batch, not the election, and a late file with an
earlier receipt moves the precinct's first receipt back, exactly as a full rerun
would. Each batch writes folders of its own, and last a small table that names, for
every bucket and day, the batch that holds it: a batch that is run again reads what
the first attempt read. Folders that no later batch can need are removed.

The timeline itself is computed from the minutes (:func:`current_timeline`).
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallycheck import fixed
from tallycheck.contracts import normalize_headers, require
from tallycheck.functions.dates import to_local
from tallycheck.operators import rollups
from tallycheck.plans import election
from tallycheck.sources.files import _exists, empty_table, hadoop_fs, read_text_csv


class MissingState(RuntimeError):
    """The state an incremental batch builds on is gone."""


ER_COLUMNS = ["ER_ID", "CLUSTERED_PRECINCT_ID", "IS_DUPLICATE", "RECEIVED_AT"]
PRECINCT, RECEIVED = "CLUSTERED_PRECINCT_ID", "RECEIVED_AT"

RECEIPTS, MINUTES = "receipts", "minutes"
_PARTS = {RECEIPTS: "BUCKET", MINUTES: "DAY"}
_SCHEMAS = {RECEIPTS: f"{PRECINCT} string, {RECEIVED} timestamp_ntz, BEFORE timestamp_ntz",
            MINUTES: "TIME_BUCKET timestamp_ntz, QR_RECEIVED_COUNT long"}
INDEX_SCHEMA = "kind string, part string, batch long"


class TimelineState:
    """The state below ``root`` as the batches left it; ``index`` of a batch maps
    (kind, part) to the batch whose folder holds that part."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def folder(self, kind: str, batch: int) -> str:
        return f"{self.root}/{kind}/batch={batch:012d}"

    def index(self, batch: int) -> dict[tuple[str, str], int]:
        """A row per bucket and day, collected: bounded by their number."""
        path = self.folder("index", batch)
        if not _exists(self.spark, f"{path}/_SUCCESS"):
            raise MissingState(f"no state of batch {batch} at {path}")
        return {(r["kind"], r["part"]): r["batch"] for r in self.spark.read.schema(INDEX_SCHEMA).json(path).collect()}

    def last(self) -> int | None:
        """The latest whole batch."""
        fs, path = hadoop_fs(self.spark, f"{self.root}/index")
        if not fs.exists(path):
            return None
        batches = [int(f.getPath().getName().split("=")[1]) for f in fs.listStatus(path)]
        whole = [b for b in batches if _exists(self.spark, f"{self.folder('index', b)}/_SUCCESS")]
        return max(whole, default=None)

    def read(self, kind: str, index: dict[tuple[str, str], int], parts: Iterable[str] | None = None) -> DataFrame:
        """The rows of ``parts`` (by default all); a part that no batch wrote has none."""
        wanted = sorted(p for k, p in index if k == kind) if parts is None else [p for p in parts if (kind, p) in index]
        paths = [f"{self.folder(kind, index[kind, p])}/{_PARTS[kind]}={p}" for p in wanted]
        if not paths:
            return empty_table(self.spark, _SCHEMAS[kind])
        return self.spark.read.schema(_SCHEMAS[kind]).parquet(*paths)

    def write(self, kind: str, df: DataFrame, batch: int) -> list[str]:
        """Writes ``df``, a folder for each part; the parts that have rows."""
        part, path = _PARTS[kind], self.folder(kind, batch)
        df.repartition(part).write.mode("overwrite").partitionBy(part).parquet(path)
        fs, p = hadoop_fs(self.spark, path)
        names = [f.getPath().getName() for f in fs.listStatus(p)]
        return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{part}="))

    def finish(self, batch: int, index: dict[tuple[str, str], int]) -> None:
        """Makes ``index`` the state after ``batch``. Then what only older batches
        than the previous one need is removed: the previous is what a second run of
        this batch reads."""
        found = empty_table(self.spark, INDEX_SCHEMA) if not index else self.spark.createDataFrame(
            [(k, p, b) for (k, p), b in sorted(index.items())], INDEX_SCHEMA)
        found.coalesce(1).write.mode("overwrite").json(self.folder("index", batch))
        if batch < 2:
            return
        older, previous = self.folder("index", batch - 2), self.index(batch - 1)
        if _exists(self.spark, f"{older}/_SUCCESS"):
            for (kind, part), at in self.index(batch - 2).items():
                if previous.get((kind, part)) != at and index.get((kind, part)) != at:
                    self.remove(f"{self.folder(kind, at)}/{_PARTS[kind]}={part}")
            self.remove(older)

    def remove(self, path: str) -> None:
        fs, p = hadoop_fs(self.spark, path)
        fs.delete(p, True)


def first_receipts(ers: DataFrame) -> DataFrame:
    """The first canonical receipt of each precinct among raw ER rows."""
    canon = election.er_canonical(election.clean_mobile_ers(ers))
    return (canon.filter(F.col(PRECINCT).isNotNull() & F.col(RECEIVED).isNotNull())
            .groupBy(PRECINCT).agg(F.min(RECEIVED).alias(RECEIVED)))


def _by_header(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The ER files as one frame of the needed columns, each file read by its own
    header: any column order, further columns allowed."""
    frames = []
    for path in paths:
        df = normalize_headers(read_text_csv(spark, path))
        require(df, ER_COLUMNS, path)
        frames.append(df.select(*ER_COLUMNS))
    return reduce(lambda a, b: a.unionByName(b), frames)


def merge_batch(state: TimelineState, batch: int, ers: DataFrame | None, buckets: int, zone: str) -> list[str]:
    """Merges the raw ER rows of ``batch`` into the state of the batch before; the
    days whose minutes changed."""
    spark = state.spark
    index = state.index(batch - 1) if batch > 0 else {}
    if ers is None:
        state.finish(batch, index)
        return []
    bucket = F.pmod(F.xxhash64(PRECINCT), F.lit(buckets)).cast("int").alias(_PARTS[RECEIPTS])
    incoming = f"{state.root}/incoming/batch={batch:012d}"
    first_receipts(ers).write.mode("overwrite").parquet(incoming)
    new = spark.read.parquet(incoming)
    touched = [str(r[0]) for r in new.select(bucket).distinct().collect()]  # at most ``buckets``
    old = state.read(RECEIPTS, index, touched)
    both = new.withColumn("BEFORE", F.lit(None).cast("timestamp_ntz")).unionByName(
        old.withColumn("BEFORE", F.col(RECEIVED)))
    merged = both.groupBy(PRECINCT).agg(F.min(RECEIVED).alias(RECEIVED), F.min("BEFORE").alias("BEFORE"))
    written = state.write(RECEIPTS, merged.select("*", bucket), batch)
    index |= {(RECEIPTS, p): batch for p in written}

    moved = state.read(RECEIPTS, index, written).filter(~F.col(RECEIVED).eqNullSafe(F.col("BEFORE")))
    ends = F.inline(F.array(F.struct(F.col(RECEIVED).alias("at"), F.lit(1).cast("long").alias("n")),
                            F.struct(F.col("BEFORE").alias("at"), F.lit(-1).cast("long").alias("n"))))
    minute = rollups.minute_bucket(to_local("at", zone))
    day = F.date_format("TIME_BUCKET", "yyyy-MM-dd").alias(_PARTS[MINUTES])
    deltas = (moved.select(ends).filter("at is not null").groupBy(minute.alias("TIME_BUCKET"))
              .agg(F.sum("n").alias("QR_RECEIVED_COUNT")).filter("QR_RECEIVED_COUNT <> 0"))
    days = sorted(r[0] for r in deltas.select(day).distinct().collect())  # days of the election
    if days:
        counts = (deltas.unionByName(state.read(MINUTES, index, days)).groupBy("TIME_BUCKET")
                  .agg(F.sum("QR_RECEIVED_COUNT").alias("QR_RECEIVED_COUNT")).filter("QR_RECEIVED_COUNT > 0"))
        kept = state.write(MINUTES, counts.select("*", day), batch)
        for d in days:
            index.pop((MINUTES, d), None)
        index |= {(MINUTES, d): batch for d in kept}
    state.finish(batch, index)
    state.remove(incoming)
    return days


def current_timeline(spark: SparkSession, state_dir: str, universe: DataFrame, universe_key: str,
                     **options) -> DataFrame:
    """The timeline (rollup A5) after the latest whole batch; empty before the first."""
    state = TimelineState(spark, state_dir)
    last = state.last()
    minutes = state.read(MINUTES, {} if last is None else state.index(last))
    return rollups.timeline_of_minutes(minutes, universe=universe, universe_key=universe_key, **options)


def _publish(spark: SparkSession, timeline: DataFrame, days: list[str], output_dir: str) -> None:
    """Rewrites the timeline's days from the first changed one on: its running
    numbers go on in the later days. Days without receipts any more are removed."""
    part = timeline.filter(F.col("RECEIVED_DATE") >= F.lit(days[0]).cast("date"))
    (part.repartition("RECEIVED_DATE").sortWithinPartitions("RECEIVED_DATE", "TIME_BUCKET").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("RECEIVED_DATE").parquet(output_dir))
    left = {str(r[0]) for r in part.select("RECEIVED_DATE").distinct().collect()}
    for day in sorted(set(days) - left):
        fs, path = hadoop_fs(spark, f"{output_dir.rstrip('/')}/RECEIVED_DATE={day}")
        fs.delete(path, True)


def start_timeline(spark: SparkSession, source_dir: str, state_dir: str, output_dir: str | None,
                   universe: DataFrame, universe_key: str, checkpoint_dir: str,
                   zone: str = fixed.LOCAL_TIME_ZONE, available_now: bool = False,
                   files_per_batch: int = 100, buckets: int = 64) -> StreamingQuery:
    """Watch ``source_dir`` for ER CSV files (reference headers, in any order) and
    keep the timeline current. A micro-batch takes up to ``files_per_batch`` files. If
    the state of the previous batch is gone, the query fails rather than start from an
    empty timeline. ``buckets`` (the same for the life of ``state_dir``): a batch
    rewrites the buckets of its precincts, so many make for small ones.

    ``output_dir`` receives the timeline by day, from the first changed day on. Its
    days are replaced one by one; readers who must not see two batches mixed, or all
    readers if it is None, call :func:`current_timeline`."""
    stream = (spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(source_dir)
              .select(F.col("_metadata.file_path").alias("path")))
    expected = universe.select(universe_key)
    state = TimelineState(spark, state_dir)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        # bounded by files_per_batch
        paths = sorted(r["path"] for r in batch.distinct().collect())
        days = merge_batch(state, batch_id, _by_header(spark, paths) if paths else None, buckets, zone)
        if days and output_dir is not None:
            tl = current_timeline(spark, state_dir, expected, universe_key)
            _publish(spark, tl, days, output_dir)

    w = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
