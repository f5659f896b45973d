"""What the operators share: the cluster's shared folder, written intermediate
tables, and word hashing over whole texts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: A word is a run of anything but space, \\t, \\n, \\v, \\f and \\r.
SPACES = " \t\n\v\f\r"
SPACE_RUN = "[ \\t-\\r]+"


def shared_dir(spark: SparkSession) -> str:
    """URI of a new folder below the one the cluster names in
    ``spark.checkpoint.dir``. Only a session that runs in one process (tests)
    and names none gets a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tallycheck-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    if "://" not in root and not root.startswith("file:"):
        root = f"file://{root}"
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame, instead_of: tuple[DataFrame, ...] = (), compression: str = "snappy") -> DataFrame:
    """``df`` written once to the shared folder and read back: later steps read
    the rows instead of repeating the work, and survive lost executors. Tables
    returned earlier and no longer needed, ``instead_of`` which this one stands, are
    deleted."""
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.option("compression", compression).parquet(path)
    for old in instead_of:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(old.path_written)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    found = spark.read.schema(df.schema).parquet(path)
    found.path_written = path
    return found


def sliced(batches: Iterator[pa.RecordBatch], col: str = "text", size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``size`` bytes of ``col``, so that what a task
    makes of a batch's texts at once is bounded."""
    for batch in batches:
        upto = np.cumsum(pc.fill_null(pc.binary_length(batch[col]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(upto, (upto[at - 1] if at else 0) + size, side="left")) + 1
            yield batch.slice(at, to - at)
            at = to


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df``, written, with gapless numbers from 0 in ``name``: the place in the
    partition, after the prefix sum of the partitions' sizes (a row each)."""
    at, part, of, base = (fresh(df, x) for x in ("_at", "_part", "_of", "_base"))
    rows = written(df.withColumn(at, F.monotonically_increasing_id())).withColumn(part, F.shiftright(at, 33))
    before = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    sizes = rows.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    bases = sizes.select(F.col(part).alias(of), F.coalesce(F.sum("n").over(before), F.lit(0)).alias(base))
    place = F.col(base) + F.col(at) - F.shiftleft(part, 33)
    return rows.join(bases, F.col(part) == F.col(of)).withColumn(name, place).drop(at, part, of, base)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def same(a: Column, b: Column) -> Column:
    """Equality that holds between two nulls."""
    return a.eqNullSafe(b)


def text_of(col: str) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(col), F.lit(""))


# --- word hashing -----------------------------------------------------------

_CHUNK = 1 << 20
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[ord(c) for c in SPACES]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_tables: list[np.ndarray] = []


def _powers() -> list[np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2**64, one per byte of a chunk."""
    if not _tables:
        for base in (int(_BASE), pow(int(_BASE), -1, 2**64)):
            steps = np.full(_CHUNK + 1, base, np.uint64)
            steps[0] = 1
            _tables.append(np.cumprod(steps, dtype=np.uint64))
    return _tables


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly (the splitmix64 finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _chunk_hashes(data: np.ndarray) -> np.ndarray:
    up, down = _powers()
    space = _IS_SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    return mixed((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of every word of UTF-8 bytes, in order. Works in chunks
    cut at white space, so memory follows the number of words."""
    if len(data) <= _CHUNK:
        return _chunk_hashes(np.frombuffer(data, np.uint8))
    parts, at = [], 0
    while at < len(data):
        to = min(at + _CHUNK, len(data))
        if to < len(data):
            cut = max(data.rfind(c.encode(), at, to) for c in SPACES)
            if cut <= at:  # one word longer than a chunk: hash it on its own
                ends = [e for c in SPACES if (e := data.find(c.encode(), to)) >= 0]
                to = min(ends, default=len(data))
                head = data[at:to].split()
                parts.append(np.array([_long_word(w) for w in head], np.uint64))
                at = to
                continue
            to = cut
        parts.append(_chunk_hashes(np.frombuffer(data, np.uint8, to - at, at)))
        at = to
    return np.concatenate(parts)


def _long_word(word: bytes) -> int:
    if len(word) <= _CHUNK:
        return int(_chunk_hashes(np.frombuffer(word, np.uint8))[0])
    import xxhash

    return xxhash.xxh64_intdigest(word)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of every run of ``k`` words (empty if there are fewer words)."""
    n = len(words) - k + 1
    if n <= 0:
        return words[:0]
    h = words[:n].copy()
    for i in range(1, k):
        h *= _BASE
        h += words[i : i + n]
    return mixed(h)
