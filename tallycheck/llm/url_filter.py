"""URL filter on a sorted digest array.

The rules become two files in the cluster's shared folder: sorted 64-bit xxhash
keys with string offsets, and the rule strings themselves. Tasks memory-map
both, hash every (host suffix, path prefix) a url could match, probe the keys
by vectorised binary search, and compare the stored full string, so a hash
collision never decides.

The array is for lists up to ``MAX_RULES``; the count is checked, and a longer
list goes through an exact Spark join on the same strings instead.

Defined results: a null url, or one without ``://``, has an empty host and path
and matches only rules of an empty host; equal rules count once, a block wins
over an allow of the same string; repeated rows each get their row; empty tables
give empty results or no rule; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycheck.llm.common import shared_dir, written

#: 16 bytes of keys and offsets a rule beside its string: a bounded index.
MAX_RULES = 1_000_000


def host_of(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a url."""
    scheme, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    cut = min((i for c in "/?#" if (i := rest.find(c)) >= 0), default=len(rest))
    tail = rest[cut:]
    end = min((i for c in "?#" if (i := tail.find(c)) >= 0), default=len(tail))
    host = rest[:cut]
    return (host.lower() if host.isascii() else host.translate(_LOWER)), tail[:end]


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def suffixes(host: str, depths: Sequence[int]) -> list[str]:
    """The host and its parent domains that have one of these numbers of labels
    (ascending): a host of many thousand labels gives no more than rules can have."""
    found, start = [], len(host) + 1
    for n in range(1, (depths[-1] if depths else 0) + 1):
        start = host.rfind(".", 0, max(start - 1, 0)) + 1
        if n in depths:
            found.append(host[start:])
        if not start:
            break
    return found


def _opened(uri: str) -> np.ndarray:
    """The file's bytes: memory-mapped where the folder is mounted, else read."""
    store, path = fs.FileSystem.from_uri(uri)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, np.uint8, "r") if store.get_file_info(path).size else np.zeros(0, np.uint8)
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read(), np.uint8)


def write_index(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> str:
    """Writes (host, path, verdict) rules as a digest array; returns its folder.
    ``keys.bin``: the numbers of rules and of path lengths, sorted uint64 keys, one
    more uint64 offsets into ``strings.bin`` (verdict letter, then the rule), the
    distinct lengths of rule paths and numbers of labels of rule hosts."""
    verdicts: dict[tuple[str, str], str] = {}
    for host, path, verdict in rules:
        rule = (host, path)
        verdicts[rule] = "block" if "block" in (verdict, verdicts.get(rule)) else verdict
    keyed = sorted((_key(h, p), h, p, v) for (h, p), v in verdicts.items())
    strings = [v[0].encode() + len(h.encode()).to_bytes(4, "little") + (h + p).encode() for _, h, p, v in keyed]
    offsets = np.cumsum([0, *map(len, strings)], dtype=np.uint64)
    lengths = np.array(sorted({len(p) for _, _, p, _ in keyed}), np.uint64)
    folder = shared_dir(spark)
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    depths = np.array(sorted({h.count(".") + 1 for _, h, _, _ in keyed}), np.uint64)
    head = np.array([len(keyed), len(lengths)], "<u8")
    for name, data in (("keys.bin", b"".join(x.astype("<u8").tobytes() for x in (
            head, np.array([k for k, *_ in keyed], np.uint64), offsets, lengths, depths))), ("strings.bin", b"".join(strings))):
        with store.open_output_stream(f"{path}/{name}") as f:
            f.write(data)
    return folder


def _key(host: str, path: str) -> int:
    return xxhash.xxh64_intdigest(f"{host}\n{path}".encode())


class DigestArray:
    """A written index, probed many keys at a time."""

    def __init__(self, folder: str):
        words = _opened(f"{folder}/keys.bin").view("<u8")
        n, of_lengths = map(int, words[:2])
        self.keys, self.offsets, rest = words[2 : n + 2], words[n + 2 : 2 * n + 3], words[2 * n + 3 :].tolist()
        self.lengths, self.depths = rest[:of_lengths], rest[of_lengths:]
        self.strings = _opened(f"{folder}/strings.bin")

    def match(self, pages: list[tuple[str, str]]) -> list[tuple[str, str] | None]:
        """For each (host, path) the longest rule that fits, as (rule, verdict)."""
        probe, owner, wanted = [], [], []
        for i, (host, path) in enumerate(pages):
            for h in suffixes(host, self.depths):
                for n in self.lengths:
                    if n <= len(path):
                        probe.append(_key(h, path[:n]))
                        owner.append(i)
                        wanted.append((h, path[:n]))
        keys = np.array(probe, np.uint64)
        at = np.searchsorted(self.keys, keys)
        best: list[tuple[str, str] | None] = [None] * len(pages)
        hit = np.flatnonzero(at < len(self.keys))
        for k in hit[self.keys[at[hit]] == keys[hit]]:
            host, path = wanted[k]
            here = int(at[k])
            while here < len(self.keys) and self.keys[here] == keys[k]:  # equal keys stand side by side
                stored = self.strings[int(self.offsets[here]) : int(self.offsets[here + 1])].tobytes()
                rule = host + path
                if stored[1:] == len(host.encode()).to_bytes(4, "little") + rule.encode():
                    old = best[owner[k]]
                    if old is None or len(rule) > len(old[0]):
                        best[owner[k]] = (rule, "allow" if stored[:1] == b"a" else "block")
                here += 1
        return best


@lru_cache(maxsize=4)
def _index(folder: str) -> DigestArray:
    return DigestArray(folder)


def _judge_batches(folder: str, default: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(folder)
        for batch in batches:
            pages = [host_of(u) for u in batch["url"].to_pylist()]
            found = index.match(pages)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array([h for h, _ in pages], pa.string()), pa.array([p for _, p in pages], pa.string()),
                 pa.array([f and f[0] for f in found], pa.string()),
                 pa.array([f[1] if f else default for f in found], pa.string())],
                ["id", "host", "path", "rule", "verdict"])

    return run


def _split_batches(lengths: list[int], depths: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = [host_of(u) for u in batch["url"].to_pylist()]
            keys = [[{"host": h, "path": p[:n]} for h in suffixes(host, depths) for n in lengths if n <= len(p)]
                    for host, p in pages]
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["id"], pa.array([h for h, _ in pages], pa.string()),
                 pa.array([p for _, p in pages], pa.string()),
                 pa.array(keys, pa.list_(pa.struct([("host", pa.string()), ("path", pa.string())])))],
                ["row", "id", "host", "path", "keys"])

    return run


def judge(pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
          default: str = "allow", max_rules: int = MAX_RULES) -> DataFrame:
    """A row per page: id, host, path, the longest fitting rule (host then path,
    else null) and its verdict (else ``default``). ``rules``: host, path, verdict."""
    spark = pages.sparkSession
    rules = rules.select(F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"),
                         "verdict").filter(F.col("verdict").isin("allow", "block"))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    kind = rows.schema["id"].dataType.simpleString()
    if rules.limit(max_rules + 1).count() <= max_rules:
        folder = write_index(spark, [tuple(r) for r in rules.collect()])
        return rows.mapInArrow(_judge_batches(folder, default),
                               f"id {kind}, host string, path string, rule string, verdict string")
    return _joined(rows, rules, kind, default)


def _joined(rows: DataFrame, rules: DataFrame, kind: str, default: str) -> DataFrame:
    """The same result by an exact join, for lists too long for every task."""
    best = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block sorts after allow
    # at most as many values as the longest rule has characters
    distinct = lambda size: sorted(r[0] for r in best.select(size).distinct().collect())
    lengths, depths = distinct(F.length("path")), distinct(F.size(F.split("host", r"\.", -1)))
    keyed = written(rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        _split_batches(lengths, depths), f"row long, id {kind}, host string, path string, "
                                 "keys array<struct<host:string,path:string>>"))
    hits = (keyed.select("row", F.inline(F.array_distinct("keys"))).join(best, ["host", "path"])
            .groupBy(F.col("row").alias("hit"))
            .agg(F.max(F.struct(F.length(F.concat("host", "path")).alias("n"), F.length("host").alias("h"),
                                F.concat("host", "path").alias("rule"), "verdict")).alias("best")))
    return keyed.join(hits, F.col("row") == F.col("hit"), "left").select(
        "id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
