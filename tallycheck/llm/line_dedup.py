"""Line dedup by winnowing over line hashes.

A passage is a run of whole lines with ``min_words`` words or more. Around every
line stand two shortest such runs, one that begins and one that ends there; they
are the windows. Of each window the smallest line hash (the rightmost of equals)
is selected as its fingerprint. Any repeated passage contains a whole window and
two equal windows select the same line, so no repeated passage is missed.

Selected positions are joined on their hashes; those that occur once drop out.
From the others the match is extended both ways to the windows around it, which
are compared by a 128-bit hash of their lines. Of equal windows the first in
(document id, line) order stays and the later ones go. Overlapping windows add
up to the whole repeated run, so the lines removed are exactly those inside a
passage that occurs earlier.

Lines are compared lower-cased (A-Z) with single spaces; lines without words are
skipped over, and go with a run that spans them.

Defined results: null and empty texts have no windows and stay; null ids come
last; equal ids order by text digest, and repeated rows (same id, same text) are
one document, each row with the same result; an empty table gives an empty
result; other columns are ignored or kept as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycheck.llm.common import fresh, same, sliced, text_of, written

WINDOW = "struct<mark:bigint,content:binary,first:int,last:int>"


def windows(lines: list[tuple[bytes, int, int]], min_words: int) -> tuple[list[tuple], set[int]]:
    """``lines``: (digest, words, line number). Returns the windows as (hash of
    the selected line, content digest, first, last line number), and the indexes
    of the selected lines."""
    spans = set()
    n, stop, total = len(lines), 0, 0
    for start in range(n):  # the shortest run that begins at each line
        while stop < n and total < min_words:
            total += lines[stop][1]
            stop += 1
        if total < min_words:
            break
        spans.add((start, stop - 1))
        total -= lines[start][1]
    start = total = 0
    for end in range(n):  # the shortest run that ends at each line
        total += lines[end][1]
        while total - lines[start][1] >= min_words:
            total -= lines[start][1]
            start += 1
        if total >= min_words:
            spans.add((start, end))
    found, picked = [], set()
    for first, last in sorted(spans):
        digests = [lines[i][0] for i in range(first, last + 1)]
        low = min(digests)
        at = last - digests[::-1].index(low)
        picked.add(at)
        found.append((mark(low), xxhash.xxh3_128_digest(b"".join(digests)), lines[first][2], lines[last][2]))
    return found, picked


def mark(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _fingerprints(min_words: int):
    kind = pa.struct([("mark", pa.int64()), ("content", pa.binary()), ("first", pa.int32()), ("last", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            digests, marks, found, ends = [], [], [], [0]
            for text in batch["text"].to_pylist():
                data = text.encode()
                lines = []
                for i, line in enumerate(data.split(b"\n")):
                    if words := line.split():
                        lines.append((xxhash.xxh3_128_digest(b" ".join(words).lower()), len(words), i))
                spans, picked = windows(lines, min_words)
                digests.append(hashlib.md5(data).digest())
                marks.append([mark(lines[i][0]) for i in sorted(picked)])
                found += spans
                ends.append(len(found))
            columns = list(zip(*found)) or [(), (), (), ()]
            spans = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind)], fields=list(kind))
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(digests, pa.binary()), pa.array(marks, pa.list_(pa.int64())),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans)],
                ["id", "digest", "marks", "windows"])

    return run


def repeated_runs(docs: DataFrame, *, min_words: int = 50, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """id, digest (md5 of the text) and ``runs``: the line spans (first, last,
    from 0) that occur earlier; only documents that have any."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    table = written(rows.mapInArrow(
        _fingerprints(min_words),
        f"id {kind}, digest binary, marks array<bigint>, windows array<{WINDOW}>"))
    often = (table.select(F.explode("marks").alias("often")).groupBy("often").agg(F.count(F.lit(1)).alias("n"))
             .filter("n > 1").select("often"))
    near = written(table.select("id", "digest", F.inline("windows"))
                   .join(often, F.col("mark") == F.col("often"), "left_semi").drop("mark"))
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "digest", F.col("first").alias("line"))
    first = (near.groupBy(F.col("content").alias("same_content"))
             .agg(F.min(place).alias("kept"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    later = near.join(first, F.col("content") == F.col("same_content")).filter(~same(place, F.col("kept")))
    return later.groupBy("id", "digest").agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("runs"))


def _left(lines: Column, runs: Column) -> Column:
    return F.filter(lines, lambda x, i: ~F.exists(runs, lambda r: (i >= r["first"]) & (i <= r["last"])))


def deduplicated(docs: DataFrame, *, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text",
                 extra: bool = False) -> DataFrame:
    """The documents with later repeated runs removed, all their columns kept.
    With ``extra`` three more columns: ``removed_lines``, ``removed_words`` and
    ``emptied`` (all its words are gone; otherwise such documents are left out)."""
    runs = repeated_runs(docs, min_words=min_words, id_col=id_col, text_col=text_col)
    key, digest, gone = (fresh(docs, x) for x in ("run_id", "run_digest", "run_lines"))
    runs = runs.toDF(key, digest, gone)
    lines = F.split(F.col(text_col), "\n", -1)
    found = docs.join(runs, (F.unhex(F.md5(text_of(text_col))) == F.col(digest))
                      & same(F.col(id_col), F.col(key)), "left")
    new, has = fresh(docs, "new_text"), F.col(gone).isNotNull()
    found = found.withColumn(new, F.when(has, F.array_join(_left(lines, F.col(gone)), "\n")).otherwise(F.col(text_col)))
    emptied = F.coalesce(has & ~F.col(new).rlike("[^ \\t-\\r]"), F.lit(False))
    keep = [F.col(new).alias(text_col) if c == text_col else F.col(c) for c in docs.columns]
    if not extra:
        return found.filter(~emptied).select(*keep)
    words = lambda c: F.size(F.filter(F.split(F.coalesce(c, F.lit("")), "[ \\t-\\r]+"), lambda x: x != ""))
    count = lambda c: F.size(F.split(c, "\n", -1))
    lost = F.when(has, count(F.col(text_col)) - F.size(_left(lines, F.col(gone)))).otherwise(0)
    return found.select(*keep, lost.cast("long").alias("removed_lines"),
                        F.when(has, words(F.col(text_col)) - words(F.col(new))).otherwise(0).cast("long")
                        .alias("removed_words"), emptied.alias("emptied"))
