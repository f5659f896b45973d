"""Quality rules with cross-document line frequency.

A document first passes two rules on its own words. Then its lines are compared
with the corpus: each normalised line is hashed, the distinct documents that
hold it are counted per host, lines above the host's limit are boilerplate and
removed, and a document of which too little remains is rejected.

Defined results: a null text counts as empty (no words, ``base_failed``); a null
host is a host of its own; documents with equal texts count once, so copying a
document never turns its lines into boilerplate; repeated rows and equal ids
each get the same verdict, which depends on host and text alone; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycheck.llm.common import fresh, same, shingle_hashes, sliced, SPACES, text_of, word_hashes, written

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class QualityRules:
    """``min_words``: least words of a document. ``repeat_pct``: most per cent of
    its words inside repeated windows of ``window`` words. A line is boilerplate
    if it stands in at least ``line_docs`` distinct documents of its host and in
    more than ``line_pct`` per cent of them; one of ``long_words`` words or more,
    which hardly recurs by chance, also from ``long_docs`` documents on, whatever
    the host's size. A document is depleted if less than ``keep_pct`` per cent of
    its words remain."""

    min_words: int = 20
    window: int = 8
    repeat_pct: int = 30
    line_docs: int = 8
    line_pct: int = 5
    long_words: int = 5
    long_docs: int = 1000
    keep_pct: int = 30


def repeated_words(words: np.ndarray, window: int) -> int:
    """Words inside windows that occur twice or more."""
    h = shingle_hashes(words, window)
    ordered = np.sort(h)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    starts = np.flatnonzero(np.isin(h, twice))
    change = np.zeros(len(words) + 1, np.int64)
    change[starts] += 1
    change[starts + window] -= 1
    return int(np.count_nonzero(np.cumsum(change[:-1])))


def _measures(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            out = {k: [] for k in ("digest", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
            hashes, counts, places, ends = [], [], [], [0]
            for text in batch["text"].to_pylist():
                data = text.encode()
                words = word_hashes(data)
                seen, dup = set(), 0
                for i, line in enumerate(data.split(b"\n")):
                    parts = line.split()
                    if parts:
                        dup += line in seen
                        seen.add(line)
                        hashes.append(xxhash.xxh64_intdigest(b" ".join(parts).lower()))
                        counts.append(len(parts))
                        places.append(i)
                ends.append(len(hashes))
                out["digest"].append(hashlib.md5(data).digest())
                out["n_words"].append(len(words))
                out["word_chars"].append(len(text) - sum(text.count(c) for c in SPACES))
                out["n_symbols"].append(sum(text.count(c) for c in SYMBOLS))
                out["n_dup_lines"].append(dup)
                out["n_repeat_words"].append(repeated_words(words, window))
            line = pa.StructArray.from_arrays(
                [pa.array(np.array(hashes, np.uint64).view(np.int64)), pa.array(counts, pa.int32()), pa.array(places, pa.int32())],
                ["hash", "words", "at"])
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["host"], pa.array(out["digest"], pa.binary()),
                 *(pa.array(out[k], pa.int64()) for k in list(out)[1:]),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), line)],
                ["id", "host", *out, "lines"])

    return run


def measured(docs: DataFrame, rules: QualityRules, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """One written row per document: its counts and its lines that have words
    (hash of the lower-cased, single-spaced line, its words and its number)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(host_col).cast("string").alias("host"),
                       text_of(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    return written(rows.mapInArrow(
        _measures(rules.window),
        f"id {id_type}, host string, digest binary, n_words long, word_chars long, n_symbols long, "
        "n_dup_lines long, n_repeat_words long, lines array<struct<hash:long,words:int,at:int>>"))


def boilerplate(texts: DataFrame, rules: QualityRules) -> DataFrame:
    """(host, hash) of the lines above their host's limit. Counts are combined
    before each shuffle, so a hot host or line is many small sums."""
    hosts = texts.groupBy(F.col("host").alias("of")).agg(F.count(F.lit(1)).alias("texts"))
    each = F.array_distinct(F.transform("lines", lambda x: F.struct(x["hash"].alias("hash"), x["words"].alias("words"))))
    lines = (texts.select("host", F.inline(each))
             .groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n"), F.max("words").alias("words"))
             .filter(F.col("n") >= min(rules.line_docs, rules.long_docs)))
    usual = (F.col("n") >= rules.line_docs) & (F.col("n") * 100 > F.col("texts") * rules.line_pct)
    many = (F.col("words") >= rules.long_words) & (F.col("n") >= rules.long_docs)
    return lines.join(hosts, same(F.col("host"), F.col("of"))).filter(usual | many).select("host", "hash")


def removed_lines(texts: DataFrame, rules: QualityRules) -> DataFrame:
    """Per host and text: words and line numbers (from 0) of its boilerplate
    lines; only texts that have any."""
    lines = texts.select("host", "digest", F.inline("lines"))
    bad = boilerplate(texts, rules).select(F.col("host").alias("bad_host"), F.col("hash").alias("bad_hash"))
    return (lines.join(bad, (F.col("hash") == F.col("bad_hash")) & same(F.col("host"), F.col("bad_host")))
            .groupBy("host", "digest")
            .agg(F.sum("words").alias("removed_words"), F.collect_list("at").alias("removed")))


def judge(docs: DataFrame, rules: QualityRules = QualityRules(), *, id_col: str = "doc_id",
          text_col: str = "text", host_col: str = "source") -> DataFrame:
    """A row per document: id, host, digest of the text, the counts,
    ``base_failed``, ``removed`` (numbers of the removed lines, from 0),
    ``removed_words`` and ``kept``."""
    table = measured(docs, rules, id_col, text_col, host_col)
    texts = table.select("host", "digest", "lines").dropDuplicates(["host", "digest"])
    cut = removed_lines(texts, rules).withColumnsRenamed({"host": "cut_host", "digest": "cut_digest"})
    n, repeat = F.col("n_words"), F.col("n_repeat_words")
    return (table.drop("lines")
            .join(cut, (F.col("digest") == F.col("cut_digest")) & same(F.col("host"), F.col("cut_host")), "left")
            .drop("cut_host", "cut_digest")
            .withColumn("removed_words", F.coalesce("removed_words", F.lit(0)))
            .withColumn("base_failed", (n < rules.min_words) | (100 * repeat > rules.repeat_pct * n))
            .withColumn("kept", ~F.col("base_failed") & (100 * (n - F.col("removed_words")) >= rules.keep_pct * n)))


def filtered(docs: DataFrame, rules: QualityRules = QualityRules(), *, id_col: str = "doc_id",
             text_col: str = "text", host_col: str = "source", chars_col: str | None = "n_chars") -> DataFrame:
    """The kept documents with all their columns, without their boilerplate
    lines; ``chars_col``, where the table has it, follows the text."""
    rules_of = written(judge(docs, rules, id_col=id_col, text_col=text_col, host_col=host_col)
                       .filter("kept").select("host", "digest", "removed").dropDuplicates(["host", "digest"]))
    host, digest, removed = (fresh(docs, x) for x in ("rule_host", "rule_digest", "rule_removed"))
    rules_of = rules_of.toDF(host, digest, removed)
    text = F.col(text_col)
    kept = F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains(F.col(removed), i))
    new = F.when(F.col(removed).isNull(), text).otherwise(F.array_join(kept, "\n"))
    out = docs.join(rules_of, (F.unhex(F.md5(text_of(text_col))) == F.col(digest))
                    & same(F.col(host_col).cast("string"), F.col(host)))
    changed = {text_col: new}
    if chars_col in docs.columns:
        changed[chars_col] = F.when(F.col(removed).isNull(), F.col(chars_col)).otherwise(
            F.length(new).cast(docs.schema[chars_col].dataType))
    return out.select(*(changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns))
