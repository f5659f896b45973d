"""Ranked lexical search: the best documents for each query text.

Documents are cut into terms once; the terms that queries hold become postings
with their impacts (weight times damped frequency, in integers). Documents are dealt
to shards of bounded size. A shard keeps, per term, the impacts in document order and a
sparse table of range maxima over them. A query starts with the interval of
all documents; the interval with the highest bound (the sum of its terms' range
maxima) is split at the document of the greatest single impact, that document is
scored in full, and both sides go back with bounds of their own. What is left when
no bound reaches the last of the best documents can't enter. The shards' best
documents are merged by rank.

Defined results: a null or termless query has no rows; a null or termless document
is never found and not counted; equal scores go by ascending id (null first), then
by row; repeated documents and queries each count by themselves; empty tables give
an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallycheck.llm.common import numbered, sliced, text_of, written
from tallycheck.llm.pieces import cut, is_term, portions, term_starts


@dataclass(frozen=True)
class Search:
    """``most`` documents a query, ``shard_terms`` occurrences of terms a shard and
    ``block`` queries searched together. ``k`` and ``b`` damp long documents, in hundredths."""

    most: int = 20
    shard_terms: int = 6_000_000
    block: int = 512
    k: int = 12
    b: int = 25


class Postings:
    """Posting lists, one after the other from the longest to the shortest, and for
    every power of two the place of the greatest impact from each place on."""

    def __init__(self, lists: np.ndarray, docs: np.ndarray, impacts: np.ndarray, n_docs: int):
        """``lists``: the number of each posting's list, from 0."""
        sizes = np.bincount(lists)
        by_size = np.argsort(-sizes, kind="stable")
        self.place = np.empty(len(sizes), np.int64)  # of each list among the sorted ones
        self.place[by_size] = np.arange(len(sizes))
        self.n_docs = n_docs
        key = self.place[lists] * n_docs + docs
        order = np.argsort(key, kind="stable")
        self.key, self.impacts = key[order], impacts[order]
        self.docs = docs[order].astype(np.int32)
        sizes = sizes[by_size]
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        tables, at, self.offset, span = [np.arange(len(docs), dtype=np.int32)], len(docs), [0], 1
        while len(sizes) and sizes[0] >= 2 * span:
            held = self.starts[np.searchsorted(-sizes, -2 * span, side="right")] - 2 * span + 1
            left, right = tables[-1][:held], tables[-1][span : span + held]
            tables.append(np.where(self.impacts[right] > self.impacts[left], right, left))
            self.offset.append(at)
            at, span = at + held, 2 * span
        self.table, self.offset = np.concatenate(tables), np.array(self.offset)
        self.power = np.zeros(int(sizes[0]) + 1 if len(sizes) else 1, np.int64)
        for j in range(1, len(self.offset)):
            self.power[1 << j :] = j

    def greatest(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The place of the greatest impact in each range (none may be empty)."""
        power = self.power[end - start]
        base = self.offset[power]
        left, right = self.table[base + start], self.table[base + end - (1 << power)]
        return np.where(self.impacts[right] > self.impacts[left], right, left)

    def best(self, lists: np.ndarray, times: np.ndarray, most: int, together: int = 64) -> list[tuple[int, int]]:
        """(score, document) of the best documents for a query that holds each list's term
        so many ``times``: highest score first, then the lowest document."""
        place = self.place[lists]
        open_: list[tuple[int, int, int]] = []  # least first: minus the bound, first document, number
        ranges: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        found: list[tuple[int, int]] = []  # the worst first: score, minus the document
        count = 0

        def add(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
            nonlocal count
            full = start < end
            top = np.zeros(start.shape, np.int64)
            top[full] = self.greatest(start[full], end[full])
            value = np.where(full, self.impacts[top] * times, 0)
            bound = value.sum(axis=1)
            split = self.docs[top[np.arange(len(top)), value.argmax(axis=1)]]
            least = found[0][0] if len(found) == most else 1
            for i in np.flatnonzero(bound >= least).tolist():
                heapq.heappush(open_, (-int(bound[i]), int(low[i]), count))
                ranges[count] = split[i], start[i], end[i]
                count += 1

        add(np.zeros(1, np.int64), self.starts[place][None], self.starts[place + 1][None])
        while open_:
            batch, lows = [], []
            while open_ and len(batch) < together:
                bound, low, number = heapq.heappop(open_)
                entry = ranges.pop(number)
                if len(found) == most and (-bound, -low) <= found[0]:
                    if -bound < found[0][0]:  # nor can any later one
                        open_.clear()
                    continue
                batch.append(entry)
                lows.append(low)
            if not batch:
                break
            doc = np.array([x[0] for x in batch], np.int64)
            start, end = np.stack([x[1] for x in batch]), np.stack([x[2] for x in batch])
            at = np.searchsorted(self.key, (place * self.n_docs)[None] + doc[:, None])
            held = (at < end) & (self.docs[np.minimum(at, len(self.docs) - 1)] == doc[:, None])
            score = (np.where(held, self.impacts[np.minimum(at, len(self.docs) - 1)], 0) * times).sum(axis=1)
            for pair in zip(score.tolist(), (-doc).tolist()):
                if len(found) < most:
                    heapq.heappush(found, pair)
                else:
                    heapq.heappushpop(found, pair)
            add(np.concatenate((np.array(lows), doc + 1)), np.concatenate((start, at + held)), np.concatenate((at, end)))
        return [(score, -doc) for score, doc in sorted(found, reverse=True)]


def lower(text: str) -> str:
    """Only A-Z lower-cased."""
    return text.encode().lower().decode()


def _terms(kind: pa.DataType):
    """A row per document (term null) with its length, and one per document and term."""
    names = ["row", "id", "n", "term", "tf"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = batch["text"].to_pylist()
            for a, b in portions(texts, 1 << 20):
                found, ends = cut([lower(t) for t in texts[a:b]], term_starts, is_term)
                n = np.diff(ends, prepend=0)
                words = found.dictionary.cast(pa.string())
                codes = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                key, tf = np.unique(np.repeat(np.arange(b - a), n) * max(len(words), 1) + codes, return_counts=True)
                doc, code = np.divmod(key, max(len(words), 1))
                row, key = batch["row"].slice(a, b - a), batch["id"].slice(a, b - a)
                yield pa.RecordBatch.from_arrays([row, key, pa.array(n, pa.int64()), pa.nulls(b - a, pa.string()),
                                                  pa.nulls(b - a, pa.int64())], names)
                for i in range(0, len(doc), 100_000):
                    at = pa.array(doc[i : i + 100_000])
                    yield pa.RecordBatch.from_arrays(
                        [row.take(at), key.take(at), pa.array(n[doc[i : i + 100_000]], pa.int64()),
                         words.take(pa.array(code[i : i + 100_000])), pa.array(tf[i : i + 100_000], pa.int64())], names)

    return run


def _searched(most: int, kind: pa.DataType):
    names = ["query", "score", "id", "row"]

    def run(postings: pa.Table, queries: pa.Table) -> pa.Table:
        out = {c: [] for c in names}
        if len(postings):
            places = postings.group_by(["id", "row"]).aggregate([])
            places = places.take(pc.sort_indices(places, [("id", "ascending"), ("row", "ascending")], null_placement="at_start"))
            rows = places["row"].to_numpy()
            by_row = np.argsort(rows)
            docs = by_row[np.searchsorted(rows[by_row], postings["row"].to_numpy())]
            terms, lists = np.unique(postings["term"].to_numpy(), return_inverse=True)
            held = Postings(lists, docs, postings["impact"].to_numpy(), len(rows))
            for query, own, times in zip(*(queries[c].to_pylist() for c in ("query", "terms", "times"))):
                own, times = np.array(own, np.int64), np.array(times, np.int64)
                at = np.minimum(np.searchsorted(terms, own), len(terms) - 1)
                here = terms[at] == own
                if here.any():
                    best = held.best(at[here], times[here], most)
                    out["query"] += [query] * len(best)
                    out["score"] += [s for s, _ in best]
                    out["row"] += [d for _, d in best]
            out["id"] = places["id"].combine_chunks().take(pa.array(out["row"], pa.int64()))
            out["row"] = rows[out["row"]] if out["row"] else []
        return pa.table([pa.array(out["query"], pa.int64()), pa.array(out["score"], pa.int64()),
                         out["id"] if len(postings) else pa.array([], kind), pa.array(out["row"], pa.int64())], names)

    return run


def _cut_up(table: DataFrame, id_col: str, text_col: str) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type

    rows = table.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = rows.schema["id"].dataType
    return rows.mapInArrow(_terms(to_arrow_type(kind)), f"row long, id {kind.simpleString()}, n long, term string, tf long")


def search(docs: DataFrame, queries: DataFrame, rules: Search = Search(), *, id_col: str = "doc_id",
           text_col: str = "text", query_id: str = "item_id", query_text: str = "text") -> DataFrame:
    """query_row, query_id, rank (from 1), id, row and score of each query's best documents."""
    from pyspark.sql.pandas.types import to_arrow_type

    asked = written(_cut_up(queries, query_id, query_text).filter("term is not null"))
    known = numbered(asked.select("term").distinct(), "number")  # written
    terms = _cut_up(docs, id_col, text_col).join(known.withColumnRenamed("term", "known"), F.col("term") == F.col("known"), "left")
    held = written(terms.filter("term is null or number is not null").select("row", "id", "n", "number", "tf"))
    n_docs, total = held.filter("number is null and n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    kind = held.schema["id"].dataType
    if not total:
        n_docs = total = 1
    postings = held.filter("number is not null")
    weight = F.floor(1000 * F.log((2 * n_docs + 2) / (2 * F.count(F.lit(1)) + 1)))
    weights = written(postings.groupBy(F.col("number").alias("of")).agg(weight.alias("weight")).filter("weight > 0"))
    length = f"(100 - {rules.b} + ({rules.b} * n * {n_docs}L) div {total}L)"
    damped = F.expr(f"(1000000000L * tf) div (1000 * tf + {rules.k} * {length})")
    shards = -(-total // rules.shard_terms)
    weighed = postings.join(weights, F.col("number") == F.col("of")).select(
        "row", "id", "number", (F.col("weight") * damped).alias("impact")).filter("impact > 0")

    block = F.floor(F.col("query") / rules.block)
    rows = numbered(asked.select(F.col("row").alias("asked")).distinct(), "query")
    own = written(asked.join(rows, F.col("row") == F.col("asked")).join(known.withColumnRenamed("term", "known"), F.col("term") == F.col("known"))
                  .select("query", F.col("id").alias("query_id"), F.col("asked").alias("query_row"), "number", "tf").withColumn("block", block))
    packed = own.groupBy("block", "query").agg(F.collect_list("number").alias("terms"), F.collect_list("tf").alias("times"))
    every = F.sequence(F.lit(0).cast("long"), F.lit(int(shards) - 1).cast("long"))
    asked_of = packed.select("block", "query", "terms", "times", F.explode(every).alias("part"))
    of_block = own.select(F.col("block").alias("of_block"), F.col("number").alias("of_term")).distinct()
    dealt = (weighed.join(of_block, F.col("number") == F.col("of_term"))
             .select(F.pmod(F.xxhash64("row"), F.lit(int(shards))).alias("shard"), F.col("of_block"), "row", "id",
                     F.col("number").alias("term"), "impact"))
    found = dealt.groupBy("shard", "of_block").cogroup(asked_of.groupBy("part", "block")).applyInArrow(
        _searched(rules.most, to_arrow_type(kind)), f"query long, score long, id {kind.simpleString()}, row long")
    order = W.partitionBy("query").orderBy(F.desc("score"), F.asc("id"), F.asc("row"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= rules.most)
    names = own.select(F.col("query").alias("of"), "query_id", "query_row").distinct()
    return ranked.join(names, F.col("query") == F.col("of")).select("query_row", "query_id", "rank", "id", "row", "score")
