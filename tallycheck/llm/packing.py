"""Lexical retrieval packing.

Documents are encoded, and sorted by their best terms: the token ids with the
highest BM25 weights over the whole corpus, best first. The order is cut into
shards of bounded size, so documents that share their best terms meet, and a
group too large for a shard is divided by its next terms and then by row. Every
shard is indexed and packed by itself: a neighbour with other best terms may
stand in another shard, where it isn't searched. The inverted index holds BM25
weights of token ids, with the corpus's frequencies; a window starts with what is left of the last document (the seed),
and takes the unused neighbours that the index returns for it, best first, until
it is full. The document that doesn't fit is cut and seeds the next window; a
seed without neighbours is followed by the next unused document. So only the
last window of a task is padded.

Defined results: a null or empty text is the end id alone; documents with equal
ids and repeated rows are packed each on its own; ties in the score go to the
document that comes first in that order; an empty table gives an empty result; other columns
are ignored. Rows carry (sequence_id, offset); sequence ids are unique but leave
gaps between tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycheck.llm.common import sliced, text_of, written
from tallycheck.llm.token_files import SLICE, encoder


@dataclass(frozen=True)
class Packing:
    """``window`` tokens a sequence, ``end_id`` after each document,
    ``shard_chars`` characters of text a shard, ``terms`` of a seed that are
    looked up (None: all), and BM25's ``k1`` and ``b``."""

    window: int = 2048
    end_id: int = 1
    shard_chars: int = 4 << 20
    terms: int | None = None
    k1: float = 1.2
    b: float = 0.75


@dataclass(frozen=True)
class Frequencies:
    """Documents, their mean length in tokens, and documents by term."""

    n: int
    mean: float
    df: np.ndarray

    @classmethod
    def of(cls, terms: np.ndarray, lengths: np.ndarray) -> Frequencies:
        """``terms``: those of each document once, one document after the other."""
        return cls(len(lengths), float(lengths.mean()), np.bincount(terms))

    def weights(self, terms: np.ndarray, counts: np.ndarray, length, rules: Packing) -> np.ndarray:
        df = self.df[terms]
        norm = rules.k1 * (1 - rules.b + rules.b * length / self.mean)
        return np.log1p((self.n - df + 0.5) / (df + 0.5)) * counts * (rules.k1 + 1) / (counts + norm)


class InvertedIndex:
    """BM25 postings of a shard's documents, by term. Terms of more than one in
    ``COMMON`` documents are rows over all documents, at most ``COMMON`` places a posting."""

    COMMON = 8

    def __init__(self, docs: list[np.ndarray], rules: Packing, corpus: Frequencies | None = None):
        parts = [np.unique(d, return_counts=True) for d in docs]
        self.n, self.rules = len(docs), rules
        sizes = np.array([len(t) for t, _ in parts])
        lengths = np.array([len(d) for d in docs], np.float64)
        terms = np.concatenate([t for t, _ in parts])
        counts = np.concatenate([c for _, c in parts]).astype(np.float64)
        owners = np.repeat(np.arange(self.n), sizes)
        df = np.bincount(terms)
        weights = (corpus or Frequencies.of(terms, lengths)).weights(terms, counts, lengths[owners], rules)
        by_doc = np.concatenate(([0], np.cumsum(sizes)))
        self.queries = [self._query(terms[a:b], weights[a:b]) for a, b in zip(by_doc, by_doc[1:])]
        order = np.argsort(terms, kind="stable")
        self.owners, self.weights = owners[order], weights[order]
        self.starts = np.concatenate(([0], np.cumsum(df)))
        common = np.flatnonzero(df * self.COMMON > self.n)
        self.dense_row = np.full(len(df), -1)
        self.dense_row[common] = np.arange(len(common))
        self.dense = np.zeros((len(common), self.n))
        row = self.dense_row[terms]
        held = row >= 0
        self.dense[row[held], owners[held]] = weights[held]

    def _query(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The document's own terms, or its best ``rules.terms``."""
        if self.rules.terms is None or len(terms) <= self.rules.terms:
            return terms
        return terms[np.argpartition(-weights, self.rules.terms)[: self.rules.terms]]

    def neighbours(self, doc: int, used: np.ndarray, most: int | None = None) -> np.ndarray:
        """Unused documents that share a query term, best first (the best ``most``)."""
        terms = self.queries[doc]
        rows = self.dense_row[terms]
        score = self.dense[rows[rows >= 0]].sum(axis=0)
        rare = terms[rows < 0]
        if len(rare):
            first = self.starts[rare]
            sizes = self.starts[rare + 1] - first
            upto = np.cumsum(sizes)
            at = np.arange(upto[-1]) + np.repeat(first - upto + sizes, sizes)
            score += np.bincount(self.owners[at], self.weights[at], self.n)
        score[used] = 0
        found = np.flatnonzero(score)
        if most is not None and len(found) > most:  # ties with the last one stay until they are ordered
            found = found[score[found] >= np.partition(score[found], -most)[-most]]
        return found[np.argsort(-score[found], kind="stable")][:most]


def packed(docs: list[np.ndarray], rules: Packing, corpus: Frequencies | None = None, sequence: int = 0,
           offset: int = 0) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of a shard that
    goes on at ``offset`` of ``sequence``."""
    index = InvertedIndex(docs, rules, corpus)
    used = np.zeros(len(docs), bool)
    first = 0
    waiting: list[int] = []  # neighbours for the current window, best last
    asked = 0  # how many were looked up; none, when there are no more
    seed = None
    while True:
        if asked and not waiting:
            # a neighbour has one token at least: more than the free ones are never taken
            waiting = index.neighbours(seed, used, min(asked, rules.window - offset))[::-1].tolist()
            asked = 16 * asked if len(waiting) == asked else 0
        doc = waiting.pop() if waiting else None
        if doc is None:
            while first < len(docs) and used[first]:
                first += 1
            if first == len(docs):
                return
            doc = first
        used[doc] = True
        start, size = 0, len(docs[doc])
        while start < size:
            length = min(size - start, rules.window - offset)
            yield doc, start, length, sequence, offset
            start, offset = start + length, offset + length
            if offset == rules.window:
                sequence, offset, seed = sequence + 1, 0, None
                waiting, asked = [], 0
        if seed is None and offset:  # what is left of this document begins the window
            seed, asked = doc, 8


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.BinaryArray:
    """A row of bytes for what stands in ``values`` up to each of ``ends``."""
    offsets = (np.concatenate(([0], ends)) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _values(column: pa.BinaryArray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """What all rows of a column of bytes hold, one after the other, and how many each."""
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) // np.dtype(dtype).itemsize
    return np.frombuffer(b"".join(column.to_pylist()), dtype), sizes


def _encoded(tokenizer: str, end_id: int):
    """Documents with their ids, and each document's terms once with how often it holds them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.dtype).tobytes()
        for batch in sliced(batches, size=SLICE):
            texts = batch["text"].to_pylist()
            ids, ends = enc.encode(texts, end)
            parts = [np.unique(d, return_counts=True) for d in np.split(ids, ends[:-1])]
            upto = np.cumsum([len(t) for t, _ in parts])
            terms, counts = (np.concatenate(x) for x in zip(*parts))
            chars = pa.array([len(t) + 1 for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["id"], chars, pa.array(np.diff(ends, prepend=0), pa.int64()), _binary(ids, ends),
                 _binary(terms, upto), _binary(counts.astype("<u4"), upto)],
                ["row", "id", "chars", "tokens", "ids", "terms", "counts"])

    return run


#: Stand for terms in the counts: documents and their tokens.
_DOCS, _TOKENS = -1, -2


def _counted(tokenizer: str):
    """Documents by term, a row per term and task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        df, n, tokens = np.zeros(enc.vocabulary, np.int64), 0, 0
        for batch in sliced(batches, "terms"):
            df += np.bincount(_values(batch["terms"], enc.dtype)[0], minlength=len(df))
            n, tokens = n + batch.num_rows, tokens + (pc.sum(batch["tokens"]).as_py() or 0)
        terms = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(([_DOCS, _TOKENS], terms)), pa.int64()),
                                          pa.array(np.concatenate(([n, tokens], df[terms])), pa.int64())], ["term", "n"])

    return run


#: Best terms in the order of documents.
_ORDER_TERMS = 4


def best_terms(terms: np.ndarray, counts: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, corpus: Frequencies,
               rules: Packing) -> list[np.ndarray]:
    """Each document's best terms that another document holds, ties by id. Documents
    stand one after the other, with ``sizes`` terms and ``lengths`` tokens."""
    weights = corpus.weights(terms, counts, np.repeat(lengths, sizes), rules)
    weights[corpus.df[terms] <= 1] = 0  # the others weigh more
    upto = np.cumsum(sizes).tolist()
    best = [a + np.argsort(-weights[a:b], kind="stable")[:_ORDER_TERMS] for a, b in zip([0, *upto], upto)]
    return [terms[x[weights[x] > 0]] for x in best]


def _keyed(tokenizer: str, corpus: Frequencies, rules: Packing):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = encoder(tokenizer).dtype
        for batch in sliced(batches, "terms", 1 << 20):
            terms, sizes = _values(batch["terms"], kind)
            best = best_terms(terms, _values(batch["counts"], "<u4")[0], sizes, batch["tokens"].to_numpy(), corpus, rules)
            yield pa.RecordBatch.from_arrays([pa.array(best, pa.list_(pa.int32())), *(batch[c] for c in ("row", "id", "ids"))],
                                             ["best", "row", "id", "ids"])

    return run


def _pack_task(tokenizer: str, rules: Packing, corpus: Frequencies, most: int, kind: pa.DataType, with_ids: bool):
    """Packs a task's documents, in shards of about ``most`` tokens at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        dtype = encoder(tokenizer).dtype
        base = TaskContext.get().partitionId() << 32
        kinds = [kind, *[pa.int64()] * 6] + [pa.list_(pa.int64())] * with_ids
        sequence = offset = size = 0
        ids, docs = [], []

        def shard() -> pa.RecordBatch:
            nonlocal sequence, offset
            rows = []
            for doc, start, length, sequence, offset in packed(docs, rules, corpus, sequence, offset):
                piece = docs[doc][start : start + length].astype("<u4")
                row = (ids[doc], start, length, zlib.crc32(piece.tobytes()), len(docs[doc]), base + sequence, offset)
                rows.append((*row, piece) if with_ids else row)
            offset += length
            if offset == rules.window:
                sequence, offset = sequence + 1, 0
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], NAMES[: len(kinds)])

        for batch in batches:
            for i, x in zip(batch["id"].to_pylist(), batch["ids"].to_pylist()):
                ids.append(i)
                docs.append(np.frombuffer(x, dtype))
                size += len(docs[-1])
                if size >= most:
                    yield shard()
                    ids, docs, size = [], [], 0
        if docs:
            yield shard()

    return run


NAMES = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]


def pack(docs: DataFrame, tokenizer: str, rules: Packing = Packing(), *, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """A row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, and with ``with_ids`` the token ids."""
    from pyspark.sql.pandas.types import to_arrow_type

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                       text_of(text_col).alias("text"))
    kind = rows.schema["id"].dataType
    name = kind.simpleString()
    encoded = written(rows.mapInArrow(_encoded(tokenizer, rules.end_id), f"row long, id {name}, chars long, "
                                      "tokens long, ids binary, terms binary, counts binary"), compression="zstd")
    chars = encoded.agg(F.sum("chars")).first()[0] or 0
    shards = max(1, -(-chars // rules.shard_chars))
    # as many rows as the vocabulary has ids, at most
    counts = dict(tuple(r) for r in encoded.select("tokens", "terms").mapInArrow(_counted(tokenizer), "term long, n long")
                  .groupBy("term").agg(F.sum("n")).collect())
    n, tokens = counts.pop(_DOCS, 0), counts.pop(_TOKENS, 0)
    df = np.zeros(max(counts, default=0) + 1, np.int64)
    df[list(counts)] = list(counts.values())
    corpus = Frequencies(n, tokens / max(n, 1), df)
    keyed = written(encoded.drop("chars").mapInArrow(
        _keyed(tokenizer, corpus, rules), f"best array<int>, row long, id {name}, ids binary"), (encoded,), "zstd")
    # the row divides what has the same best terms: no group is too large for a shard
    dealt = keyed.repartitionByRange(shards, "best", "row").sortWithinPartitions("best", "row").select("id", "ids")
    schema = f"id {name}, start long, length long, ids_crc32 long, doc_tokens long, " \
             "sequence_id long, offset long" + ", ids array<long>" * with_ids
    most = max(1, 2 * tokens // shards)
    return dealt.mapInArrow(_pack_task(tokenizer, rules, corpus, most, to_arrow_type(kind), with_ids), schema)
