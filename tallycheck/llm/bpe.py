"""Byte-level BPE by a global shuffle of distinct words.

1. Texts are cut into pre-tokens (the matches of ``public_tokenizers.PATTERN``).
   A block of documents keeps its distinct ones once, so that a document is the
   list of its pre-tokens' codes by position and a word that fills a third of the
   corpus is one row a block. Blocks are written, bucketed by their number.
2. The words of all blocks, exploded with their places (block and code), meet by
   word, sorted: every distinct word of the corpus is encoded once, and its ids are
   joined to all its places. What goes to the same block goes packed.
3. A block's words and documents meet again (the documents don't move: they are
   bucketed), and every document gets the ids of its codes, by position.

Decoding joins the token-byte table: it has as many rows as the vocabulary, so
every task holds it as an array and joins by id.

Defined results: null and empty texts have no ids; null ids of documents, equal
ids and repeated rows keep a row each; an empty table gives an empty result; other
columns are ignored; a token id that isn't in the table decodes to no bytes. A text
is never cut, so a task needs the memory for the codes of its longest text.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycheck.llm.common import shared_dir, sliced, text_of
from tallycheck.llm.pieces import byte_level_starts, cut, gathered, portions
from tallycheck.llm.token_files import width

#: Characters of text a block, about.
BLOCK_CHARS = 32 << 20
#: Bits of a code in a place; the block is above.
_CODE_BITS = 28


@lru_cache(maxsize=2)
def ranks(path: str) -> dict[bytes, int]:
    """Id of each token's bytes."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(path), special_tokens={})


@lru_cache(maxsize=2)
def token_bytes(path: str) -> pa.BinaryArray:
    """The bytes of each id; empty for ids without a token."""
    found = ranks(path)
    table = [b""] * (max(found.values(), default=-1) + 1)
    for token, rank in found.items():
        table[rank] = token
    return pa.array(table, pa.binary())


def _blocks(kind: pa.DataType, most: int):
    """Rows of two sorts: some documents of a block with their codes, or a word and its
    code in the block (the most frequent word has the least code)."""
    names = ["block", "rows", "ids", "ends", "codes", "code", "word"]
    types = [pa.int64(), pa.list_(pa.int64()), pa.list_(kind), pa.list_(pa.int32()), pa.binary(), pa.int32(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 12  # a task has fewer blocks than that
        pieces, ends, keys, chars = [], [], [], 0

        def emit() -> Iterator[pa.RecordBatch]:
            nonlocal block
            parts = pa.chunked_array(pieces).unify_dictionaries()
            words = parts.chunk(0).dictionary
            codes = np.concatenate([c.indices.to_numpy(zero_copy_only=False) for c in parts.chunks])
            order = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
            place = np.empty(len(order), "<u4")
            place[order] = np.arange(len(order), dtype="<u4")
            codes, words = place[codes], words.take(pa.array(order)).cast(pa.string())
            at = 0
            for end, key in zip(ends, keys):
                row = [[block], [key["row"].to_pylist()], [key["id"].to_pylist()], [end], [_planes(codes[at : at + end[-1]])]]
                at += end[-1]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, row, types), *(pa.nulls(1, t) for t in types[5:])], names)
            for a in range(0, len(words), 50_000):
                some = words.slice(a, 50_000)
                n = len(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, block, np.int64)), *(pa.nulls(n, t) for t in types[1:5]),
                     pa.array(np.arange(a, a + n, dtype=np.int32)), some], names)
            block += 1

        for batch in sliced(batches):
            texts = batch["text"].to_pylist()
            for a, b in portions(texts):
                found, end = cut(texts[a:b], byte_level_starts)
                pieces.append(found)
                ends.append(end.tolist())
                keys.append(batch.slice(a, b - a).select(["row", "id"]))
                chars += sum(map(len, texts[a:b]))
                if chars >= most:
                    yield from emit()
                    pieces, ends, keys, chars = [], [], [], 0
        if pieces:
            yield from emit()

    return run


def _planes(codes: np.ndarray) -> bytes:
    """All first bytes, then all second ones and so on: alike bytes compress well."""
    return codes.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _of_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _encoded(path: str, together: int = 400_000):
    """From places and words sorted by word: the ids of each place, packed by block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, kind = _encoding(path).encode_ordinary, width(len(token_bytes(path)))
        last: tuple[str, bytes] = "", b""
        held: list[pa.RecordBatch] = []

        def emit() -> Iterator[pa.RecordBatch]:
            nonlocal last
            rows = pa.Table.from_batches(held)
            words = rows["word"].combine_chunks().dictionary_encode()
            ids = [last[1] if w == last[0] else np.array(encode(w), kind).tobytes() for w in words.dictionary.to_pylist()]
            last = words.dictionary[-1].as_py(), ids[-1]
            place = rows["place"].to_numpy()
            order = np.argsort(place)
            place = place[order]
            found = pa.array(ids, pa.binary()).take(words.indices.take(pa.array(order)))
            data, ends = gathered(found, np.arange(len(found)))
            ends = np.concatenate(([0], ends))
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(place >> _CODE_BITS)) + 1, [len(place)]))
            pairs = list(zip(cuts, cuts[1:]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(place[cuts[:-1]] >> _CODE_BITS),
                 pa.array([_planes(np.diff(place[a:b] & (1 << _CODE_BITS) - 1, prepend=0)) for a, b in pairs], pa.binary()),
                 pa.array([_planes(np.diff(ends[a : b + 1])) for a, b in pairs], pa.binary()),
                 pa.array([data[ends[a] : ends[b]].tobytes() for a, b in pairs], pa.binary())],
                ["of", "steps", "sizes", "ids"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                if sum(x.num_rows for x in held) >= together:
                    yield from emit()
                    held = []
        if held:
            yield from emit()

    return run


def _words(packs: pa.Table) -> pa.BinaryArray:
    """The ids of a block's words by code."""
    if not len(packs):
        return pa.array([], pa.binary())
    codes = np.concatenate([np.cumsum(_of_planes(x), dtype=np.int64) for x in packs["steps"].to_pylist()])
    ends = np.cumsum(np.concatenate([_of_planes(x) for x in packs["sizes"].to_pylist()]), dtype=np.int64)
    data = pa.py_buffer(b"".join(packs["ids"].to_pylist()))
    offsets = pa.py_buffer(np.concatenate(([0], ends)).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(codes), [None, offsets, data]).take(pa.array(np.argsort(codes)))


def _binary(ends: np.ndarray, data: np.ndarray) -> pa.BinaryArray:
    """Byte strings that stand one after the other in ``data``."""
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _reassembled(kind: pa.DataType, path: str, with_decoded: bool):
    fields = [("row", pa.int64()), ("id", kind), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())]
    schema = pa.schema(fields if with_decoded else fields[:-1])

    def run(docs: pa.Table, packs: pa.Table) -> pa.Table:
        table, own = _words(packs), np.dtype(width(len(token_bytes(path))))
        out = []
        for i in range(len(docs)):
            row, key, ends, data = (docs[c][i] for c in ("rows", "ids", "ends", "codes"))
            found, upto = gathered(table, _of_planes(data.as_buffer()).astype(np.int32))
            tokens = (np.concatenate(([0], upto)) // own.itemsize)[ends.values.to_numpy()]
            ids = _binary(4 * tokens, found.view(own).astype("<u4"))
            columns = [row.values, key.values, pa.array(np.diff(tokens, prepend=0)), ids]
            out.append(pa.RecordBatch.from_arrays(columns + [_joined(ids, path)] * with_decoded, schema=schema))
        return pa.Table.from_batches(out, schema)

    return run


def encode(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text",
           with_decoded: bool = False, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """A row per document: row, id, n_tokens and ids (little-endian unsigned 32-bit
    integers, as bytes); ``with_decoded`` also what :func:`decode` makes of these ids, without
    a way to other workers. ``path``: a file of ranks."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = rows.schema["id"].dataType
    name = kind.simpleString()
    cut_up = rows.mapInArrow(_blocks(to_arrow_type(kind), block_chars), f"block long, rows array<long>, ids array<{name}>, "
                                                                        "ends array<int>, codes binary, code int, word string")
    table, path_of = f"blocks_{uuid.uuid4().hex}", shared_dir(spark)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (cut_up.write.format("parquet").bucketBy(buckets, "block").option("path", path_of)
     .option("compression", "zstd").saveAsTable(table))
    blocks = spark.table(table)
    blocks.schema  # resolved: the files stay, the name is no longer needed
    spark.sql(f"DROP TABLE {table}")
    words = spark.read.schema(blocks.schema).parquet(path_of).filter("word is not null")
    places = words.select(F.shiftleft("block", _CODE_BITS).bitwiseOR(F.col("code").cast("long")).alias("place"), "word")
    found = places.repartition("word").sortWithinPartitions("word").mapInArrow(
        _encoded(path), "of long, steps binary, sizes binary, ids binary")
    whole = blocks.filter("codes is not null").select("block", "rows", "ids", "ends", "codes")
    return whole.groupBy("block").cogroup(found.groupBy("of")).applyInArrow(
        _reassembled(to_arrow_type(kind), path, with_decoded),
        f"row long, id {name}, n_tokens long, ids binary" + ", decoded binary" * with_decoded)


def _joined(ids: pa.BinaryArray, path: str) -> pa.BinaryArray:
    """The tokens' bytes of each row of ids: the token-byte table joined by id."""
    table = token_bytes(path)
    ends = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1] // 4
    tokens = np.frombuffer(ids.buffers()[2], "<u4")[ends[0] : ends[-1]] if len(ids) and ends[-1] else np.zeros(0, "<u4")
    known = tokens < len(table)
    data, upto = gathered(table, tokens[known].astype(np.int32))
    return _binary(np.concatenate(([0], upto))[np.concatenate(([0], np.cumsum(known)))[ends[1:] - ends[0]]], data)


def _decoded(path: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "ids"):
            yield pa.RecordBatch.from_arrays([*(part[c] for c in names), _joined(part["ids"], path)], [*names, "decoded"])

    return run


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (with ``ids`` as :func:`encode` gives them, not null) and the bytes
    they stand for, ``decoded``."""
    names = encoded.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(_decoded(path, names), f"{schema}, decoded binary")
