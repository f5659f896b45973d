"""Token ids in flat files.

Documents are range-partitioned and sorted by id, encoded, and every partition
writes one flat file of unsigned integers (the narrowest of 8, 16 or 32 bits
that holds the vocabulary), one of 64-bit document offsets (ends, in tokens of
that file) and one of the document ids. The number of
tokens of each file is known only then: the bases are prefix sums over the small
manifest, ordered by the first id of each file. Readers memory-map both files.

Encoding goes by pieces that no merge spans: a task encodes each distinct piece of
some megabytes of text once and gathers the ids by position. Texts with an added token's string, or with code
points on which libraries disagree, are encoded whole; the ids are always those of a
plain call of the tokenizers library.

Defined results: a null or empty text is the end id alone; null ids come first;
equal ids and repeated rows each keep a place of their own, equal ids ordered by
a hash of the text; an empty table gives no file and an empty result; other
columns are ignored. A lost task leaves at most files that no manifest row names.
"""

from __future__ import annotations

import os
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallycheck.llm.common import shared_dir, sliced, text_of, written
from tallycheck.llm.pieces import BETWEEN, byte_level_starts, cut, gathered, is_lexical, lexical_starts, portions

#: Code points that every library sorts alike into letters, digits, white space and signs
#: (others came, or changed, with later versions of Unicode), as ranges.
_SETTLED = [(0x00, 0x1B), (0x20, 0x84), (0x86, 0x12F), (0x131, 0x24F), (0x370, 0x377), (0x384, 0x38A), (0x38E, 0x3A1), (0x3A3, 0x52F), (0x5D0, 0x5EA),
            (0x620, 0x64A), (0x660, 0x669), (0x2010, 0x2027), (0x2030, 0x205E), (0x3001, 0x3003), (0x3041, 0x3096),
            (0x30A1, 0x30FA), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3), (0x1F300, 0x1F64F)]
_settled = np.zeros(0x110000, bool)
for _a, _b in _SETTLED:
    _settled[_a : _b + 1] = True
#: Bytes of pieces that stay known at most, but for those of the last call.
_MEMO_BYTES = 32 << 20
_CLOSE = BETWEEN.encode("utf-8", "surrogatepass")


class Encoder:
    """Ids of whole texts. A text's pieces (the matches of the tokenizer's pattern) are
    encoded apart, as no merge spans two of them: each distinct piece of a call once,
    the others by position; about ``remember`` pieces stay known with their ids. Texts
    that name an added token, or whose pieces can't be told surely, go to the tokenizer
    whole. A call works on ``most`` characters at a time."""

    def __init__(self, path: str, most: int = 1 << 20, remember: int = 400_000):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.byte_level = self.tokenizer.normalizer is None
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype(width(self.vocabulary))
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.starts = byte_level_starts if self.byte_level else lexical_starts
        # a piece by itself wherever it stands between others
        self.between = "\n" if self.byte_level else " \x01 "
        self.mark = int(np.frombuffer(self.whole([self.between])[0], self.dtype)[0])
        self.most, self.remember = most, remember
        self.memo = pa.array([], pa.binary()), pa.array([], pa.binary())
        if self.byte_level:  # joined pieces are cut already, and spelt in the vocabulary's letters, each a byte
            spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
            every = "".join(map(chr, (*range(0x800), *range(0x800, 0xD800, 64), *range(0xE000, 0x110000, 64))))
            self.letters = np.zeros(256, "<u4")
            self.letters[list(every.encode())] = [ord(c) for c in spell(every)[0][0]]
            self.plain = self.tokenizer.pre_tokenizer
            self.joined = pre_tokenizers.CharDelimiterSplit(chr(self.letters[ord(self.between)]))
            self.letters_of = np.zeros(self.vocabulary, np.int64)
            for token, i in self.tokenizer.get_vocab().items():
                self.letters_of[i] = len(token)

    def whole(self, texts: list[str]) -> list[bytes]:
        """Each text encoded by itself."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.dtype).tobytes() for x in found]

    def _batches(self, texts: list[str], cutter=None, most: int = 32) -> list[np.ndarray]:
        """The ids of each text, cut by ``cutter`` instead of the tokenizer's pattern; of
        ``most`` at a time the tokenizer holds more than the ids."""
        if cutter is not None:
            self.tokenizer.pre_tokenizer = cutter
        try:
            calls = (self.tokenizer.encode_batch_fast(texts[i : i + most], add_special_tokens=False) for i in range(0, len(texts), most))
            return [np.array(x.ids, self.dtype) for found in calls for x in found]
        finally:
            if cutter is not None:
                self.tokenizer.pre_tokenizer = self.plain

    def _grouped(self, pieces: pa.BinaryArray, group: int = 256) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of all pieces, encoded many to a call, and how many each piece has;
        None if that can't be told."""
        bounds = np.append(np.arange(0, len(pieces), group), len(pieces))
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pieces)
        joined = pc.binary_join(lists, self.between.encode()).to_pylist()
        if self.byte_level:
            texts = [self.letters[np.frombuffer(x, np.uint8)].tobytes().decode("utf-32-le") for x in joined]
            ids = np.concatenate([np.zeros(0, self.dtype), *self._batches(texts, self.joined)])
            upto = np.cumsum(self.letters_of[ids])
            ends = np.cumsum(pc.binary_length(pieces).to_numpy(zero_copy_only=False), dtype=np.int64)
            last = np.searchsorted(upto, ends)
            if len(upto) < len(ends) or not np.array_equal(upto[np.minimum(last, len(upto) - 1)], ends):
                return None
            return ids, np.diff(last, prepend=-1)
        texts = [f"{self.between}{x.decode()}{self.between}" for x in joined]
        found = self._batches(texts)
        if [np.count_nonzero(x == self.mark) for x in found] != (np.diff(bounds) + 1).tolist():
            return None
        ids = np.concatenate([np.zeros(0, self.dtype), *found])
        # between two marks stand the ids of a piece, or two groups meet
        counts = np.diff(np.flatnonzero(ids == self.mark)) - 1
        return ids[ids != self.mark], np.delete(counts, np.cumsum(np.diff(bounds) + 1)[:-1] - 1)

    def _new(self, pieces: pa.BinaryArray) -> pa.BinaryArray:
        """The ids of each piece."""
        plain = ~pc.match_substring(pieces, self.between.strip(" ")).to_numpy(zero_copy_only=False)
        grouped = self._grouped(pieces.filter(pa.array(plain)))
        if grouped is None:
            plain[:] = False
            grouped = np.zeros(0, self.dtype), np.zeros(0, np.int64)
        ids, counts = grouped
        ends = np.cumsum(np.append(0, counts * self.dtype.itemsize)).astype(np.int32)
        of_plain = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(ids)])
        others = self.whole([x.decode() for x in pieces.filter(pa.array(~plain)).to_pylist()])
        place = np.empty(len(pieces), np.int64)
        place[plain] = np.arange(len(counts))
        place[~plain] = len(counts) + np.arange(len(others))
        return pa.concat_arrays([of_plain, pa.array(others, pa.binary())]).take(pa.array(place))

    def _ids(self, pieces: pa.BinaryArray, end: bytes) -> pa.BinaryArray:
        """The ids of each piece, ``end`` for what stands between texts."""
        known, ids = self.memo
        at = pc.index_in(pieces, pa.concat_arrays([known, pa.array([_CLOSE], pa.binary())]))
        new = pieces.filter(pc.is_null(at))
        ids = pa.concat_arrays([ids, pa.array([end], pa.binary()), self._new(new)])
        place = at.fill_null(0).to_numpy(zero_copy_only=False).copy()
        place[at.is_null().to_numpy(zero_copy_only=False)] = len(known) + 1 + np.arange(len(new))
        found = ids.take(pa.array(place))
        kept = pa.array(place != len(known))
        if len(known) + len(new) > self.remember or known.nbytes + new.nbytes > _MEMO_BYTES:
            self.memo = pieces.filter(kept), found.filter(kept)
        else:
            self.memo = pa.concat_arrays([known, new]), pa.concat_arrays([self.memo[1], ids.slice(len(known) + 1)])
        return found

    def _apart(self, text: str) -> bool:
        if any(t in text for t in self.added):
            return False
        if not text.isascii() and not _settled[np.frombuffer(text.encode("utf-32-le"), "<u4")].all():
            return False
        return self.byte_level or unicodedata.is_normalized("NFC", text)

    def encode(self, texts: list[str], end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, ``end`` after each, and where each ends."""
        apart = [self._apart(t) for t in texts]
        ids, ends = self._by_pieces([t for t, a in zip(texts, apart) if a], end)
        if all(apart):
            return ids, ends
        pieces = iter(np.split(ids, ends[:-1]) if len(ends) else [])
        wholes = iter(self.whole([t for t, a in zip(texts, apart) if not a]))
        found = [next(pieces) if a else np.frombuffer(next(wholes) + end, self.dtype) for a in apart]
        return np.concatenate(found), np.cumsum([len(x) for x in found])

    def _by_pieces(self, texts: list[str], end: bytes) -> tuple[np.ndarray, np.ndarray]:
        if not texts:
            return np.zeros(0, self.dtype), np.zeros(0, np.int64)
        if not self.byte_level:  # the tokenizer lower-cases; here ASCII, which changes no piece's bounds
            texts = [t.encode().lower().decode() for t in texts]
        cuts, ends = zip(*(cut(texts[a:b], self.starts, None if self.byte_level else is_lexical, with_ends=True)
                           for a, b in portions(texts, self.most)))
        chunks = pa.chunked_array(cuts).unify_dictionaries().chunks
        ids = self._ids(chunks[0].dictionary, end)
        found, upto = zip(*(gathered(ids, x.indices.to_numpy(zero_copy_only=False)) for x in chunks))
        before = np.cumsum([0, *map(len, found)])
        upto = [n + u[e - 1].astype(np.int64) for n, u, e in zip(before, upto, ends)]
        return np.concatenate(found).view(self.dtype), np.concatenate(upto) // self.dtype.itemsize


def width(vocabulary: int) -> str:
    return "<u1" if vocabulary <= 1 << 8 else "<u2" if vocabulary <= 1 << 16 else "<u4"


#: Bytes of text that a task encodes at once: the more, the fewer distinct pieces it meets again.
SLICE = 8 << 20


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    return Encoder(path)


def _writer(folder: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, name = encoder(tokenizer), uuid.uuid4().hex
        store, path = fs.FileSystem.from_uri(folder)
        end = np.array([end_id], enc.dtype).tobytes()
        tokens = docs = 0
        place = out = None
        for batch in sliced(batches, size=SLICE):
            if out is None:
                place = batch["place"][0].as_py()
                out = [store.open_output_stream(f"{path}/{name}.{x}") for x in ("bin", "idx", "ids")]
                keys = pa.ipc.new_stream(out[2], pa.schema([batch.schema.field("id")]))
            ids, ends = enc.encode(batch["text"].to_pylist(), end)
            out[0].write(ids.tobytes())
            out[1].write((tokens + ends).astype("<u8").tobytes())
            tokens += len(ids)
            keys.write_batch(batch.select(["id"]))
            docs += batch.num_rows
        if out is not None:
            keys.close()
            for f in out:
                f.close()
            yield pa.RecordBatch.from_pylist(
                [{"file": f"{folder}/{name}", "place": place, "docs": docs, "tokens": tokens, "dtype": enc.dtype.str}])

    return run


def write_tokens(docs: DataFrame, tokenizer: str, *, end_id: int = 1, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Writes the files in ascending id order; returns the manifest: file (with
    endings ``.bin``, ``.idx`` and ``.ids``), place, docs, tokens, dtype and
    base (tokens before). Spark's shuffle settings say how many files."""
    spark = docs.sparkSession
    folder = shared_dir(spark)
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    # the hash and the row number only part equal ids, so that no id fills one task
    keyed = rows.withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    ordered = keyed.repartitionByRange("id", "tie", "row").sortWithinPartitions("id", "tie", "row")
    manifest = written(ordered.select("id", F.spark_partition_id().cast("long").alias("place"), "text").mapInArrow(
        _writer(folder, tokenizer, end_id), "file string, place long, docs long, tokens long, dtype string"))
    before = W.orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def mapped(uri: str, dtype: str) -> np.ndarray:
    """A flat file, memory-mapped where its folder is mounted, else read."""
    store, path = fs.FileSystem.from_uri(uri)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype, "r") if store.get_file_info(path).size else np.zeros(0, dtype)
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


def documents_in(file: str, dtype: str) -> Iterator[tuple[object, np.ndarray]]:
    """Id and token ids of each document of a file, in order."""
    tokens, ends = mapped(f"{file}.bin", dtype), mapped(f"{file}.idx", "<u8").tolist()
    store, path = fs.FileSystem.from_uri(f"{file}.ids")
    start = at = 0
    with store.open_input_file(path) as f:
        for batch in pa.ipc.open_stream(f):
            for key in batch["id"].to_pylist():
                yield key, tokens[start : ends[at]]
                start, at = ends[at], at + 1


def _reader(kind: pa.DataType):
    names = ["id", "start", "n_tokens", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.to_pylist():
                rows, start = [], x["base"]
                for key, ids in documents_in(x["file"], x["dtype"]):
                    rows.append((key, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), (kind, *[pa.int64()] * 3))], names)

    return run


def read_documents(manifest: DataFrame, id_type: str = "bigint") -> DataFrame:
    """From the files alone: id, start (tokens of all documents before),
    n_tokens and ids_crc32 (of the ids as little-endian 32-bit integers)."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    kind = to_arrow_type(_parse_datatype_string(id_type))
    many = max(1, manifest.count())
    return manifest.repartition(many, "file").mapInArrow(
        _reader(kind), f"id {id_type}, start long, n_tokens long, ids_crc32 long")
