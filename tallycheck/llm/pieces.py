"""Texts as arrays of pieces: what a tokenizer encodes apart, found by array
operations on code points, dictionary-encoded, and joined again by position."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

#: Stands between two texts; no text can hold it (a lone surrogate).
BETWEEN = "\udfff"
#: Kinds of code points.
LETTER, DIGIT, SPACE, SIGN, END = range(5)
_CONTRACTIONS = [np.frombuffer(x.encode("utf-32-le"), "<u4") for x in ("s", "t", "m", "d", "re", "ve", "ll")]


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """The kind of every code point."""
    table = np.full(0x110000, SIGN, np.uint8)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for kind, pattern in ((LETTER, r"\p{L}"), (DIGIT, r"\p{N}"), (SPACE, r"\s")):
        table[np.frombuffer("".join(regex.findall(pattern, every)).encode("utf-32-le"), "<u4")] = kind
    table[ord(BETWEEN)] = END
    return table


def _runs(kind: np.ndarray) -> np.ndarray:
    """Where the kind changes; every ``END`` is a run by itself."""
    run = np.ones(len(kind), bool)
    np.not_equal(kind[1:], kind[:-1], out=run[1:])
    run |= kind == END
    return run


def _contract(points: np.ndarray, kind: np.ndarray, quote: np.ndarray, start: np.ndarray) -> None:
    """Moves the cut after each ``quote`` (a run by itself, before letters) to the end of
    the contraction that it begins."""
    quote = quote[kind[np.minimum(quote + 1, len(points) - 1)] == LETTER]
    ahead = np.concatenate((points, np.zeros(3, points.dtype)))
    for tail in _CONTRACTIONS:
        hit = quote[np.logical_and.reduce([ahead[quote + 1 + i] == c for i, c in enumerate(tail)])]
        start[hit + 1] = False
        start[hit + 1 + len(tail)] = True


def byte_level_starts(points: np.ndarray) -> np.ndarray:
    """Where the matches of ``public_tokenizers.PATTERN`` begin in code points
    that end with ``END``; every ``END`` is a piece by itself. The pattern cuts
    where the kind changes, but for one space that goes with what follows, the
    last white space before a word, and contractions."""
    kind = kinds()[points]
    run = _runs(kind)
    start = run.copy()
    after = np.flatnonzero(run[1:] & (kind[:-1] == SPACE) & (kind[1:] != END)) + 1
    start[after - 1] = True
    start[after[points[after - 1] == 32]] = False
    quote = np.flatnonzero((points == 39) & run)
    _contract(points, kind, quote[(quote == 0) | (points[quote - 1] != 32)], start)
    return start


def lexical_starts(points: np.ndarray) -> np.ndarray:
    """Where runs of letters, of signs and of white space, single digits and contractions
    begin (a pattern without leading spaces); every ``END`` is a piece by itself."""
    kind = kinds()[points]
    run = _runs(kind)
    start = run | (kind == DIGIT)
    _contract(points, kind, np.flatnonzero((points == 39) & run), start)
    return start


def word_starts(points: np.ndarray) -> np.ndarray:
    """Where ASCII white space ends and something else begins, or the other way
    round; every ``END`` is a piece by itself."""
    end = points == ord(BETWEEN)
    space = (points == 32) | (points - np.uint32(9) < 5)
    start = end.copy()
    start[0] = True
    start[1:] |= (space[1:] != space[:-1]) | end[:-1]
    return start


def term_starts(points: np.ndarray) -> np.ndarray:
    """Where ASCII letters and digits and all that isn't ASCII begin or end; every
    ``END`` is a piece by itself."""
    end, term = points == ord(BETWEEN), is_term(points)
    start = end.copy()
    start[0] = True
    start[1:] |= (term[1:] != term[:-1]) | end[:-1]
    return start


def is_lexical(points: np.ndarray) -> np.ndarray:
    return kinds()[points] != SPACE


def is_word(points: np.ndarray) -> np.ndarray:
    return (points != 32) & (points - np.uint32(9) >= 5)


_TERM = np.array([chr(c).isalnum() for c in range(128)])


def is_term(points: np.ndarray) -> np.ndarray:
    return (points >= 128) | _TERM[np.minimum(points, 127)]


def cut(texts: list[str], starts, wanted=None, with_ends: bool = False) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The pieces of all texts, one after the other, dictionary-encoded UTF-8, and
    where each text ends among them. ``wanted`` tells by their first code points
    which pieces to keep; ``with_ends`` keeps what stands between the texts, too."""
    joined = BETWEEN.join([*texts, ""])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    data = joined.encode("utf-8", "surrogatepass")
    at = np.flatnonzero(starts(points)) if len(points) else np.zeros(0, np.int64)
    first, end = at, points[at] == ord(BETWEEN)
    if len(data) != len(points):
        at = np.flatnonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80)[at]  # where code points begin
    offsets = np.append(at, len(data)).astype(np.int32)
    found = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    keep = np.ones(len(at), bool) if wanted is None else wanted(points[first])
    keep = keep | end if with_ends else keep & ~end
    return found.filter(pa.array(keep)).dictionary_encode(), np.cumsum(keep)[end]


def portions(texts: list[str], chars: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Index ranges of about ``chars`` characters each."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def gathered(values: pa.BinaryArray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``values`` at ``codes``, joined: the bytes, and where each value ends in them."""
    found = values.take(pa.array(codes))
    ends = np.frombuffer(found.buffers()[1], np.int32)[found.offset + 1 : found.offset + len(found) + 1] if len(found) else np.zeros(0, np.int32)
    data = np.frombuffer(found.buffers()[2], np.uint8) if len(found) and ends[-1] else np.zeros(0, np.uint8)
    return data, ends
