"""Benchmark decontamination by spaced seeds, in DataFrame functions alone.

A document leaks a benchmark item if, on some alignment, a window of ``WINDOW``
item words has at most ``SUBSTITUTIONS`` that differ. Each mask of ``MASKS``
hashes some positions and ignores the others; of the two masks, one always fits
such a window without touching its substitutions (a test tries every case), so
joining the mask hashes of benchmark and documents finds every leak. Around each
hit the windows that hold it are compared word by word. Items of ``SHORT`` words or
more, but less than a window, leak whole with at most one word that differs, found by
a mask of their own; shorter ones leak whole and unchanged, found by the hash of all
their words. Documents are hashed only by the masks that the benchmark's items need.

The hashes of the benchmark are broadcast after a check of their number
(``MAX_WORDS``); a larger benchmark takes the same join as a shuffle.

Defined results: words are runs between ASCII white space, lower-cased; an item
without words never leaks; null and empty texts leak nothing; documents with equal id and text
share their rows; equal items each have theirs; empty tables give an empty
result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycheck.llm.common import SPACE_RUN, fresh, text_of, written

WINDOW, SUBSTITUTIONS = 13, 2
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))
#: Least words of an item that leaks with one substitution, and the mask for those below a window.
SHORT, SHORT_MASK = 8, (0, 1, 3, 4)
#: Words of a benchmark whose hashes every executor holds: two hashes a word.
MAX_WORDS = 250_000


def word_array(text: Column) -> Column:
    """64-bit hashes of the lower-cased words."""
    return F.transform(F.array_remove(F.split(F.lower(text), SPACE_RUN), ""), lambda w: F.xxhash64(w))


def masks_for(sizes: set[int]) -> list[tuple[tuple[int, ...], int, int]]:
    """(mask, least and most words of the items it is for) that items of these
    sizes need; a size of ``WINDOW`` stands for all from there on."""
    wanted = [(m, WINDOW, 2**31 - 1) for m in MASKS] + [(SHORT_MASK, SHORT, WINDOW - 1)]
    wanted += [(tuple(range(n)), n, n) for n in range(1, SHORT)]
    return [(m, low, high) for m, low, high in wanted if any(low <= n <= high for n in sizes)]


def seeds(rows: DataFrame, words: str, masks: list[tuple[tuple[int, ...], int, int]], items: bool = False) -> DataFrame:
    """``rows`` once for each word position ``at`` and mask, with the mask's
    ``hash`` and its length ``span``; of ``items`` only the masks for their sizes."""
    placed = rows.select("*", F.posexplode(words).alias("at", "word"))

    def masked(i: int, mask: tuple[int, ...], low: int, high: int) -> Column:
        others = [F.get(F.col(words), F.col("at") + k) for k in mask[1:]]
        fits = F.col("at") + mask[-1] < F.size(words)  # beyond the end there is no hash
        if items:
            fits &= F.size(words).between(low, high)
        return F.when(fits, F.xxhash64(F.lit(i), "word", *others))

    found = F.array(*(F.struct(masked(i, *m).alias("hash"), F.lit(m[0][-1] + 1).alias("span")) for i, m in enumerate(masks)))
    return placed.select("*", F.inline(found)).drop("word").filter(F.col("hash").isNotNull())


def _leaks(hits: DataFrame) -> DataFrame:
    """Hits (words, at, item_words, item_at, span) with a window around them
    that matches, and ``matched``: equal words over the whole item."""
    size, item = F.size("item_words"), F.col("item_words")
    shift = F.col("at") - F.col("item_at")
    window = F.least(size, F.lit(WINDOW))
    need = F.when(size >= WINDOW, WINDOW - SUBSTITUTIONS).when(size >= SHORT, size - 1).otherwise(size)
    equal = lambda k: F.get(item, k) == F.get(F.col("words"), k + F.col("shift"))
    first = F.greatest(F.lit(0), F.col("item_at") + F.col("span") - F.col("window"))
    last = F.least(F.col("item_at"), F.size("item_words") - F.col("window"))
    inside = lambda s: F.size(F.filter(F.sequence(s, s + F.col("window") - 1), equal))
    return (hits.withColumns({"shift": shift, "window": window, "need": need})
            .filter(F.exists(F.sequence(first, last), lambda s: inside(s) >= F.col("need")))
            .withColumn("matched", F.size(F.filter(F.sequence(F.lit(0), F.size("item_words") - 1), equal))))


def keys(text: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes that together name a text."""
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def leaks(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", max_words: int = MAX_WORDS) -> DataFrame:
    """A row per leaking document and item: id, key1, key2 (of its text), item,
    ``matched`` words at best and ``item_size``."""
    items = benchmark.select(F.col(item_col).alias("item"), word_array(text_of(item_text_col)).alias("item_words"))
    items = written(items.withColumn("item_row", F.monotonically_increasing_id()))
    held = items.agg(F.sum(F.size("item_words")), F.collect_set(F.least(F.size("item_words"), F.lit(WINDOW)))).first()
    total, masks = held[0] or 0, masks_for(set(held[1])) or masks_for({WINDOW})
    marks = seeds(items.select("item_row", "item_words"), "item_words", masks, items=True).select(
        F.col("hash").alias("item_hash"), "item_row", F.col("at").alias("item_at"))
    text = text_of(text_col)
    key1, key2 = keys(text)
    rows = docs.select(F.col(id_col).alias("id"), key1.alias("key1"), key2.alias("key2"), word_array(text).alias("words"))
    items = items.withColumnRenamed("item_row", "of")
    if total <= max_words:
        hits = (seeds(rows, "words", masks).join(F.broadcast(marks), F.col("hash") == F.col("item_hash"))
                .join(F.broadcast(items), F.col("item_row") == F.col("of")))
    else:
        rows = written(rows.withColumn("row", F.monotonically_increasing_id()))
        met = (seeds(rows.select("row", "words"), "words", masks).select("row", "at", "hash", "span")
               .join(marks, F.col("hash") == F.col("item_hash")))
        hits = (met.join(rows.withColumnRenamed("row", "in_row"), F.col("row") == F.col("in_row"))
                .join(items, F.col("item_row") == F.col("of")))
    return (_leaks(hits.select("id", "key1", "key2", "words", "at", "span", "item_row", "item", "item_words", "item_at"))
            .groupBy("id", "key1", "key2", "item_row")
            .agg(F.first("item").alias("item"), F.max("matched").alias("matched"),
                 F.first(F.size("item_words")).alias("item_size")).drop("item_row"))


def cleaned(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", **columns) -> DataFrame:
    """The documents that leak nothing, all their columns kept."""
    found = leaks(docs, benchmark, text_col=text_col, **columns).select("key1", "key2").distinct()
    k1, k2 = fresh(docs, "leak_key1"), fresh(docs, "leak_key2")
    key1, key2 = keys(text_of(text_col))
    return docs.join(found.toDF(k1, k2), (key1 == F.col(k1)) & (key2 == F.col(k2)), "left_anti")
