"""Small documents with the awkward cases every operator must take."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

WORDS = re.compile("[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHES = ("id", "row", "n", "words", "hash", "digest", "host", "key1", "node", "shard", "value", "page", "token")


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text or "")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sentence(r: random.Random, n: int, vocabulary: int = 5000) -> str:
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def documents(spark, rows):
    """``rows``: (doc_id, text, source)."""
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], DOCS)


def clashing(df):
    """``df`` with extra columns named like the operators' own."""
    return df.withColumns({c: F.lit("x") for c in CLASHES if c not in df.columns})


AWKWARD = [(None, "null id with a few words in it", "s"), (100, None, "s"), (101, "", "s"), (102, " \t\n\v\f\r ", None),
           (103, "one", None), (104, "same row", "s"), (104, "same row", "s"), (104, "same id, other text", "t"),
           (105, "\n".join(["a line", "", "a line"] * 3), "s"), (106, "é　ß 🙂 \x1c x", "s"),
           (107, "z" * 300_000 + " " + "long " * 60_000, "s")]
