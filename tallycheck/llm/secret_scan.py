"""Secret scan with corpus-wide ownership frequency.

Three base patterns find candidates in every text, and vendor token shapes add
further ones. Candidate values are hashed and counted over the corpus: distinct
repositories (texts) and distinct owners that hold each value. A value that many
owners share, or that stands in many repositories, is a copied example; one that
stays with few of both and looks random is a live credential, and its span is
added with the kind ``live``.

Defined results: a null text counts as empty; a null owner is an owner of its
own; exact copies of a text are one repository of each owner; repeated rows and
equal ids each get their row; an empty table gives an empty result; other
columns are ignored. Offsets are code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycheck.llm.common import same, sliced, text_of, written

KINDS = ("assign", "access", "hex", "live")
#: The patterns of the contract, and shapes of vendors' tokens.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
VENDOR = re.compile(r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|glpat-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}"
                    r"|sk-[A-Za-z0-9_-]{20,}|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)")
_ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")
_VENDOR_MARKS = ("gh", "glpat-", "xox", "sk-", "AIza", "eyJ")

SPAN = "struct<kind:string,start:int,stop:int,value:binary,from:int,to:int,random:boolean>"


@dataclass(frozen=True)
class Ownership:
    """A value held by at most ``max_owners`` owners, in at most
    ``max_repositories`` distinct texts, is owner-specific; it looks live with ``min_chars`` characters or more and ``min_bits`` bits of entropy
    a character."""

    max_owners: int = 2
    max_repositories: int = 16
    min_chars: int = 16
    min_bits: float = 3.0


def bits_a_char(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def base_spans(text: str) -> list[tuple[str, int, int, int, int]]:
    """(kind, start, end, value's start, value's end) of the base patterns."""
    found = []
    lowered = text.lower()
    if any(w in lowered for w in _ASSIGN_WORDS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 8:
                found.append(("assign", *m.span(), *m.span(2)))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= 16:
                found.append(("access", *m.span(), *m.span()))
    for m in HEX.finditer(text):
        found.append(("hex", *m.span(), *m.span()))
    found.sort(key=lambda x: (x[1], KINDS.index(x[0])))
    return found


def _scan(rule: Ownership):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            out: dict[str, list] = {k: [] for k in ("digest", "n_assign", "n_access", "n_hex", "base_sha256", "spans")}
            for text in batch["text"].to_pylist():
                base = base_spans(text)
                extra = []
                if any(w in text for w in _VENDOR_MARKS):
                    extra = [("vendor", *m.span(), *m.span()) for m in VENDOR.finditer(text)]
                listed = ",".join(f"{k}:{s}:{e}" for k, s, e, *_ in base)
                kinds = Counter(k for k, *_ in base)
                out["digest"].append(hashlib.md5(text.encode()).digest())
                for k in KINDS[:3]:
                    out[f"n_{k}"].append(kinds[k])
                out["base_sha256"].append(hashlib.sha256(listed.encode()).hexdigest())
                spans = []
                for k, s, e, a, b in base + extra:
                    value = text[a:b]
                    spans.append({
                        "kind": k, "start": s, "stop": e, "value": xxhash.xxh3_128_digest(value.encode()),
                        "from": a, "to": b,
                        "random": len(value) >= rule.min_chars and bits_a_char(value) >= rule.min_bits})
                out["spans"].append(spans)
            span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("value", pa.binary()),
                              ("from", pa.int32()), ("to", pa.int32()), ("random", pa.bool_())])
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["owner"], pa.array(out["digest"], pa.binary()),
                 *(pa.array(out[f"n_{k}"], pa.int64()) for k in KINDS[:3]),
                 pa.array(out["base_sha256"], pa.string()), pa.array(out["spans"], pa.list_(span))],
                ["id", "owner", *out])

    return run


def ownership(candidates: DataFrame) -> DataFrame:
    """value, repositories and owners: distinct counts, each level combined
    before its shuffle. ``candidates``: value, owner, digest."""
    return (candidates.groupBy("value", "owner", "digest").agg(F.lit(1).alias("one"))
            .groupBy("value", "owner").agg(F.count("one").alias("texts"))
            .groupBy("value").agg(F.sum("texts").alias("repositories"), F.count(F.lit(1)).alias("owners")))


def scan(docs: DataFrame, rule: Ownership = Ownership(), *, id_col: str = "doc_id", text_col: str = "text",
         owner_col: str = "source") -> DataFrame:
    """A row per document: id, owner, digest, the base counts, ``base_sha256``,
    ``found`` (base spans in order: kind, start, stop), ``live`` (spans added)
    and ``copied`` (base or vendor spans whose value many owners share or many
    texts hold)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(owner_col).cast("string").alias("owner"),
                       text_of(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    table = written(rows.mapInArrow(
        _scan(rule), f"id {kind}, owner string, digest binary, n_assign long, n_access long, n_hex long, "
                     f"base_sha256 string, spans array<{SPAN}>"))
    held = table.filter(F.size("spans") > 0)
    counts = ownership(held.select(F.explode("spans.value").alias("value"), "owner", "digest"))
    each = (held.select("digest", "spans").dropDuplicates(["digest"])
            .select("digest", F.inline("spans"))
            .join(counts.withColumnRenamed("value", "held_value"), F.col("value") == F.col("held_value")))
    place = F.struct(F.col("from").alias("start"), F.col("to").alias("stop"))
    few = (F.col("owners") <= rule.max_owners) & (F.col("repositories") <= rule.max_repositories)
    judged = each.groupBy(F.col("digest").alias("of")).agg(
        F.sort_array(F.collect_set(F.when(few & F.col("random"), place))).alias("live"),
        F.sort_array(F.collect_set(F.when(~few, place))).alias("copied"))
    empty = F.array().cast("array<struct<start:int,stop:int>>")
    base = F.transform(F.filter("spans", lambda s: s["kind"] != "vendor"),
                       lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))
    return table.join(judged, same(F.col("digest"), F.col("of")), "left").select(
        "id", "owner", "digest", "n_assign", "n_access", "n_hex", "base_sha256", base.alias("found"),
        F.coalesce("live", empty).alias("live"), F.coalesce("copied", empty).alias("copied"))


def listed(scanned: DataFrame) -> DataFrame:
    """Adds ``spans``: all spans by start, then kind as in ``KINDS``."""
    order = F.create_map(*(x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))))
    live = F.transform("live", lambda s: F.struct(F.lit("live").alias("kind"), s["start"].alias("start"),
                                                  s["stop"].alias("stop")))
    ranked = F.sort_array(F.transform(F.concat("found", live), lambda s: F.struct(
        s["start"].alias("start"), order[s["kind"]].alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    text = F.transform(ranked, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")))
    return scanned.withColumn("spans", F.array_join(text, ","))
