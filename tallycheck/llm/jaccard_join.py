"""Near duplicates by an exact n-gram Jaccard join with several token orders.

A document is the set of its distinct ``k``-word shingles. Documents link when
their Jaccard similarity is ``percent`` per cent or more; the result gives each
document the smallest id its links reach.

1. Equal sets form one class; the rest works on one representative a class.
2. First order (by shingle hash): every set sends its prefix and a little more,
   so that linked sets share many of the shingles sent. Shingles found in one
   set only drop out.
3. Shingles of more than ``hot`` sets come last in that order: pairs are formed
   on the others, and a pair stays if it shares as many of them as two similar
   sets of these sizes must. Sets that consist mostly of hot shingles, of which
   that may be none, send all of theirs and are paired on the rarest.
   The place of the first shingle that two sets share tells how many they can
   share at most; what can't be that first shingle forms no pair.
4. Before that, sets that share their first shingle under each of several orders
   are verified against the most central of them. Those links merge classes
   into components, and pairs are then formed between components only, so a
   group of a thousand near copies costs some thousand pairs, not half a million.
5. A pair must also share prefix shingles under the other orders (other mixings
   of the hash); pairs that pass every filter are verified on the whole sets.

Every filter is lossless, so the links are exact (on 64-bit shingle hashes).

Defined results: null and wordless texts are empty sets, linked with nothing;
a document with fewer than ``k`` words is one shingle; a null id never names a
component that has another id; repeated rows and equal ids each get their row;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallycheck.llm.common import fresh, mixed, same, shingle_hashes, sliced, text_of, word_hashes, written
from tallycheck.llm.components import components


@dataclass(frozen=True)
class JaccardJoin:
    """``k`` words a shingle, ``percent`` least similarity. Sets of up to
    ``whole`` shingles send all of them; larger ones their prefix and ``spare``
    more. ``hot``: sets that may share a shingle before it is paired last.
    ``orders``: token orders that a pair must pass. ``held``: texts to verify
    whose keys every executor may hold (24 bytes each), and copies whose rows it may."""

    k: int = 5
    percent: int = 75
    whole: int = 128
    spare: int = 16
    hot: int = 16
    orders: int = 3
    firsts: int = 6
    together: int = 4
    held: int = 500_000


def shingles(text: str, k: int) -> np.ndarray:
    """Sorted distinct hashes of the text's ``k``-word shingles."""
    words = word_hashes(text.encode().lower())
    if not len(words):
        return words
    return np.unique(shingle_hashes(words, min(k, len(words))))


def prefix_size(n: int, percent: int) -> int:
    """Shingles of which linked sets share at least one, in any order."""
    return n + percent * n // -100 + 1


def sent_size(n: int, join: JaccardJoin) -> int:
    return n if n <= join.whole else min(n, prefix_size(n, join.percent) + join.spare)


def _prefix_size(n: Column, percent: int) -> Column:
    return n - F.ceil(n * percent / 100).cast("long") + 1


def _sent_size(n: Column, join: JaccardJoin) -> Column:
    return F.when(n <= join.whole, n).otherwise(F.least(n, _prefix_size(n, join.percent) + join.spare))


def _seeds(n: int) -> np.ndarray:
    """One constant for each further token order: its mixing of the hashes."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))


_ODD = np.uint64(0x9FB21C651E98DF25)


def first_shingles(tokens: np.ndarray, join: JaccardJoin) -> list[int]:
    """A key for each bundle of ``together`` orders: the set's first shingles there."""
    if not len(tokens):
        return []
    # shingle hashes are spread evenly: one more multiplication gives another order
    least = [((tokens ^ s) * _ODD).min() for s in _seeds(join.firsts * join.together)]
    bundles = np.array(least, np.uint64).reshape(join.firsts, join.together)
    return [xxhash.xxh64_intdigest(b.tobytes(), seed=i) for i, b in enumerate(bundles)]


def _sets(join: JaccardJoin):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            if part.num_rows:
                sizes, low, high, sent, ends, firsts = [], [], [], [], [0], []
                for text in part["text"].to_pylist():
                    found = shingles(text, join.k)
                    data = found.tobytes()
                    sizes.append(len(found))
                    low.append(xxhash.xxh64_intdigest(data))
                    high.append(xxhash.xxh3_64_intdigest(data))
                    sent.append(found[: sent_size(len(found), join)])
                    ends.append(ends[-1] + len(sent[-1]))
                    firsts.append(np.array(first_shingles(found, join), np.uint64).view(np.int64))
                tokens = np.concatenate(sent).view(np.int64) if sent else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part[c] for c in ("row", "id", "key1", "key2")]
                    + [pa.array(sizes, pa.int64()), pa.array(np.array(low, np.uint64).view(np.int64)),
                       pa.array(np.array(high, np.uint64).view(np.int64)),
                       pa.array(firsts, pa.list_(pa.int64())),
                       pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tokens))],
                    ["row", "id", "key1", "key2", "n", "set1", "set2", "firsts", "prefix"])

    return run


def keys(text: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes that together name a text."""
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def _linked(join: JaccardJoin):
    seeds = _seeds(join.orders - 1)

    def prefixes(tokens: np.ndarray) -> list[np.ndarray]:
        size = prefix_size(len(tokens), join.percent)
        return [np.sort(mixed(tokens ^ s))[:size] for s in seeds]

    def run(pairs: pa.Table, texts: pa.Table) -> pa.Table:
        sets = {}
        for row, text in zip(texts["row"].to_pylist(), texts["text"].to_pylist()):
            found = shingles(text, join.k)
            sets[row] = found, prefixes(found)
        keep = []
        for u, v in zip(pairs["u"].to_pylist(), pairs["v"].to_pylist()):
            (a, of_a), (b, of_b) = sets[u], sets[v]
            if not all(len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(of_a, of_b)):
                continue
            shared = len(np.intersect1d(a, b, assume_unique=True))
            if 100 * shared >= join.percent * (len(a) + len(b) - shared):
                keep.append((u, v))
        return pa.table({"u": pa.array([u for u, _ in keep], pa.int64()), "v": pa.array([v for _, v in keep], pa.int64())})

    return run


def _blocks(pairs: DataFrame, size: int = 64) -> DataFrame:
    """Pairs with a ``block``: those around one set stand together, so that a text
    is sent to few blocks. Many pairs around one set are dealt out by either
    end to as many blocks as hold some ``size`` * ``size`` each; few share one."""
    ends = pairs.union(pairs.select("v", "u")).groupBy(F.col("u").alias("end")).agg(F.min("v").alias("least"))
    around = pairs.join(ends, F.col("u") == F.col("end")).select("u", "v", F.least("u", "least").alias("at"))
    many = around.groupBy(F.col("at").alias("of")).agg(F.ceil(F.sqrt(F.count(F.lit(1))) / size).alias("cuts"))
    few = pairs.count() // (size * size) + 1
    part = lambda x: F.pmod(F.xxhash64(x), F.col("cuts"))
    block = F.when(F.col("cuts") > 1, F.xxhash64("at", part("u"), part("v"))).otherwise(
        F.pmod(F.xxhash64("at"), F.lit(few)))
    return around.join(many, F.col("at") == F.col("of")).select(block.alias("block"), "u", "v")


def _texts(rows: DataFrame, docs: DataFrame, reps: DataFrame, join: JaccardJoin) -> DataFrame:
    """(row, text) of representatives."""
    wanted = written(rows.join(reps.select(F.col("node").alias("row"), "key1", "key2"), "row"))
    if wanted.count() <= join.held:
        wanted = F.broadcast(wanted)
    key1, key2 = keys(F.col("text"))
    return (docs.select("text", key1.alias("t1"), key2.alias("t2"))
            .join(wanted, (F.col("t1") == F.col("key1")) & (F.col("t2") == F.col("key2")))
            .select("row", "text").dropDuplicates(["row"]))


def _unsent(join: JaccardJoin):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t, join.k) for t in batch["text"].to_pylist()]
            later = [f[sent_size(len(f), join):].view(np.int64) for f in found]
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(later, pa.list_(pa.int64()))], ["row", "tokens"])

    return run


def verified(pairs: DataFrame, docs: DataFrame, reps: DataFrame, join: JaccardJoin) -> DataFrame:
    """The pairs (u, v) whose whole sets are similar enough, written."""
    found = written(pairs)
    pairs = written(_blocks(found), (found,))
    sent = (pairs.select(F.col("block").alias("to"), F.col("u").alias("row"))
            .union(pairs.select("block", "v")).distinct())
    texts = _texts(sent.select("row").distinct(), docs, reps, join)
    return written(pairs.groupBy("block").cogroup(sent.join(texts, "row").groupBy("to"))
                   .applyInArrow(_linked(join), "u long, v long"), (pairs,))


def _least(percent: int) -> Column:
    """Shingles that two similar sets a and b share."""
    return F.ceil((F.col("a_n") + F.col("b_n")) * percent / (100 + percent)).cast("long")


def _need(join: JaccardJoin) -> Column:
    """Cold shingles that two similar sets a and b share among those they sent.
    A shared shingle that one of them didn't send lies beyond the end of the
    shorter reach, so those are at most the unsent ones of that set; the hot
    ones are at most what either sent."""
    unsent = F.greatest(F.col("a_n") - F.col("a_sent"), F.col("b_n") - F.col("b_sent"))
    return _least(join.percent) - unsent - F.least("a_hot", "b_hot")


def _fits(a: Column, b: Column, percent: int) -> Column:
    """Sets of these sizes can reach the similarity."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _between(left: DataFrame, right: DataFrame, percent: int) -> DataFrame:
    """Pairs of rows (token, row, n, sent, hot_n, part, pos) of one token, from
    different parts (components). In each token's group the largest part is met by
    the others, never by itself. The first shingle that two sets share, at ``pos`` in
    the order, leaves enough after it in both: rows that can't be that one don't meet."""
    parts = (right.groupBy("token", "part").agg(F.count(F.lit(1)).alias("c"))
             .groupBy(F.col("token").alias("of")).agg(F.max_by("part", F.struct("c", "part")).alias("major"),
                                                      F.count(F.lit(1)).alias("parts")).filter("parts > 1"))
    rows = lambda df, x: df.join(parts, F.col("token") == F.col("of")).select(
        F.col("token").alias(f"{x}_token"), F.col("row").alias(x), F.col("n").alias(f"{x}_n"),
        F.col("hot_n").alias(f"{x}_hot"), F.col("sent").alias(f"{x}_sent"), F.col("part").alias(f"{x}_part"),
        F.col("pos").alias(f"{x}_pos"), (F.col("part") == F.col("major")).alias(f"{x}_major"))
    found = rows(left, "a").join(rows(right, "b"), (F.col("a_token") == F.col("b_token"))
                                 & (F.col("a_part") != F.col("b_part")) & _fits(F.col("a_n"), F.col("b_n"), percent)
                                 & (F.col("a_n") - F.col("a_pos") >= _least(percent)) & (F.col("b_n") - F.col("b_pos") >= _least(percent))
                                 & ~F.col("a_major") & (F.col("b_major") | (F.col("a") < F.col("b"))))
    return found.select("a", "b", "a_n", "b_n", "a_hot", "b_hot", "a_sent", "b_sent")


def _candidates(rows: DataFrame, join: JaccardJoin) -> DataFrame:
    """Pairs (u, v) that the first order lets pass. ``rows``: token, row, plain (in
    the prefix proper), n, sent (shingles sent), df, hot_n (hot ones sent), part."""
    n, need = F.col("n"), _need(join)
    cold, hot = rows.filter(F.col("df") <= join.hot), rows.filter(F.col("df") > join.hot)
    cold = cold.withColumn("pos", F.lit(0))  # shared cold shingles are counted, so all of them meet
    common = (_between(cold, cold, join.percent)
              .select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"), need.alias("need"))
              .groupBy("u", "v", "need").agg(F.count(F.lit(1)).alias("shared"))
              .filter(F.col("shared") >= F.col("need")).select("u", "v"))
    # Pairs of which no cold shingle need be shared: each set sent too few cold
    # ones for a prefix. Where all its shingles are known, the rarest make it up.
    full, short = _rarest(rows, join), hot.filter(_is_short(join))
    part, plain = short.filter((F.col("sent") < n) & F.col("plain")), hot.filter("plain")
    on_hot = _between(full, full, join.percent).unionByName(_part_pairs(part, plain, join.percent)).filter(need <= 0)
    return common.union(on_hot.select(F.least("a", "b"), F.greatest("a", "b"))).distinct()


def _rarest(rows: DataFrame, join: JaccardJoin) -> DataFrame:
    """Of the sets short of cold shingles and known whole: the rarest hot shingles
    that fill up their prefixes, with their places ``pos`` in the order (the cold
    ones come before)."""
    n = F.col("n")
    at = F.row_number().over(W.partitionBy("row").orderBy("df", "token"))
    return (rows.filter((F.col("df") > join.hot) & _is_short(join) & (F.col("sent") == n))
            .withColumn("pos", n - F.col("hot_n") + at - 1).filter(F.col("pos") < _prefix_size(n, join.percent)))


def _is_short(join: JaccardJoin) -> Column:
    """The set sent too few cold shingles for a prefix."""
    return F.col("sent") - F.col("hot_n") < _prefix_size(F.col("n"), join.percent)


def _part_pairs(part: DataFrame, plain: DataFrame, percent: int) -> DataFrame:
    """Sets whose hot shingles aren't all known, against every set on its plain prefix."""
    side = lambda df, x: df.select(F.col("row").alias(x), *(
        F.col(c).alias(f"{x}_{y}") for c, y in (("token", "token"), ("n", "n"), ("hot_n", "hot"), ("sent", "sent"),
                                                ("part", "part"))))
    met = (F.col("a_token") == F.col("b_token")) & (F.col("a_part") != F.col("b_part"))
    return side(part, "a").join(side(plain, "b"), met & _fits(F.col("a_n"), F.col("b_n"), percent)).select(
        "a", "b", "a_n", "b_n", "a_hot", "b_hot", "a_sent", "b_sent")


def _untagged(sent: DataFrame) -> DataFrame:
    row = F.when(F.col("tagged") < 0, -1 - F.col("tagged")).otherwise(F.col("tagged"))
    return sent.withColumns({"row": row, "plain": F.col("tagged") >= 0}).drop("tagged")


def _of_many(sent: DataFrame, least: int) -> DataFrame:
    """The rows (token, tagged) whose token more than ``least`` sets sent, with
    ``df`` (how many). The count and the join share one shuffle: the greatest row goes
    along so that both need the same columns."""
    dealt = sent.repartition("token")
    counts = (dealt.groupBy(F.col("token").alias("of")).agg(F.count(F.lit(1)).alias("df"), F.max("tagged").alias("most"))
              .filter((F.col("df") > least) & F.col("most").isNotNull()).drop("most"))
    return dealt.join(counts, F.col("token") == F.col("of")).drop("of")


def _thin(sent: DataFrame, sizes: DataFrame, join: JaccardJoin) -> DataFrame:
    """The rows short of cold shingles among those they sent, if that weren't all."""
    hot = _untagged(_of_many(sent, join.hot)).groupBy("row").agg(F.count(F.lit(1)).alias("hot_n"))
    return (sizes.join(hot, "row").withColumn("sent", _sent_size(F.col("n"), join))
            .filter(_is_short(join) & (F.col("sent") < F.col("n"))).select("row"))


def _counted(sent: DataFrame, sizes: DataFrame, join: JaccardJoin) -> DataFrame:
    """The shingles that two sets or more sent, with ``df`` (how many did), ``hot_n``
    (hot shingles the row sent) and the row's ``n`` and ``sent`` of ``sizes``. One
    shuffle by shingle, one by row."""
    hot = F.count_if(F.col("df") > join.hot).over(W.partitionBy("row"))
    return _untagged(_of_many(sent, 1)).join(sizes, "row").withColumn("hot_n", hot)


def _stars(met: DataFrame, join: JaccardJoin) -> DataFrame:
    """Pairs (u, v) of each set with the most central one of its kind. ``met``:
    like (the kind), c (sets of the kind), row, n. The set that meets most others
    is nearest to all: an original, not one of its copies."""
    central = met.groupBy(F.col("row").alias("by")).agg(F.sum("c").alias("score"))
    ranked = met.join(central, F.col("row") == F.col("by")).select(
        "like", F.struct("score", (-F.col("row")).alias("order"), "n").alias("rank"))
    centers = ranked.groupBy(F.col("like").alias("of")).agg(F.max("rank").alias("center"))
    center = -F.col("center.order")
    return (met.join(centers, F.col("like") == F.col("of")).filter(F.col("row") != center)
            .filter(_fits(F.col("n"), F.col("center.n"), join.percent))
            .select(F.least("row", center).alias("u"), F.greatest("row", center).alias("v")).distinct())


def _merged(parts: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) after ``links`` (u, v) join the components of ``parts``."""
    at = lambda x: parts.toDF(f"{x}_node", f"{x}_part")
    ends = (links.join(at("u"), F.col("u") == F.col("u_node"), "left").join(at("v"), F.col("v") == F.col("v_node"), "left")
            .select(F.coalesce("u_part", "u").alias("u"), F.coalesce("v_part", "v").alias("v")))
    final = components(ends).toDF("part", "final")
    every = (parts.union(links.select("u", "u")).union(links.select("v", "v"))
             .groupBy("node").agg(F.min("component").alias("component")))  # a component is its least node
    return written(every.join(final, F.col("component") == F.col("part"), "left")
                   .select("node", F.coalesce("final", "component").alias("component")))


def groups(docs: DataFrame, join: JaccardJoin = JaccardJoin(), *, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """A row per document: row, id, key1 and key2 (of its text), n_shingles,
    component_id and part (the component's least row: ids may repeat or be null)."""
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    key1, key2 = keys(F.col("text"))
    kind = texts.schema["id"].dataType.simpleString()
    sets = written(texts.select(F.monotonically_increasing_id().alias("row"), "id", key1.alias("key1"),
                                key2.alias("key2"), "text").mapInArrow(
        _sets(join), f"row long, id {kind}, key1 long, key2 long, n long, set1 long, set2 long, "
                     "firsts array<long>, prefix array<long>"))
    heads = written(sets.drop("prefix", "firsts"))
    # the representative's text: any text of the class has the same set
    reps = written(heads.filter("n > 0").groupBy("set1", "set2", "n")
                   .agg(F.min("row").alias("node"), F.min("id").alias("first_id"))
                   .join(heads.select(F.col("row").alias("node"), "key1", "key2"), "node"))

    # of equal sets only the representative sends its shingles
    copies = written(heads.filter("n > 0").select("row").join(reps.select(F.col("node").alias("row")), "row", "left_anti"))
    if copies.count() <= join.held:
        copies = F.broadcast(copies)
    plain = F.col("pos") < _prefix_size(F.col("n"), join.percent)
    sent = sets.join(copies, "row", "left_anti").select("row", "n", F.posexplode("prefix").alias("pos", "token")).select(
        "token", F.when(plain, F.col("row")).otherwise(-1 - F.col("row")).alias("tagged"))
    sizes = reps.select(F.col("node").alias("row"), "n")
    # sets short of cold shingles send the rest of theirs as well
    thin = written(_thin(sent, sizes, join))
    later = written(_texts(thin, texts, reps, join).mapInArrow(_unsent(join), "row long, tokens array<long>")
                    .select(F.explode("tokens").alias("token"), (-1 - F.col("row")).alias("tagged")))
    whole = thin.select("row", F.col("row").alias("thin"))
    known = F.when(F.col("thin").isNull(), _sent_size(F.col("n"), join)).otherwise(F.col("n"))
    sizes = sizes.join(whole, "row", "left").withColumn("sent", known).drop("thin")
    rows = written(_counted(sent.union(later), sizes, join), (later,))

    sizes = reps.select(F.col("node").alias("row"), "n")
    alike = sets.select("row", F.explode("firsts").alias("like")).join(sizes, "row")
    often = alike.groupBy(F.col("like").alias("often")).agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    met = written(alike.join(often, F.col("like") == F.col("often")).drop("often"), (sets,))
    parts = written(components(verified(_stars(met, join), texts, reps, join)), (met,))
    # once more around each of the rarest hot shingles
    kinds = written(_rarest(rows, join).select(F.col("token").alias("like"), F.col("df").alias("c"), "row", "n"))
    parts = _merged(parts, verified(_stars(kinds, join), texts, reps, join))

    named = rows.join(parts, F.col("row") == F.col("node"), "left").withColumn(
        "part", F.coalesce("component", "row")).drop("node", "component")
    parts = _merged(parts, verified(_candidates(written(named, (rows,)), join), texts, reps, join))
    label = (reps.join(parts.toDF("in_node", "part"), F.col("node") == F.col("in_node"), "left")
             .withColumn("part", F.coalesce("part", "node")).select("set1", "set2", "part", "first_id"))
    least = label.groupBy(F.col("part").alias("whole")).agg(F.min("first_id").alias("component_id"))
    named = label.join(least, F.col("part") == F.col("whole")).select(
        F.col("set1").alias("c1"), F.col("set2").alias("c2"), "component_id", "part")
    return heads.join(named, (F.col("n") > 0) & (F.col("set1") == F.col("c1")) & (F.col("set2") == F.col("c2")), "left") \
        .select("row", "id", "key1", "key2", F.col("n").alias("n_shingles"),
                F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"), "part")


def distinct(docs: DataFrame, join: JaccardJoin = JaccardJoin(), *, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One document of each group, all its columns kept: the one with the
    smallest id (null last, then the first row). Empty sets are groups of one."""
    found = written(groups(docs, join, id_col=id_col, text_col=text_col))
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    first = (found.filter("n_shingles > 0").groupBy("part").agg(F.min(order).alias("first"))
             .select(F.col("first.row").alias("row"), F.lit(True).alias("chosen")))
    kept = written(found.join(first, "row", "left").groupBy("id", "key1", "key2")
                   .agg(F.max(F.coalesce("chosen", F.col("n_shingles") == 0)).alias("chosen"),
                        ((F.count(F.lit(1)) > 1) & (F.max("n_shingles") > 0)).alias("twins"))
                   .filter("chosen").drop("chosen"))
    names = [fresh(docs, x) for x in ("kept_id", "kept1", "kept2", "kept_twins")]
    key1, key2 = keys(text_of(text_col))
    match = docs.join(kept.toDF(*names), same(F.col(id_col), F.col(names[0])) & (key1 == F.col(names[1]))
                      & (key2 == F.col(names[2])))
    if kept.filter("twins").isEmpty():
        return match.drop(*names)
    # rows that repeat id and text are one document
    twins = match.filter(F.col(names[3])).dropDuplicates(names[:3])
    return match.filter(~F.col(names[3])).unionByName(twins).drop(*names)
