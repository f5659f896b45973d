import random

import pytest

from helpers import AWKWARD, clashing, documents, lower, sentence, words_of
from tallycheck.llm import jaccard_join
from tallycheck.llm.components import components
from tallycheck.llm.jaccard_join import JaccardJoin


def linked(rows):
    """Each row's set, and a function that gives the root of a row's component."""
    sets = []
    for i, text, _ in rows:
        w = words_of(lower(text or ""))
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    head = list(range(len(rows)))

    def root(x):
        while head[x] != x:
            x = head[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                head[root(a)] = root(b)
    return sets, root


def brute(rows):
    sets, root = linked(rows)
    least = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted(((rows[k][0], len(sets[k]), least.get(root(k)) if sets[k] else rows[k][0]) for k in range(len(rows))), key=repr)


def corpus(seed, common=0.0):
    r = random.Random(seed)
    rows = list(AWKWARD)
    shared = [sentence(r, 60) for _ in range(2)]
    i = 1000
    for _ in range(30):
        w = sentence(r, r.choice((3, 6, 12, 40, 200, 420))).split()
        if r.random() < common:
            w += r.choice(shared).split()
        for _ in range(r.choice((1, 1, 2, 5, 12))):
            c = list(w)
            for _ in range(r.randrange(0, 1 + len(c) // 25)):
                c[r.randrange(len(c))] = f"w{r.randrange(5000)}"
            rows.append((i, " ".join(c) if r.random() < 0.8 else "  ".join(c).upper(), "s"))
            i += 1
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("rules", [JaccardJoin(), JaccardJoin(whole=16, spare=2, hot=3), JaccardJoin(whole=0, spare=0, hot=1, orders=1)])
def test_equals_all_pairs(spark, rules):
    rows = corpus(rules.hot, 0.6)
    got = jaccard_join.groups(clashing(documents(spark, rows)), rules)
    assert sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in got.collect()), key=repr) == brute(rows)


def test_distinct_keeps_one_row_of_each_group(spark):
    rows = corpus(9)
    rows += rows[:4]
    docs = clashing(documents(spark, rows))
    got = jaccard_join.distinct(docs)
    assert got.columns == docs.columns
    sets, root = linked(rows)
    roots = {root(k) for k, s in enumerate(sets) if s}
    empty = {(i, t) for i, t, _ in rows if not words_of(t)}  # rows that repeat id and text are one document
    assert got.count() == len(roots) + len(empty)
    groups = {c for i, n, c in brute(rows) if n}
    found = [r["doc_id"] for r in got.collect()]
    assert {x for x in groups if x is not None} <= set(found)


def test_common_passages_form_no_pairs_of_unlike_sets(spark):
    """Half the documents hold the same passage, and most of it makes up each of them."""
    r = random.Random(12)
    passage = sentence(r, 80)
    rows = [(k, sentence(r, 8) + " " + passage + " " + sentence(r, 14), "s") for k in range(60)]
    rows += [(100 + k, rows[k][1].replace(" ", "  ") + " and one more", "s") for k in range(0, 60, 7)]
    rows += [(200 + k, sentence(r, 90), "s") for k in range(40)]
    got = jaccard_join.groups(documents(spark, rows), JaccardJoin(hot=4))
    assert sorted(((x["id"], x["n_shingles"], x["component_id"]) for x in got.collect()), key=repr) == brute(rows)


def test_shuffled_texts_give_the_same_links(spark):
    rows = corpus(21, 0.5)
    got = jaccard_join.groups(documents(spark, rows), JaccardJoin(hot=3, held=0))  # nothing small enough to broadcast
    assert sorted(((x["id"], x["n_shingles"], x["component_id"]) for x in got.collect()), key=repr) == brute(rows)


def test_distinct_keeps_unlinked_texts_of_null_and_equal_ids(spark):
    r = random.Random(4)
    texts = [sentence(r, 60) for _ in range(8)]
    rows = [(None, t, "s") for t in texts[:5]] + [(None, texts[0], "t"), (7, texts[5], "s"), (7, texts[6], "s"),
                                                  (8, texts[6], "s"), (9, texts[7], "s"), (None, texts[7], "s")]
    got = jaccard_join.distinct(documents(spark, rows)).collect()
    assert sorted(((x["doc_id"], x["text"]) for x in got), key=repr) == sorted(
        [(None, t) for t in texts[:5]] + [(7, texts[5]), (7, texts[6]), (9, texts[7])], key=repr)


def test_components_of_chains_and_hubs(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (300, 250)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {**{k: 0 for k in range(41)}, **{100 + k: 100 for k in range(30)}, 300: 250, 250: 250}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_empty_table(spark):
    assert jaccard_join.groups(documents(spark, [])).count() == 0
    assert jaccard_join.distinct(documents(spark, [])).count() == 0
