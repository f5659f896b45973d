import math
import random
import re
from collections import Counter

import numpy as np

from helpers import AWKWARD, clashing, documents, lower, sentence
from tallycheck.llm.lexical import Postings, Search, search

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, items, most=20):
    terms = [TERM.findall(lower(t or "")) for _, t, _ in docs]
    n_docs, total = sum(map(bool, terms)), sum(map(len, terms))
    df = Counter(w for t in terms for w in set(t))
    out = []
    for item, text, _ in items:
        asked, scored = Counter(TERM.findall(lower(text or ""))), []
        for (i, _, _), t in zip(docs, terms):
            tf, m = Counter(t), 75 + 25 * len(t) * n_docs // total if total else 0
            score = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * tf[w] // (1000 * tf[w] + 12 * m))
                        for w, k in asked.items() if tf[w])
            if score > 0:
                scored.append((score, i))
        scored.sort(key=lambda x: (-x[0], x[1] is not None, x[1]))
        out += [(item, rank, i, s) for rank, (s, i) in enumerate(scored[:most], 1)]
    return out


def check(spark, docs, items, **rules):
    queries = clashing(documents(spark, items)).withColumnRenamed("doc_id", "item_id")
    found = search(clashing(documents(spark, docs)), queries, Search(**rules)).collect()
    want = brute(docs, items, rules.get("most", 20))
    assert sorted(((x["query_id"], x["rank"], x["id"], x["score"]) for x in found), key=repr) == sorted(want, key=repr)


def corpus(n, vocabulary, seed):
    r = random.Random(seed)
    return [(k, sentence(r, r.randrange(1, 60), vocabulary), "s") for k in r.sample(range(10 * n), n)]


ITEMS = [(1, "W1 w2, w3 w3 w77!", "s"), (2, None, "s"), (3, "", "s"), (4, " ,. ", "s"), (5, "nowhere", "s"),
         (6, "the w5 the the W9 W1", "s"), (7, "é　ß 🙂 one", "s"), (8, "w1 " * 50 + "long", "s")]


def test_best_documents_of_all(spark):
    docs = corpus(400, 120, 3) + list(AWKWARD[:-1])
    check(spark, docs, ITEMS)
    check(spark, docs, ITEMS, shard_terms=700, block=2, most=5)  # many shards, several blocks of queries


def test_ties_and_a_term_in_a_third_of_the_documents(spark):
    docs = [(k, "same text here", "s") for k in range(90)] + [(1000 + k, f"the w{k % 9} the", "s") for k in range(90)]
    docs += [(2000 + k, sentence(random.Random(k), 20, 300), "s") for k in range(90)]
    check(spark, docs, [(1, "same", "s"), (2, "the w3", "s"), (3, "same the w1 w2", "s")], shard_terms=200)


def test_very_long_text(spark):
    r = random.Random(8)
    check(spark, corpus(50, 80, 1) + [(9999, sentence(r, 60_000, 4000), "s"), (9998, "z" * 200_000, "s")], ITEMS)


def test_empty_tables(spark):
    check(spark, [], ITEMS)
    check(spark, corpus(20, 30, 1), [])
    check(spark, [(1, None, "s"), (2, " . ", "s")], ITEMS)


def test_range_maxima_and_best_first():
    r = np.random.default_rng(3)
    for n in (1, 2, 7, 64, 300):
        lists, docs = np.nonzero(r.random((9, n)) < 0.4)
        if not len(lists):
            continue
        lists = np.unique(lists, return_inverse=True)[1]
        impacts = r.integers(1, 40, len(lists))
        held = Postings(lists, docs, impacts, n)
        for _ in range(60):
            a = int(r.integers(0, len(lists)))
            b = int(held.starts[np.searchsorted(held.starts, a, side="right")])
            end = int(r.integers(a + 1, b + 1))
            at = held.greatest(np.array([a]), np.array([end]))[0]
            assert a <= at < end and held.impacts[at] == held.impacts[a:end].max()
        own = np.unique(r.integers(0, lists.max() + 1, 4))
        times = r.integers(1, 4, len(own))
        score = np.zeros(n, np.int64)
        for k, t in zip(own, times):
            score[docs[lists == k]] += t * impacts[lists == k]
        want = sorted(((int(s), d) for d, s in enumerate(score) if s), key=lambda x: (-x[0], x[1]))[:20]
        for together in (1, 64):
            assert held.best(own, times, 20, together) == want
