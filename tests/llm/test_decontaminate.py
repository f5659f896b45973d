import itertools
import random

from helpers import AWKWARD, clashing, documents, sentence, words_of
from tallycheck.llm import decontaminate
from tallycheck.llm.decontaminate import MASKS, SHORT, SHORT_MASK, SUBSTITUTIONS, WINDOW


def brute(rows, items):
    out = set()
    for i, text, _ in rows:
        d = words_of((text or "").lower())
        for k, item in items:
            w = words_of((item or "").lower())
            size = min(13, len(w))
            need = 11 if size == 13 else size - 1 if size >= 8 else size
            best = 0
            for shift in range(-len(w), len(d)):
                eq = [0 <= j + shift < len(d) and d[j + shift] == w[j] for j in range(len(w))]
                if w and any(sum(eq[a:a + size]) >= need for a in range(len(w) - size + 1)):
                    best = max(best, sum(eq))
            if best:
                out.add((i, k, best, len(w)))
    return sorted(out, key=repr)


def test_masks_catch_every_placing_of_substitutions():
    for wrong in itertools.combinations(range(WINDOW), SUBSTITUTIONS):
        assert any(not {p + s for p in m} & set(wrong) for m in MASKS for s in range(WINDOW - m[-1]))


def test_short_mask_catches_every_single_substitution():
    for size in range(SHORT, WINDOW):
        for wrong in range(size):
            assert any(wrong not in {p + s for p in SHORT_MASK} for s in range(size - SHORT_MASK[-1]))


def test_short_items(spark):
    items = [(1, "alpha beta gamma delta epsilon zeta eta theta"), (2, "one two three"), (3, "solo"), (4, "a b c d e"),
             (5, "k1 k2 k3 k4 k5 k6 k7 k8 k9 k10 k11 k12")]
    rows = [(1, "x ALPHA beta gamma CHANGED epsilon zeta eta theta", "s"), (2, "alpha beta gamma y epsilon y eta theta", "s"),
            (3, "so one two three four", "s"), (4, "one two\nfour three", "s"), (5, "Solo", "s"), (6, "soloist", "s"),
            (7, "a b c d e", "s"), (8, "a b c x e", "s"), (9, "k1 k2 k3 k4 k5 k6 k7 k8 k9 k10 k11 zz", "s"), (10, None, "s")]
    rows += [(100 + p, " ".join("w" if k == p else f"k{k + 1}" for k in range(12)), "s") for p in range(12)]
    want = brute(rows, items)
    assert {w[0] for w in want} == {1, 3, 5, 7, 9, *range(100, 112)}
    for most in (250_000, 0):
        got = decontaminate.leaks(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"), max_words=most)
        assert sorted(((r["id"], r["item"], r["matched"], r["item_size"]) for r in got.collect()), key=repr) == want


def corpus():
    r = random.Random(3)
    items = [(k, sentence(r, n)) for k, n in enumerate((15, 13, 12, 8, 7, 40, 25, 1))] + [(20, None), (21, ""), (22, "w1 " * 30)]
    rows = [x for x in AWKWARD if x[0] != 107] + [(107, "z" * 300_000, "s")]
    for i in range(120):
        w = sentence(r, r.randrange(0, 60)).split()
        item = (items[r.randrange(8)][1]).split()
        for _ in range(r.randrange(0, 5)):
            item[r.randrange(len(item))] = "other"
        a = r.randrange(0, max(1, len(item) - 10))
        item = item[a:a + r.randrange(8, 41)]
        at = r.randrange(0, len(w) + 1)
        rows.append((1000 + i, "\n".join(w[:at] + [x.upper() for x in item] + w[at:]), "s"))
    return rows + rows[12:14] + [(300, "w1 " * 40, "s")], items + [items[0]]


def test_equals_every_alignment(spark):
    rows, items = corpus()
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS item", "1 AS at")
    want = brute(rows, items)
    assert 20 < len(want) < 200
    for most in (250_000, 0):
        got = decontaminate.leaks(clashing(documents(spark, rows)), bench, max_words=most).collect()
        assert sorted({(r["id"], r["item"], r["matched"], r["item_size"]) for r in got}, key=repr) == want
    docs = clashing(documents(spark, rows))
    kept = decontaminate.cleaned(docs, bench)
    bad = {i for i, *_ in want}
    assert kept.columns == docs.columns
    assert sorted((r[0] for r in kept.select("doc_id").collect()), key=repr) == sorted((i for i, *_ in rows if i not in bad), key=repr)


def test_main_path_runs_no_python(spark):
    docs, bench = documents(spark, [(1, "a b", "s")]), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    plan = decontaminate.leaks(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_tables(spark):
    docs, bench = documents(spark, [(1, "a b", "s")]), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leaks(docs, bench).count() == 0 and decontaminate.cleaned(docs, bench).count() == 1
    assert decontaminate.leaks(documents(spark, []), bench).count() == 0
