import random
from collections import Counter

from helpers import AWKWARD, clashing, documents, lower, sentence, words_of
from tallycheck.llm import quality
from tallycheck.llm.quality import QualityRules

RULES = QualityRules(line_docs=3, line_pct=20)


def brute(rows, rules):
    texts, lines = {}, {}
    norm = lambda x: lower(" ".join(words_of(x)))
    for _, text, host in rows:
        text = text or ""
        texts.setdefault(host, set()).add(text)
        for line in {norm(x) for x in text.split("\n")} - {""}:
            lines.setdefault((host, line), set()).add(text)
    bad = {k for k, v in lines.items() if len(v) >= rules.line_docs and 100 * len(v) > rules.line_pct * len(texts[k[0]])
           or len(v) >= rules.long_docs and len(k[1].split(" ")) >= rules.long_words}
    out = []
    for i, text, host in rows:
        text = text or ""
        w = words_of(text)
        grams = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
        covered = {p for k in range(len(w) - 7) if grams[tuple(w[k:k + 8])] > 1 for p in range(k, k + 8)}
        full = [x for x in text.split("\n") if words_of(x)]
        removed = sum(len(words_of(x)) for x in full if (host, norm(x)) in bad)
        failed = len(w) < rules.min_words or 100 * len(covered) > rules.repeat_pct * len(w)
        kept = not failed and 100 * (len(w) - removed) >= rules.keep_pct * len(w)
        out.append((i, len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(full) - len(set(full)),
                    len(covered), removed, failed, kept))
    return sorted(out, key=repr)


def corpus():
    r = random.Random(1)
    rows = list(AWKWARD)
    for i in range(60):
        lines = [sentence(r, r.randrange(1, 40)) for _ in range(r.randrange(1, 5))]
        if i % 2:
            lines.insert(0, "Buy   NOW at our #1 shop " + " ".join(f"h{k}" for k in range(25 if i % 6 == 1 else 2)))
        if i % 7 == 0:
            lines += lines[:1] * 4
        rows.append((i, "\n".join(lines), ("a", "b", None)[i % 3]))
    hot = "Buy   NOW at our #1 shop " + " ".join(f"h{k}" for k in range(25))
    return rows + rows[11:14] + [(500 + k, f"{hot}\nonly {k} more", "b") for k in range(3)]


def test_judge_equals_brute_force(spark):
    rows = corpus()
    got = quality.judge(clashing(documents(spark, rows)), RULES)
    cols = ("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "removed_words", "base_failed", "kept")
    assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=repr) == brute(rows, RULES)
    assert any(b[6] for b in brute(rows, RULES)) and any(not b[7] and not b[8] for b in brute(rows, RULES))


def test_long_lines_have_a_limit_of_their_own(spark):
    r = random.Random(6)
    rules = QualityRules(line_docs=4, line_pct=50, long_words=5, long_docs=6)
    long, short = "all rights reserved by us", "read more here now"
    rows = [(k, "\n".join([sentence(r, 60), *([long] if k < 6 else []), *([short] if k < 9 else [])]), "hot") for k in range(40)]
    rows += [(100 + k, f"{sentence(r, 60)}\n{long}", "other") for k in range(5)]
    got = quality.judge(documents(spark, rows), rules).collect()
    cols = ("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "removed_words", "base_failed", "kept")
    assert sorted((tuple(r[c] for c in cols) for r in got), key=repr) == brute(rows, rules)
    assert {r["id"]: r["removed_words"] for r in got if r["removed_words"]} == {**dict.fromkeys(range(6), 5), **dict.fromkeys(range(100, 105), 5)}


def test_filtered_keeps_rows_and_columns_and_cuts_lines(spark):
    rows = corpus()
    docs = clashing(documents(spark, rows))
    got = quality.filtered(docs, RULES)
    assert got.columns == docs.columns and [f.dataType for f in got.schema] == [f.dataType for f in docs.schema]
    kept = [b[0] for b in brute(rows, RULES) if b[-1]]
    found = got.collect()
    assert sorted((r["doc_id"] for r in found), key=repr) == sorted(kept, key=repr)
    assert not any("Buy   NOW" in r["text"] and r["source"] == "b" for r in found)
    assert all(r["n_chars"] == len(r["text"]) for r in found)


def test_copies_do_not_make_boilerplate(spark):
    text = sentence(random.Random(2), 60)
    got = quality.judge(documents(spark, [(i, text, "s") for i in range(50)])).collect()
    assert len(got) == 50 and all(r["kept"] for r in got)


def test_empty_table(spark):
    assert quality.judge(documents(spark, [])).count() == 0
    assert quality.filtered(documents(spark, [])).count() == 0
