import random

from helpers import AWKWARD, clashing, documents, lower, sentence, words_of
from tallycheck.llm import line_dedup


def brute(rows, least):
    """Lines inside any run of ``least`` words or more that occurs earlier; tries every run."""
    docs = sorted({(i is None, i, t or "") for i, t, _ in rows}, key=lambda x: (x[0], x[1] or 0, __import__("hashlib").md5(x[2].encode()).digest()))
    seen, out = {}, {}
    for order, (_, i, text) in enumerate(docs):
        lines = [(k, lower(" ".join(words_of(x))), len(words_of(x))) for k, x in enumerate(text.split("\n")) if words_of(x)]
        for a in range(len(lines)):
            total = 0
            for b in range(a, len(lines)):
                total += lines[b][2]
                if total >= least:
                    seen.setdefault(tuple(x[1] for x in lines[a:b + 1]), []).append((order, a))
    for order, (_, i, text) in enumerate(docs):
        lines = [(k, lower(" ".join(words_of(x))), len(words_of(x))) for k, x in enumerate(text.split("\n")) if words_of(x)]
        gone = set()
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                key = tuple(x[1] for x in lines[a:b + 1])
                if key in seen and min(seen[key]) < (order, a):
                    gone.update(range(lines[a][0], lines[b][0] + 1))
        kept = [x for k, x in enumerate(text.split("\n")) if k not in gone]
        out[(i, text)] = ("\n".join(kept), len(gone), bool(gone) and not any(map(words_of, kept)))
    return out


def corpus():
    r = random.Random(5)
    passage = [sentence(r, n) for n in (12, 3, 20, 18, 9, 30)]
    rows = list(AWKWARD[:-1]) + [(107, "z" * 300_000, "s")]
    for i in range(40):
        lines = [sentence(r, r.randrange(1, 30)) for _ in range(r.randrange(0, 6))]
        a = r.randrange(0, 5)
        cut = passage[a:a + r.randrange(1, 6)]
        if i % 3 == 0:
            cut = [x.upper().replace(" ", "  ") if k % 2 else x for k, x in enumerate(cut)]
        if i % 5 == 0 and cut:
            cut.insert(1, "  ")
        at = r.randrange(0, len(lines) + 1)
        rows.append((i, "\n".join(lines[:at] + cut + lines[at:]), "s"))
    rows += [(200, rows[-1][1], "t"), rows[20], (201, "\n".join(passage * 2), "s"), (202, passage[5] * 3, "s"), (203, passage[5] * 3, "s")]
    return rows


def test_equals_every_run_tried(spark):
    rows = corpus()
    want = brute(rows, 50)
    docs = clashing(documents(spark, rows))
    got = line_dedup.deduplicated(docs, extra=True).collect()
    assert len(got) == len(rows)
    texts = {(i, t or "") for i, t, _ in rows}
    by_id = {}
    for (i, text), v in want.items():
        by_id.setdefault(i, []).append(v)
    for r in got:
        assert ((r["text"] or ""), r["removed_lines"], r["emptied"]) in by_id[r["doc_id"]]
    assert sum(r["removed_lines"] for r in got) > 30 and any(r["emptied"] for r in got)
    kept = line_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r["emptied"] for r in got)
    assert {r[0] for r in kept.filter("doc_id in (100, 101, 102)").select("doc_id").collect()} == {100, 101, 102}


def test_windows_of_equal_runs_pick_the_same_line():
    lines = [(bytes([k]) * 16, n, k) for k, n in enumerate((10, 30, 15, 60, 5))]
    found, picked = line_dedup.windows(lines, 50)
    assert [(f[2], f[3]) for f in found] == [(0, 2), (1, 3), (2, 3), (3, 3), (3, 4)]
    assert picked == {0, 1, 2, 3}


def test_empty_table(spark):
    assert line_dedup.deduplicated(documents(spark, [])).count() == 0
