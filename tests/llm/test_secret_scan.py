import collections
import hashlib
import math
import random
import re

from helpers import AWKWARD, clashing, documents, sentence
from tallycheck.llm import secret_scan
from tallycheck.llm.secret_scan import Ownership


def base(text):
    found = []
    word = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    for m in re.finditer(rf"""({word})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, f"assign:{m.start()}:{m.end()}", m[2]))
    for k, (kind, pattern, least) in enumerate((("access", "AKIA[A-Z0-9]+", 16), ("hex", "[0-9a-f]+", 32)), 1):
        for m in re.finditer(pattern, text):
            if len(m[0]) >= least:
                found.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}", m[0]))
    return sorted(found)


def vendor(text):
    """Tokens of known shapes, not inside a word."""
    word, found = "A-Za-z0-9_", []
    for shape in (r"gh[pousr]_[A-Za-z0-9]{36,}", rf"glpat-[{word}-]{{20,}}", r"xox[abprs]-[A-Za-z0-9-]{10,}", rf"sk-[{word}-]{{20,}}",
                  rf"AIza[{word}-]{{35}}", rf"eyJ[{word}-]+\.[{word}-]+\.[{word}-]+"):
        found += [(m.start(), m.end(), m[0]) for m in re.finditer(rf"(?<!\w){shape}", text)]
    return found


def random_looking(value):
    counts = collections.Counter(value).values()
    return len(value) >= 16 and sum(-c * math.log2(c / len(value)) for c in counts) >= 3 * len(value)


def corpus():
    r = random.Random(2)
    key = lambda n, letters="0123456789abcdef": "".join(r.choice(letters) for _ in range(n))
    live, copied, short = key(40), key(40), key(32)
    rows = [x for x in AWKWARD if x[0] != 107] + [(107, "deadbeef" * 30_000 + " token = 'x'", "s")]
    for k in range(40):
        w = sentence(r, 20).split()
        w.insert(r.randrange(len(w)), r.choice(["PassWord='%s'" % live, "api_key: %s" % copied, "apikey=%s" % key(7),
                                                "AKIA" + key(12, "ABCZ09"), "AKIAAKIA" + key(3, "AB"), key(33), short + "\n" + short,
                                                "secret=test-%s-xxxx" % key(20), "token=%s" % live[:20] if k < 20 else "",
                                                "ghp_" + key(36, "abcXYZ019"), "ſecret=%s" % key(9), "toKen=%s" % key(9), "token==========="]))
        if k % 4 == 0:
            w.append("é secret: " + copied)
        rows.append((1000 + k, " ".join(w), f"o{k % 5}" if k % 7 else None))
    rows += [(2000, "password=" + live, "o1"), (2001, "password=" + live, "o1"), rows[20], rows[20]]
    often, seldom = key(24), key(24)
    rows += [(3000 + k, f"n{k % 6} secret={often}", "o1") for k in range(8)] + [(3100 + k, f"n{k % 5} secret={seldom}", "o1") for k in range(8)]
    return rows


def test_base_spans_and_owners_equal_brute_force(spark):
    rows = corpus()
    got = secret_scan.listed(secret_scan.scan(clashing(documents(spark, rows)), Ownership(max_owners=2, max_repositories=5))).collect()
    assert len(got) == len(rows)
    owners, repositories = collections.defaultdict(set), collections.defaultdict(set)
    for _, text, owner in rows:
        text = text or ""
        for value in [x[-1] for x in base(text)] + [x[-1] for x in vendor(text)]:
            owners[value].add(owner)
            repositories[value].add((owner, text))
    want = []
    for i, text, _ in rows:
        text = text or ""
        b = base(text)
        live = set()
        for start, _, listed, value in b:
            at = text.index(value, start)
            live.add((at, at + len(value), value))
        live |= set(vendor(text))
        live = [(s, 3, f"live:{s}:{e}") for s, e, v in live if len(owners[v]) <= 2 and len(repositories[v]) <= 5 and random_looking(v)]
        spans = ",".join(x[2] for x in sorted([x[:3] for x in b] + live))
        counts = [sum(x[1] == k for x in b) for k in range(3)]
        want.append((i, *counts, hashlib.sha256(",".join(x[2] for x in b).encode()).hexdigest(), spans))
    cols = ("id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
    assert sorted((tuple(r[c] for c in cols) for r in got), key=repr) == sorted(want, key=repr)
    assert any("live" in w[-1] for w in want) and any(r["copied"] for r in got)


def test_value_in_many_texts_of_one_owner_is_copied(spark):
    example, live = "q7Zk2Lw9Xv4Rt8Yb1Nc6", "m3Hd8Js5Pf0Gu2Ea7Ko9"
    most = Ownership().max_repositories
    rows = [(k, f"note {k} secret={example}", "hot") for k in range(most + 1)]
    rows += [(100 + k, f"note {k} secret={live}", "hot") for k in range(most)]
    rows += [(200 + k, f"note 0 secret={live}", "hot") for k in range(3)]  # exact copies are one repository
    got = {r["id"]: r for r in secret_scan.scan(documents(spark, rows)).collect()}
    assert all(bool(r["live"]) == (i >= 100) and bool(r["copied"]) == (i < 100) for i, r in got.items())
    assert len(got) == len(rows)


def test_empty_table(spark):
    assert secret_scan.scan(documents(spark, [])).count() == 0
