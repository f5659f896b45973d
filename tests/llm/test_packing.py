import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from helpers import AWKWARD, clashing, documents, sentence
from tallycheck.llm import packing
from tallycheck.llm.packing import InvertedIndex, Packing

BYTE = public_tokenizers.path("byte_bpe_50k.json")


def test_pieces_hold_each_id_once(spark):
    r = random.Random(8)
    rows = list(AWKWARD) + [(1000 + k, sentence(r, r.randrange(0, 900)), "s") for k in range(150)] + [(1000, "again", "s")]
    rules = Packing(shard_chars=100_000)
    got = packing.pack(clashing(documents(spark, rows)), BYTE, rules, with_ids=True).collect()
    plain = Tokenizer.from_file(BYTE)
    want = sorted(([*x.ids, 1] for x in plain.encode_batch([t or "" for _, t, _ in rows], add_special_tokens=False)))
    whole, open_docs = [], {}
    for p in sorted(got, key=lambda p: (repr(p["id"]), p["sequence_id"], p["offset"])):
        assert p["length"] == len(p["ids"]) and p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes())
        open_docs.setdefault((p["id"], p["doc_tokens"]), []).append(p)
    for (key, size), pieces in open_docs.items():
        at = 0
        ids = []
        for p in pieces:
            assert p["start"] == at % size
            ids += p["ids"]
            at += p["length"]
        assert at % size == 0
        whole += [ids[k:k + size] for k in range(0, at, size)]
    assert sorted(whole) == want
    sequences = {}
    for p in got:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    sizes = []
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        sizes.append(at)
    shards = len({s >> 32 for s in sequences})
    assert shards > 3 and max(sizes) == 2048 and sum(s < 2048 for s in sizes) <= shards


def test_index_scores_are_bm25():
    r = random.Random(9)
    docs = [np.array([r.randrange(30) for _ in range(r.randrange(1, 40))], "<u2") for _ in range(25)]
    rules = Packing(terms=1000)
    index = InvertedIndex(docs, rules)
    mean = np.mean([len(d) for d in docs])
    used = np.zeros(25, bool)
    used[[3, 7]] = True

    def score(q, d):
        total = 0.0
        for t in set(docs[q].tolist()):
            tf = int((docs[d] == t).sum())
            df = sum(t in x for x in docs)
            idf = np.log1p((25 - df + 0.5) / (df + 0.5))
            total += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(docs[d]) / mean))
        return total

    want = [d for d in range(25) if not used[d] and score(7, d) > 0]
    got = index.neighbours(7, used).tolist()
    assert set(got) == set(want)
    assert np.all(np.diff([score(7, d) for d in got]) <= 1e-9)


def test_production_scores_use_all_terms():
    r = random.Random(10)
    docs = [np.array([r.randrange(400) for _ in range(r.randrange(20, 300))], "<u2") for _ in range(40)]
    mean = np.mean([len(d) for d in docs])
    df = {t: sum(t in d for d in docs) for t in range(400)}

    def score(q, d):
        tf = {t: int((docs[d] == t).sum()) for t in set(docs[q].tolist())}
        return sum(np.log1p((40 - df[t] + 0.5) / (df[t] + 0.5)) * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * len(docs[d]) / mean))
                   for t, c in tf.items() if c)

    index = InvertedIndex(docs, Packing())
    for q in range(40):
        used = np.arange(40) == q
        got = index.neighbours(q, used).tolist()
        assert sorted(got) == [d for d in range(40) if d != q and score(q, d) > 0]
        assert np.all(np.diff([score(q, d) for d in got]) <= 1e-9)
        assert index.neighbours(q, used, 5).tolist() == got[:5]


def test_neighbours_share_a_window():
    a, b = np.arange(2, 300, dtype="<u2"), np.arange(5000, 5300, dtype="<u2")
    docs = [a, b, a[::-1], b[::-1], a, b]
    first = [x[0] for x in packing.packed(docs, Packing(window=900))]
    assert set(first[:3]) == {0, 2, 4}


def test_few_neighbours_are_looked_up_in_the_same_order(monkeypatch):
    r = random.Random(12)
    docs = [np.array([r.randrange(60) for _ in range(r.choice((1, 2, 5, 40, 90)))], "<u2") for _ in range(400)]
    rules = Packing(window=200)
    full, asked = InvertedIndex.neighbours, []

    def eager():
        index, used, first, seed, waiting, offset, order = InvertedIndex(docs, rules), np.zeros(len(docs), bool), 0, None, [], 0, []
        while not used.all():
            if not waiting:
                while used[first]:
                    first += 1
            doc = waiting.pop(0) if waiting else first
            used[doc] = True
            order.append(doc)
            offset += len(docs[doc])
            if offset >= rules.window:
                offset, seed, waiting = offset % rules.window, None, []
            if seed is None and offset:
                seed, waiting = doc, full(index, doc, used).tolist()
        return order

    monkeypatch.setattr(InvertedIndex, "neighbours", lambda self, doc, used, most=None: asked.append(most) or full(self, doc, used, most))
    got = list(dict.fromkeys(x[0] for x in packing.packed(docs, rules)))
    monkeypatch.undo()
    assert got == eager()
    assert sorted(asked)[len(asked) // 2] <= 8 < max(asked)


def test_best_terms_are_those_of_each_document_alone():
    r = random.Random(13)
    docs = [np.array([r.randrange(300) for _ in range(r.randrange(1, 60))], "<u2") for _ in range(50)]
    parts = [np.unique(d, return_counts=True) for d in docs]
    terms, counts = (np.concatenate(x) for x in zip(*parts))
    lengths = np.array([len(d) for d in docs])
    corpus = packing.Frequencies.of(terms, lengths)
    got = packing.best_terms(terms, counts, np.array([len(t) for t, _ in parts]), lengths, corpus, Packing())
    for (t, c), size, best in zip(parts, lengths, got):
        weights = dict(zip(t.tolist(), corpus.weights(t, c, size, Packing()).tolist()))
        held = [x for x in weights if corpus.df[x] > 1]
        assert best.tolist() == sorted(held, key=lambda x: (-weights[x], x))[:4]


def test_near_copies_meet_in_a_shard(spark):
    r = random.Random(11)
    rows = []
    for k in range(200):
        words = [f"{chr(97 + k % 26)}{r.randrange(10**6)}" for _ in range(60)]
        for c in range(2):
            rows.append((1000 * c + k, " ".join(words[:55] + ["end", str(c)] if c else words), "s"))
    r.shuffle(rows)
    got = packing.pack(documents(spark, rows), BYTE, Packing(window=512, shard_chars=8_000)).collect()
    shards = {}
    for p in got:
        shards.setdefault(p["id"], set()).add(p["sequence_id"] >> 32)
    assert len(set().union(*shards.values())) > 10
    assert sum(bool(shards[k] & shards[1000 + k]) for k in range(200)) >= 150  # about 10 by chance


def test_empty_table(spark):
    assert packing.pack(documents(spark, []), BYTE).count() == 0
