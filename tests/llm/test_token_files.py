import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

from helpers import AWKWARD, clashing, documents, sentence
from tallycheck.llm import token_files
from tallycheck.llm.pieces import portions
from tallycheck.llm.token_files import _SETTLED, Encoder, width

WORD, BYTE = (public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = ["", " ", "\n", "a  b", " a", "a ", "a\n\nb c", "a b   c", "a\x1cb \x1c c", "it's 's don't, x.", "é ́x",
       "İstanbul ΣΑΣ ΟΔΟΣ.", "a,. b., c,", "<|endoftext|> x <|startoftext|>", "12 3a b4 ,", "日本語 テキスト。", "\t\ta\r\nb",
       "ﬁ ª º²", "x" * 5000, "\u3000a\xa0b \u2009", "ÀÉ, ñ. À,", "🙂 🙂, a🙂", "ᾳΣ ς σ"]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_pieces_give_the_ids_of_whole_texts(path):
    r = random.Random(4)
    letters = "ab ,.\n\t'1 é\x1c S\xa0"
    texts = ODD + ["".join(r.choice(letters) for _ in range(r.randrange(40))) for _ in range(2000)]
    texts += [sentence(r, 50) for _ in range(20)]
    e = Encoder(path, most=50)
    end = np.array([1], e.dtype).tobytes()
    got = []
    for a, b in portions(texts, 500):
        ids, ends = e.encode(texts[a:b], end)
        got += [x.tolist() for x in np.split(ids, ends[:-1])]
    plain = Tokenizer.from_file(path)
    assert got == [[*x.ids, 1] for x in plain.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_distinct_pieces_of_a_call_are_encoded_once(path, monkeypatch):
    r = random.Random(7)
    words = ["".join(r.choice("abcdefghij") for _ in range(9)) for _ in range(300)]
    texts = [" ".join(["x", *r.choices(words, k=40)]) for _ in range(200)]
    e = Encoder(path, most=1000)  # many portions with the same pieces
    seen = []
    batches = e._batches
    monkeypatch.setattr(e, "_batches", lambda texts, *more: seen.extend(texts) or batches(texts, *more))
    ids, _ = e.encode(texts)
    assert max(sum(w in t for t in seen) for w in words) == 1
    assert ids.tolist() == [i for x in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False) for i in x.ids]


def test_settled_code_points_are_alike_everywhere():
    plain, pattern = Tokenizer.from_file(BYTE).pre_tokenizer, regex.compile(public_tokenizers.PATTERN)
    for a, b in _SETTLED:
        for c in map(chr, range(a, b + 1)):
            text = f"a{c}1 {c}{c}b.{c}"
            assert [at for _, at in plain.pre_tokenize_str(text)] == [m.span() for m in pattern.finditer(text)], hex(ord(c))
            assert len(c.lower()) == 1


def test_files_round_trip(spark, request):
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")
    request.addfinalizer(lambda: spark.conf.set(merge, "true"))
    r = random.Random(6)
    rows = list(AWKWARD) + [(k, sentence(r, r.randrange(0, 30)), "s") for k in r.sample(range(1000, 2000), 300)]
    rows += [(500, ODD[k], "s") for k in range(10)]
    manifest = token_files.write_tokens(clashing(documents(spark, rows)), WORD)
    got = sorted((tuple(x) for x in token_files.read_documents(manifest).collect()), key=lambda x: x[1])
    plain = Tokenizer.from_file(WORD)
    ids = lambda t: [*plain.encode(t or "", add_special_tokens=False).ids, 1]
    want = [(i, len(x := ids(t)), zlib.crc32(np.array(x, "<u4").tobytes())) for i, t, _ in rows]
    assert sorted([(a, c, d) for a, b, c, d in got], key=repr) == sorted(want, key=repr)
    keys = [a for a, *_ in got]
    assert keys[0] is None and keys[1:] == sorted(keys[1:])
    assert [b for _, b, *_ in got] == [0, *np.cumsum([c for _, _, c, _ in got])[:-1].tolist()]
    files = manifest.orderBy("place").collect()
    assert sum(f["docs"] for f in files) == len(rows) and len(files) > 1
    assert all(f["dtype"] == "<u2" for f in files)


def test_integer_width():
    assert [width(n) for n in (256, 257, 65_536, 65_537)] == ["<u1", "<u2", "<u2", "<u4"]


def test_empty_table(spark):
    manifest = token_files.write_tokens(documents(spark, []), WORD)
    assert manifest.count() == 0 and token_files.read_documents(manifest).count() == 0
