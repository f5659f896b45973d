import base64
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken

from helpers import AWKWARD, clashing, documents, sentence
from tallycheck.llm import bpe, pieces

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def reference():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pieces_are_the_matches_of_the_pattern():
    r, pattern = random.Random(5), regex.compile(public_tokenizers.PATTERN)
    letters = "a b'srevlltdm12 .,!\n\t é　Ж٣'\xa0\x1c🙂x\x85"
    for _ in range(2000):
        texts = ["".join(r.choice(letters) for _ in range(r.randrange(25))) for _ in range(r.randrange(1, 6))]
        found, ends = pieces.cut(texts, pieces.byte_level_starts)
        want = [pattern.findall(t) for t in texts]
        assert [x.decode() for x in found.to_pylist()] == [w for x in want for w in x]
        assert ends.tolist() == np.cumsum([len(w) for w in want]).tolist()


def test_every_code_point_is_cut_alike():
    pattern = regex.compile(public_tokenizers.PATTERN)
    texts = [f"a{c}1 {c}{c}b.{c}" for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000]
    for a in range(0, len(texts), 100_000):
        found, ends = pieces.cut(texts[a : a + 100_000], pieces.byte_level_starts)
        assert found.cast(pa.string()).to_pylist() == [w for t in texts[a : a + 100_000] for w in pattern.findall(t)]


def check(spark, rows, **options):
    got = bpe.decode(bpe.encode(clashing(documents(spark, rows)), PATH, with_decoded=True, **options)
                     .withColumnRenamed("decoded", "at_once"), PATH).collect()
    assert all(x["at_once"] == x["decoded"] for x in got)
    enc = reference()
    want = [(i, np.array(enc.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t, _ in rows]
    assert sorted(((x["id"], bytes(x["ids"]), bytes(x["decoded"])) for x in got), key=repr) == sorted(want, key=repr)
    assert all(x["n_tokens"] * 4 == len(x["ids"]) for x in got)
    assert len({x["row"] for x in got}) == len(rows)


def test_ids_of_the_library_and_back(spark):
    r = random.Random(9)
    rows = list(AWKWARD) + [(k, sentence(r, r.randrange(200)), "s") for k in range(1000, 1300)]
    rows += [(2000 + k, t, "s") for k, t in enumerate(["<|endoftext|>", "it's 'S we'LL", "\u3000\x85 \t\n\n x", "日本語 テキスト", "\x00"])]
    check(spark, rows)
    check(spark, rows, block_chars=3000)  # many blocks, some without a word


def test_word_that_fills_a_third_of_all_positions(spark):
    r = random.Random(2)
    check(spark, [(k, " the".join(f" {w}" for w in sentence(r, 60).split()), "s") for k in range(400)], block_chars=5000)


def test_unknown_ids_and_empty_table(spark):
    ids = np.array([0, 50_300, 1, 2**32 - 1], "<u4").tobytes()
    got = bpe.decode(spark.createDataFrame([(ids,), (b"",)], "ids binary"), PATH).collect()
    table = bpe.token_bytes(PATH)
    assert [bytes(x["decoded"]) for x in got] == [table[0].as_py() + table[1].as_py(), b""]
    assert bpe.encode(documents(spark, []), PATH).count() == 0
