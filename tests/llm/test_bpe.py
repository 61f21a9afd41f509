import random

import numpy as np
import pytest
import tiktoken

from starweave.llm import bpe


@pytest.fixture(scope="module")
def vocabulary(spark):
    return bpe.default_vocabulary(spark)


@pytest.fixture(scope="module")
def reference(vocabulary):
    own = bpe.codec(*vocabulary)
    return tiktoken.Encoding("own", pat_str=vocabulary[1], mergeable_ranks=own.ranks, special_tokens={})


def noise(seed: int, n: int) -> list[str]:
    rnd = random.Random(seed)
    pool = [*range(32, 127), *range(0xA0, 0x250), 9, 10, 13, 0x1C, 0x85, 0x2028, 0x3000, 0x4E00, 0x1F600, *[32, 97, 98, 39] * 20]
    return ["".join(chr(rnd.choice(pool)) for _ in range(rnd.randrange(80))) for _ in range(n)]


def packed(reference, text: str) -> bytes:
    return np.array(reference.encode_ordinary(text), dtype="<u4").tobytes()


def test_equals_tiktoken_and_round_trips(vocabulary, reference):
    own = bpe.codec(*vocabulary)
    for text in ["", " ", "it's", "aaaaaaa", "<|endoftext|>", *noise(1, 400)]:
        ids = own.encode(text)
        assert ids == packed(reference, text)
        assert own.decode(ids) == text.encode()


def test_very_long_pre_token(vocabulary, reference):
    own = bpe.codec(*vocabulary)
    for text in ("x" * 30_000, "".join(random.Random(2).choices("abcdeé", k=20_000))):
        assert own.encode(text) == packed(reference, text)


def test_shared_queue_equals_single(vocabulary):
    own = bpe.codec(*vocabulary)
    rnd = random.Random(3)
    pieces = ["".join(rnd.choices("aeinrst h", k=rnd.randrange(1, 24))).encode() for _ in range(3000)] + [b"aaaaaaaa", b"x"]
    pieces = [p for p in pieces if p not in own.ranks]
    merged = bpe.merge_many(pieces, own.table)
    assert merged == [np.array(bpe.merge(p, own.ranks), dtype="<u4").tobytes() for p in pieces]


def test_blocks_of_a_long_text(vocabulary, reference, monkeypatch):
    text = " ".join(noise(4, 200))
    monkeypatch.setattr(bpe, "BLOCK", 100)
    own = bpe.codec(*vocabulary)
    assert own.encode(text) == packed(reference, text)
    assert sum(own.encode_all([text, "", "a"]), []) == [packed(reference, t) for t in (text, "", "a")]


def test_frames(spark, vocabulary):
    rows = [(1, "hello world", "x"), (1, "hello world", "x"), (None, None, None), (3, "", "y"), (4, "日本 " * 500, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.digests(bpe.decode(bpe.encode(df, *vocabulary), *vocabulary)).collect()
    assert len(out) == 5
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in out)
    assert {r["n_tokens"] for r in out if not r["text"]} == {0}
    once = bpe.round_trip(df, *vocabulary)
    assert once.columns == ["doc_id", "text", "ids", "decoded"]
    key = lambda r: (r["text"] or "", bytes(r["ids"]), bytes(r["decoded"]))
    assert sorted(map(key, once.collect())) == sorted(map(key, out))
    assert bpe.encode(df.limit(0), *vocabulary).count() == bpe.round_trip(df.limit(0), *vocabulary).count() == 0
