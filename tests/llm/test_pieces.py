import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starweave.llm import pieces, registry


@pytest.fixture(scope="module")
def model(spark):
    return pieces.default_model(spark)


def noise(seed: int, n: int) -> list[str]:
    rnd = random.Random(seed)
    pool = [*range(0, 127), *range(0xA0, 0x250), 0x2581, 0x3000, 0x4E00, 0x1F600, 0xFFFD, *[32, 97, 98, 39, 0x2581] * 20]
    return ["".join(chr(rnd.choice(pool)) for _ in range(rnd.randrange(80))) for _ in range(n)]


def test_equals_the_library_and_decodes(model):
    own = pieces.codec(model)
    for text in ["", " ", "   ", "▁", "it's", "a\tb\r\n", "<s>x</s><unk><0x41>", "aaaaaaaa", *noise(1, 500)]:
        ids = own.encode(text)
        assert ids.tolist() == own.library.encode(text), text
        assert own.decode(ids) == own.library.decode(ids.tolist())


def test_decodes_any_ids(model):
    own = pieces.codec(model)
    rnd = random.Random(2)
    for _ in range(500):
        ids = [rnd.choice([rnd.randrange(300), rnd.randrange(32_000)]) for _ in range(rnd.randrange(10))]
        assert own.decode(np.array(ids, dtype=np.int32)) == own.library.decode(ids), ids


def test_very_long_texts(model, monkeypatch):
    own = pieces.codec(model)
    for text in ("x" * 30_000, " " * 20_000, "".join(random.Random(3).choices("abcdeé ", k=50_000))):
        assert own.encode(text).tolist() == own.library.encode(text)
    monkeypatch.setattr(pieces, "BLOCK", 50)
    for text in noise(4, 30):
        assert own.encode(text * 5).tolist() == own.library.encode(text * 5)
        assert own.decode(own.encode(text * 5)) == own.library.decode(own.library.encode(text * 5))


def test_equal_scores_merge_leftmost_first():
    entries = {"aa": pieces.FIRST, "ab": 2 * pieces.FIRST, "aaa": 3 * pieces.FIRST}
    assert pieces.merge("aaaa", entries) == ["aa", "aa"]
    assert pieces.merge("aaab", entries) == ["aa", "ab"]
    assert pieces.merge("aaa", entries) == ["aaa"]


def test_a_full_table_is_emptied(model, monkeypatch):
    monkeypatch.setattr(pieces, "CACHED", 3)
    own = pieces.Codec(model)
    for text in ("one two three four five", "six five four"):
        assert own.encode(text).tolist() == own.library.encode(text)
    assert len(own) <= 3


def test_texts_are_cut_where_no_piece_crosses(model):
    own = pieces.codec(model)
    text = "▁▁ab12,.\n▁c\x00é_½▁"
    assert "".join(own.parts.findall(text)) == text
    assert own.parts.findall("▁▁ab12,▁c▁²x") == ["▁▁ab", "12,", "▁c", "▁²", "x"]
    assert pieces.parts_of(["▁a", "b."]).findall("▁a.b▁c") == ["▁a.b", "▁c"]
    assert pieces.parts_of(["a▁b"]).findall("▁a.b▁c") == ["▁a.b▁c"]


def test_frames(spark, model):
    rows = [(1, "hello world", "x"), (1, "hello world", "x"), (None, None, None), (3, "", "y"), (4, "日本 " * 500, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    once = pieces.round_trip(df, model)
    assert once.columns == ["doc_id", "text", "ids", "decoded", "agrees"]
    out = once.collect()
    assert len(out) == 5 and all(r["agrees"] for r in out)
    assert all(r["decoded"] == (r["text"] or "") for r in out)
    twice = pieces.decode(pieces.encode(df, model), model)
    key = lambda r: (r["text"] or "", r["ids"], r["decoded"])
    assert sorted(map(key, out)) == sorted(map(key, twice.collect()))
    assert [r["agrees"] for r in pieces.round_trip(df.coalesce(1), model, every=3).collect()] == [True, None, None, True, None]
    none = df.limit(0)
    assert pieces.round_trip(none, model).count() == pieces.encode(none, model).count() == 0
    assert [r["decoded"] for r in pieces.decode(df.select(F.lit(None).cast("array<int>").alias("ids")), model).collect()] == [""] * 5


def test_query_against_the_library(spark, model):
    sf = "/root/testdata/sf0.001"
    library = pieces.codec(model).library
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode(r["text"] or "")
        digests = (hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids)))
        want[r["doc_id"]] = (len(ids), *digests)
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in registry.op12_pieces(spark, sf).collect()}
    assert got == want


def test_query_shows_every_row_to_the_library(spark):
    out = registry.op12_pieces(spark, "/root/testdata/sf0.001").coalesce(1)
    assert out.where("agrees").count() == out.count() > 16
