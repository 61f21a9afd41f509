import random
import re
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from starweave.llm import ngram_join
from starweave.llm.components import components
from starweave.llm.ngram_join import SUBSETS_UP_TO, Bands, JaccardJoin, _folded, sketch
from starweave.llm.shingles import shingle_set, word_hashes


def shingles(text: str | None, k: int) -> frozenset:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def brute(rows: list[tuple[int, str | None]], k: int, percent: int) -> dict[int, int]:
    sets = {i: shingles(t, k) for i, t in rows}
    root = {i: i for i in sets}

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def corpus(seed: int, groups: int = 12, copies: int = 6, n: int = 60) -> list[tuple[int, str | None]]:
    rnd = random.Random(seed)
    word = lambda: rnd.choice("ab") + str(rnd.randrange(4000))
    line = " ".join(word() for _ in range(12))
    rows: list[str | None] = [None, "", "  \t", "one", "ONE", "two words", "two  WORDS"]
    for _ in range(groups):
        base = [word() for _ in range(rnd.randrange(3, n))]
        for _ in range(copies):
            new = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
                new[rnd.randrange(len(new))] = word()
            rows.append((line + "\n" if rnd.random() < 0.3 else "") + " ".join(new))
    return list(enumerate(rows, 10))


def test_words_and_shingles():
    text = "The  quick\tBROWN Ünï\x0bfox x"
    assert len(word_hashes(text)) == 5
    assert len(shingle_set(text, 2)) == len(shingles(text, 2))
    assert np.array_equal(shingle_set("a b", 4), shingle_set("A\nB ", 4))
    assert not len(shingle_set(None, 3)) and not len(shingle_set(" \n", 3))


def test_long_text_in_blocks(monkeypatch):
    text = " ".join(str(i) for i in range(3000))
    whole = shingle_set(text, 5)
    monkeypatch.setattr("starweave.llm.shingles.BLOCK", 200)
    assert np.array_equal(shingle_set(text, 5), whole)


@pytest.mark.parametrize("percent", [80, 85])
@pytest.mark.parametrize("marked", [False, True])
def test_linked_sets_share_a_signature(percent, marked):
    rnd = np.random.default_rng(percent)
    bands = Bands(percent)
    frequent = rnd.random(1 << 10) < 0.5 if marked else None
    for _ in range(400):
        common = rnd.integers(1, 400)
        room = common * 100 // percent - common
        left = rnd.integers(0, room + 1)
        right = room - left
        pool = rnd.integers(0, 1 << 63, common + room, dtype=np.uint64)
        a = np.unique(pool[: common + left])
        b = np.unique(np.concatenate((pool[:common], pool[common + left : common + left + right])))
        assert len(np.intersect1d(bands.signatures(a, frequent), bands.signatures(b, frequent)))


@pytest.mark.parametrize("words,percent", [(4, 85), (5, 80)])
def test_equals_brute_force(spark, words, percent):
    rows = corpus(words)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got, links = JaccardJoin(words, percent).run(df)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == brute(rows, words, percent)
    assert {r["doc_id"]: r["n_shingles"] for r in got.collect()} == {i: len(shingles(t, words)) for i, t in rows}
    sets = {i: shingles(t, words) for i, t in rows}
    for a, b in links.collect():
        assert 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])


def test_sketches_never_differ_more_than_the_sets():
    rnd = np.random.default_rng(4)
    for _ in range(100):
        a = np.unique(rnd.integers(0, 1 << 63, rnd.integers(1, 300), dtype=np.uint64))
        b = np.unique(np.concatenate((a[rnd.random(len(a)) < 0.9], rnd.integers(0, 1 << 63, rnd.integers(0, 40), dtype=np.uint64))))
        one, two = sketch(a), sketch(b)
        words = min(len(one), len(two))
        x, y = _folded([one.tobytes(), two.tobytes()], words)
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("block", [3, 256])
def test_groups_near_the_threshold(spark, monkeypatch, block):
    """Copies with so many edits that some pairs are linked and others not, in signatures of many classes."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "FEW", 2)
    monkeypatch.setattr(ngram_join, "PIVOT_ROUNDS", 1)
    rnd = random.Random(block)
    base = [f"w{rnd.randrange(9999)}" for _ in range(80)]
    rows = []
    for i in range(60):
        new = list(base)
        for _ in range(rnd.randrange(1, 5)):
            new[rnd.randrange(80)] = f"x{rnd.randrange(9999)}"
        rows.append((i, " ".join(new)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in JaccardJoin(4, 85).run(df)[0].collect()}
    assert got == brute(rows, 4, 85)
    assert len(set(got.values())) > 1


def test_one_row_of_each_group_and_odd_rows(spark):
    text = " ".join(map(str, range(50)))
    rows = [(1, text, "a"), (1, text, "a"), (2, text + " x", "b"), (3, None, "c"), (3, None, "c"), (4, "", "d"), (None, text, "e"), (5, "other words here", "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    kept = JaccardJoin(5, 80).one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in kept.collect()) == [(0, "e"), (1, "a"), (3, "c"), (4, "d"), (5, "f")]
    assert JaccardJoin(5, 80).run(df.limit(0))[0].count() == 0


def test_other_texts_under_one_id_stay(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(40)) for c in "abc")
    rows = [(1, one), (1, two), (2, one), (2, one + " x"), (3, two + " y"), (5, three), (5, None), (5, ""), (5, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted((r["doc_id"], r["text"] or "") for r in JaccardJoin(5, 80).one_of_each(df).collect())
    assert kept == [(1, one), (1, two), (5, ""), (5, ""), (5, " "), (5, three)]
    got = JaccardJoin(5, 80).run(df)[0].collect()
    assert all(r["component_id"] == (1 if r["n_shingles"] and r["doc_id"] < 4 else r["doc_id"]) for r in got)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("shingle_sets")]


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 150)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 150)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("percent", [80, 85])
def test_linked_sets_share_a_signature_in_bands_with_subsets_and_beyond(percent):
    rng, bands, linked, beyond = np.random.default_rng(percent), Bands(percent), 0, 0
    for trial in range(4000):
        one = np.unique(rng.integers(0, 1 << 63, int(rng.integers(1, 260)), dtype=np.uint64))
        k = bands.differ(len(one))
        gone = int(rng.integers(0, k + 1))
        more = rng.integers(0, 1 << 63, int(rng.integers(0, k + 1 - gone)), dtype=np.uint64)
        two = np.unique(np.concatenate([one[rng.permutation(len(one))[gone:]], more]))
        common = len(np.intersect1d(one, two))
        if not len(two) or 100 * common < percent * (len(one) + len(two) - common):
            continue
        # Any share of the shingles may be frequent: none, few or nearly all.
        marks = rng.random(1 << 12) < rng.random() if trial % 3 else None
        assert np.intersect1d(bands.signatures(one, marks), bands.signatures(two, marks)).size
        linked, beyond = linked + 1, beyond + (k > SUBSETS_UP_TO)
    assert linked > 2000 and beyond > 100


def test_known_components_go_on_with_new_links(spark):
    old = components(spark.createDataFrame([(1, 2), (2, 3), (7, 8)], "a long, b long"))
    both = components(spark.createDataFrame([(3, 8), (20, 21)], "a long, b long"), old)
    assert dict(both.collect()) == {1: 1, 2: 1, 3: 1, 7: 1, 8: 1, 20: 20, 21: 20} and both.count() == 7


def test_a_large_group_sends_out_about_as_many_pairs_as_it_has_members(spark, monkeypatch):
    """All members are nearly alike: some pairs are linked, many are just below, and no pivot joins them before."""
    sent = []

    def counted(df, label, stage=ngram_join.stage):
        out = stage(df, label)
        if label == "pairs":
            sent.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "stage", counted)
    monkeypatch.setattr(ngram_join, "PIVOT_ROUNDS", 0)
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 800)
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(150):
        new = list(base)
        for at in rnd.sample(range(200), 3 if i % 3 else 2):
            new[at] = f"x{rnd.randrange(9999)}"
        rows.append((i, " ".join(new)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in JaccardJoin(4, 85).run(df)[0].collect()}
    assert got == brute(rows, 4, 85)
    assert sum(sent) < 150 * 149 // 8, sent


@pytest.mark.parametrize("spanning", [0, 1])
def test_links_behind_failed_pairs_are_found(spark, monkeypatch, spanning):
    """Where sketches allow pairs that are not linked, the last round still finds the links beside them."""
    monkeypatch.setattr(ngram_join, "FEW", 2)
    monkeypatch.setattr(ngram_join, "PIVOT_ROUNDS", 0)
    monkeypatch.setattr(ngram_join, "SPANNING_ROUNDS", spanning)
    monkeypatch.setattr(ngram_join, "sketch", lambda s: np.zeros(1, dtype=np.uint64))
    rows = corpus(7, groups=6, copies=15)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in JaccardJoin(4, 85).run(df)[0].collect()}
    assert got == brute(rows, 4, 85)


def test_only_texts_that_share_a_signature_are_described(spark, monkeypatch, tmp_path):
    """The join that fetches texts again must not compute, or shuffle, the sets of all documents first."""

    def marked(shingles, kept=ngram_join.sketch, at=str(tmp_path)):
        open(f"{at}/{uuid.uuid4().hex}", "w").close()
        return kept(shingles)

    monkeypatch.setattr(ngram_join, "sketch", marked)
    rnd = random.Random(3)
    rows = [(i, " ".join(f"w{rnd.randrange(10**9)}" for _ in range(20))) for i in range(300)]
    rows += [(300, rows[7][1] + " x"), (301, rows[9][1]), (None, rows[9][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in JaccardJoin(4, 85).run(df)[0].collect()}
    assert got == {None: None} | {i: i for i in range(300)} | {300: 7, 301: 9}
    assert 2 <= len(list(tmp_path.iterdir())) <= 12


def test_python_gets_small_batches_and_the_setting_returns(spark, monkeypatch):
    """One row can be two blocks of whole sets: Spark's own 10,000 rows of them are no bounded batch."""
    names = [f"spark.sql.execution.arrow.{x}" for x in ("maxRecordsPerBatch", "maxBytesPerBatch")]
    before, seen = [spark.conf.get(x) for x in names], []

    def spied(df, label, stage=ngram_join.stage):
        seen.append([int(spark.conf.get(x)) for x in names])
        return stage(df, label)

    monkeypatch.setattr(ngram_join, "stage", spied)
    df = spark.createDataFrame([(1, "a b c d e"), (2, "a b c d e")], "doc_id long, text string")
    for run in (lambda: JaccardJoin(4, 85).run(df)[0], lambda: JaccardJoin(4, 85).one_of_each(df)):
        run().collect()
        assert [spark.conf.get(x) for x in names] == before
    assert seen and all(rows <= 1024 and size <= 4 << 20 for rows, size in seen)


def test_a_signature_of_one_block_meets_itself_without_a_second_copy(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 10)
    made = [(s, s * 100 + i, 5, s * 100 + i, m) for s, m in ((1, 9), (2, 35)) for i in range(m)]
    many = spark.createDataFrame(made, "sig long, v long, n long, label long, m long")
    sets = many.selectExpr("v", "cast('12345678' as binary) sketch")
    met = JaccardJoin()._blocks(many, F.ceil(F.col("m") / 10), sets).collect()
    alone = [r for r in met if r["rows2"] is None]
    assert [len(r["rows1"]) for r in alone if r["sig"] == 1] == [9] and not any(r["sig"] == 1 for r in met if r["rows2"])
    pairs = [frozenset((a["v"], b["v"])) for r in met for a in r["rows1"] for b in r["rows2"] or r["rows1"] if a != b]
    assert len(set(pairs)) == 9 * 8 // 2 + 35 * 34 // 2
