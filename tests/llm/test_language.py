import random

import numpy as np

from starweave.llm import language

WORDS = {
    "en": "the and that with from have this which would there their about people water house river morning".split(),
    "de": "der die und nicht mit eine sich auch werden haben über straße wasser häuser morgen schön".split(),
    "fr": "le les des une dans pour que avec être cette mais où déjà français rivière matin eau".split(),
}


def text(rnd, lang, n):
    return " ".join(rnd.choices(WORDS[lang], k=n))


def learned(spark):
    rnd = random.Random(1)
    rows = [(text(rnd, lang, 60), lang) for lang in WORDS for _ in range(20)] + [(None, "en"), ("abc", None)]
    return language.learn(spark.createDataFrame(rows, "text string, lang string").repartition(4))


def test_counts_equal_brute_force(spark):
    rows = [("a bc", "x"), ("a bc", "x"), ("déjà", "y"), ("", "z")]
    got = language._gram_counts(spark.createDataFrame(rows, "text string, lang string")).groupBy("lang", "gram").sum("n").collect()
    want: dict = {}
    for t, lang in rows:
        for g in language.trigrams(t).tolist():
            want[lang, g] = want.get((lang, g), 0) + 1
    assert {(r[0], r[1]): r[2] for r in got} == want
    assert len(language.trigrams("a  1 bc")) == 1 + 2  # " a ", " bc", "bc "


def test_held_out_accuracy_and_mixtures(spark):
    model = learned(spark)
    assert model.names == ("de", "en", "fr")
    rnd = random.Random(2)
    rows = [(i, text(rnd, lang, 15), lang) for i, lang in enumerate(list(WORDS) * 30)]
    rows += [(900, text(rnd, "en", 300) + "\n" + text(rnd, "fr", 200), "mix"), (901, "Le 12", "fr")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = {r["doc_id"]: r for r in language.predict(df, model).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in rows if i < 900)
    mixed = {m["lang"]: m["share"] for m in got[900]["mixture"]}
    assert set(mixed) == {"en", "fr"} and 0.5 < mixed["en"] < 0.7 and abs(sum(mixed.values()) - 1) < 1e-6


def test_em_raises_the_likelihood():
    rnd = np.random.default_rng(3)
    chance = rnd.dirichlet(np.ones(50), 3)
    weight = rnd.integers(1, 9, 50).astype(float)
    shares, best = language._proportions(chance, weight, weight.sum())
    assert abs(shares.sum() - 1) < 1e-9
    for _ in range(50):
        assert weight @ np.log(rnd.dirichlet(np.ones(3)) @ chance) <= best + 1e-3


def test_odd_rows(spark):
    model = learned(spark)
    df = spark.createDataFrame([(1, None), (2, ""), (3, "12 !! 34"), (3, "12 !! 34"), (4, "water " * 20000)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in language.predict(df, model).collect())
    assert got == [(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0), (3, "und", 0.0), (4, "en", 1.0)]
    assert language.predict(df.limit(0), model).count() == 0
    nothing = language.learn(spark.createDataFrame([], "text string, lang string"))
    assert language.predict(df, nothing).where("lang_pred != 'und'").count() == 0


def test_a_refused_relative_does_not_end_the_search(monkeypatch):
    """Shares of all languages put a relative of the first one before another that is there; a trace is not tried."""
    chance = np.full((4, language.BUCKETS), 1.0 / language.BUCKETS, dtype=np.float32)
    chance[0] *= 1.5
    tried = []

    def stub(rows, weight, total):
        if len(rows) == 4:
            return np.array([0.6, 0.25, 0.15 - 1e-9, 1e-9]), 0.0
        tried.append(len(rows))
        likes = {1: -1e9, 2: 1e9}
        return np.full(len(rows), 1 / len(rows)), likes[len(tried)]

    monkeypatch.setattr(language, "_proportions", stub)
    model = language.Languages(("a", "a2", "b", "c"), chance)
    assert [name for name, _ in model.mixture("words of some length " * 9)] == ["a", "b"]
    assert tried == [2, 2]
