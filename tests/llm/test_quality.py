import random

import numpy as np
from pyspark.sql import functions as F

from starweave.llm import quality


def corpus(spark, n=400):
    rnd = random.Random(5)
    rows, labels = [], []
    for i in range(n):
        host = rnd.choice(["good", "good", "mixed", "bad"])
        junk = rnd.random() < {"good": 0.02, "mixed": 0.3, "bad": 0.9}[host]
        words = ["".join(rnd.choices("abcdefg", k=rnd.randrange(2, 8))) for _ in range(rnd.randrange(20, 60))]
        text = " ".join(w.upper() + "!!" for w in words) if junk else " ".join(words) + "."
        rows.append((i, text, host, rnd.choice(["p", "q", None]), int(junk)))
        if i % 3 == 0:
            labels.append((i, int(not junk)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, junk int").repartition(4)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int")


def test_rejects_junk_and_keeps_clean_documents(spark):
    docs, labels = corpus(spark)
    model = quality.fit(docs, labels)
    out = quality.score(docs, model, F.col("source"), F.col("lang"))
    assert out.count() == 400
    assert out.where((F.col("junk") == 1) == F.col("keep")).count() == 0
    again = quality.score(docs.repartition(7), model, F.col("source"), F.col("lang"))
    ids = lambda df: {(r["doc_id"], round(r["posterior"], 9)) for r in df.collect()}
    assert ids(out) == ids(again)


def test_rates_equal_brute_force(spark):
    rnd = np.random.default_rng(1)
    rows = [(h, p, float(rnd.beta(2, 1 + i))) for i, h in enumerate("abcd") for p in "xyz" for _ in range(3 + 4 * i)]
    got = quality.site_rates(spark.createDataFrame(rows, "host string, path string, p double")).collect()
    p = np.array([r[2] for r in rows])
    host = np.array([r[0] for r in rows])
    mean = p.mean()
    n = np.array([(host == h).sum() for h in "abcd"])
    rate = np.array([p[host == h].mean() for h in "abcd"])
    noise = mean * (1 - mean)
    between = ((n * (rate - mean) ** 2).sum() - 4 * noise) / (n.sum() - (n**2).sum() / n.sum())
    want = np.clip(noise / between - 1, *quality.STRENGTH) if between > 0 else quality.STRENGTH[1]
    assert len(got) == 12
    assert all(abs(r["host_prior"] - want) < 1e-6 and abs(r["mean"] - mean) < 1e-12 for r in got)
    assert {r["host"]: r["host_n"] for r in got} == dict(zip("abcd", n.tolist(), strict=True))


def test_sparse_sites_follow_their_parents(spark):
    base = [(i, "word " * 20, "bad", "p") for i in range(200)] + [(1000, "word " * 20, "new", "p"), (1001, "word " * 20, "bad", "q")]
    docs = spark.createDataFrame(base, "doc_id long, text string, source string, lang string")
    model = quality.Evidence((0.0,) * 6, -2.0, 0.5)
    rates = {r["doc_id"]: r for r in quality.score(docs, model, F.col("source"), F.col("lang")).collect()}
    assert abs(rates[1001]["path_rate"] - rates[1001]["host_rate"]) < 1e-9  # a path of one document has no evidence of its own
    assert abs(rates[1000]["host_rate"] - rates[1000]["path_rate"]) < 1e-9


def test_odd_rows_and_missing_labels(spark):
    rows = [(1, None, None, None), (1, None, None, None), (2, "", "a", None), (None, "x " * 5000, "a", "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumn("posterior", F.lit("old"))
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    out = quality.score(docs, model, F.col("source"), F.col("lang")).collect()
    assert len(out) == 4 and all(r["keep"] for r in out)
    assert quality.score(docs.limit(0), model, F.col("source"), F.col("lang")).count() == 0
