import hashlib
import math
import random

from pyspark.sql import functions as F

from starweave.llm import mixing


def brute_targets(sizes: dict, cycle, share, most) -> dict:
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(names)}
    total, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = (total - sum(out.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level >= most * sizes[s]}
        if not over:
            return out | {s: weight[s] * level for s in open_}
        out |= {s: most * sizes[s] for s in over}
        open_ -= over
    return out


def frame(spark, n=400, seed=1):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice(["a", "a", "a", "b", "c", "é", None]), rnd.randrange(0, 50), rnd.random(), "x") for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id long, source string, w long, q double, target string").repartition(6)


def test_targets_and_taken(spark):
    rows, df = frame(spark)
    got = {r["doc_id"]: r for r in mixing.mix(df, F.col("w"), F.col("q"), "s").collect()}
    sizes: dict = {}
    for _, s, w, _, _ in rows:
        sizes[s] = sizes.get(s, 0) + w
    want = brute_targets(sizes, (5, 2, 1), 1.5, 2.0)
    assert math.isclose(sum(want.values()), 1.5 * sum(sizes.values()))

    def key(row):
        u = (int(hashlib.md5(f"s:{row[0]}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        return -math.log(u) / row[3], row[0]

    for s, target in want.items():
        own = sorted((r for r in rows if r[1] == s), key=key)
        epochs, budget, so_far = int(target // sizes[s]), target - target // sizes[s] * sizes[s], 0
        for r in own:
            so_far += r[2]
            copies = epochs + (budget > 0 and so_far - r[2] / 2 <= budget)
            assert got[r[0]]["taken"] == copies * r[2]
            assert math.isclose(got[r[0]]["target"], target) and got[r[0]]["source_size"] == sizes[s]
        taken = sum(got[r[0]]["taken"] for r in own)
        assert abs(taken - target) <= 50


def test_reruns_agree_and_odd_rows(spark):
    rows = [(1, "a", None, None), (2, "a", -3, float("nan")), (3, None, 5, 0.0), (3, None, 5, 0.0), (None, "b", 7, 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, source string, w long, q double")
    one, two = (sorted(map(str, mixing.mix(d, F.col("w"), F.col("q"), "s").collect())) for d in (df, df.repartition(3)))
    assert one == two and len(one) == 5
    assert mixing.mix(df.limit(0), F.col("w"), F.col("q"), "s").count() == 0


def test_words(spark):
    df = spark.createDataFrame([("Two words.",), ("a$$$ THE!! ok, | x",), (None,), ("",)], "text string")
    got = df.select(mixing.word_count().alias("n"), mixing.clean_words().alias("c")).collect()
    assert [tuple(r) for r in got] == [(2, 2), (5, 2), (0, 0), (0, 0)]


def test_runs_without_python(spark):
    _, df = frame(spark, 20)
    plan = mixing.mix(df, F.col("w"), F.col("q"), "s")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
