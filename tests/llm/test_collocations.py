import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starweave.llm import collocations as c

LOWER = {i: i + 32 for i in range(65, 91)}


def brute_counts(rows, longest=3):
    counts, sizes = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    return counts, sizes


def brute(rows, least=10, longest=3, percent=50, top=2000):
    counts, sizes = brute_counts(rows, longest)
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        ranked = []
        for p, a in candidates.items():
            inside = [b for q, b in candidates.items() if len(q) > len(p) and " ".join(p) in " ".join(q)
                      and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= percent * a for b in inside):
                continue
            score, _, l, r = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, sizes[lang], -score))
    return sorted(out)


def prose(seed: int, n: int) -> list[tuple]:
    rnd = random.Random(seed)
    words = ["the", "New", "york", "City", "é", "Ünder", "a", "b c", "x-y", " "]
    fixed = ["new york city", "Ünder the", "a a a a"]
    out = []
    for _ in range(n):
        parts = [rnd.choice(fixed) if rnd.random() < 0.4 else rnd.choice(words) for _ in range(rnd.randrange(30))]
        out.append((rnd.choice(["en", "en", "de", None]), rnd.choice([" ", "\t ", ". ", "  "]).join(parts)))
    return [*out, ("en", None), (None, ""), ("de", " .,;\n"), ("one", "x")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string")


def result(df) -> list[tuple]:
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_equals_brute_force(spark, longest):
    rows = prose(longest, 120)
    assert result(c.collocations(frame(spark, rows).repartition(5), longest=longest)) == brute(rows, longest=longest)


def test_any_sample_gives_the_same(spark):
    rows = prose(9, 100)
    df = frame(spark, rows)
    want = {(lang, len(p), " ".join(p), f) for lang, own in brute_counts(rows)[0].items() for p, f in own.items() if f >= 10}
    named = df.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").where("text is not null")
    for share, times in ((0.0, 1), (0.05, 1), (0.3, 40), (1.0, 1)):
        got = c.frequent(named, 10, 3, share, times).where("k > 0").collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want, share


def test_a_long_text_is_counted_in_parts(spark, monkeypatch):
    rnd = random.Random(4)
    text = "".join(rnd.choice(["a", "b", "ccc", "é"]) + rnd.choice([" ", "  ", ".", "\t"]) for _ in range(3000)) + "z" * 99
    everything = [c.Generation({k: c._everything() for k in (1, 2)})]

    def counted(size):
        monkeypatch.setattr(c, "SLICE", size)
        total = Counter()
        count = c._counts_of(everything, 3)
        batch = pa.RecordBatch.from_pydict({"lang": ["x", "y", "x"], "text": [text, "a b", text[:50]]})
        for out in count(iter([batch])):
            for lang, k, phrase, f in zip(*(out[i].to_pylist() for i in range(4)), strict=True):
                total[lang, k, phrase] += f
        return total

    whole = counted(1 << 22)
    counts, sizes = brute_counts([("x", text), ("y", "a b"), ("x", text[:50])])
    assert whole["x", 0, ""] == sizes["x"] and whole["y", 0, ""] == 2
    assert {k: f for k, f in whole.items() if k[1]} == {(g, len(p), " ".join(p)): f for g, own in counts.items() for p, f in own.items()}
    for size, held in ((1, 3), (7, 1 << 16), (64, 0), (5000, 5)):
        monkeypatch.setattr(c, "HELD", held)
        monkeypatch.setattr(c, "OFTEN", 2)
        assert counted(size) == whole, size


def test_a_filter_holds_what_it_was_built_from(spark):
    phrases = [("en", f"w{i} é{i * 7}") for i in range(500)] + [("de", "w1 x")]
    made = c.bloom(spark.createDataFrame(phrases, "lang string, phrase string"), 2)
    def hashes(lang, texts):
        words = c.word_hashes(" ".join(texts)).reshape(-1, 2)
        return c._extend(c.mix(words[:, 0] ^ c._salt(lang)), words[:, 1])
    assert made.holds(hashes("en", [p for lang, p in phrases if lang == "en"])).all()
    assert made.holds(hashes("fr", [f"q{i} r{i}" for i in range(2000)])).mean() < 0.05


def test_scores_are_exact_beyond_64_bits(spark):
    big = 123_456_789_012_345
    rows = [("en", 1, "a", big), ("en", 1, "b", big + 2), ("en", 2, "a b", big - 1), ("en", 3, "a b c", 11), ("en", 1, "c", 12),
            ("en", 2, "b c", 11)]
    counts = spark.createDataFrame(rows, "lang string, k int, phrase string, f long")
    got = {r["phrase"]: (r["l"], r["r"], r["score"]) for r in c.scored(counts).collect()}
    assert got["a b"] == (big, big + 2, 1_000_000 * (big - 1) ** 2 // (big * (big + 2)))
    # Both cuts of the triple score 0: the shorter first part counts.
    assert got["a b c"] == (big, 11, 0)


def test_empty_tables_ties_and_other_columns(spark):
    df = frame(spark, prose(5, 5))
    assert c.collocations(df.limit(0)).count() == 0
    assert c.collocations(df.where("text is null")).count() == 0
    rows = [("en", "b a. a b. d c")] * 10 + [(None, "z y")] * 10
    wide = frame(spark, rows).withColumns({"k": F.lit(1), "phrase": F.lit("p"), "F": F.lit(2), "n": F.lit(0)})
    got = result(c.collocations(wide, top=2))
    assert got == brute(rows, top=2)
    assert [(r[0], r[1], r[2]) for r in got] == [("en", 1, "d c"), ("en", 2, "a b"), ("und", 1, "z y")]


def test_a_filter_that_errs_hides_no_longer_phrase():
    """The first filter holds pairs whose words it lacks: the second pass counts the triples behind them."""
    nothing = c.Bloom(c.np.zeros(1, dtype=c.np.uint64))
    erring = c.Generation({1: nothing, 2: c._everything()})
    later = c.Generation({1: c._everything(), 2: c._everything()})
    counted = [{(k, p): n for k, found, times in c._count(b"x y z", 0, "en", passes, 3) for p, n in zip(found.to_pylist(), times)}
               for passes in ([erring], [erring, later])]
    assert [p for k, p in counted[0] if k > 1] == []
    assert counted[1] == {(2, b"x y"): 1, (2, b"y z"): 1, (3, b"x y z"): 1}
