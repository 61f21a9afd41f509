import hashlib
import random

import numpy as np

from starweave.llm import syncmers
from starweave.llm.neighbours import edited, with_successors
from starweave.llm.syncmers import K, S, anchors, fingerprint, likeness, parsed


def prose(seed: int, n: int) -> str:
    return " ".join("".join(random.Random(f"{seed}.{i}").choices("abcdeéß日", k=5)) for i in range(n))


def test_anchors_equal_brute_force():
    text = prose(1, 60)
    codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64) + np.uint64(1)
    inner = syncmers.mix(syncmers._run_hashes(codes, S), S).tolist()
    want = []
    for i in range(len(text) - K + 1):
        window = inner[i : i + K - S + 1]
        if min(window) in (window[0], window[-1]):
            want.append(i)
    assert anchors(text)[1].tolist() == want


def test_anchors_do_not_depend_on_what_is_around():
    text = prose(2, 80)
    hashes, places = anchors(text)
    inside = {h: p for h, p in zip(hashes.tolist(), places.tolist(), strict=True)}
    moved, moved_places = anchors("x" * 37 + text)
    found = dict(zip(moved.tolist(), moved_places.tolist(), strict=True))
    assert all(found[h] == p + 37 for h, p in inside.items())


def test_blocks(monkeypatch):
    text = prose(3, 400)
    whole = fingerprint(text)
    monkeypatch.setattr(syncmers, "BLOCK", 64)
    assert fingerprint(text) == whole


def test_likeness():
    a, b = prose(4, 300), prose(5, 300)
    assert likeness(parsed(fingerprint(a)), parsed(fingerprint(a))) == 1.0
    assert likeness(parsed(fingerprint(a)), parsed(fingerprint(b))) < 0.05
    near = likeness(parsed(fingerprint(a)), parsed(fingerprint(edited(a, b))))
    assert 0.35 < near < 0.85
    assert fingerprint(None) == fingerprint("") == "" and fingerprint("ab") == fingerprint("ab") != fingerprint("ac")
    none = parsed("")
    assert likeness(none, none) == 1.0 and likeness(none, parsed(fingerprint("ab"))) == 0.0


def brute_likeness(one: str, two: str) -> float:
    """Over the full anchor sets, by quadratic search for the longest common order."""
    sides = []
    for text in (one, two):
        seen: dict[int, int] = {}
        for h, p in zip(*(x.tolist() for x in anchors(text)), strict=True):
            seen.setdefault(h, p)
        sides.append(seen or ({text: 0} if text else {}))  # a short text may have no anchor
    a, b = sides
    if not a or not b:
        return float(a == b)
    places = [b[h] for h in sorted(a, key=a.get) if h in b]
    longest: list[int] = []
    for i, p in enumerate(places):
        longest.append(1 + max((longest[j] for j in range(i) if places[j] < p), default=0))
    return max(longest, default=0) / len(a.keys() | b.keys())


def test_likeness_equals_brute_force_on_full_sets():
    rnd = random.Random(8)
    texts = [prose(i, rnd.randrange(1, 60)) for i in range(12)]
    texts += [texts[0] + texts[1], texts[1] + " " + texts[0], texts[2] * 3, "", "a" * 300, "abcdefghijkl"]
    for a in texts:
        for b in texts:
            assert likeness(parsed(fingerprint(a)), parsed(fingerprint(b))) == brute_likeness(a, b)


def test_long_texts_are_compared_over_all_their_anchors():
    rnd = random.Random(9)
    words = ["".join(rnd.choices("abcdefgh", k=rnd.randrange(3, 8))) for _ in range(3000)]
    text = " ".join(rnd.choices(words, k=20_000))
    assert len(text) > 100_000 and fingerprint(text)[0] == "h"
    few = text.split(" ")
    for i in rnd.sample(range(len(few)), 20):
        few[i] = "changed"
    passage = text[40_000:43_000]
    other = " ".join(rnd.choices(["".join(rnd.choices("stuvwxyz", k=6)) for _ in range(3000)], k=20_000))

    def exact(a: str, b: str) -> float:
        sides = [dict(reversed([*zip(*(x.tolist() for x in anchors(t)), strict=True)])) for t in (a, b)]
        one, two = sides
        places = np.array([two[h] for h in sorted(one, key=one.get) if h in two])
        return syncmers.in_order(places) / len(one.keys() | two.keys())

    for a, b in ((text, " ".join(few)), (text, text[25_000:]), (text, other[:50_000] + passage + other[50_000:]), (text, other)):
        near = likeness(parsed(fingerprint(a)), parsed(fingerprint(b)))
        assert abs(near - exact(a, b)) < 0.01
    assert likeness(parsed(fingerprint(text)), parsed(fingerprint(" ".join(few)))) < 1
    assert likeness(parsed(fingerprint(text)), parsed(fingerprint(other[:50_000] + passage + other[50_000:]))) > 0.005
    short = text[:3000]  # all its anchors against a half
    assert abs(likeness(parsed(fingerprint(short)), parsed(fingerprint(text))) - exact(short, text)) < 0.01


def test_successors_equal_brute_force(spark):
    rnd = random.Random(6)
    rows = [(i * 3, prose(i, rnd.randrange(0, 40)), "x") for i in range(60)] + [(7, None, "x"), (6, "zz", "x"), (9, "same", "y"), (9, "same", "y")]
    shuffled = rows[:]
    rnd.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "doc_id long, text string, part string").repartition(5)
    for parts in (1, 4, 200):
        got = with_successors(df, parts).collect()
        order = sorted((i, t or "") for i, t, _ in rows)
        want = []
        for n, (i, t) in enumerate(order):
            following = order[(n + 1) % len(order)][1]
            changed = edited(t, following)
            digest = hashlib.sha256(changed.encode()).hexdigest()
            near = (brute_likeness(t, changed), brute_likeness(t, following))
            want.append((i, len(t), digest, fingerprint(t), fingerprint(changed), *near))
        assert sorted(tuple(r) for r in got) == sorted(want)


def test_lone_null_and_no_documents(spark):
    df = spark.createDataFrame([(5, "abcdefgh")], "doc_id long, text string")
    row = with_successors(df, 3).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and row["near_next"] == 1.0
    assert with_successors(df.limit(0), 3).count() == 0
    nameless = spark.createDataFrame([(None, "abcd"), (None, None)], "doc_id long, text string")
    assert sorted(r["n_chars"] for r in with_successors(nameless, 3).collect()) == [0, 4]
