"""Frequent phrases by Toivonen's method, scored as collocations.

A sample proposes frequent phrases. A full pass counts, exactly, what they propose and its
negative border: every word, and every phrase whose parts one word shorter are all proposed.
Where the border turns out to hold a frequent phrase, longer ones behind it were not counted;
a further pass then counts what the exact sets newly admit, until nothing is missing.

What a pass admits is decided by Bloom filters of bounded size over the proposed phrases. A false
positive is counted as well, exactly; nothing is ever missed. Every phrase is counted in one pass
alone, the first whose filters admit it, so the tables of all passes add up without overlaps.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starweave.llm.shingles import mix, word_hashes
from starweave.session import stage

#: Bytes of text counted at once; a longer text is cut at a separator, with the words before the cut as context.
SLICE = 1 << 21
#: Rows of an Arrow batch that a task hands over.
ROWS = 1 << 15
#: Bits of a filter: at least, at most (8 MB), and for each phrase in between.
LEAST_BITS, MOST_BITS, BITS_EACH = 16, 26, 16
#: Share of the rows in the sample, and how often the sample must hold what it proposes.
SHARE, SAMPLE_COUNT = 0.25, 2
#: A phrase that a slice holds so often is summed over a task's slices, in a table of so many phrases.
OFTEN, HELD = 8, 1 << 16
#: Shares in which a language is ranked before its best phrases meet in one task.
SHARES = 16

#: What separates pieces, and words inside a piece.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
WHITE = b"\x20\x09"

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[list(WHITE)] = 1
_KIND[list(BREAKS)] = 2
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_SEPARATOR = re.compile(b"[" + re.escape(WHITE + BREAKS) + b"]")
_WORD = re.compile(b"[^" + re.escape(WHITE + BREAKS) + b"]+")
_COUNTS = "lang string, k int, phrase string, f long"
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Bloom:
    """A set of 64-bit hashes that may answer yes for others too; two bits for each."""

    words: np.ndarray

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64(len(self.words) * 64 - 1)
        return hashes & mask, (hashes >> np.uint64(32)) & mask

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), dtype=bool)
        for at in self.places(hashes):
            found &= (self.words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return found


def _salt(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def _extend(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one more word behind."""
    return mix(phrase * _FACTOR + word)


def _bits_of(k: int, bits: int):
    """For batches of ``lang, phrase`` (``k`` words each): the filled words of the filter."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = Bloom(np.zeros(1 << bits - 6, dtype=np.uint64))
        for batch in batches:
            if not batch.num_rows:
                continue
            words = word_hashes(" ".join(batch["phrase"].to_pylist())).reshape(-1, k)
            langs = batch["lang"].dictionary_encode()
            salts = np.array([_salt(x) for x in langs.dictionary.to_pylist()], dtype=np.uint64)
            hashes = mix(words[:, 0] ^ salts[langs.indices.to_numpy()])
            for i in range(1, k):
                hashes = _extend(hashes, words[:, i])
            for at in bloom.places(hashes):
                np.bitwise_or.at(bloom.words, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
        filled = np.flatnonzero(bloom.words)
        values = bloom.words[filled].view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(filled, pa.int64()), pa.array(values, pa.int64())], names=["at", "bits"])

    return fill


def bloom(phrases: DataFrame, k: int) -> Bloom:
    """The filter over ``lang, phrase``. Its words are combined by Spark; at most ``2 ** (MOST_BITS - 6)`` reach the driver."""
    wanted = max(phrases.count() * BITS_EACH, 1)
    bits = min(max(wanted.bit_length(), LEAST_BITS), MOST_BITS)
    filled = phrases.select("lang", "phrase").mapInArrow(_bits_of(k, bits), "at long, bits long")
    rows = filled.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(1 << bits - 6, dtype=np.uint64)
    words[rows["at"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return Bloom(words)


@dataclass(frozen=True)
class Generation:
    """What a pass admits: ``filters[k]`` are the phrases of ``k`` words that longer ones may be built from."""

    filters: dict[int, Bloom]


def _blocks(raw: bytes, context: int) -> Iterator[tuple[bytes, int]]:
    """Parts of a long text, each with the number of words in front that were in the part before."""
    start = stop = known = 0
    while stop < len(raw):
        found = _SEPARATOR.search(raw, min(stop + SLICE, len(raw)))
        stop = found.start() if found else len(raw)
        yield raw[start:stop], known
        window = 1 << 12
        while True:
            from_ = max(start, stop - window)
            at = [m.start() for m in _WORD.finditer(raw, from_, stop)]
            if from_ == start or len(at) > context:
                break
            window *= 4
        at = at[-context:]
        start, known = (at[0], len(at)) if at else (stop, 0)


def _gathered(texts: Sequence[bytes], context: int) -> Iterator[tuple[bytes, int]]:
    """Short texts joined by a break, long ones in parts."""
    waiting: list[bytes] = []
    size = 0
    for text in texts:
        if len(text) > SLICE:
            yield from _blocks(text, context)
            continue
        if size + len(text) > SLICE:
            yield b"\n".join(waiting), 0
            waiting, size = [], 0
        waiting.append(text)
        size += len(text) + 1
    if waiting:
        yield b"\n".join(waiting), 0


def _words_in(buffer: bytes) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Numbers of the words in order, the distinct words, and the piece of each word."""
    raw = np.frombuffer(buffer, dtype=np.uint8)
    kind = _KIND[raw]
    inside = kind == 0
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    offsets = np.zeros(len(starts) + 1, dtype=np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.BinaryArray.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])]
    ).dictionary_encode()
    piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
    return words.indices.to_numpy().astype(np.int64), words.dictionary, piece


def _admitted(generations: Sequence[Generation], shorter: int, hashes: np.ndarray, built: np.ndarray) -> np.ndarray:
    """For each generation, which of the phrases that it has ``built`` its filter holds.

    A filter may hold a phrase by mistake whose own parts its generation lacks. Only a later pass comes to such a
    phrase, so it must not count as one that the earlier pass went on from.
    """
    out = np.zeros((len(generations), len(hashes)), dtype=bool)
    for g, generation in enumerate(generations):
        here = np.flatnonzero(built[g])
        if shorter in generation.filters:
            out[g, here] = generation.filters[shorter].holds(hashes[here])
    return out


def _count(buffer: bytes, known: int, lang: str, generations: Sequence[Generation], longest: int) -> list[tuple]:
    """``k``, phrases and counts of what the last generation admits and no earlier one did.

    With one generation, all words are counted as well, and under ``k`` 0 their number.
    """
    ids, distinct, piece = _words_in(buffer)
    n = len(ids)
    if n <= known:
        return []
    out = []
    if len(generations) == 1:
        times = np.bincount(ids[known:], minlength=len(distinct))
        seen = np.flatnonzero(times)
        out.append((0, pa.array([b""], pa.binary()), np.array([n - known])))
        out.append((1, distinct.take(pa.array(seen)), times[seen]))
    words = word_hashes(b" ".join(distinct.to_pylist()).decode("utf-8"))[ids]
    hashes = mix(words ^ _salt(lang))
    both = np.ones((len(generations), n), dtype=bool)
    for k in range(2, longest + 1):
        holds = _admitted(generations, k - 1, hashes, both)
        both = holds[:, : n - k + 1] & holds[:, 1 : n - k + 2]
        inside = piece[: n - k + 1] == piece[k - 1 :]
        both &= inside
        hashes = _extend(hashes[: n - k + 1], words[k - 1 :])
        fresh = both[-1] & ~both[:-1].any(axis=0)
        fresh[: max(known - k + 1, 0)] = False
        at = np.flatnonzero(fresh)
        if len(at):
            key = ids[at]
            for i in range(1, k):
                if i > 1:
                    key = np.unique(key, return_inverse=True)[1]
                key = key * len(distinct) + ids[at + i]
            _, first, times = np.unique(key, return_index=True, return_counts=True)
            parts = [distinct.take(pa.array(ids[at[first] + i])) for i in range(k)]
            out.append((k, pc.binary_join_element_wise(*parts, b" "), times))
        if n - k < 1:
            break
    return out


def _batches(lang: str, k: int, phrases: pa.Array, times: np.ndarray) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(times), ROWS):
        part = times[start : start + ROWS]
        columns = [
            pa.repeat(lang, len(part)),
            pa.repeat(pa.scalar(k, pa.int32()), len(part)),
            phrases.slice(start, ROWS).cast(pa.string()),
            pa.array(part, pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "k", "phrase", "f"])


class Often:
    """Counts of phrases that many slices of a task hold, so that the task hands over one row for them."""

    def __init__(self) -> None:
        self.counts: dict[tuple[str, int], Counter[bytes]] = {}
        self.held = 0

    def take(self, lang: str, k: int, phrases: pa.Array, times: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Rows of the rarer phrases; and what is held so far, if that is too much."""
        often = times >= OFTEN
        own = self.counts.setdefault((lang, k), Counter())
        before = len(own)
        for phrase, n in zip(phrases.filter(pa.array(often)).to_pylist(), times[often].tolist(), strict=True):
            own[phrase] += n
        self.held += len(own) - before
        if not often.all():
            yield from _batches(lang, k, phrases.filter(pa.array(~often)), times[~often])
        if self.held > HELD:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        for (lang, k), own in self.counts.items():
            if own:
                yield from _batches(lang, k, pa.array(list(own), pa.binary()), np.array(list(own.values())))
        self.counts, self.held = {}, 0


def _counts_of(generations: Sequence[Generation], longest: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = Often()
        for batch in batches:
            langs = batch["lang"].dictionary_encode()
            texts = batch["text"].cast(pa.binary())
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                own = texts.filter(pc.equal(langs.indices, i))
                lowered = (t.as_py().translate(_LOWER) for t in own)
                for buffer, known in _gathered(lowered, longest - 1):
                    for k, phrases, times in _count(buffer, known, lang, generations, longest):
                        yield from often.take(lang, k, phrases, times)
        yield from often.rest()

    return count


def _pass(docs: DataFrame, generations: Sequence[Generation], longest: int, least: int) -> DataFrame:
    """Counts of at least ``least``, in the shared folder; ``k`` 0 holds the number of words."""
    counted = docs.mapInArrow(_counts_of(generations, longest), _COUNTS)
    # Tasks have summed what is frequent. The rest is mostly unique: to look for repeats before the shuffle would cost
    # a large table in every task and find few.
    dealt = counted.repartition("lang", "k", "phrase")
    total = dealt.groupBy("lang", "k", "phrase").agg(F.sum("f").alias("f"))
    return stage(total.where((F.col("f") >= least) | (F.col("k") == 0)), "phrases")


def _everything() -> Bloom:
    return Bloom(np.full(1, np.iinfo(np.uint64).max, dtype=np.uint64))


def frequent(
    docs: DataFrame, least: int, longest: int, share: float = SHARE, sample_count: int = SAMPLE_COUNT
) -> DataFrame:
    """``lang, k, phrase, f`` of all phrases that occur ``least`` times or more, exactly; ``k`` 0: number of words.

    ``docs`` has ``lang`` and ``text`` without nulls. The sample only decides how much the first full pass
    admits: any sample gives the same result.
    """
    proposed = _proposed(docs.sample(share, seed=7), sample_count, longest)
    generations = [Generation({k: bloom(proposed.where(F.col("k") == k), k) for k in range(1, longest)})]
    found = _pass(docs, generations, longest, least)
    known = proposed
    while True:
        short = found.where(F.col("k").between(1, longest - 1))
        failures = short.join(known, ["lang", "k", "phrase"], "left_anti")
        if failures.isEmpty():
            return found
        known = short
        generations.append(Generation({k: bloom(short.where(F.col("k") == k), k) for k in range(1, longest)}))
        found = found.union(_pass(docs, generations, longest, least))


def _proposed(sample: DataFrame, least: int, longest: int) -> DataFrame:
    """``lang, k, phrase`` that the sample holds often enough, shorter than the longest."""
    all_ = [Generation({k: _everything() for k in range(1, longest - 1)})]
    counts = _pass(sample, all_, longest - 1, least)
    return counts.where("k > 0").select("lang", "k", "phrase")


def _words(phrase: Column) -> Column:
    return F.split(phrase, " ")


def _joined(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def scored(counts: DataFrame) -> DataFrame:
    """``lang, phrase, k, a, l, r, score`` of every phrase of two words or more, by its lowest-scoring cut.

    The score is the whole part of ``1000000 * a * a / (l * r)`` in decimals of 38 digits: exact for counts
    below 10^15.
    """
    many = counts.where("k > 1").select("lang", "k", "phrase", F.col("f").alias("a"))
    cuts = many.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    words = _words(F.col("phrase"))
    halves = cuts.withColumns(
        {
            "head": _joined(words, F.lit(1), F.col("cut")),
            "tail": _joined(words, F.col("cut") + 1, F.col("k") - F.col("cut")),
        }
    )
    part = counts.where("k > 0").select("lang", F.col("phrase").alias("part"), F.col("f"))
    head = part.select("lang", F.col("part").alias("head"), F.col("f").alias("l"))
    tail = part.select("lang", F.col("part").alias("tail"), F.col("f").alias("r"))
    both = halves.join(head, ["lang", "head"]).join(tail, ["lang", "tail"])
    score = F.expr(
        "cast(a as decimal(15, 0)) * cast(a as decimal(15, 0)) * cast(1000000 as decimal(7, 0))"
        " div (cast(l as decimal(15, 0)) * cast(r as decimal(15, 0)))"
    )
    lowest = both.groupBy("lang", "phrase").agg(
        F.min(F.struct(score.alias("score"), "cut", "l", "r", "k", "a")).alias("best")
    )
    return lowest.select("lang", "phrase", *(F.col(f"best.{c}").alias(c) for c in ("k", "a", "l", "r", "score")))


def _runs(phrase: Column, words: Column, m: int) -> Column:
    """All runs of ``m`` words of a phrase."""
    return F.transform(F.sequence(F.lit(1), words - m + 1), lambda i: _joined(_words(phrase), i, F.lit(m)))


def _covered(counts: DataFrame, longest: int) -> DataFrame:
    """``lang, phrase, inside``: the highest count among the longer frequent phrases that hold a phrase."""
    longer = counts.where("k > 2")
    legs = [
        longer.where(F.col("k") > m).select("lang", F.explode(_runs(F.col("phrase"), F.col("k"), m)).alias("phrase"), "f")
        for m in range(2, longest)
    ]
    if not legs:
        return counts.where("false").select("lang", "phrase", F.col("f").alias("inside"))
    out = legs[0]
    for leg in legs[1:]:
        out = out.union(leg)
    return out.groupBy("lang", "phrase").agg(F.max("f").alias("inside"))


def collocations(
    df: DataFrame,
    least: int = 10,
    longest: int = 3,
    covered_percent: int = 50,
    top: int = 2000,
    text: Column | None = None,
    lang: Column | None = None,
) -> DataFrame:
    """The best ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A-Z are lower-cased; texts are split into pieces and words as ``BREAKS`` and ``WHITE`` say, and phrases lie
    within a piece. A phrase of 2 to ``longest`` words with a count ``a`` of ``least`` or more is a candidate; it goes
    if a longer candidate holds it whose count is ``covered_percent`` of ``a`` or more. A null text counts as empty,
    a null language as ``und``; repeated rows count each time; no candidates give no rows. Ties in score go to the
    larger ``a``, then to the phrase that comes first by its bytes. ``longest`` is 2 or more.
    """
    text = F.col("text") if text is None else text
    lang = F.col("lang") if lang is None else lang
    docs = df.select(F.coalesce(lang, F.lit("und")).alias("lang"), text.alias("text")).where("text is not null")
    counts = frequent(docs, least, longest)
    ranked = scored(counts).join(_covered(counts, longest), ["lang", "phrase"], "left")
    kept = ranked.where(F.col("inside").isNull() | (F.col("inside") * 100 < F.col("a") * covered_percent))
    order = (F.col("score").desc(), F.col("a").desc(), "phrase")
    # The best of each share of a language first: the last task then sees SHARES * top rows of a language, whatever its size.
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SHARES))).orderBy(*order)
    leading = kept.withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= top)
    whole = Window.partitionBy("lang").orderBy(*order)
    best = leading.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= top)
    sizes = counts.where("k = 0").select("lang", F.col("f").alias("n"))
    return best.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
