"""Language proportions of documents by expectation-maximisation.

A language is a distribution of hashed byte trigrams, counted over all its
training documents. A document is a mixture: its trigrams come from several
languages in unknown proportions, which expectation-maximisation estimates. The
language set grows while another language raises the likelihood by more than a
penalty that grows with the length of the text, so a lone borrowed word does not
add a language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starweave.llm.tables import free_name

#: Trigram hashes; a model has this many numbers for each language.
BUCKETS = 1 << 16
#: Languages whose counts a task holds before it passes them on.
HELD = 256
#: Trigrams share bytes, so likelihood gains are overstated by about this factor.
OVERLAP = 3.0
STEPS = 30
UNKNOWN = "und"

_PLAIN = np.full(256, 32, dtype=np.uint32)
_PLAIN[97:123] = np.arange(97, 123)
_PLAIN[128:] = np.arange(128, 256)


def trigrams(text: str) -> np.ndarray:
    """Hashes of the byte trigrams of lower-cased words; other characters are gaps."""
    raw = np.frombuffer(f" {text.lower()} ".encode(), dtype=np.uint8)
    b = _PLAIN[raw]
    one, two, three = b[:-2], b[1:-1], b[2:]
    real = (two != 32) | ((one != 32) & (three != 32))
    real &= (one != 32) | (two != 32)
    real &= (two != 32) | (three != 32)
    joined = (one << np.uint32(16) | two << np.uint32(8) | three)[real]
    return ((joined * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass(frozen=True)
class Languages:
    """Trigram distributions, one row per name."""

    names: tuple[str, ...]
    chance: np.ndarray  # names x BUCKETS, float32

    def mixture(self, text: str | None) -> list[tuple[str, float]]:
        """Selected languages with their proportions, largest first; ties by name. Empty without letters."""
        if not self.names or not has_letter(text):
            return []
        grams, counts = np.unique(trigrams(text), return_counts=True)
        if not len(grams):
            return []
        weight = counts.astype(np.float64)
        total = weight.sum()
        chance = self.chance[:, grams].astype(np.float64)
        alone = np.log(chance) @ weight
        chosen = [int(alone.argmax())]
        best, shares = alone[chosen[0]], np.ones(1)
        if len(self.names) > 1:
            everyone, _ = _proportions(chance, weight, total)
            penalty = OVERLAP * 0.5 * np.log(total + 1.0)
            for other in np.argsort(-everyone, kind="stable"):
                if other in chosen:
                    continue
                if everyone[other] * total < 1:
                    break  # less than one trigram's worth, and so are all behind it
                trial = [*chosen, int(other)]
                new_shares, likelihood = _proportions(chance[trial], weight, total)
                if (likelihood - best) / OVERLAP <= penalty / OVERLAP + np.log(len(self.names)):
                    continue  # a relative of a chosen language may stand before one that is really there
                chosen, shares, best = trial, new_shares, likelihood
        ranked = sorted(zip((self.names[i] for i in chosen), shares.tolist(), strict=True), key=lambda x: (-x[1], x[0]))
        return ranked


def _proportions(chance: np.ndarray, weight: np.ndarray, total: float) -> tuple[np.ndarray, float]:
    """Maximum-likelihood proportions of the given languages, and the likelihood."""
    shares = np.full(len(chance), 1.0 / len(chance))
    for _ in range(STEPS):
        new = shares * (chance @ (weight / (shares @ chance))) / total
        moved = np.abs(new - shares).max()
        shares = new
        if moved < 1e-4:
            break
    return shares, float(weight @ np.log(shares @ chance))


def _gram_counts(df: DataFrame) -> DataFrame:
    """``lang, gram, n`` of rows ``text, lang``: one row per language, trigram and task."""

    def rows(held: dict[str, np.ndarray]) -> pa.RecordBatch:
        langs, grams, counts = [], [], []
        for lang, table in held.items():
            filled = np.flatnonzero(table)
            langs += [lang] * len(filled)
            grams.append(filled)
            counts.append(table[filled])
        columns = [pa.array(langs, pa.string()), *(pa.array(np.concatenate(x or [[]]).astype(np.int64)) for x in (grams, counts))]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1), strict=True):
                name = lang.as_py()
                if name not in held:
                    if len(held) >= HELD:
                        yield rows(held)
                        held = {}
                    held[name] = np.zeros(BUCKETS, dtype=np.int64)
                grams, counts = np.unique(trigrams(text.as_py()), return_counts=True)
                held[name][grams] += counts
        yield rows(held)

    return df.mapInArrow(count, "lang string, gram long, n long")


def learn(df: DataFrame, text: str = "text", lang: str = "lang", smooth: float = 0.5) -> Languages:
    """Models of all languages of the rows, from all of them. Rows with a null text or language teach nothing.

    The driver receives at most ``BUCKETS`` numbers for each language.
    """
    known = df.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    counts = _gram_counts(known.select(F.col(text), F.col(lang).cast("string"))).groupBy("lang", "gram")
    seen = counts.agg(F.sum("n").alias("n")).toArrow()
    langs = np.array(seen.column("lang").to_pylist(), dtype=object)
    names = sorted(set(langs.tolist()))
    table = np.full((len(names), BUCKETS), smooth)
    place = {name: i for i, name in enumerate(names)}
    at = np.array([place[x] for x in langs], dtype=np.int64)
    if len(at):
        table[at, seen.column("gram").to_numpy()] += seen.column("n").to_numpy()
    chance = table / table.sum(1, keepdims=True)
    return Languages(tuple(names), chance.astype(np.float32))


def predict(df: DataFrame, model: Languages, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred``, ``score`` (its proportion of the text) and ``mixture`` (all selected languages).

    * ``und`` with score 0 for a text that is null or has no letter, or without any learned language.
    * Equal texts have equal results; whole texts are read. Columns of these three names are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)  # BUCKETS float32 for each language
    kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    @F.arrow_udf("array<struct<lang: string, share: double>>")
    def mixtures(texts: pa.Array) -> pa.Array:
        own = shared.value
        found = (own.mixture(t.as_py()) for t in texts)
        return pa.array([[{"lang": n, "share": s} for n, s in m] for m in found], kind)

    df = df.drop("lang_pred", "score", "mixture")
    (raw,) = free_name(df, "language_mixture")
    found: Column = F.get(F.col(raw), F.lit(0))
    return df.withColumn(raw, mixtures(F.col(text))).select(
        *df.columns,
        F.coalesce(found["lang"], F.lit(UNKNOWN)).alias("lang_pred"),
        F.least(F.coalesce(found["share"], F.lit(0.0)), F.lit(1.0)).alias("score"),
        F.col(raw).alias("mixture"),
    )
