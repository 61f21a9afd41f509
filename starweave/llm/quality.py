"""Quality by hierarchical empirical Bayes.

A logistic model, fitted on a bounded sample of labelled documents, turns the
shape of a text into evidence for or against it. The mean evidence of every host
and of every path on a host is gathered by grouped sums over all documents; how
far hosts differ among each other, and paths within a host, sets how strongly a
small host is pulled to the whole corpus and a small path to its host. A
document's posterior joins its own evidence with the rate of its path, taken
without the document itself.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starweave.llm.mixing import clean_words, word_count
from starweave.llm.tables import free_name
from starweave.session import stage

#: Labelled rows used to fit the model at most, picked by a hash of their id.
SAMPLE = 20_000
#: A rate or probability is kept this far from 0 and 1.
MARGIN = 1e-6
#: Prior documents a group may be worth, at least and at most.
STRENGTH = (1.0, 1000.0)


def features(text: str = "text") -> list[Column]:
    """What the model sees of a text; a null text counts as empty."""
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.greatest(word_count(text), F.lit(1)).cast("double")
    chars = F.greatest(F.length(whole), F.lit(1)).cast("double")
    again = F.regexp_count(whole, F.lit(r"(?<![^\s])([^\s]+)(?=\s\1(?![^\s]))"))
    upper = F.regexp_count(whole, F.lit(r"\p{Lu}{2,}"))
    marks = F.regexp_count(whole, F.lit(r"[^\p{L}\p{N}\s.,;:?'\"()-]+"))
    return [
        clean_words(text) / words,
        again / words,
        upper / words,
        marks / words,
        F.log1p(words),
        chars / words / 10.0,
    ]


@dataclass(frozen=True)
class Evidence:
    """Logistic model of standardised features; ``base`` is the share of good documents it was fitted on."""

    weights: tuple[float, ...]
    bias: float
    base: float

    def log_odds(self, text: str = "text") -> Column:
        score = F.lit(self.bias)
        for w, f in zip(self.weights, features(text), strict=True):
            score = score + F.lit(w) * f
        return F.greatest(F.least(score, F.lit(30.0)), F.lit(-30.0))


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Evidence:
    """The model from labels ``id, quality`` (1 good, 0 bad; null is no label).

    Without labels of both kinds no document has evidence against it.
    """
    picked = (
        labels.where(F.col("quality").isNotNull() & F.col(id).isNotNull())
        .orderBy(F.xxhash64(id), id, "quality")
        .limit(sample)
        .select(F.col(id), F.col("quality").cast("double").alias("good"))
    )
    rows = docs.select(id, text).join(F.broadcast(picked), id)  # at most ``sample`` rows
    names = [f"f{i}" for i in range(len(features(text)))]
    seen = rows.select("good", *(f.alias(n) for f, n in zip(features(text), names, strict=True))).toArrow()
    y = seen.column("good").to_numpy()
    x = np.column_stack([seen.column(n).to_numpy() for n in names]) if len(y) else np.zeros((0, len(names)))
    if len(y) == 0 or y.min() == y.max():
        return Evidence((0.0,) * len(names), 0.0, 0.5)
    order = np.lexsort((*x.T, y))  # the same sums in every run
    return _logistic(x[order], y[order])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> Evidence:
    mean, spread = x.mean(0), x.std(0)
    spread[spread == 0] = 1.0
    z = np.column_stack([(x - mean) / spread, np.ones(len(y))])
    w = np.zeros(z.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[-1, -1] = 0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (p - y) / len(y) + penalty @ w
        curve = (z * (p * (1 - p))[:, None]).T @ z / len(y) + penalty + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    weights = w[:-1] / spread
    return Evidence(tuple(map(float, weights)), float(w[-1] - weights @ mean), float(y.mean()))


def _logit(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(1 - MARGIN)), F.lit(MARGIN))
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, parent: Column) -> Column:
    """Prior documents by moments: how much group rates vary beyond what their sizes explain."""
    noise = parent * (1 - parent)
    excess = F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - parent, 2)) - F.sum(noise)
    between = F.try_divide(excess, F.sum("n") - F.sum(F.col("n") * F.col("n")) / F.sum("n"))
    prior = F.try_divide(F.sum(noise * F.col("n")) / F.sum("n"), between) - 1
    low, high = STRENGTH
    return F.when(between > 0, F.greatest(F.least(prior, F.lit(high)), F.lit(low))).otherwise(F.lit(high))


def site_rates(scored: DataFrame) -> DataFrame:
    """``host, path, s, n, host_s, host_n, mean, host_prior, path_prior`` from rows ``host, path, p``.

    One row per path. Sums are combined in each task first, so a hot host costs a row per task.
    """
    paths = stage(scored.groupBy("host", "path").agg(F.sum("p").alias("s"), F.count("*").alias("n")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    whole = hosts.agg((F.sum("s") / F.sum("n")).alias("mean"))
    host_level = hosts.join(F.broadcast(whole)).agg(  # one row
        F.first("mean").alias("mean"), _strength(hosts, F.col("mean")).alias("host_prior")
    )
    shrunk = hosts.join(F.broadcast(host_level)).select(
        "host", F.col("s").alias("host_s"), F.col("n").alias("host_n"), "mean", "host_prior"
    )
    joined = paths.join(shrunk.withColumnRenamed("host", "of"), F.col("host").eqNullSafe(F.col("of"))).drop("of")
    rate = (F.col("host_s") + F.col("host_prior") * F.col("mean")) / (F.col("host_n") + F.col("host_prior"))
    path_level = joined.agg(_strength(joined, rate).alias("path_prior"))  # one row
    return stage(joined.join(F.broadcast(path_level)), "site-rates")


def score(
    df: DataFrame,
    model: Evidence,
    host: Column,
    path: Column,
    text: str = "text",
    least: float = 0.5,
    log_odds: Column | None = None,
) -> DataFrame:
    """``df`` with ``p_doc``, ``host_rate``, ``path_rate``, ``posterior`` and ``keep`` (posterior at least ``least``).

    * A null host or path is a site of its own. A null or empty text is judged as a text of no words.
    * Equal rows have equal results. An empty table gives an empty result.
    * Columns of these five names are replaced; all other columns are kept.
    * ``log_odds`` gives the documents' evidence where it is known; texts are then not read, else twice.
    """
    df = df.drop("p_doc", "host_rate", "path_rate", "posterior", "keep")
    odds, of_host, of_path = free_name(df, "log_odds", "own_host", "own_path")
    own = model.log_odds(text) if log_odds is None else log_odds
    scored = df.select(host.alias("host"), path.alias("path"), (1 / (1 + F.exp(-own))).alias("p"))
    rates = site_rates(scored)
    names = {c: n for c, n in zip(rates.columns, free_name(df, *(f"site_{c}" for c in rates.columns)), strict=True)}
    sites = rates.withColumnsRenamed(names)
    col = lambda c: F.col(names[c])
    rows = df.withColumns({odds: own, of_host: host, of_path: path})
    match = F.col(of_host).eqNullSafe(col("host")) & F.col(of_path).eqNullSafe(col("path"))
    p = 1 / (1 + F.exp(-F.col(odds)))
    host_rate = (col("host_s") - p + col("host_prior") * col("mean")) / (col("host_n") - 1 + col("host_prior"))
    path_rate = (col("s") - p + col("path_prior") * F.col("host_rate")) / (col("n") - 1 + col("path_prior"))
    base = float(np.clip(model.base, MARGIN, 1 - MARGIN))
    evidence = F.col(odds) - float(np.log(base / (1 - base)))
    return (
        rows.join(sites, match)
        .withColumn("p_doc", p)
        .withColumn("host_rate", host_rate)
        .withColumn("path_rate", path_rate)
        .withColumn("posterior", 1 / (1 + F.exp(-(evidence + _logit(F.col("path_rate"))))))
        .withColumn("keep", F.col("posterior") >= least)
        .select(*df.columns, "p_doc", "host_rate", "path_rate", "posterior", "keep")
    )
