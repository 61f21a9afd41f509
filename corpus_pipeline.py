"""A corpus pipeline: reject, deduplicate, pseudonymise, mix, tokenise.

Each stage reads what the one before has written and keeps the columns of
``documents``, but for the last, which returns token ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starweave.llm import bpe, mixing, pii, quality, registry
from starweave.llm.ngram_join import JaccardJoin
from starweave.llm.tables import documents, free_name, table
from starweave.session import scratch_dir

#: Columns of documents.
KNOWN = ("doc_id", "text", "lang", "source", "n_chars")
#: Near duplicates share at least this percentage of their runs of this many words.
WORDS, PERCENT = 5, 80


def _aside(docs: DataFrame) -> tuple[DataFrame, list[Column]]:
    """``docs`` with columns that the operators know nothing of packed into one, and how to get all of them back.

    So an extra column may have any name, those of the operators' results included.
    """
    extra = [c for c in docs.columns if c not in KNOWN]
    if not extra:
        return docs, [F.col(c) for c in docs.columns]
    (kept,) = free_name(docs, "set_aside")
    packed = docs.select(*(c for c in docs.columns if c in KNOWN), F.struct(*(F.col(f"`{c}`") for c in extra)).alias(kept))
    return packed, [F.col(c) if c in KNOWN else F.col(kept)[c].alias(c) for c in docs.columns]


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior quality is at least one half."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    packed, back = _aside(docs)
    scored = quality.score(packed, model, F.col("source"), F.col("lang"))
    return scored.where("keep").select(*back)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates."""
    return JaccardJoin(WORDS, PERCENT).one_of_each(docs)


def replace_private_values(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for private values and ``n_chars`` of the new text."""
    return pii.pseudonymise(docs, registry.PSEUDONYM_KEY).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every time that the mix takes a document."""
    packed, back = _aside(docs)
    size, clean = free_name(packed, "n_words", "n_clean")
    counted = packed.withColumns({size: mixing.word_count(), clean: mixing.clean_words()})
    weight = mixing.quality_weight(F.col(size), F.col(clean))
    mixed = mixing.mix(counted, F.col(size), weight, seed="mix")
    return mixed.withColumn(size, F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select(*back)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, lang, n_tokens, ids`` (little-endian unsigned 32-bit) and whether they decode to the text."""
    vocabulary, pattern = bpe.default_vocabulary(spark)
    named = docs.select("doc_id", "source", "lang", "text")
    decoded = bpe.round_trip(named, vocabulary, pattern)
    exact = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return decoded.select(
        "doc_id", "source", "lang", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", exact.alias("exact")
    )


STAGES = [
    ("quality", reject_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("private_values", replace_private_values),
    ("source_mix", mix_sources),
    ("tokens", tokenise),
]

#: SQL expresses neither near duplicates by signatures, nor keyed permutations, nor BPE; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
