"""The queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starweave.llm import (
    bpe,
    collocations,
    language,
    merkle,
    mixing,
    multi_index,
    neighbours,
    oracle,
    pieces,
    pii,
    quality,
    sharding,
    wrappers,
)
from starweave.llm.ngram_join import JaccardJoin
from starweave.llm.tables import documents, table, text_or_empty
from starweave.session import stage


#: Pseudonyms of the registered query; a real run brings its own secret.
PSEUDONYM_KEY = "starweave-example-key"


def op1_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    # The texts are read once; sums and results come from this narrow table.
    known = stage(docs.select("doc_id", "source", "lang", model.log_odds("text").alias("odds")), "evidence")
    scored = quality.score(known, model, F.col("source"), F.col("lang"), log_odds=F.col("odds"))
    return scored.select("doc_id", "p_doc", "host_rate", "path_rate", "posterior", "keep")


def held_out() -> Column:
    """Documents that the language models don't learn from; a null id counts as an empty one."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language.learn(docs.where(~held_out()).select("text", "lang"))
    return language.predict(docs.select("doc_id", "text", held_out().alias("held_out")), model).select(
        "doc_id", "held_out", "lang_pred", "score"
    )


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary, pattern = bpe.default_vocabulary(spark)
    both = bpe.round_trip(documents(spark, sf_dir).select("doc_id", "text"), vocabulary, pattern)
    return bpe.digests(both).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return neighbours.with_successors(documents(spark, sf_dir), parts)


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return JaccardJoin(words=4, percent=85).run(documents(spark, sf_dir))[0].drop("text_hash")


def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return pii.pseudonymise(docs, PSEUDONYM_KEY, count="n_private")


def op7_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20)


def op8_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = text_or_empty().cast("binary")
    narrow = documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(raw) + 8).cast("long").alias("size"), F.crc32(raw).alias("text_crc32")
    )
    order = [F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    return sharding.shard_by_bytes(narrow, F.col("size"), order, 24).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = documents(spark, sf_dir).select(
        "doc_id", "source", mixing.word_count().alias("size"), mixing.clean_words().alias("clean")
    )
    counted = stage(words, "counted")  # the mix looks at it several times
    quality_ = mixing.quality_weight(F.col("size"), F.col("clean"))
    return mixing.mix(counted, F.col("size"), quality_, seed="mix").select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return wrappers.extract(pages).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "source", "lang", "n_chars", "text")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0

    def fields(n_chars: Column) -> list[Column]:
        return [F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")]

    claimed = F.when(tampered, merkle.leaf_digest(*fields(F.col("n_chars") + 1)))
    made = merkle.manifest(docs, fields(F.col("n_chars")), [F.col("doc_id")], F.col("lang"), ["doc_id"], claimed)
    return made.prove()


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = pieces.round_trip(documents(spark, sf_dir).select("doc_id", "text"), pieces.default_model(spark))
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "agrees",
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir).select("lang", "text"))


QUERIES = {
    "op1_site_quality": op1_site_quality,
    "op2_language": op2_language,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_fingerprints": op4_fingerprints,
    "op5_ngram_join": op5_ngram_join,
    "op6_pseudonyms": op6_pseudonyms,
    "op7_multi_index": op7_multi_index,
    "op8_byte_shards": op8_byte_shards,
    "op9_source_mix": op9_source_mix,
    "op10_main_text": op10_main_text,
    "op11_merkle": op11_merkle,
    "op12_pieces": op12_pieces,
    "op13_collocations": op13_collocations,
}

SQL = oracle.SQL
