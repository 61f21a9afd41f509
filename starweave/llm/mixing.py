"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets an exponential key, ``-ln(u) / quality``, with ``u`` from a
hash of its id, so reruns agree. A source takes as many complete epochs as its
target holds; for the rest, its documents are taken in key order until their
running size reaches the budget. Running sizes are exact prefix sums over key
ranges, so a source with a third of all rows is worked on by many tasks. They
give the last key that a source takes, and every row is compared with that, so
texts are not shuffled. Only DataFrame operations are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starweave.llm.prefix import running
from starweave.llm.tables import WORD, free_name
from starweave.session import stage

#: Least quality weight; keeps every document selectable.
LEAST_QUALITY = 0.05


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def clean_words(text: str = "text") -> Column:
    """Words of letters only, with at most one ordinary mark after them."""
    outside = WORD.rstrip("+")
    pattern = rf"(?<!{outside})\p{{L}}+[.,;:?]?(?!{outside})"
    return F.coalesce(F.regexp_count(F.col(text), F.lit(pattern)), F.lit(0)).cast("long")


def quality_weight(size: Column, clean: Column) -> Column:
    """Share of clean words, at least ``LEAST_QUALITY``."""
    share = clean.cast("double") / F.greatest(size, F.lit(1)).cast("double")
    return F.greatest(share, F.lit(LEAST_QUALITY))


def uniform(seed: str, id: Column) -> Column:
    """A number in (0, 1) from 52 bits of a hash of seed and id; a null id has one of its own."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(id.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def targets(totals: DataFrame, cycle: Sequence[int], share: float, most: float) -> DataFrame:
    """``source, source_size`` with ``target``; one row per source.

    Sources by code point, null last, get the weights of ``cycle`` in turn and share ``share`` times all sizes.
    No target is above ``most`` times its source's size; the excess is shared by weight among the others. In
    order of cap per weight, capped sources come first, so one pass finds the level of the others.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*(F.lit(float(w)) for w in cycle))
    weighted = totals.select(
        "source",
        "source_size",
        F.get(weights, ((F.row_number().over(by_name) - 1) % len(cycle)).cast("int")).alias("weight"),
        (F.col("source_size") * most).alias("cap"),
    )
    by_cap = Window.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last())
    before, rest = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    levelled = weighted.select(
        "*",
        (F.sum("source_size").over(Window.partitionBy()) * share).alias("all"),
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("capped"),
        F.sum("weight").over(rest).alias("open"),
    ).withColumn("level", (F.col("all") - F.col("capped")) / F.col("open"))
    final = levelled.withColumn("is_capped", F.col("cap") / F.col("weight") <= F.col("level"))
    level = F.first(F.when(~F.col("is_capped"), F.col("level")), ignorenulls=True).over(
        by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return final.select(
        "source", "source_size", F.when(F.col("is_capped"), F.col("cap")).otherwise(F.col("weight") * level).alias("target")
    )


def mix(
    df: DataFrame,
    size: Column,
    quality: Column,
    seed: str,
    cycle: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    id: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """``df`` with ``size``, ``source_size``, ``target`` of its source, ``copies`` and ``taken`` (size times copies).

    * A null or negative size counts as 0; such rows are taken with the others, for 0. A null, NaN or non-positive
      quality counts as ``LEAST_QUALITY``. A null source is a source of its own, the last one.
    * The document on the budget's edge is taken if at least half of it fits. Equal keys (repeated ids) follow
      size; rows that are equal in both are taken together.
    * An empty table gives an empty result. Columns of these five names are replaced.
    """
    df = df.withColumn("size", F.greatest(F.coalesce(size.cast("long"), F.lit(0)), F.lit(0)))
    df = df.drop("source_size", "target", "copies", "taken")
    key, from_, whole, last = free_name(df, "es_key", "from_source", "epochs", "last_key")
    safe = F.when((quality > 0) & ~F.isnan(quality), quality).otherwise(F.lit(LEAST_QUALITY))
    keyed = df.withColumn(key, F.struct((-F.log(uniform(seed, F.col(id))) / safe).alias("k"), F.col(id).alias("id"), F.col("size")))
    narrow = keyed.select(F.col(source).alias("source"), F.col(key).alias("key"), "size")
    summed = running(narrow, F.col("size"), [F.col("key")], [F.col("source")])
    totals = summed.groupBy("source").agg(F.sum("size").alias("source_size"))
    epochs = F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))
    goals = targets(totals, cycle, share, most).withColumn("epochs", epochs)
    goals = goals.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    chosen = (F.col("budget") > 0) & (F.col("upto") - F.col("size") / 2.0 <= F.col("budget"))
    edges = (
        summed.join(goals.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .groupBy("of", "source_size", "target", "epochs")
        .agg(F.max(F.when(chosen, F.col("key"))).alias("last"))
    )
    plan = stage(edges, "mix-plan").select(  # one row per source
        F.col("of").alias(from_), "source_size", "target", F.col("epochs").alias(whole), F.col("last").alias(last)
    )
    copies = (F.col(whole) + F.when(F.col(key) <= F.col(last), 1).otherwise(0)).cast("long")
    return (
        keyed.join(plan, keyed[source].eqNullSafe(plan[from_]))
        .select(*df.columns, "source_size", "target", copies.alias("copies"))
        .withColumn("taken", F.col("copies") * F.col("size"))
    )
