"""Fingerprints of documents, of their edited texts and of the document after each.

Documents are cut into ranges of ids. The first document of every range is also
sent to the range before it, so each task sees every document with its
successor, and a text is shuffled once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starweave.llm.syncmers import Print, likeness, print_of

SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)
#: Rows given out at once.
ROWS = 512
#: Rows are given out earlier after so many characters: fingerprints grow with the texts.
CHARS = 1 << 21


def edited(text: str, following: str) -> str:
    """The last quarter (rounded down) of the code points replaced by the first ones of the next text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n] if n else text


def _range_of(lows: list[int]) -> Callable[[Column], Column]:
    """Number of the range, by the lowest id of each."""
    bounds = np.array(lows, dtype=np.int64)

    @F.arrow_udf("int")
    def find(ids: pa.Array) -> pa.Array:
        return pa.array((np.searchsorted(bounds, ids.to_numpy(), side="right") - 1).astype(np.int32))

    return find


def _lows(df: DataFrame, parts: int) -> list[int]:
    """Lowest id of each range that has rows, in order; at most ``parts``."""
    cuts = df.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], 10_000)).first()[0]
    if not cuts:
        return []
    near = _range_of([np.iinfo(np.int64).min, *sorted(set(cuts))])
    found = df.groupBy(near(F.col("doc_id")).alias("part")).agg(F.min("doc_id").alias("low")).collect()
    return sorted(row["low"] for row in found)


def with_successors(df: DataFrame, parts: int) -> DataFrame:
    """Fingerprint rows of all documents ``doc_id, text``; see ``SCHEMA``.

    * The order is by id, then text. The last document's successor is the first one; a lone document is its own.
    * A null text counts as empty. Repeated rows are documents of their own.
    * Rows with a null id have no place in the order and come without a successor: their edited text loses its
      last quarter, and ``near_next`` is null.
    * An empty table gives an empty result. Only ``doc_id`` and ``text`` are read of other columns.
    """
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    placed = docs.where(F.col("doc_id").isNotNull())
    lows = _lows(placed, parts)  # one for each range
    count = max(len(lows), 1)
    own = _range_of(lows or [0])(F.col("doc_id"))
    lowest = F.array(*(F.lit(low).cast("long") for low in lows or [0]))
    here = F.struct(F.col("part"), F.lit(False).alias("is_next"))
    first = F.col("doc_id") == F.get(lowest, F.col("part"))
    before = F.when(first, F.struct(F.pmod(F.col("part") - 1, F.lit(count)).alias("part"), F.lit(True).alias("is_next")))
    sent = (
        placed.withColumn("part", own)
        .withColumn("to", F.explode(F.array_compact(F.array(here, before))))
        .select("to.part", "to.is_next", "doc_id", "text")
    )
    lone = docs.where(F.col("doc_id").isNull()).select(
        (-1 - F.pmod(F.hash("text"), F.lit(parts))).alias("part"), F.lit(False).alias("is_next"), "doc_id", "text"
    )
    dealt = sent.unionByName(lone).repartitionById(parts, F.pmod("part", F.lit(parts)))
    return dealt.sortWithinPartitions("part", "is_next", "doc_id", "text").mapInArrow(_pairs, SCHEMA)


def _row(doc_id: int | None, text: str, own: Print, following: tuple[str, Print] | None) -> dict:
    changed = edited(text, following[0] if following else "")
    print_edited = own if changed == text else print_of(changed)
    return {
        "doc_id": doc_id,
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(changed.encode("utf-8")).hexdigest(),
        "fingerprint": str(own),
        "edited_fingerprint": str(print_edited),
        "near_edited": likeness(own, print_edited),
        "near_next": likeness(own, following[1]) if following else None,
    }


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: tuple[int | None, str, Print] | None = None
    part: int | None = None
    ended = False
    rows: list[dict] = []
    chars = 0
    for batch in batches:
        for i in range(batch.num_rows):
            here, is_next, doc_id, text = (c[i].as_py() for c in batch.columns)
            if here != part:
                part, waiting, ended = here, None, False
            if ended:
                continue  # further rows with the successor's id
            print_ = print_of(text)
            if part < 0:
                rows.append(_row(doc_id, text, print_, None))
            else:
                if waiting is not None:
                    rows.append(_row(*waiting, (text, print_)))
                waiting, ended = (doc_id, text, print_), is_next
            chars += len(text)
            if len(rows) >= ROWS or chars > CHARS:
                yield pa.RecordBatch.from_pylist(rows, _ARROW)
                rows, chars = [], 0
    yield pa.RecordBatch.from_pylist(rows, _ARROW)
