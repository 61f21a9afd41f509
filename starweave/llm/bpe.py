"""Byte-level BPE with a hierarchical-bitmap rank queue.

``encode`` merges the bytes of each pre-token lowest rank first, leftmost first
among equal ranks. The queue has one bucket of linked-list positions per merge
rank; two levels of bitmap words say which buckets are filled, so the next rank
is found by two find-first-set steps, however long the pre-token is.
Entries that a neighbouring merge has made stale are skipped when they surface.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import islice
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starweave.llm.tables import free_name

#: Pre-tokens kept with their ids in a worker; the table is emptied when full.
CACHED = 1 << 18
#: Longer pre-tokens are not kept.
CACHED_CHARS = 64
#: At least so many new pre-tokens of a batch share one queue; fewer are merged one by one, with the same ids.
TOGETHER = 4096
#: Texts from which a new worker learns the common pre-tokens.
FIRST = 256
#: Characters of the texts whose new pre-tokens are merged together; bounds a worker's memory.
SLICE = 1 << 21
#: Rows decoded at once.
ROWS = 512
#: Matches taken at once from a text longer than this many characters.
BLOCK = 1 << 18


#: Ranks in a word of the lower bitmap.
WORD_BITS = 8
WORD_MASK = (1 << WORD_BITS) - 1


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token.

    ``slots`` are the buckets: a heap of positions for each rank. A bit of ``low`` says that a
    rank's bucket is filled, a bit of ``top`` that a word of ``low`` has any bit.
    """
    rank_of = ranks.get
    whole = rank_of(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    after, before = list(range(1, n + 1)), list(range(-1, n))
    #: Rank of the token at a position joined with the next token.
    pair = [rank_of(piece[i : i + 2], -1) for i in range(n)]
    pair[-1] = -1
    slots: dict[int, list[int]] = {}
    low: dict[int, int] = {}
    top = 0
    for i, rank in enumerate(pair):
        if rank >= 0:
            slot = slots.get(rank)
            if slot:
                slot.append(i)  # ascending, so a heap
            else:
                slots[rank] = [i]
                word = rank >> WORD_BITS
                low[word] = low.get(word, 0) | 1 << (rank & WORD_MASK)
                top |= 1 << word
    while top:
        word = (top & -top).bit_length() - 1
        bits = low[word]
        bit = bits & -bits
        rank = word << WORD_BITS | bit.bit_length() - 1
        slot = slots[rank]
        i = heappop(slot)
        if not slot:
            low[word] = bits = bits ^ bit
            if not bits:
                top ^= 1 << word
        if pair[i] != rank:
            continue  # stale
        gone = after[i]
        end = after[gone]
        after[i] = end
        before[end] = i
        pair[gone] = pair[i] = -1
        left = before[i]
        for at, stop in ((left, end), (i, after[end] if end < n else 0)):
            if at < 0 or not stop:
                continue
            pair[at] = new = rank_of(piece[at:stop], -1)
            if new >= 0:
                slot = slots.get(new)
                if slot:
                    heappush(slot, at)
                else:
                    slots[new] = [at]
                    word = new >> WORD_BITS
                    low[word] = low.get(word, 0) | 1 << (new & WORD_MASK)
                    top |= 1 << word
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


class PairTable:
    """Rank of two adjoining tokens, for arrays of them."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        keys, merged = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    merged.append(rank)
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.keys = np.array([*keys, -1], dtype=np.int64)[np.append(order, len(keys))]
        self.keys[-1] = np.iinfo(np.int64).max
        self.merged = np.array([*merged, -1], dtype=np.int64)[np.append(order, len(keys))]
        self.bytes = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        self.ranks = max(ranks.values()) + 1

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = self.keys.searchsorted(key)
        return np.where(self.keys[at] == key, self.merged[at], -1)


class Queue:
    """The rank queue for many pre-tokens at once: a bucket holds arrays of positions."""

    def __init__(self, ranks: int) -> None:
        self.slots: dict[int, list[np.ndarray]] = {}
        self.low = np.zeros((ranks >> WORD_BITS) + 1 << WORD_BITS, dtype=bool)
        self.top = np.zeros((ranks >> WORD_BITS) + 1, dtype=bool)

    def push(self, positions: np.ndarray, ranks: np.ndarray) -> None:
        order = ranks.argsort()
        positions, ranks = positions[order], ranks[order]
        starts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        named = ranks[np.append(0, starts)]
        self.low[named] = True
        self.top[named >> WORD_BITS] = True
        slots, start = self.slots, 0
        for rank, stop in zip(named.tolist(), [*starts.tolist(), len(ranks)], strict=True):
            part = positions[start:stop]
            if rank in slots:
                slots[rank].append(part)
            else:
                slots[rank] = [part]
            start = stop

    def pop(self) -> tuple[int, np.ndarray] | None:
        word = int(self.top.argmax())
        if not self.top[word]:
            return None
        bits = self.low[word << WORD_BITS : (word + 1) << WORD_BITS]
        bit = int(bits.argmax())
        bits[bit] = False
        if not bits.any():
            self.top[word] = False
        rank = word << WORD_BITS | bit
        parts = self.slots.pop(rank)
        return rank, parts[0] if len(parts) == 1 else np.concatenate(parts)


def merge_many(pieces: list[bytes], table: PairTable) -> list[bytes]:
    """Packed ids of many pre-tokens, by one queue over all their positions.

    A bucket's step takes the leftmost open position of each pre-token, so each is merged exactly as alone.
    """
    lengths = np.array([len(p) for p in pieces])
    ends = lengths.cumsum()
    token = table.bytes[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
    n = len(token)
    owner = np.repeat(np.arange(len(pieces), dtype=np.int32), lengths)
    after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
    after[ends - 1] = -1
    before[ends - lengths] = -1
    pair = np.append(table.find(token[:-1], token[1:]), -1)
    pair[ends - 1] = -1
    gone = np.zeros(n, dtype=bool)
    queue = Queue(table.ranks)
    open_ = np.flatnonzero(pair >= 0)
    if len(open_):
        queue.push(open_, pair[open_])
    while (found := queue.pop()) is not None:
        rank, at = found
        at = at[pair[at] == rank]  # the others are stale
        if len(at) > 1:
            at.sort()
            own = owner[at]
            later = own[1:] == own[:-1]
            if later.any():
                later = np.append(False, later)
                queue.push(at[later], np.full(int(later.sum()), rank))
                at = at[~later]
        elif not len(at):
            continue
        middle = after[at]
        end = after[middle]
        gone[middle] = True
        pair[middle] = -1
        pair[at] = -1
        token[at] = rank
        after[at] = end
        has_end = end >= 0
        left = before[at]
        has_left = left >= 0
        inner, end, left, right = at[has_end], end[has_end], left[has_left], at[has_left]
        before[end] = inner
        where = np.concatenate((inner, left))
        if not len(where):
            continue
        new = table.find(token[where], token[np.concatenate((end, right))])
        pair[where] = new
        good = new >= 0
        if good.any():
            queue.push(where[good], new[good])
    kept = ~gone
    packed = token[kept].astype("<u4").tobytes()
    stops = (np.bincount(owner[kept], minlength=len(pieces)).cumsum() * 4).tolist()
    return [packed[i:j] for i, j in zip([0, *stops], stops, strict=False)]


class Codec(dict):
    """Pre-token -> packed ids; computes what is missing and stays bounded."""

    def __init__(self, vocabulary: bytes, pattern: str) -> None:
        super().__init__()
        lines = (line.split() for line in vocabulary.splitlines() if line.strip())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        tokens = {rank: token for token, rank in self.ranks.items()}
        ordered = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.flat = np.frombuffer(b"".join(ordered), dtype=np.uint8)
        self.lengths = np.array([len(t) for t in ordered])
        self.starts = self.lengths.cumsum() - self.lengths
        self.pattern = regex.compile(pattern)
        self.table = PairTable(self.ranks)

    def __missing__(self, piece: str) -> bytes:
        ids = merge(piece.encode("utf-8"), self.ranks)
        packed = pack(f"<{len(ids)}I", *ids)
        if len(piece) <= CACHED_CHARS:
            self._keep({piece: packed})
        return packed

    def _keep(self, new: dict[str, bytes]) -> None:
        if len(self) + len(new) > CACHED:
            self.clear()
        self.update(new)

    def encode(self, text: str) -> bytes:
        if len(text) <= BLOCK:
            return b"".join(map(self.__getitem__, self.pattern.findall(text)))
        return b"".join(self._blocks(text))

    def _blocks(self, text: str) -> Iterator[bytes]:
        matches = self.pattern.finditer(text)
        while block := [m.group() for m in islice(matches, BLOCK)]:
            yield b"".join(map(self.__getitem__, block))

    def encode_all(self, texts: Iterable[str]) -> Iterator[list[bytes]]:
        """As ``encode`` of each, in slices; the first texts fill an empty table with what is common."""
        waiting: list[str] = []
        chars = 0
        for text in texts:
            waiting.append(text)
            chars += len(text)
            if chars > SLICE or (not self and len(waiting) == FIRST):
                yield self._together(waiting)
                waiting, chars = [], 0
        if waiting:
            yield self._together(waiting)

    def _together(self, texts: list[str]) -> list[bytes]:
        """New pre-tokens of ordinary length are merged together."""
        out: list[bytes] = []
        parts: dict[int, list[bytes | None]] = {}
        holes: list[tuple[int, int, str]] = []
        new: dict[str, bytes] = {}
        known = self.get
        for text in texts:
            if len(text) > BLOCK:
                out.append(self.encode(text))
                continue
            found = self.pattern.findall(text)
            got = list(map(known, found))
            try:
                out.append(b"".join(got))
            except TypeError:  # some are not known yet
                at = len(out)
                parts[at] = got
                holes += [(at, i, found[i]) for i, ids in enumerate(got) if ids is None]
                out.append(b"")
        missing = {piece for _, _, piece in holes}
        for piece in missing:
            raw = piece.encode("utf-8")
            whole = self.ranks.get(raw)
            if whole is not None:
                new[piece] = pack("<I", whole)
            elif len(piece) > CACHED_CHARS:
                parts_ids = merge(raw, self.ranks)
                new[piece] = pack(f"<{len(parts_ids)}I", *parts_ids)
        left = [p for p in missing if p not in new]
        if len(left) >= TOGETHER:
            raws = [p.encode("utf-8") for p in left]
            new.update(zip(left, merge_many(raws, self.table), strict=True))
        else:
            for piece in left:
                ids = merge(piece.encode("utf-8"), self.ranks)
                new[piece] = pack(f"<{len(ids)}I", *ids)
        for at, i, piece in holes:
            parts[at][i] = new[piece]
        for at, got in parts.items():
            out[at] = b"".join(got)
        self._keep({p: ids for p, ids in new.items() if len(p) <= CACHED_CHARS})
        return out

    def decode(self, ids: bytes) -> bytes:
        whole = np.frombuffer(ids, dtype="<u4")
        return b"".join(self._decoded(whole[i : i + BLOCK]) for i in range(0, len(whole), BLOCK))

    def _decoded(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        ends = lengths.cumsum()
        shift = self.starts[ids] - ends + lengths
        return self.flat[np.repeat(shift, lengths) + np.arange(ends[-1])].tobytes()


@lru_cache(maxsize=2)
def _codec(key: bytes, pattern: str) -> Codec:
    return Codec(_SOURCES.pop(key), pattern)


_SOURCES: dict[bytes, bytes] = {}


def codec(vocabulary: bytes, pattern: str) -> Codec:
    """One codec per worker process and vocabulary."""
    key = hashlib.sha256(vocabulary).digest()
    _SOURCES[key] = vocabulary
    try:
        return _codec(key, pattern)
    finally:
        _SOURCES.pop(key, None)


def load_vocabulary(path: str) -> bytes:
    """The ``.tiktoken`` file (base64 token and rank on each line) as the driver reads it, about 1 MB."""
    with open(path, "rb") as f:
        return f.read()


def encode(df: DataFrame, vocabulary: bytes, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with a binary column of token ids as little-endian unsigned 32-bit integers.

    Each match of ``pattern`` is encoded separately; special tokens have no meaning. A null text counts
    as empty and has no ids. A column of the name of ``ids`` is replaced. Whole texts are encoded, in
    blocks, so memory grows with the ids of one text only. Equal texts have equal ids.
    """

    @F.arrow_udf("binary")
    def encode_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(vocabulary, pattern)
        for texts in batches:
            for packed in own.encode_all(t.as_py() or "" for t in texts):
                yield pa.array(packed, pa.binary())

    return df.withColumn(ids, encode_texts(F.col(text)))


def decode(df: DataFrame, vocabulary: bytes, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the bytes that the packed ids stand for; null ids count as none."""

    @F.arrow_udf("binary")
    def decode_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(vocabulary, pattern)
        for packed in batches:
            for start in range(0, len(packed), ROWS):
                part = packed[start : start + ROWS]
                yield pa.array([own.decode(x.as_py() or b"") for x in part], pa.binary())

    return df.withColumn(decoded, decode_ids(F.col(ids)))


def round_trip(
    df: DataFrame, vocabulary: bytes, pattern: str, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``encode`` and ``decode`` in one pass over the texts, so that one worker does both."""
    kind = pa.struct([("ids", pa.binary()), ("decoded", pa.binary())])

    @F.arrow_udf("struct<ids: binary, decoded: binary>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(vocabulary, pattern)
        for texts in batches:
            for packed in own.encode_all(t.as_py() or "" for t in texts):
                columns = [pa.array(packed, pa.binary()), pa.array(map(own.decode, packed), pa.binary())]
                yield pa.StructArray.from_arrays(columns, fields=list(kind))

    (raw,) = free_name(df, "round_trip")
    kept = [c for c in df.columns if c not in (ids, decoded)]
    made = df.withColumn(raw, both(F.col(text)))
    return made.select(*kept, F.col(raw)["ids"].alias(ids), F.col(raw)["decoded"].alias(decoded))


def digests(df: DataFrame, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Count and digests of encoded and decoded columns."""
    return df.withColumns(
        {
            "n_tokens": (F.octet_length(ids) / 4).cast("long"),
            "ids_sha256": F.sha2(ids, 256),
            "decoded_sha256": F.sha2(decoded, 256),
        }
    )


def default_vocabulary(spark: SparkSession) -> tuple[bytes, str]:
    """The multilingual 50k vocabulary and its pre-token pattern, from the installed public files."""
    import public_tokenizers

    return load_vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN
