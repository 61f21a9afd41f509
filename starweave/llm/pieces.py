"""SentencePiece models of the merge type, encoded by a score-ordered agenda.

``encode`` starts from the characters of a text, with a space symbol in front and
for every space. An agenda holds each adjacent pair whose join is a piece, best
score first, leftmost first among equal scores; an entry is stale if the pair
at its position has changed since. In most models no piece has a space symbol behind
another character, or a letter beside a character of another kind. Then no merge crosses
such a place and a text is cut there: each part is merged on its own, and common parts are
remembered. The pieces of the model at hand decide where it is cut, if at all.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starweave.llm.tables import free_name

SPACE = "▁"
#: An agenda entry's lower bits are a position.
FIRST = 1 << 40
POSITION = FIRST - 1
#: Parts of a text kept with their ids in a worker; the table is emptied when full.
CACHED = 1 << 19
#: Longer parts are not kept.
CACHED_CHARS = 64
#: Characters of a long text that are cut into parts at once.
BLOCK = 1 << 18
#: Characters of texts whose results a worker holds at once.
SLICE = 1 << 21

def parts_of(pieces: Iterable[str]) -> re.Pattern[str]:
    """The finest way to cut a text that puts every piece into one part."""
    pieces = list(pieces)
    # Numbers that are no digits: beside letters in the pattern language, beside other characters in pieces.
    odd = re.escape("".join(sorted({c for p in pieces if len(p) > 1 for c in p if c.isalnum() and not (c.isalpha() or c.isdecimal())})))
    for pattern in (
        rf"{SPACE}*(?:[^\W\d_{odd}]+|(?:[^{SPACE}\w]|[\d_{odd}])+)|{SPACE}+",
        rf"{SPACE}*[^{SPACE}]+|{SPACE}+",
    ):
        parts = re.compile(pattern)
        if all(parts.fullmatch(p) for p in pieces):
            return parts
    return re.compile("(?s:.+)")


def merge(part: str, entry_of: dict[str, int]) -> list[str]:
    """The pieces of one part of an escaped text.

    An agenda entry is a number: the place of the piece by score in the upper bits, the position of its
    left symbol in the lower ones. ``open_`` holds the valid entry of each position, 0 if there is none.
    """
    symbols = list(part)
    n = len(symbols)
    get = entry_of.get
    open_ = [get(a + b, 0) + i for i, (a, b) in enumerate(zip(symbols, symbols[1:]))]
    agenda = [e for e in open_ if e >= FIRST]
    if not agenda:
        return symbols
    open_.append(0)
    after, before = list(range(1, n + 1)), list(range(-1, n))
    heapify(agenda)
    while agenda:
        entry = heappop(agenda)
        i = entry & POSITION
        if open_[i] != entry:
            continue  # stale
        j = after[i]
        joined = symbols[i] = symbols[i] + symbols[j]
        symbols[j] = ""
        open_[j] = 0
        end = after[i] = after[j]
        if end < n:
            before[end] = i
            entry = open_[i] = get(joined + symbols[end], 0) + i
            if entry >= FIRST:
                heappush(agenda, entry)
        else:
            open_[i] = 0
        left = before[i]
        if left >= 0:
            entry = open_[left] = get(symbols[left] + joined, 0) + left
            if entry >= FIRST:
                heappush(agenda, entry)
    return [s for s in symbols if s]


class Codec(dict):
    """Part of a text -> its ids; computes what is missing and stays bounded."""

    def __init__(self, model: bytes) -> None:
        super().__init__()
        library = self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.of_byte = [-1] * 256
        n = library.get_piece_size()
        surface: list[bytes] = []
        self.control, self.byte, self.spaced = (np.zeros(n, dtype=bool) for _ in range(3))
        self.unknown = library.unk_id()
        for i in range(n):
            piece = library.id_to_piece(i)
            if library.is_byte(i):
                value = int(piece[1:-1], 16)
                self.of_byte[value] = i
                self.byte[i] = True
                surface.append(bytes([value]))
            elif library.is_control(i):
                self.control[i] = True
                surface.append(b"")
            elif library.is_unknown(i):
                surface.append(library.decode([i]).encode())
            elif library.is_unused(i):
                raise ValueError(f"unused pieces are not supported: {piece!r}")
            else:
                self.ids[piece] = i
                scores[piece] = library.get_score(i)
                self.spaced[i] = piece.startswith(SPACE)
                surface.append(piece.replace(SPACE, " ").encode())
        for probe in ("  Aﬁéé  b\t\n", "x"):
            if library.normalize(probe) != SPACE + probe.replace(" ", SPACE):
                raise ValueError("only models that leave texts as they are, behind one added space, are supported")
        places = {score: i for i, score in enumerate(sorted(set(scores.values()), reverse=True), start=1)}
        #: Piece -> its place by score, equal scores sharing one, in the upper bits of an agenda entry.
        self.entries = {piece: places[score] * FIRST for piece, score in scores.items()}
        self.parts = parts_of(self.ids)
        self.flat = np.frombuffer(b"".join(surface), dtype=np.uint8)
        self.lengths = np.array([len(s) for s in surface])
        self.starts = self.lengths.cumsum() - self.lengths

    def __missing__(self, part: str) -> tuple[int, ...]:
        found: list[int] = []
        for piece in merge(part, self.entries):
            own = self.ids.get(piece)
            if own is not None:
                found.append(own)
                continue
            raw = [self.of_byte[b] for b in piece.encode("utf-8")]
            found += [self.unknown] if -1 in raw else raw
        if len(part) <= CACHED_CHARS:
            if len(self) >= CACHED:
                self.clear()
            self[part] = tuple(found)
        return tuple(found)

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, dtype=np.int32)
        escaped = SPACE + text.replace(" ", SPACE)
        if len(escaped) <= BLOCK:
            return np.array([i for part in self.parts.findall(escaped) for i in self[part]], dtype=np.int32)
        blocks, ids = [], []
        for found in self.parts.finditer(escaped):
            ids += self[found.group()]
            if len(ids) >= BLOCK:
                blocks.append(np.array(ids, dtype=np.int32))
                ids = []
        return np.concatenate([*blocks, np.array(ids, dtype=np.int32)])

    def decode(self, ids: np.ndarray) -> str:
        if not len(ids):
            return ""
        raw = b"".join(self._surface(ids[i : i + BLOCK]) for i in range(0, len(ids), BLOCK))
        shown = np.flatnonzero(~self.control[ids[:BLOCK]])
        if len(shown) and self.spaced[ids[shown[0]]]:
            raw = raw[1:]
        try:
            return raw.decode("utf-8")
        except UnicodeDecodeError:
            return _decode_loosely(raw)

    def _surface(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        ends = lengths.cumsum()
        shift = self.starts[ids] - ends + lengths
        return self.flat[np.repeat(shift, lengths) + np.arange(ends[-1])].tobytes()


def _decode_loosely(raw: bytes) -> str:
    """Every byte that is no part of a character becomes U+FFFD."""
    out = []
    while raw:
        try:
            return "".join([*out, raw.decode("utf-8")])
        except UnicodeDecodeError as e:
            out += [raw[: e.start].decode("utf-8"), "�"]
            raw = raw[e.start + 1 :]
    return "".join(out)


@lru_cache(maxsize=2)
def _codec(key: bytes) -> Codec:
    return Codec(_SOURCES.pop(key))


_SOURCES: dict[bytes, bytes] = {}


def codec(model: bytes) -> Codec:
    """One codec per worker process and model."""
    key = hashlib.sha256(model).digest()
    _SOURCES[key] = model
    try:
        return _codec(key)
    finally:
        _SOURCES.pop(key, None)


def _slices(texts: Iterable[str]) -> Iterator[list[str]]:
    waiting, chars = [], 0
    for text in texts:
        waiting.append(text)
        chars += len(text)
        if chars > SLICE:
            yield waiting
            waiting, chars = [], 0
    if waiting:
        yield waiting


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(ids) + 1, dtype=np.int32)
    np.cumsum([len(x) for x in ids], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids), pa.int32()))


def encode(df: DataFrame, model: bytes, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with an array of the ids of each whole text, without begin or end ids.

    A null text counts as empty and has no ids. A column of the name of ``ids`` is replaced. Equal texts have
    equal ids. Memory grows with the ids of one text only.
    """

    @F.arrow_udf("array<int>")
    def encode_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(model)
        for batch in batches:
            for texts in _slices(t.as_py() or "" for t in batch):
                yield _lists([own.encode(t) for t in texts])

    return df.withColumn(ids, encode_texts(F.col(text)))


def decode(df: DataFrame, model: bytes, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the text that the ids stand for; null ids count as none.

    The space added in front goes, every other space symbol becomes a space, bytes that form no character
    become U+FFFD, control ids nothing.
    """

    @F.arrow_udf("string")
    def decode_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(model)
        for batch in batches:
            for start in range(0, len(batch), 512):
                rows = batch[start : start + 512]
                yield pa.array([own.decode(np.array(x.as_py() or [], dtype=np.int32)) for x in rows], pa.string())

    return df.withColumn(decoded, decode_ids(F.col(ids)))


def round_trip(
    df: DataFrame,
    model: bytes,
    text: str = "text",
    ids: str = "ids",
    decoded: str = "decoded",
    agrees: str = "agrees",
    every: int = 1,
) -> DataFrame:
    """``encode`` and ``decode`` in one pass, and whether the sentencepiece library gives the same ids and text.

    The library sees rows of the same Arrow batches, each one or one in ``every``; it decides nothing but ``agrees``,
    which is null for the rows it did not see.
    """
    kind = pa.struct([("ids", pa.list_(pa.int32())), ("decoded", pa.string()), ("agrees", pa.bool_())])

    @F.arrow_udf("struct<ids: array<int>, decoded: string, agrees: boolean>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(model)
        for batch in batches:
            for texts in _slices(t.as_py() or "" for t in batch):
                found = [own.encode(t) for t in texts]
                back = [own.decode(x) for x in found]
                want = own.library.encode(texts[::every], num_threads=1)
                same: list[bool | None] = [None] * len(texts)
                same[::every] = [
                    x.tolist() == w and b == own.library.decode(w)
                    for x, b, w in zip(found[::every], back[::every], want, strict=True)
                ]
                columns = [_lists(found), pa.array(back, pa.string()), pa.array(same, pa.bool_())]
                yield pa.StructArray.from_arrays(columns, fields=list(kind))

    (raw,) = free_name(df, "round_trip")
    kept = [c for c in df.columns if c not in (ids, decoded, agrees)]
    made = df.withColumn(raw, both(F.col(text)))
    return made.select(*kept, *(F.col(raw)[c].alias(a) for c, a in (("ids", ids), ("decoded", decoded), ("agrees", agrees))))


def load_model(path: str) -> bytes:
    """The model file as the driver reads it, about 0.5 MB; a model that cannot be encoded here raises ``ValueError``."""
    with open(path, "rb") as f:
        model = f.read()
    codec(model)
    return model


def default_model(spark: SparkSession) -> bytes:
    """The 32k merge-type model with byte fallback, from the installed public files."""
    import public_tokenizers

    return load_model(public_tokenizers.path("piece_bpe_32k.model"))
