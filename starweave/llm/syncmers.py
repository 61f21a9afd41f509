"""Document fingerprints of closed syncmers.

A run of ``K`` characters is an anchor if the smallest of its inner runs of ``S``
characters, by hash, is the first or the last one. Whether a run is an anchor
depends on nothing around it, so an edit moves only anchors that it touches.
About every fourth place of a text is one. A fingerprint holds the distinct anchors
in the order of their first positions: all of them, or of a text with more than
``WHOLE`` those in the lower half of the hashes. Two fingerprints are compared by
the anchors that they share in the same order, over all that both could hold.
"""

from __future__ import annotations

import base64
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np

from starweave.llm.shingles import _powers, mix

K, S = 12, 5
#: Distinct anchors of a text up to which a fingerprint holds them all; of more, it holds a half.
WHOLE = 2048
#: 32-bit hashes of the lower half.
HALF = 1 << 31
#: Characters worked on at once.
BLOCK = 1 << 18


def _run_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    power, inverse = _powers(2 * BLOCK)
    total = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * power[: len(codes)], out=total[1:])
    return (total[n:] - total[:-n]) * inverse[: len(codes) - n + 1]


def anchors(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of all anchors, in text order. A text shorter than ``K`` is one anchor."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64) + np.uint64(1)
    if not len(codes):
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    if len(codes) < K:
        whole = mix(_run_hashes(codes, len(codes)), len(codes))
        return whole, np.zeros(1, dtype=np.int64)
    hashes, places = [], []
    for start in range(0, len(codes) - K + 1, BLOCK):
        part = codes[start : start + BLOCK + K - 1]
        inner = mix(_run_hashes(part, S), S)
        width = K - S + 1
        lowest, reach = inner, 1
        while reach < width:
            step = min(reach, width - reach)
            lowest = np.minimum(lowest[:-step], lowest[step:])
            reach += step
        at = np.flatnonzero((inner[: len(lowest)] == lowest) | (inner[width - 1 :] == lowest))
        hashes.append(mix(_run_hashes(part, K)[at], K))
        places.append(at + start)
    return np.concatenate(hashes), np.concatenate(places)


@dataclass(frozen=True)
class Print:
    """32-bit hashes of distinct anchors in text order, and whether these are all or the lower half."""

    whole: bool
    hashes: np.ndarray

    def lower(self) -> np.ndarray:
        return self.hashes[self.hashes < HALF] if self.whole else self.hashes

    def __str__(self) -> str:
        if not len(self.hashes) and self.whole:
            return ""
        return ("a" if self.whole else "h") + base64.b64encode(self.hashes.astype("<u4").tobytes()).decode()


def print_of(text: str | None) -> Print:
    """The fingerprint of a text; no anchors for a null or empty text.

    A text with no anchor at all (only possible for a few characters more than ``K``) is represented by the
    hash of the whole text.
    """
    hashes, _ = anchors(text or "")
    if not len(hashes) and text:
        codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64) + np.uint64(1)
        hashes = mix(_run_hashes(codes, len(codes)), len(codes))
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    distinct, first = np.unique(short, return_index=True)
    whole = len(distinct) <= WHOLE
    if not whole:
        first = first[distinct < HALF]
    return Print(whole, short[np.sort(first)])


def fingerprint(text: str | None) -> str:
    """The fingerprint as text: ``a`` (all anchors) or ``h`` (lower half), then the hashes in text order, base64 of
    little-endian 32-bit integers; empty for a null or empty text. Equal texts have equal fingerprints.

    It is as long as about 1.4 times the characters of a text, 0.7 times beyond ``WHOLE`` anchors.
    """
    return str(print_of(text))


def parsed(print_: str) -> Print:
    hashes = np.frombuffer(base64.b64decode(print_[1:]), dtype="<u4")
    return Print(print_[:1] != "h", hashes.astype(np.uint32))


def in_order(places: np.ndarray) -> int:
    """Length of the longest increasing subsequence."""
    if (places[1:] > places[:-1]).all():
        return len(places)
    tails: list[int] = []
    for place in places.tolist():
        at = bisect_left(tails, place)
        tails[at : at + 1] = [place]
    return len(tails)


def likeness(one: Print, two: Print) -> float:
    """Of the anchors of both texts together, the share that they have in common in the same order.

    Where one fingerprint holds the lower half only, the lower halves are compared. 1 for equal texts, two empty ones
    included; 0 if only one is empty.
    """
    both_whole = one.whole and two.whole
    a, b = (one.hashes, two.hashes) if both_whole else (one.lower(), two.lower())
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    shared, at, there = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    return in_order(there[np.argsort(at)]) / (len(a) + len(b) - len(shared))
