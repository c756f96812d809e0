"""Words, hashes and row keys shared by the operators of this package.

Texts travel to Python as UTF-8 bytes. On bytes, ``lower`` touches A-Z only and ``split`` cuts at the six ASCII
blanks only, which are the two word definitions used here; a null text counts as the empty one.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Bytes outside 0-9, a-z and non-ASCII become blanks; A-Z become a-z.
ALNUM = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def blank_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words between ASCII blanks."""
    return text.lower().split() if text else []


def alnum_words(text: bytes | None) -> list[bytes]:
    """Lower-cased runs of letters, digits and non-ASCII characters."""
    return text.translate(ALNUM).split() if text else []


class WordHashes(dict):
    """64-bit hash of a word, remembered; emptied by ``trim`` so that it stays bounded."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))

    def trim(self) -> None:
        if len(self) > self.LIMIT:
            self.clear()


_kept: dict[str, dict] = {}


def kept(operator: str) -> dict:
    """What a Python worker keeps between the tasks of one operator.

    Workers outlive queries, so a task first drops what other operators kept: it would lie beside this one's memory.
    """
    for other in [o for o in _kept if o != operator]:
        del _kept[other]
    return _kept.setdefault(operator, {})


MIX_A, MIX_B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * MIX_A
    x = x ^ (x >> np.uint64(33))
    x = x * MIX_B
    return x ^ (x >> np.uint64(33))


BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
EIGHT = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)
LONG = 64


def word_spans(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words between ASCII blanks, from the text's bytes."""
    inside = np.zeros(len(text) + 2, bool)
    np.logical_not(BLANK[text], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def span_hashes(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of a text, all at once and eight bytes at a time; those of spans beyond ``LONG`` bytes by xxhash."""
    sizes = ends - starts
    eights = np.ndarray(len(text) + 1, "<u8", buffer=text + bytes(8), strides=(1,))
    total = mixed(sizes.astype(np.uint64) * STEP + (eights[starts] & EIGHT[np.minimum(sizes, 8)]))
    rows = np.flatnonzero((sizes > 8) & (sizes <= LONG))
    for at in range(8, LONG, 8):
        rows = rows[sizes[rows] > at]
        total[rows] = mixed(total[rows] + (eights[starts[rows] + at] & EIGHT[np.minimum(sizes[rows] - at, 8)]))
    for i in np.flatnonzero(sizes > LONG).tolist():
        total[i] = xxhash.xxh3_64_intdigest(text[starts[i] : ends[i]])
    return total


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` word hashes, in order; empty if there are fewer words."""
    count = len(words) - n + 1
    if count <= 0:
        return words[:0]
    total = words[:count].copy()
    for i in range(1, n):
        total = mixed(total + STEP) + words[i : i + count]
    return mixed(total)


def utf8(column: Column | str) -> Column:
    """The text as bytes, null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("binary")


def id_crc(column: str) -> Column:
    """crc32 of the id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def batches_of(sizes: Iterable[int], limit: int) -> list[tuple[int, int]]:
    """Consecutive slices whose sizes sum to ``limit`` or little more; one large item is a slice of its own."""
    found, start, total, i = [], 0, 0, -1
    for i, size in enumerate(sizes):
        total += size
        if total >= limit:
            found.append((start, i + 1))
            start, total = i + 1, 0
    if start <= i:
        found.append((start, i + 1))
    return found
