"""Words of whole texts as 64-bit hashes, many texts at a time.

Both word patterns of the operators can be told byte by byte in UTF-8, so the texts of an
Arrow batch are hashed as one byte array. A text of any length is cut only between words.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# The task functions travel with the job; executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE_BYTES = 1 << 20  # text hashed at a time; longer texts are cut between words
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX_1, MIX_2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
SHIFT = np.uint64(33)


def byte_classes(separators: bytes) -> np.ndarray:
    """For each byte 0 if it parts words, else the byte with A-Z in lower case."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[list(separators)] = 0
    return table


# Words of [^\x20\x09-\x0D]+, and of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z. A
# NUL inside a word of the first sort stands as byte 255, which UTF-8 does not use.
SPACED = byte_classes(b" \t\n\x0b\x0c\r")
SPACED[0] = 255
ALPHANUMERIC = byte_classes(bytes(b for b in range(128)
                                  if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit over all."""
    h = (h ^ (h >> SHIFT)) * MIX_1
    h = (h ^ (h >> SHIFT)) * MIX_2
    return h ^ (h >> SHIFT)


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base squared, … modulo 2**64."""
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def inverse(odd: np.uint64) -> np.uint64:
    return np.uint64(pow(int(odd), -1, 1 << 64))


class Polynomial:
    """Hashes of stretches of a sequence, by prefix sums: sum of value[i] * base**(i - start)."""

    def __init__(self, base: np.uint64 = BASE):
        self.base = base
        self.up = self.down = np.empty(0, np.uint64)

    def of(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(values) + 1
        if len(self.up) < n:
            self.up = powers(self.base, 2 * n)
            self.down = powers(inverse(self.base), 2 * n)
        sums = np.zeros(n, np.uint64)
        np.cumsum(values * self.up[:n - 1], out=sums[1:])
        return (sums[ends] - sums[starts]) * self.down[starts]


@dataclass
class Words:
    """Words of consecutive texts: text ``first + t`` has ``hashes[bounds[t]:bounds[t + 1]]``.

    ``starts`` and ``ends`` are byte positions in the text.
    """

    first: int
    bounds: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def texts(self) -> int:
        return len(self.bounds) - 1

    def owner(self) -> np.ndarray:
        """For each word, the position of its text."""
        return np.repeat(np.arange(self.texts()), np.diff(self.bounds))


class WordHasher:
    def __init__(self, classes: np.ndarray, slice_bytes: int = SLICE_BYTES):
        self.classes, self.slice_bytes, self.polynomial = classes, slice_bytes, Polynomial()

    def _hash(self, codes: np.ndarray, breaks: np.ndarray):
        """Hashes, starts and ends of the words; a word never runs over a break."""
        inside = codes != 0
        before = np.zeros(len(codes), bool)
        before[1:] = inside[:-1]
        before[breaks] = False
        after = np.zeros(len(codes), bool)
        after[:-1] = inside[1:]
        after[breaks[breaks > 0] - 1] = False
        starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(inside & ~after) + 1
        raw = self.polynomial.of(codes.astype(np.uint64), starts, ends)
        return mix(raw + (ends - starts).astype(np.uint64) * MIX_2), starts, ends

    def _long(self, data: np.ndarray):
        """The words of one long text, a slice at a time."""
        parts, at = [], 0
        while at < len(data):
            end, pieces = at, []
            while end < len(data):  # more than one piece only while one word fills them all
                start, end = end, min(len(data), end + self.slice_bytes)
                pieces.append(self.classes[data[start:end]])
                if not pieces[-1].all():
                    break
            codes = np.concatenate(pieces)
            if end < len(data):  # stop after the last separator
                codes = codes[:len(codes) - int(np.argmax(codes[::-1] == 0))]
            h, s, e = self._hash(codes, np.zeros(1, np.int64))
            parts.append((h, s + at, e + at))
            at += len(codes)
        return tuple(np.concatenate(p) for p in zip(*parts))

    def slices(self, texts: pa.Array) -> Iterator[Words]:
        """The words of all texts in order; a NULL text has none."""
        texts = texts.cast(pa.large_string())
        if texts.null_count:
            texts = texts.fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[
            texts.offset:texts.offset + len(texts) + 1]
        data = (np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2]
                else np.empty(0, np.uint8))
        first = 0
        while first < len(texts):
            last = int(np.searchsorted(offsets, offsets[first] + self.slice_bytes, "right")) - 1
            last = min(max(last, first + 1), len(texts))
            start, end = offsets[first], offsets[last]
            if end - start > self.slice_bytes:
                hashes, starts, ends = self._long(data[start:end])
                bounds = np.array([0, len(hashes)])
            elif end == start:
                hashes, starts, ends = np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 2
                bounds = np.zeros(last - first + 1, np.int64)
            else:
                places = offsets[first:last] - start
                breaks = places[places < end - start]
                hashes, starts, ends = self._hash(self.classes[data[start:end]], breaks)
                bounds = np.searchsorted(starts, offsets[first:last + 1] - start)
                origin = np.repeat(places, np.diff(bounds))
                starts, ends = starts - origin, ends - origin
            yield Words(first, bounds, hashes, starts, ends)
            first = last
