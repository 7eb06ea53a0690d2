"""Vectorised words, word hashes and word-window hashes over Arrow string buffers.

Everything here is a small NumPy helper used inside ``mapInArrow`` functions.
Word rules are sets of bytes; UTF-8 bytes above 0x7F are always word bytes, so
working on bytes equals working on characters.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

U = np.uint64
#: Word bytes: everything but space and 0x09-0x0D.
NON_SPACE = "space"
#: Word bytes: digits, ASCII letters and all bytes from 0x80.
ALNUM = "alnum"

_WRAP = 1 << 12


def _byte_table(rule: str) -> np.ndarray:
    t = np.ones(256, bool)
    if rule == NON_SPACE:
        t[0x20] = False
        t[0x09:0x0E] = False
    else:
        t[:0x30] = False
        t[0x3A:0x61] = False
        t[0x7B:0x80] = False
    return t


def _lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def _weights(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 64, n, dtype=U) | U(1)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift), elementwise."""
    x = x ^ U(salt)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Words(NamedTuple):
    buf: np.ndarray  # bytes (lower-cased if asked)
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # one past the last byte
    first: np.ndarray  # per text: index of its first word; one more entry at the end

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a large-string array without nulls."""
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if texts.buffers()[2] is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    buf = np.frombuffer(texts.buffers()[2], np.uint8)[off[0] : off[-1]]
    return buf, off - off[0]


def words(texts: pa.Array, rule: str = NON_SPACE, lower: bool = False) -> Words:
    buf, off = buffer_of(texts)
    if lower:
        buf = _lower_table()[buf]
    if not len(buf):
        e = np.zeros(0, np.int64)
        return Words(buf, e, e, np.zeros(len(texts) + 1, np.int64))
    ok = _byte_table(rule)[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[off] = True
    begins = ok.copy()
    begins[1:] &= ~ok[:-1] | edge[1:-1]
    ends = ok.copy()
    ends[:-1] &= ~ok[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(buf, start, end, np.searchsorted(start, off))


def word_hash(w: Words, seed: int = 11) -> np.ndarray:
    """Multilinear hash of each word's bytes with random odd weights by place, then mixed.

    A word of more than ``_WRAP`` bytes is hashed in blocks of that size, and
    then its mixed block hashes with a weight for each block number.
    """
    if not len(w.start):
        return np.zeros(0, U)
    n = w.end - w.start
    if int(n.max()) <= _WRAP:
        return _block_hash(w.buf, w.start, n, seed)
    blocks = -(-n // _WRAP)
    first = np.cumsum(blocks) - blocks
    number = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
    start = np.repeat(w.start, blocks) + number * _WRAP
    h = _block_hash(w.buf, start, np.minimum(np.repeat(w.end, blocks) - start, _WRAP), seed)
    by_number = mix(number.astype(U) + U(seed), 0x9E3779B97F4A7C15) | U(1)
    whole = mix(np.add.reduceat(h * by_number, first) + n.astype(U) * U(0x9E3779B97F4A7C15))
    return np.where(blocks > 1, whole, h[first])


def _block_hash(buf: np.ndarray, start: np.ndarray, n: np.ndarray, seed: int) -> np.ndarray:
    first = np.cumsum(n) - n
    place = np.arange(int(n.sum())) - np.repeat(first, n)
    h = np.add.reduceat((buf[place + np.repeat(start, n)].astype(U) + U(1)) * _weights(seed, _WRAP)[place], first)
    return mix(h + n.astype(U) * U(0x9E3779B97F4A7C15))


def window_hash(h: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Hash of every ``k`` consecutive entries of ``h`` (len(h) - k + 1 values), whatever texts they cross."""
    if len(h) < k:
        return np.zeros(0, U)
    m = mix(h, seed * 0x9E3779B97F4A7C15 & ((1 << 64) - 1))
    out = np.zeros(len(h) - k + 1, U)
    for j, c in enumerate(_weights(seed, k)):
        out += m[j : j + len(out)] * c
    return mix(out)


def window_starts(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Word index and text index of each window of ``k`` words that stays in one text."""
    n = np.maximum(np.diff(first) - k + 1, 0)
    doc = np.repeat(np.arange(len(n)), n)
    base = np.cumsum(n) - n
    at = np.arange(int(n.sum())) - np.repeat(base, n) + np.repeat(first[:-1], n)
    return at, doc


def gathered_words(w: Words, keep: np.ndarray) -> pa.Array:
    """Per text: its kept words joined by one space."""
    i = np.flatnonzero(keep)
    doc = w.doc()[i]
    last = np.ones(len(i), bool)
    last[:-1] = doc[1:] != doc[:-1]
    n = w.end[i] - w.start[i]
    size = n + ~last  # with the space after it
    begin = np.cumsum(size) - size
    out = np.full(int(size.sum()), 0x20, np.uint8)
    inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    out[np.repeat(begin, n) + inside] = w.buf[np.repeat(w.start[i], n) + inside]
    per = np.zeros(len(w.first) - 1, np.int64)
    np.add.at(per, doc, size)
    off = np.concatenate([[0], np.cumsum(per)]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(per), [None, pa.py_buffer(off.tobytes()), pa.py_buffer(out.tobytes())])
