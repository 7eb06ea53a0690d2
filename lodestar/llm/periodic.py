"""Periodic runs of words: every maximal stretch that repeats with some period, and texts with the repeats left out.

A run is a stretch of consecutive words of one document, of length at least
``max(least, 2 * period)``, in which words one period apart are equal, which no
neighbouring word extends, and whose period is its smallest.

Seed and extend on diagonals. On the diagonal of lag q (word i against word
i + q) a run of period q is a matched stretch of at least ``max(least - q, q)``
words. Lags are taken in bands from B to 2B - 1. In a band every such stretch
holds an aligned k-gram, k being half the guaranteed overlap. So only k-grams at
multiples of k are indexed, and each window of k words looks up the
indexed ones of its own document that lie B to 2B - 1 words before it: two or
three at most. These occurrence pairs are the seeds, a bounded number for a word
and band, whatever a document repeats. Seeds are walked by lag and place, with
the furthest word covered on that lag: a seed that starts there belongs to the
same stretch and isn't extended again. Each stretch is then extended to both
sides by less than k words, by bisection on fingerprints of prefixes. Of runs
with the same ends the one of smallest period stays (by Fine and Wilf's theorem
all others are its multiples). The work is O(n log n) for a document of n words.

Everything is vectorised over the documents of one bounded step; a document is
never cut and never leaves its task. Words are compared by 64-bit hashes, grams
by 62 bits.

Defined results: a null or wordless text has no words and no runs; repeated rows
and ids are treated row by row; a null id is kept; an empty table gives no
rows; columns not asked for are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm._common import steps, strings
from lodestar.llm._text import U, Words, gathered_words, mix, word_hash, words

#: Shortest run, in words.
LEAST = 12
STEP = 1 << 21

_PRIMES = (2147483647, 2147483629)
_BASES = (1270318363, 834027191)


def _powers(base: int, p: int, n: int) -> np.ndarray:
    out = np.ones(max(n, 1), U)
    m = 1
    while m < n:
        out[m : 2 * m] = out[: min(m, n - m)] * U(pow(base, m, p)) % U(p)
        m *= 2
    return out


class Prefixes:
    """Fingerprints of any stretch of a sequence of integers, from prefix sums over two prime fields."""

    def __init__(self, ids: np.ndarray):
        self.n = len(ids)
        self.power = [_powers(b, p, self.n + 1) for b, p in zip(_BASES, _PRIMES)]
        self.sums = [np.concatenate([np.zeros(1, U), np.cumsum((ids.astype(U) + U(1)) * w[:-1] % U(p))]) for w, p in zip(self.power, _PRIMES)]

    def of(self, start: np.ndarray, length) -> np.ndarray:
        out = []
        for s, w, p in zip(self.sums, self.power, _PRIMES):
            out.append((s[start + length] - s[start]) % U(p) * w[self.n - start] % U(p))
        return out[0] << U(31) | out[1]


def _bands(least: int, longest: int) -> Iterator[tuple[int, int, int]]:
    """``(smallest lag, lag beyond the largest, guaranteed overlap)`` up to half of the longest document."""
    half = least // 2
    lo = 1
    hi = 1 << max(half.bit_length(), 1)
    while lo <= longest // 2:
        yield lo, hi, max(min(max(least - q, q) for q in range(lo, min(hi, lo + half + 1))), 1)
        lo, hi = hi, hi * 2


def _pairs(print_: np.ndarray, pos: np.ndarray, anchor: np.ndarray, lo: int, hi: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchors and lags (``lo`` to ``hi`` - 1) of equal windows; ``pos`` ascends."""
    slot = (print_ & U((1 << 20) - 1)).astype(np.int64)
    some = np.bincount(slot, minlength=1 << 20)[slot] > 1
    print_, pos, anchor = print_[some], pos[some], anchor[some]
    if not anchor.any():
        return pos[:0], pos[:0]
    rank = np.unique(print_, return_inverse=True)[1].astype(np.int64) * (n + 1)
    index = np.sort((rank + pos)[anchor])
    first = np.searchsorted(index, rank + np.maximum(pos - hi + 1, 0))
    last = np.searchsorted(index, rank + np.maximum(pos - lo + 1, 0))
    each = np.maximum(last - first, 0)
    base = np.cumsum(each) - each
    at = np.arange(int(each.sum())) + np.repeat(first - base, each)
    a = index[at] % (n + 1)
    return a, np.repeat(pos, each) - a


def _reach(fits: Callable[[np.ndarray], np.ndarray], limit: np.ndarray) -> np.ndarray:
    """Largest t in 0..limit that fits, where whatever is smaller than a fitting t fits too."""
    low, high = np.zeros_like(limit), limit.copy()
    while (low < high).any():
        mid = (low + high + 1) >> 1
        ok = fits(mid)
        low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
    return low


def runs_of(ids: np.ndarray, first: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, period)`` of all runs, by start and period.

    ``ids`` are the words of all documents end to end, document d being
    ``ids[first[d]:first[d + 1]]``; starts and ends count from its first entry.
    """
    n = len(ids)
    size = np.diff(first)
    none = np.zeros(0, np.int64)
    if not n or int(size.max()) < least:
        return none, none, none
    doc = np.repeat(np.arange(len(size)), size)
    prefix = Prefixes(ids)
    found = []
    for lo, hi, overlap in _bands(least, int(size.max())):
        k = (overlap + 1) // 2
        pos = np.flatnonzero((size >= max(least, 2 * lo))[doc])
        d = doc[pos]
        inside = pos + k <= first[d + 1]
        pos, d = pos[inside], d[inside]
        place = pos - first[d]
        a, q = _pairs(mix(prefix.of(pos, k) + mix(d.astype(U))), pos, place % k == 0, lo, hi, n)
        if not len(a):
            continue
        order = np.lexsort((a, q))
        a, q = a[order], q[order]
        new = np.ones(len(a), bool)  # not where the lag's last stretch is covered up to here
        new[1:] = (q[1:] != q[:-1]) | (a[1:] != a[:-1] + k) | (doc[a[1:]] != doc[a[:-1]])
        head = np.flatnonzero(new)
        s, e, q = a[head], a[np.append(head[1:], len(a)) - 1] + k, q[head]
        in_ = doc[s]
        left = _reach(lambda t: prefix.of(s - t, t) == prefix.of(s - t + q, t), np.minimum(k - 1, s - first[in_]))
        right = _reach(lambda t: prefix.of(e, t) == prefix.of(e + q, t), np.minimum(k - 1, first[in_ + 1] - q - e))
        s, e = s - left, e + right
        long = e - s >= np.maximum(least - q, q)
        found.append(np.stack([s[long], (e + q)[long], q[long]]))
    if not found:
        return none, none, none
    s, e, q = np.concatenate(found, axis=1)
    order = np.lexsort((q, e, s))
    s, e, q = s[order], e[order], q[order]
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    s, e, q = s[keep], e[keep], q[keep]
    order = np.lexsort((q, s))
    return s[order], e[order], q[order]


def repeated_words(n: int, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of ``n`` words lie in some run behind its first period."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, start + period, 1)
    np.add.at(step, end, -1)
    return np.cumsum(step[:-1]) > 0


#: ``(words, batch) -> words``: another order of each text's words, taken from the batch's rows.
Rewrite = Callable[[Words, pa.RecordBatch], Words]


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", keep: Sequence[str] = (), least: int = LEAST, rewrite: Rewrite | None = None
) -> DataFrame:
    """Per row: id, ``n_words``, ``runs`` (array of start, length, period by start and period), ``collapsed`` text.

    ``collapsed`` joins by one space the words that no run repeats. ``keep``
    names further columns to carry along. ``rewrite`` may rearrange the words of
    a text before runs are looked for.
    """
    cols = [id_col, *keep]
    df = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(cols)], F.col(text).cast("string").alias("text"))
    run = "array<struct<start:long,length:long,period:long>>"
    schema = T._parse_datatype_string(f"n_words long, runs {run}, collapsed string")
    out = T.StructType([*[T.StructField(f"k{i}", df.schema[i].dataType) for i in range(len(cols))], *schema.fields])

    def task(batches):
        for b in steps(batches, "text", STEP):
            w = words(strings(b.column(len(cols))))
            if rewrite is not None:
                w = rewrite(w, b)
            ids = np.unique(word_hash(w), return_inverse=True)[1]
            s, e, q = runs_of(ids, w.first, least)
            home = np.searchsorted(w.first, s, side="right") - 1
            bounds = np.concatenate([[0], np.cumsum(np.bincount(home, minlength=b.num_rows))]).astype(np.int32)
            parts = [pa.array(x.astype(np.int64)) for x in (s - w.first[home], e - s, q)]
            runs = pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays(parts, ["start", "length", "period"]))
            left = gathered_words(w, ~repeated_words(len(ids), s, e, q))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[: len(cols)], pa.array(np.diff(w.first)), runs, left], [*(f"k{i}" for i in range(len(cols))), "n_words", "runs", "collapsed"]
            )

    got = df.mapInArrow(task, out)
    return got.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(cols)], "n_words", "runs", "collapsed")


def planted(w: Words, b: pa.RecordBatch) -> Words:
    """Of documents whose crc32(id) is a multiple of 10, words from a place on go round in a circle of some first ones.

    With h = crc32 of the decimal id, g = floor(h / 10) and n words, word i >= a
    becomes word a + (i - a) % p, where a = g % n and p = 1 + floor((n - a) / (3 + g % 8)).
    Documents without an id stay as they are.
    """
    import zlib

    source = np.arange(len(w.start))
    for d, id_ in enumerate(b.column(0).to_pylist()):
        n = int(w.first[d + 1] - w.first[d])
        h = 1 if id_ is None else zlib.crc32(str(id_).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            source[w.first[d] + a : w.first[d + 1]] = w.first[d] + a + np.arange(n - a) % p
    return Words(w.buf, w.start[source], w.end[source], w.first)


def run_digest(docs: DataFrame) -> DataFrame:
    """Runs of the documents after ``planted``: number, the longest, and digests of all runs and of the collapsed text."""
    best = "array_max(transform(runs, r -> struct(r.length as length, -r.start as s, -r.period as p)))"
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    return periodic_runs(docs, rewrite=planted).select(
        "doc_id",
        F.expr("cast(size(runs) as long)").alias("n_runs"),
        F.expr(f"-{best}.s").alias("start"),
        F.expr(f"{best}.length").alias("length"),
        F.expr(f"-{best}.p").alias("period"),
        F.expr(f"1000 * {best}.length div -{best}.p").alias("exponent_milli"),
        F.sha2(F.expr(lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
