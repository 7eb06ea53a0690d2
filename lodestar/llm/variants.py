"""Spelling variants: words one code point apart, found by sorted permuterm rotations.

Words are maximal runs of letters, counted over all documents. Of a word ``xcy``
(c one code point) the rotation ``y$xc`` of its terminator-marked form ends in
the edited code point. Words that differ by replacing c share the prefix
``y$x``, and the word ``xy``, which lacks c, has ``y$x`` as a whole rotation. So
the rotations are dealt out and sorted by that prefix, the edited code point
skipped, and a scan meets each group of neighbours in one stretch. A group has one
row for each letter of the alphabet and one more at most, and every pair by
replacement meets in one group only. A deletion from a stretch of equal letters
meets in several; it counts at the last letter alone. The scan emits no
pairs: for each word of a group it gives the number of near words there and the
commonest of them, and a sum and a minimum by word do the rest.

Prefixes of more than ``TEXT_KEY`` code points are replaced by fingerprints of 124
bits, so that a word of m letters makes m rows of bounded size, not m^2 letters.

Defined results: a null or empty text has no words; a null id counts as the empty
text in the edit rule; repeated rows count as often as they occur; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm._common import save, steps, strings
from lodestar.llm._text import Words, _lower_table, buffer_of, mix, word_hash
from lodestar.llm.periodic import _PRIMES, _powers

STEP = 1 << 22
#: Longest prefix, in code points, that is sorted as text.
TEXT_KEY = 64
_FOUR_PRIMES = (*_PRIMES, 2147483587, 2147483579)
_FOUR_BASES = (1732050807, 1414213562, 1618033988, 1234567891)


def letter_runs(texts: pa.Array) -> Words:
    """Maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased; in UTF-8 that block is C3 and one more byte."""
    buf, off = buffer_of(texts)
    buf = _lower_table()[buf]
    ok = (buf >= 0x61) & (buf <= 0x7A) | (buf == 0xC3)
    if len(buf):
        ok[1:] |= (buf[1:] >= 0x80) & (buf[1:] <= 0xBF) & (buf[:-1] == 0xC3)
    edge = np.zeros(len(buf) + 1, bool)
    edge[off] = True
    before = np.concatenate([[False], ok[:-1]]) if len(buf) else ok
    after = np.concatenate([ok[1:], [False]]) if len(buf) else ok
    start = np.flatnonzero(ok & (~before | edge[:-1]))
    end = np.flatnonzero(ok & (~after | edge[1:])) + 1
    return Words(buf, start, end, np.searchsorted(start, off))


def _strings(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    n = end - start
    base = np.cumsum(n) - n
    flat = buf[np.arange(int(n.sum())) + np.repeat(start - base, n)]
    off = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(n), [None, pa.py_buffer(off.tobytes()), pa.py_buffer(flat.tobytes())])


def word_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", edit: int | None = None, least_letters: int = 7, least_count: int = 2) -> DataFrame:
    """``word, n`` of all words of enough letters and occurrences.

    With ``edit`` a run loses its code point h % length where h, the crc32 of
    ``<id>:<run>``, is divisible by ``edit``.
    """
    df = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text).cast("string").alias("text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, "text", STEP):
            w = letter_runs(strings(b.column(1)))
            points = np.concatenate([[0], np.cumsum((w.buf & 0xC0) != 0x80)])
            letters = points[w.end] - points[w.start]
            at = np.flatnonzero(letters >= least_letters)
            doc, start, end, letters = w.doc()[at], w.start[at], w.end[at], letters[at]
            h = word_hash(Words(w.buf, start, end, w.first))
            one, times = np.unique(mix(h + mix(doc.astype(np.uint64))), return_index=True, return_counts=True)[1:]  # once a document
            h, doc, start, end, letters = h[one], doc[one], start[one], end[one], letters[one]
            changed, counts = [], []
            if edit:
                raw = w.buf.tobytes()
                seed = [zlib.crc32(i.encode() + b":") for i in b.column(0).to_pylist()]
                crc = np.fromiter((zlib.crc32(raw[s:e], seed[d]) for s, e, d in zip(start.tolist(), end.tolist(), doc.tolist())), np.int64, len(one))
                hit = crc % edit == 0
                for i in np.flatnonzero(hit & (letters > least_letters)):
                    run = raw[start[i] : end[i]].decode()
                    place = int(crc[i] % letters[i])
                    changed.append(run[:place] + run[place + 1 :])
                    counts.append(int(times[i]))
                h, times, start, end = h[~hit], times[~hit], start[~hit], end[~hit]
            rep, code = np.unique(h, return_index=True, return_inverse=True)[1:]
            n = np.bincount(code, times, len(rep)).astype(np.int64)
            words = pa.concat_arrays([_strings(w.buf, start[rep], end[rep]), pa.array(changed, pa.large_string())])
            yield pa.RecordBatch.from_arrays([words.cast(pa.string()), pa.array(np.concatenate([n, np.array(counts, np.int64)]))], ["word", "n"])

    return df.mapInArrow(task, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _long_keys(points: np.ndarray, whole: bool) -> list[str]:
    """Fingerprints of the prefixes ``y$x`` of a word: of all its whole rotations, or of those without the code point before."""
    m = len(points)
    parts = []
    for base, p in zip(_FOUR_BASES, _FOUR_PRIMES):
        power = _powers(base, p, m + 2)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((points.astype(np.uint64) + np.uint64(2)) * power[:m] % np.uint64(p))])
        i = np.arange(0 if whole else 1, m + 1)
        tail = (sums[m] - sums[i]) % np.uint64(p)  # of y, still times power[i]
        head = sums[i if whole else i - 1] % np.uint64(p)
        # y$x as y + $ * power[len y] + x * power[len y + 1], all times power[i]; then turned to one scale, power[m]
        up = power[m - i]
        value = tail * up % np.uint64(p) + power[m - i] * power[m] % np.uint64(p) + head * power[m - i + 1] % np.uint64(p) * power[m] % np.uint64(p)
        scale = np.uint64(pow(pow(base, m, p), -1, p))
        parts.append(value % np.uint64(p) * scale % np.uint64(p))
    n = m if whole else m - 1
    return [f"{n}#{a:x}.{b:x}.{c:x}.{d:x}" for a, b, c, d in zip(*(x.tolist() for x in parts))]


def _rotations(word: str) -> Iterator[tuple[str, int, bool]]:
    """``(prefix, edited code point or -1, whether a deletion counts here)`` for all rotations of ``word``."""
    m = len(word)
    two = word + "$" + word
    whole = [two[i : i + m + 1] for i in range(m + 1)] if m <= TEXT_KEY else _long_keys(np.array([ord(c) for c in word]), True)
    cut = [two[i : i + m] for i in range(1, m + 1)] if m - 1 <= TEXT_KEY else _long_keys(np.array([ord(c) for c in word]), False)
    for key in whole:
        yield key, -1, False
    for i, key in enumerate(cut):
        yield key, ord(word[i]), i + 1 == m or word[i + 1] != word[i]


def rotations(vocabulary: DataFrame) -> DataFrame:
    """Rows ``prefix, letter, last, wid, n`` for every rotation of every word of ``vocabulary`` (wid, word, n)."""

    def task(batches):
        for b in steps(batches, "word", 1 << 17):
            wid, words, n = (b.column(i).to_pylist() for i in range(3))
            keys, letter, last, of, rows = [], [], [], [], 0
            for j, word in enumerate(words):
                for k, c, canonical in _rotations(word):
                    keys.append(k)
                    letter.append(c)
                    last.append(canonical)
                    of.append(j)
                if len(keys) > 200_000 or j + 1 == len(words):
                    at = np.array(of, np.int64)
                    cols = [pa.array(keys, pa.string()), pa.array(letter, pa.int32()), pa.array(last, pa.bool_())]
                    cols += [pa.array(np.array(wid, np.int64)[at]), pa.array(np.array(n, np.int64)[at])]
                    yield pa.RecordBatch.from_arrays(cols, ["prefix", "letter", "last", "wid", "n"])
                    keys, letter, last, of = [], [], [], []

    return vocabulary.select("wid", "word", "n").mapInArrow(task, "prefix string, letter int, last boolean, wid long, n long")


def _scan(table: pa.Table, ratio: int) -> pa.RecordBatch:
    """Near words of whole groups: ``wid, near, cand, cand_n``; a row has at most one candidate, the rest go in further rows."""
    key = table.column(0).combine_chunks()
    letter, last, wid, n = (table.column(i).to_numpy() for i in range(1, 5))
    first = np.ones(len(letter), bool)
    if len(key) > 1:
        first[1:] = ~pc.equal(key.slice(1), key.slice(0, len(key) - 1)).to_numpy(zero_copy_only=False)
    g = np.cumsum(first) - 1
    groups = int(g[-1]) + 1 if len(g) else 0
    whole = letter < 0
    zero = np.full(groups, -1)
    zero[g[whole]] = np.flatnonzero(whole)
    ends = np.bincount(g[~whole], minlength=groups)
    cuts = np.bincount(g[~whole & last], minlength=groups)
    near = np.where(whole, cuts[g], ends[g] - 1 + (last & (zero[g] >= 0)))

    def best(rows):
        """Per group the row of largest n (ties: smallest letter) among ``rows``, and the second."""
        order = rows[np.lexsort((letter[rows], -n[rows], g[rows]))]
        head = np.ones(len(order), bool)
        head[1:] = g[order[1:]] != g[order[:-1]]
        one, two = np.full(groups, -1), np.full(groups, -1)
        one[g[order[head]]] = order[head]
        second = np.flatnonzero(head) + 1
        second = second[second < len(order)]
        second = second[~head[second]]
        two[g[order[second]]] = order[second]
        return one, two

    one, two = best(np.flatnonzero(~whole))
    del_one, _ = best(np.flatnonzero(~whole & last))
    row = np.arange(len(g))
    cand = np.where(whole, del_one[g], np.where(one[g] == row, two[g], one[g]))
    more = np.where(~whole & last, zero[g], -1)
    out_of, out_cand, out_near = [], [], []
    for c, k in ((cand, near), (more, np.zeros_like(near))):
        good = (c >= 0) & (n[c] // ratio >= n)
        take = good | (k > 0)
        out_of.append(row[take])
        out_cand.append(np.where(good, c, -1)[take])
        out_near.append(k[take])
    at, c, k = np.concatenate(out_of), np.concatenate(out_cand), np.concatenate(out_near)
    null = c < 0
    cols = [pa.array(wid[at]), pa.array(k.astype(np.int64)), pa.array(wid[c], mask=null), pa.array(n[c], mask=null)]
    return pa.RecordBatch.from_arrays(cols, ["wid", "near", "cand", "cand_n"])


def neighbours(vocabulary: DataFrame, ratio: int) -> DataFrame:
    """Per word and group with neighbours: ``wid, near, cand, cand_n``; candidates are at least ``ratio`` times as common."""

    def task(batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t])
            if not t.num_rows:
                continue
            key = t.column(0).combine_chunks()
            other = np.flatnonzero(pc.not_equal(key, key[-1]).to_numpy(zero_copy_only=False))
            cut = int(other[-1]) + 1 if len(other) else 0  # the last group may go on in the next batch
            if cut:
                yield _scan(t.slice(0, cut), ratio)
            held = t.slice(cut)
        if held is not None and held.num_rows:
            yield _scan(held, ratio)

    sorted_ = rotations(vocabulary).repartition("prefix").sortWithinPartitions("prefix", "letter")
    return sorted_.mapInArrow(task, "wid long, near long, cand long, cand_n long")


def _roots(links: DataFrame) -> DataFrame:
    """``wid, root``: links followed to their end, twice as far each round. A link at least multiplies n, so few rounds do."""
    links = save(links, "roots")
    while True:
        on = links.select(F.col("wid").alias("root"), F.col("root").alias("further"))
        links = save(links.join(on, "root", "left").select("wid", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if links.filter("moved").isEmpty():
            return links.select("wid", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text: str = "text", edit: int | None = None, least_letters: int = 7, least_count: int = 2, ratio: int = 10) -> DataFrame:
    """Per word: its count, number of near words, commoner form (``ratio`` times as common at least) and root form."""
    if ratio < 2:
        raise ValueError("ratio must be 2 or more, so that forms lead to ever commoner words")
    words = word_counts(docs, id_col, text, edit, least_letters, least_count)
    vocabulary = save(words.select(F.monotonically_increasing_id().alias("wid"), "word", "n"), "vocabulary")
    found = save(neighbours(vocabulary, ratio), "neighbours")
    near = found.groupBy("wid").agg(F.sum("near").alias("n_near"))
    name = vocabulary.select(F.col("wid").alias("cand"), F.col("word").alias("name"))
    choice = found.filter("cand is not null").join(name, "cand")
    forms = choice.groupBy("wid").agg(F.min(F.struct((-F.col("cand_n")).alias("less"), "name", "cand")).alias("f"))
    forms = save(forms.select("wid", F.col("f.name").alias("form"), F.col("f.cand").alias("form_wid"), (-F.col("f.less")).alias("form_n")), "forms")
    roots = _roots(forms.select("wid", F.col("form_wid").alias("root")))
    ends = roots.join(name.select(F.col("cand").alias("root"), F.col("name").alias("root_name")), "root").select("wid", "root_name")
    out = vocabulary.join(near, "wid", "left").join(forms.drop("form_wid"), "wid", "left").join(ends, "wid", "left")
    return out.select("word", "form", F.coalesce("root_name", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
