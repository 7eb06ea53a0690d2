"""Brown class-based bigram model: exchange clustering, class transitions, word emissions.

Texts are read once into chunks of about a million tokens: sorted 64-bit hashes
of a chunk's distinct words, a hash of each word's ending, token positions in
that list, and training counts.
Totals of all words are summed by slices of the hash range and sent back to the
chunks that have the word, so no vocabulary is ever broadcast or collected.

Classes: the ``core`` most frequent words are units of their own, all others
fall into ``endings`` units by a hash of their last three bytes. Exchange
clustering moves units between ``classes``, each to the class that raises the
likelihood of the class bigrams most. It starts with the core, word after word
on its table of bigrams
(core x core counts, summed by Spark over all training text). Then come rounds
over the other units: Spark counts the classes before and after each unit (a
table of fixed size), and parts of it are improved side by side; all units move
in the first round and a half of them in the others, so that neighbours don't
swap forever. The end of a text has a class of its own, which also stands before
its first word.

At last every other training word, however rare, is exchanged by itself
(``own_classes``): from how often each class stands before it, summed over all
training text by slices of the hash range, it goes to the class that raises the
likelihood most. Units keep their classes as what stands before a word, so the
class pairs follow from the same counts. All move side by side in one step, so
words of one unit that would gain by parting may still choose the same class.
Only words without training text take their ending's.

P(w | v) = share * P(class w | class v) P(w | class w) + (1 - share) * P(w),
with add-0.5 emissions (one unseen word per class), transitions smoothed towards
class frequencies, and the add-0.5 unigram ``base``.

Defined results: a null or wordless text is its end alone; a null id is never
held out; repeated rows count as often as they occur; without training text
every token has c = 0 and both scores are the base; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm._common import save, shuffle_width, steps, strings, train_fold
from lodestar.llm._text import NON_SPACE, U, word_hash, words

CHUNK_TOKENS = 1_000_000
SLICE_TYPES = 2_000_000
CORE, ENDINGS, CLASSES = 1024, 1 << 14, 64
ROUNDS, SWEEPS = 3, 12
SHARE, PULL = 0.95, 5.0
#: Bytes of a word's ending.
ENDING_BYTES = 3
#: Stands for the end of a text; word hashes that equal it are moved by one.
END = 0
CHUNKS = "chunk long, doc_ids array<long>, held array<boolean>, n_tokens array<long>, types binary, ends binary, counts binary, tokens binary"


def read_chunks(docs: DataFrame) -> DataFrame:
    """``CHUNKS`` of ``doc_id, held_out, text``; tokens index ``types`` (sorted; the end is at 0)."""

    def run(batches):
        from pyspark import TaskContext

        base, seq = TaskContext.get().partitionId() << 32, 0
        held, n = [], 0

        def row():
            tokens = np.concatenate([x[3] for x in held])
            per = np.concatenate([x[2] for x in held])
            out = np.concatenate([x[1] for x in held])
            types, one_, at = np.unique(np.append(tokens, U(END)), return_index=True, return_inverse=True)
            at = at[:-1].astype("<u4")
            ends = np.append(np.concatenate([x[4] for x in held]), np.uint16(0))[one_]
            counts = np.bincount(at[np.repeat(~out, per)], minlength=len(types))
            one = pa.array([0, len(per)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([base + seq], pa.int64()),
                    pa.ListArray.from_arrays(one, pa.concat_arrays([x[0] for x in held])),
                    pa.ListArray.from_arrays(one, pa.array(out)),
                    pa.ListArray.from_arrays(one, pa.array(per, pa.int64())),
                    *(pa.array([x.tobytes()], pa.binary()) for x in (types.astype("<u8"), ends.astype("<u2"), counts.astype("<u4"), at)),
                ],
                names=[c.split()[0] for c in CHUNKS.split(", ")],
            )

        for b in steps(batches, "text"):
            w = words(strings(b.column(2)), NON_SPACE, lower=True)
            h = np.maximum(word_hash(w), U(END + 1))
            ending = word_hash(w._replace(start=np.maximum(w.start, w.end - ENDING_BYTES))) >> U(48)
            held.append(
                (
                    b.column(0),
                    b.column(1).to_numpy(zero_copy_only=False).astype(bool),
                    np.diff(w.first) + 1,
                    np.insert(h, w.first[1:], U(END)),
                    np.insert(ending.astype(np.uint16), w.first[1:], np.uint16(0)),
                )
            )
            n += len(h) + b.num_rows
            if n >= CHUNK_TOKENS:
                yield row()
                held, n, seq = [], 0, seq + 1
        if held:
            yield row()

    return docs.mapInArrow(run, CHUNKS)


def _col(b: pa.RecordBatch, name: str, i: int, dtype: str) -> np.ndarray:
    return np.frombuffer(b.column(b.schema.get_field_index(name))[i].as_buffer(), dtype)


class Units(NamedTuple):
    """Units of words: the core's own, then one per ending; the end of a text has the one after the last."""

    core: np.ndarray  # sorted hashes of the core's words
    endings: int

    @property
    def size(self) -> int:  # without the end, in whole parts
        return -(-(len(self.core) + self.endings) // PART) * PART

    def of(self, types: np.ndarray, ends: np.ndarray) -> np.ndarray:
        u = len(self.core) + (ends & np.uint16(self.endings - 1)).astype(np.int64)
        if len(self.core):
            i = np.minimum(np.searchsorted(self.core, types), len(self.core) - 1)
            u = np.where(self.core[i] == types, i, u)
        return np.where(types == U(END), self.size, u)


def hash_slices(chunks: DataFrame) -> int:
    n_types = chunks.agg(F.sum(F.length("types"))).first()[0] or 0
    return max(shuffle_width(chunks.sparkSession), n_types // 8 // SLICE_TYPES + 1)


def _edges(types: np.ndarray, slices: int) -> np.ndarray:
    """Where each slice of the hash range begins in sorted ``types``, and their end."""
    return np.append(np.searchsorted(types, np.array([(k << 64) // slices for k in range(slices)], U)), len(types))


def word_totals(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts in all training text: per chunk and slice of its words; and per slice its words, their endings and counts."""
    slices = hash_slices(chunks)

    def split(batches):
        for b in batches:
            for i in range(b.num_rows):
                types, ends, counts = _col(b, "types", i, "<u8"), _col(b, "ends", i, "<u2"), _col(b, "counts", i, "<u4")
                edge = _edges(types, slices)
                k = np.flatnonzero(np.diff(edge))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(k, pa.int32()),
                        pa.array(np.full(len(k), b.column(0)[i].as_py())),
                        *(pa.array([x[edge[j] : edge[j + 1]].tobytes() for j in k], pa.binary()) for x in (types, ends, counts)),
                    ],
                    names=["slice", "chunk", "types", "ends", "counts"],
                )

    def total(batches):
        # A partition is one slice of the hash range.
        rows = [(b.column(0)[i].as_py(), b.column(1)[i].as_py(), _col(b, "types", i, "<u8"), _col(b, "ends", i, "<u2"), _col(b, "counts", i, "<u4")) for b in batches for i in range(b.num_rows)]
        if not rows:
            return
        types, one, at = np.unique(np.concatenate([r[2] for r in rows]), return_index=True, return_inverse=True)
        n = np.zeros(len(types), np.int64)
        np.add.at(n, at, np.concatenate([r[4] for r in rows]).astype(np.int64))
        ends = np.concatenate([r[3] for r in rows])[one]
        none = pa.nulls(1, pa.binary())

        def row(chunk, n, types, ends):
            cols = [pa.array([rows[0][0]], pa.int32()), pa.array([chunk], pa.int64()), pa.array([n.astype("<i8").tobytes()], pa.binary()), types, ends]
            return pa.RecordBatch.from_arrays(cols, names=["slice", "chunk", "n", "types", "ends"])

        done = 0
        for _, chunk, t, *_ in rows:
            yield row(chunk, n[at[done : done + len(t)]], none, none)
            done += len(t)
        known = n > 0
        yield row(None, n[known], *(pa.array([x[known].tobytes()], pa.binary()) for x in (types, ends)))

    sent = chunks.select("chunk", "types", "ends", "counts").mapInArrow(split, "slice int, chunk long, types binary, ends binary, counts binary")
    got = save(sent.repartitionById(slices, F.col("slice")).mapInArrow(total, "slice int, chunk long, n binary, types binary, ends binary"), "totals")
    return got.filter("chunk is not null").select("slice", "chunk", "n"), got.filter("chunk is null").select("n", "types", "ends")


def choose_units(known: DataFrame, core: int, endings: int) -> Units:
    """The ``core`` words of the highest counts (ties: smaller hash) have units of their own."""

    def top(batches):
        for b in batches:
            for i in range(b.num_rows):
                n, types = _col(b, "n", i, "<i8"), _col(b, "types", i, "<u8")
                word = types != U(END)
                n, types = n[word], types[word]
                k = np.lexsort((types, -n))[:core]
                yield pa.RecordBatch.from_arrays([pa.array(types[k].view(np.int64)), pa.array(n[k])], names=["t", "n"])

    rows = known.mapInArrow(top, "t long, n long").orderBy(F.desc("n"), "t").limit(core).collect()  # at most ``core``
    return Units(np.sort(np.array([r["t"] for r in rows], np.int64).view(U)), endings)


def unit_sizes(known: DataFrame, units: Units) -> tuple[np.ndarray, np.ndarray]:
    """Per unit, and at last for the end: training tokens, distinct words."""

    def run(batches):
        both = np.zeros((2, units.size + 1), np.int64)
        for b in batches:
            for i in range(b.num_rows):
                u = units.of(_col(b, "types", i, "<u8"), _col(b, "ends", i, "<u2"))
                np.add.at(both[0], u, _col(b, "n", i, "<i8"))
                both[1] += np.bincount(u, minlength=units.size + 1)
        k = np.flatnonzero(both[1])
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(both[0][k]), pa.array(both[1][k])], names=["u", "n", "v"])

    out = np.zeros((2, units.size + 1), np.int64)
    for r in known.mapInArrow(run, "u long, n long, v long").groupBy("u").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():  # a row per unit
        out[:, r["u"]] = r["n"], r["v"]
    return out[0], out[1]


PART = 512


def _train_units(b: pa.RecordBatch, units: Units):
    """Units of the training tokens of each chunk of a batch."""
    for i in range(b.num_rows):
        per = b.column(b.schema.get_field_index("n_tokens"))[i].values.to_numpy()
        out = b.column(b.schema.get_field_index("held"))[i].values.to_numpy(zero_copy_only=False)
        unit = units.of(_col(b, "types", i, "<u8"), _col(b, "ends", i, "<u2"))[_col(b, "tokens", i, "<u4")][np.repeat(~out, per)]
        if len(unit):
            yield unit


def neighbours(chunks: DataFrame, of: np.ndarray, units: Units, classes: int) -> DataFrame:
    """Per part of PART units: how often each class stands before and after each unit, over all training bigrams."""
    parts = units.size // PART

    def count(batches):
        near = np.zeros((2, units.size * classes), np.int64)
        seen = False
        for b in batches:
            for unit in _train_units(b, units):
                seen = True
                c = of[unit]
                # Before the first word stands the end of the text before it, which has the same class as a start.
                word = unit < units.size
                for k, other in ((0, np.concatenate([c[-1:], c[:-1]])), (1, np.concatenate([c[1:], c[:1]]))):
                    near[k] += np.bincount(unit[word] * classes + other[word], minlength=units.size * classes)
        if seen:
            near = near.reshape(2, parts, PART * classes).astype("<i8")
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(parts), pa.int32()), pa.array([near[:, p].tobytes() for p in range(parts)], pa.binary())], names=["part", "near"])

    def merge(batches):
        # A partition is one part.
        total, part = 0, None
        for b in batches:
            for i in range(b.num_rows):
                part, total = b.column(0)[i].as_py(), total + _col(b, "near", i, "<i8")
        if part is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "near"])

    sent = chunks.select("types", "ends", "tokens", "n_tokens", "held").mapInArrow(count, "part int, near binary")
    return save(sent.repartitionById(parts, F.col("part")).mapInArrow(merge, "part int, near binary"), "near")


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def core_bigrams(chunks: DataFrame, units: Units) -> np.ndarray:
    """Counts of adjacent pairs of the core's units; the last two rows and columns are other units and the end."""
    k = len(units.core) + 2
    place = np.full(units.size + 1, k - 2)
    place[: k - 2] = np.arange(k - 2)
    place[units.size] = k - 1

    def count(batches):
        n = np.zeros(k * k, np.int64)
        for b in batches:
            for unit in _train_units(b, units):
                c = place[unit]
                n += np.bincount(np.concatenate([c[-1:], c[:-1]]) * k + c, minlength=k * k)
        for row in range(k):  # a row of the table at a time, its non-zero cells
            x = n[row * k : (row + 1) * k]
            i = np.flatnonzero(x)
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), row), pa.int32()), pa.array(i, pa.int32()), pa.array(x[i])], names=["a", "b", "n"])

    cells = chunks.select("types", "ends", "tokens", "n_tokens", "held").mapInArrow(count, "a int, b int, n long")
    table = np.zeros((k, k), np.int64)
    for r in cells.groupBy("a").agg(F.collect_list("b").alias("b"), F.collect_list("n").alias("n")).toLocalIterator():
        np.add.at(table[r["a"]], r["b"], r["n"])
    return table


def core_classes(n: np.ndarray, classes: int, sweeps: int) -> np.ndarray:
    """Exchange clustering of the core's units, most frequent first, into classes 1 to ``classes - 2``.

    ``n``: ``core_bigrams``. The end is class 0 and other units are the last class; they stay.
    """
    k = len(n) - 2
    order = np.argsort(-n[:, :k].sum(0), kind="stable")
    of = np.append(np.zeros(k, np.int64), [classes - 1, 0])
    of[order] = np.arange(k) % (classes - 2) + 1
    n = n.astype(np.float64)
    rows = np.zeros((classes, len(n)))
    np.add.at(rows, of, n)  # class before, unit after
    cols = np.zeros((len(n), classes))
    np.add.at(cols.T, of, n.T)  # unit before, class after
    pairs = np.zeros((classes, classes))
    np.add.at(pairs, of, cols)
    size = pairs.sum(0)
    f = _xlogx(pairs)
    for _ in range(sweeps):
        moved = 0
        for u in order:
            a, left, right, self_, c = of[u], rows[:, u].copy(), cols[u].copy(), n[u, u], n[:, u].sum()
            if not c:
                continue
            # Without u: its own class loses it as neighbour, too.
            left[a] -= self_
            right[a] -= self_
            pairs[:, a] -= left
            pairs[a, :] -= right
            pairs[a, a] -= self_
            size[a] -= c
            pairs[[a], :] = np.maximum(pairs[[a], :], 0)
            f[:, a], f[a, :] = _xlogx(pairs[:, a]), _xlogx(pairs[a, :])
            gain = (_xlogx(pairs + left[:, None]) - f).sum(0) + (_xlogx(pairs + right[None, :]) - f).sum(1)
            d = np.arange(classes)
            gain -= (_xlogx(pairs[d, d] + left) - f[d, d]) + (_xlogx(pairs[d, d] + right) - f[d, d])
            gain += _xlogx(pairs[d, d] + left + right + self_) - f[d, d]
            gain -= 2 * (_xlogx(size + c) - _xlogx(size))
            gain[[0, classes - 1]] = -np.inf
            to = int(np.argmax(gain))
            of[u] = to
            pairs[:, to] += left
            pairs[to, :] += right
            pairs[to, to] += self_
            size[to] += c
            f[:, to], f[to, :] = _xlogx(pairs[:, to]), _xlogx(pairs[to, :])
            if to != a:
                moved += 1
                rows[a] -= n[u]
                rows[to] += n[u]
                cols[:, a] -= n[:, u]
                cols[:, to] += n[:, u]
        if not moved:
            break
    return of[:k]


def class_bigrams(near: DataFrame, of: np.ndarray, end_end: int, classes: int) -> np.ndarray:
    """Counts of class pairs; row: the class before. Class 0 is the end."""

    def run(batches):
        n = np.zeros((2, classes, classes), np.int64)
        for b in batches:
            for i in range(b.num_rows):
                p = b.column(0)[i].as_py()
                x = _col(b, "near", i, "<i8").reshape(2, PART, classes)
                mine = of[p * PART : (p + 1) * PART]
                np.add.at(n[0], mine, x[0])  # class of the unit, class before
                np.add.at(n[1], mine, x[1])
        yield pa.RecordBatch.from_arrays([pa.array([n.tobytes()], pa.binary())], names=["n"])

    got = [np.frombuffer(r["n"], np.int64).reshape(2, classes, classes) for r in near.mapInArrow(run, "n binary").collect()]  # at most a row per part
    before, after = sum(got, np.zeros((2, classes, classes), np.int64))
    pairs = before.T.copy()
    pairs[:, 0] = after[:, 0]  # words before an end
    pairs[0, 0] = end_end
    return pairs


def exchanged(near: DataFrame, of: np.ndarray, pairs: np.ndarray, movable: np.ndarray, classes: int) -> np.ndarray:
    """Classes after the ``movable`` units have each moved to their best class."""
    n = pairs.astype(np.float64)
    size = n.sum(0)

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                p = b.column(0)[i].as_py()
                x = _col(b, "near", i, "<i8").reshape(2, PART, classes).astype(np.float64)
                mine = of[p * PART : (p + 1) * PART].copy()
                for u in np.flatnonzero((x[0].sum(1) > 0) & movable[p * PART : (p + 1) * PART]):
                    left, right = x[0, u], x[1, u]
                    a, k = mine[u], left.sum()
                    m = n.copy()
                    m[:, a] -= left
                    m[a, :] -= right
                    np.maximum(m, 0, out=m)
                    rest = size.copy()
                    rest[a] -= k
                    # Gain of joining each class: its column gets what stands before, its row what stands after.
                    gain = (_xlogx(m + left[:, None]) - _xlogx(m)).sum(0) + (_xlogx(m + right[None, :]) - _xlogx(m)).sum(1) - 2 * (_xlogx(rest + k) - _xlogx(rest))
                    gain[0] = -np.inf
                    mine[u] = int(np.argmax(gain))
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([mine.astype("<i8").tobytes()], pa.binary())], names=["part", "of"])

    out = of.copy()
    for r in near.mapInArrow(run, "part int, of binary").collect():  # units numbers in all
        out[r["part"] * PART : (r["part"] + 1) * PART] = np.frombuffer(r["of"], "<i8")
    return out


class Model:
    """Tables of fixed size: class of each unit, class pairs, class sizes; and the training text's totals."""

    def __init__(self, *tables):
        self.tables = tables  # plain values, from which workers make the model again
        units, of, pairs, unit_n, unit_v, share, pull, *moved = tables
        units, classes = Units(*units), len(pairs)
        self.of, self.units, self.share = of, units, share
        self.n, self.v = int(unit_n.sum()), int(unit_v.sum())
        self.class_n, self.class_v = (np.bincount(of, x, classes) for x in (unit_n, unit_v))
        if moved:  # by ``own_classes``: changes of class pairs, and of the words in each class
            pairs, self.class_v = pairs + moved[0], self.class_v + moved[1]
            self.class_n = self.class_n + moved[0].sum(0)
        if self.n:
            prior = (self.class_n + 1) / (self.n + classes)
            self.step = np.log((pairs + pull * prior[None, :]) / (pairs.sum(1, keepdims=True) + pull))

    def score(self, types: np.ndarray, ends: np.ndarray, total: np.ndarray, tokens: np.ndarray, per: np.ndarray, own: np.ndarray | None = None):
        """Per text: known tokens, base score, model score (log10). ``own``: classes of ``types`` (else their units')."""
        c, first = total[tokens], np.cumsum(per) - per
        base = np.log((c + 0.5) / (self.n + 0.5 * (self.v + 1)))
        out = base
        if self.n:
            unit_k = self.of[self.units.of(types, ends)]
            k = unit_k if own is None else own
            emit = np.log((total + 0.5) / (self.class_n[k] + 0.5 * (self.class_v[k] + 1)))
            emit[k == 0] = 0.0  # the end's class has no other word
            k = k[tokens]
            before = np.concatenate([[0], unit_k[tokens[:-1]]])
            before[first] = 0  # every text starts anew
            step = self.step[before, k]
            out = np.logaddexp(np.log(self.share) + step + emit[tokens], np.log1p(-self.share) + base)
        return np.add.reduceat((c > 0).astype(np.int64), first), np.add.reduceat(base, first) / np.log(10), np.add.reduceat(out, first) / np.log(10)


def fit(
    chunks: DataFrame,
    *,
    core: int = CORE,
    endings: int = ENDINGS,
    classes: int = CLASSES,
    rounds: int = ROUNDS,
    sweeps: int = SWEEPS,
    share: float = SHARE,
    pull: float = PULL,
) -> tuple[Model, DataFrame]:
    """The model, and every chunk's word totals. ``endings``: a power of two, 65,536 at most."""
    totals, known = word_totals(chunks)
    units = choose_units(known, core, endings)
    unit_n, unit_v = unit_sizes(known, units)
    of = np.full(units.size + 1, classes - 1)
    of[-1] = 0
    pairs = np.zeros((classes, classes), np.int64)
    if unit_n.sum():
        k = len(units.core)
        of[:k] = core_classes(core_bigrams(chunks, units), classes, sweeps)
        half = (np.arange(units.size) * 0x9E3779B1 >> 7) % 2
        for turn in range(rounds + 1):
            near = neighbours(chunks, of, units, classes)
            pairs = class_bigrams(near, of, 0, classes)
            pairs[0, 0] = unit_n[-1] - pairs[1:, 0].sum()  # texts without words
            if turn < rounds:
                movable = (np.arange(units.size) >= k) & ((half == turn % 2) | (turn == 0))
                of = exchanged(near, of, pairs, movable, classes)
    return Model(tuple(units), of, pairs, unit_n, unit_v, share, pull), totals


OWN_STEP = 1 << 15


def best_classes(word: np.ndarray, before: np.ndarray, n: np.ndarray, old: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Best class of each word: ``n`` times class ``before`` stands before ``word`` (ascending numbers), which is now in class ``old``.

    The likelihood of class pairs changes by the cells that hold the word's counts and by the sizes of the classes.
    """
    table, size, out = pairs.astype(np.float64), pairs.sum(0).astype(np.float64), old.copy()
    new = np.flatnonzero(np.append(True, np.diff(word) != 0)) if len(word) else np.zeros(0, np.int64)
    ends, s = np.append(new[1:], len(word)), 0
    while s < len(new):  # some words at a time
        e = max(s + 1, int(np.searchsorted(ends, new[s] + OWN_STEP, side="right")))
        rows = slice(new[s], ends[e - 1])
        w, x, row = word[new[s:e]], n[rows].astype(np.float64), np.arange(ends[e - 1] - new[s])
        total = np.add.reduceat(x, new[s:e] - new[s])
        cell = table[before[rows]]  # per entry: its row of the table, without the word
        cell[row, old[word[rows]]] -= x
        np.maximum(cell, 0, out=cell)
        gain = np.add.reduceat(_xlogx(cell + x[:, None]) - _xlogx(cell), new[s:e] - new[s], axis=0)
        rest = np.tile(size, (e - s, 1))
        rest[np.arange(e - s), old[w]] -= total
        np.maximum(rest, 0, out=rest)
        gain -= _xlogx(rest + total[:, None]) - _xlogx(rest)
        gain[:, 0] = -np.inf
        out[w] = gain.argmax(1)
        s = e
    return out


def own_classes(chunks: DataFrame, model: Model) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Classes of each chunk's words by slice (``slice, chunk, k``), each training word outside the core exchanged by itself.

    And how that changes the class pairs (units before, words after) and the number of words in each class.
    """
    tables, slices = model.tables, hash_slices(chunks)
    classes = len(tables[2])
    cols = ["slice", "chunk", "types", "ends", "entries", "before", "n"]

    def count(batches):
        units, of = Units(*tables[0]), tables[1]
        for b in batches:
            for i in range(b.num_rows):
                types, ends = _col(b, "types", i, "<u8"), _col(b, "ends", i, "<u2")
                unit = units.of(types, ends)
                per = b.column(b.schema.get_field_index("n_tokens"))[i].values.to_numpy()
                out = b.column(b.schema.get_field_index("held"))[i].values.to_numpy(zero_copy_only=False)
                t = _col(b, "tokens", i, "<u4")[np.repeat(~out, per)].astype(np.int64)
                key = np.zeros(0, np.int64)
                if len(t):
                    # Before the first word stands the end of the text before it, of the same class as a start.
                    key = t * classes + of[unit[np.concatenate([t[-1:], t[:-1]])]]
                    key = key[(unit[t] >= len(units.core)) & (unit[t] < units.size)]
                key, n = np.unique(key, return_counts=True)
                entries = np.bincount(key // classes, minlength=len(types)).astype("<u4")
                at, edge = np.concatenate([[0], np.cumsum(entries, dtype=np.int64)]), _edges(types, slices)
                before, n = (key % classes).astype("<u2"), n.astype("<u4")
                k = np.flatnonzero(np.diff(edge))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(k, pa.int32()),
                        pa.array(np.full(len(k), b.column(b.schema.get_field_index("chunk"))[i].as_py(), np.int64)),
                        *(pa.array([x[edge[j] : edge[j + 1]].tobytes() for j in k], pa.binary()) for x in (types, ends, entries)),
                        *(pa.array([x[at[edge[j]] : at[edge[j + 1]]].tobytes() for j in k], pa.binary()) for x in (before, n)),
                    ],
                    names=cols,
                )

    def choose(batches):
        # A partition is one slice of the hash range.
        units, of = Units(*tables[0]), tables[1]
        rows = [(b.column(0)[i].as_py(), b.column(1)[i].as_py(), *(_col(b, c, i, d) for c, d in zip(cols[2:], ("<u8", "<u2", "<u4", "<u2", "<u4")))) for b in batches for i in range(b.num_rows)]
        if not rows:
            return
        types, one, at = np.unique(np.concatenate([r[2] for r in rows]), return_index=True, return_inverse=True)
        old = of[units.of(types, np.concatenate([r[3] for r in rows])[one])]
        key = np.repeat(at, np.concatenate([r[4] for r in rows])) * classes + np.concatenate([r[5] for r in rows])
        key, place = np.unique(key, return_inverse=True)
        n = np.zeros(len(key), np.int64)
        np.add.at(n, place, np.concatenate([r[6] for r in rows]).astype(np.int64))
        word, before = key // classes, key % classes
        own = best_classes(word, before, n, old, tables[2])
        pairs, v = np.zeros((classes, classes), np.int64), np.zeros(classes, np.int64)
        for k, sign in ((own, 1), (old, -1)):
            np.add.at(pairs, (before, k[word]), sign * n)
            np.add.at(v, k[np.unique(word)], sign)
        done = 0
        for r in rows:
            k = own[at[done : done + len(r[2])]].astype("<u2").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([r[0]], pa.int32()), pa.array([r[1]], pa.int64()), pa.array([k], pa.binary())], names=["slice", "chunk", "k"])
            done += len(r[2])
        yield pa.RecordBatch.from_arrays([pa.array([r[0]], pa.int32()), pa.nulls(1, pa.int64()), pa.array([pairs.tobytes() + v.tobytes()], pa.binary())], names=["slice", "chunk", "k"])

    sent = chunks.select("chunk", "types", "ends", "tokens", "n_tokens", "held").mapInArrow(count, "slice int, chunk long, types binary, ends binary, entries binary, before binary, n binary")
    got = save(sent.repartitionById(slices, F.col("slice")).mapInArrow(choose, "slice int, chunk long, k binary"), "own")
    moved = np.zeros((classes + 1, classes), np.int64)
    for r in got.filter("chunk is null").select("k").toLocalIterator():  # a table of fixed size per slice, one after the other
        moved += np.frombuffer(r["k"], np.int64).reshape(classes + 1, classes)
    return got.filter("chunk is not null"), moved[:-1], moved[-1]


def score(docs: DataFrame, *, folds: int = 5, held: int = 1, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Learn from the documents outside the held-out fold, score all: per document its tokens and log10 probabilities."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), train_fold(docs, folds, held, id_col).alias("held_out"), F.col(text_col).alias("text"))
    chunks = save(read_chunks(rows), "chunks")
    model, totals = fit(chunks, **options)
    own, pairs, v = own_classes(chunks, model)
    shared = docs.sparkSession.sparkContext.broadcast((*model.tables, pairs, v))
    by_chunk = totals.join(own, ["slice", "chunk"]).groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("slice", "n", "k"))).alias("x"))
    by_chunk = by_chunk.select("chunk", F.col("x.n").alias("totals"), F.col("x.k").alias("own"))

    def run(batches):
        m = Model(*shared.value)
        for b in batches:
            for i in range(b.num_rows):
                types, ends, tokens = _col(b, "types", i, "<u8"), _col(b, "ends", i, "<u2"), _col(b, "tokens", i, "<u4")
                per = b.column(2)[i].values.to_numpy()
                total = np.frombuffer(b"".join(b.column(6)[i].as_py()), "<i8")
                known, base, s = m.score(types, ends, total, tokens, per, np.frombuffer(b"".join(b.column(7)[i].as_py()), "<u2"))
                k = len(per)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[i].values, b.column(1)[i].values, pa.array(per, pa.int64()), pa.array(known), pa.array(np.full(k, m.n)), pa.array(base), pa.array(s)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    both = chunks.drop("counts").join(by_chunk, "chunk").select("doc_ids", "held", "n_tokens", "types", "ends", "tokens", "totals", "own")
    return both.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
