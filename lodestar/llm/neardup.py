"""Near-duplicate detection: MinHash signatures, multi-index Hamming join, exact check, components.

A document's signature is 64 MinHash values of 16 bits, of which the first are cut
into chunks of 4: two signatures with at most one differing slot in some chunk are
found, since each chunk gives one key per slot left out. The distance threshold is
the number of differing slots six standard deviations above the mean at the asked
similarity (26 at 0.85, 31 at 0.80; 1 in 10^8 pairs at 0.85 lies beyond it). There
are as many chunks as make the pigeonhole hold for it: with threshold // 2 + 1
chunks (14 at 0.85, 16 at 0.80) no pair within the threshold has two errors in every
chunk, so all of them share a key. Below 0.80 a signature has no more chunks: all
pairs of up to 31 differing slots are found and of those beyond MISS at most are
lost, which holds down to 0.71; lower similarities are refused. Pairs beyond the
threshold are dropped before whole texts are fetched, and every link is confirmed
on the full shingle sets.

Equal sets are one class from the start. Among classes that share a key, the
pairs to confirm are not all pairs: first every class is compared with its key's
most popular class (the one whose keys are shared most); what that links
becomes components. Only where the classes of a key are still in different
components are they compared with each other: pair by pair for a few classes,
else in cells of two blocks of classes, whose tasks get the full sets, find all
intersections by one matrix product and return links alone. So no link between
components is lost, and no group is held or paired out as a whole.

Defined results: a null or wordless text has no shingles and is linked with
nothing; rows of one id are one node; a null id says nothing about which texts
belong together, so each set that only null ids have is a node of its own, and a
component of such sets alone has a null id and keeps one text of one of them;
repeated rows share their class; an empty table gives no rows; columns other
than id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm._common import binaries, bitmap_of, has_bit, ranked_id, save, steps, strings
from lodestar.llm._text import NON_SPACE, U, _weights, mix, window_hash, window_starts, word_hash, words
from lodestar.llm.components import components

SLOTS = 64
CHUNK = 4
MISS = 2.1e-8
SIGNED = "id long, h long, n long, s1 long, s2 long, sig binary"
BITS = 26
#: Classes of a key that are compared pair by pair; classes of a block beyond.
FEW, BLOCK = 16, 1024


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, bounds)``: the sorted distinct shingle hashes of each text."""
    w = words(texts, NON_SPACE, lower=True)
    h = word_hash(w)
    at, doc = window_starts(w.first, k)
    g = window_hash(h, k, 400)[at]
    for m in range(1, k):  # fewer words: the whole sequence is the only shingle
        i = np.flatnonzero(np.diff(w.first) == m)
        if len(i):
            g, doc = np.concatenate([g, window_hash(h, m, 400 + m)[w.first[i]]]), np.concatenate([doc, i])
    order = np.lexsort((g, doc))
    g, doc = g[order], doc[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
    g, doc = g[new], doc[new]
    return g, np.searchsorted(doc, np.arange(len(w.first)))


def _signatures(g: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """SLOTS 16-bit MinHash values per set (zeros for an empty one)."""
    out = np.zeros((len(bounds) - 1, SLOTS), "<u2")
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        for k, a in enumerate(_weights(500, SLOTS)):
            out[full, k] = mix(np.minimum.reduceat(g * a, bounds[full]), k) >> U(48)
    return out


def _sum_per(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    c = np.concatenate([np.zeros(1, U), np.cumsum(values, dtype=U)])
    return (c[bounds[1:]] - c[bounds[:-1]]).view(np.int64)


def signed(docs: DataFrame, shingle: int) -> DataFrame:
    """Per row: id, hash of the text, set size, 128-bit hash of the set, signature."""

    def run(batches):
        for b in steps(batches, "text", 1 << 19):
            g, bounds = shingle_sets(strings(b.column(2)), shingle)
            sig = _signatures(g, bounds)
            cols = [np.diff(bounds), _sum_per(mix(g, 1), bounds), _sum_per(mix(g, 2), bounds)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *(pa.array(c, pa.int64()) for c in cols), binaries(sig.ravel(), np.arange(len(sig) + 1) * SLOTS)],
                names=["id", "h", "n", "s1", "s2", "sig"],
            )

    return docs.mapInArrow(run, SIGNED)


def _sig(col: pa.Array) -> np.ndarray:
    off = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1]
    return np.frombuffer(col.buffers()[2], np.uint8)[off[0] : off[-1]].view("<u2").reshape(-1, SLOTS)


def radius_of(percent: int) -> int:
    """Most differing slots of a pair that is looked at: six standard deviations above the mean at the similarity."""
    p = 1 - percent / 100
    return int(SLOTS * p + 6 * np.sqrt(SLOTS * p * (1 - p)))


def chunks_for(percent: int) -> int:
    """Chunks of which one has at most one error in every pair within the radius; as many as there are below 80 %."""
    n = min(SLOTS // CHUNK, radius_of(percent) // 2 + 1)
    p = 1 - percent / 100
    fails = 1 - (1 - p) ** CHUNK - CHUNK * p * (1 - p) ** (CHUNK - 1)
    if 2 * n - 1 < radius_of(percent) and fails**n > MISS:
        raise ValueError(f"a similarity of {percent} % needs more than the {SLOTS} slots of a signature")
    return n


def chunk_keys(classes: DataFrame, percent: int) -> DataFrame:
    """``key, id``: for each chunk, one key per slot that may be in error."""
    chunks = chunks_for(percent)

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            sig = _sig(b.column(1)).astype(U)
            keys = []
            for c in range(chunks):
                for out in range(CHUNK):
                    s = [c * CHUNK + j for j in range(CHUNK) if j != out]
                    x = sig[:, s[0]] | sig[:, s[1]] << U(16) | sig[:, s[2]] << U(32)
                    keys.append(mix(x | U(c * CHUNK + out) << U(48)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.tile(b.column(0).to_numpy(), len(keys)))], names=["key", "id"])

    return classes.select("id", "sig").mapInArrow(run, "key long, id long")


def _near_signatures(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs that differ in no more slots than pairs of the asked similarity do."""
    radius = radius_of(percent)
    sig = classes.select("id", "sig")
    both = pairs.join(sig.select(F.col("id").alias("a"), F.col("sig").alias("sa")), "a").join(sig.select(F.col("id").alias("b"), F.col("sig").alias("sb")), "b")

    def run(batches):
        for b in batches:
            if b.num_rows:
                ok = (_sig(b.column(2)) != _sig(b.column(3))).sum(1) <= radius
                yield b.select([0, 1]).filter(pa.array(ok))

    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def texts_of(ids: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """``id, text`` of some classes' nodes; a bitmap of fixed size keeps most other texts from being shuffled."""
    held = classes.select("id", F.col("own").alias("doc"), "h").join(ids, "id")
    wanted = bitmap_of(held.select(F.xxhash64("doc", "h").alias("x")), "x", BITS)

    def maybe(batches):
        for b in batches:
            yield b.filter(pa.array(has_bit(wanted.value, b.column(2).to_numpy().view(U) >> U(64 - BITS)))).select([0, 1, 3])

    some = docs.select(F.col("id").alias("doc"), "h", F.xxhash64("id", "h").alias("x"), "text").mapInArrow(maybe, "doc long, h long, text string")
    return some.join(held, ["doc", "h"]).dropDuplicates(["doc", "h"]).select("id", "text")


def _similar(inter: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    return 100 * inter >= percent * (na + nb - inter)


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= percent * union."""
    pairs = save(_near_signatures(pairs, classes, percent).distinct(), "pairs")
    ends = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    texts = save(texts_of(ends, classes, docs), "texts")

    def run(batches):
        for whole in batches:
            for b in steps(steps([whole], "ta", 1 << 20), "tb", 1 << 20):
                k = b.num_rows
                g, bounds = shingle_sets(pa.concat_arrays([strings(b.column(2)), strings(b.column(3))]), shingle)
                n = np.diff(bounds)
                pair = np.repeat(np.arange(2 * k) % k, n)
                order = np.lexsort((g, pair))
                same = (g[order][1:] == g[order][:-1]) & (pair[order][1:] == pair[order][:-1])
                inter = np.bincount(pair[order][1:][same], minlength=k)
                yield b.select([0, 1]).filter(pa.array(_similar(inter, n[:k], n[k:], percent)))

    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def links_in_cells(members: DataFrame, classes: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links between the components of a key's many classes. ``members``: key, id, c (component).

    A key's largest component needs no comparison within itself: its blocks meet
    the blocks of all others, and these meet each other.
    """
    parts = members.groupBy("key", "c").agg(F.count("*").alias("n"))
    sizes = parts.groupBy("key").agg(F.max(F.struct("n", "c")).alias("top"), F.sum("n").alias("m"))
    sizes = sizes.select("key", F.col("top.c").alias("big"), F.ceil((F.col("m") - F.col("top.n")) / BLOCK).cast("int").alias("others"), F.ceil(F.col("top.n") / BLOCK).cast("int").alias("own"))
    at = F.xxhash64("id", "key")
    k = F.when(F.col("c") == F.col("big"), F.col("others") + F.pmod(at, F.col("own"))).otherwise(F.pmod(at, F.col("others")))
    members = save(members.join(sizes, "key").withColumn("k", k.cast("int")), "members")

    def sets(batches):
        for b in steps(batches, "text", 1 << 20):
            g, bounds = shingle_sets(strings(b.column(1)), shingle)
            yield pa.RecordBatch.from_arrays([b.column(0), binaries(g, bounds)], names=["id", "set"])

    known = save(texts_of(members.select("id").distinct(), classes, docs).mapInArrow(sets, "id long, set binary"), "sets")
    # Blocks below ``others`` meet every block, the largest component's meet these alone; cell (i, j) has i <= j.
    meets = F.when(F.col("k") < F.col("others"), F.col("others") + F.col("own")).otherwise(F.col("others"))
    cell = F.explode(F.transform(F.sequence(F.lit(0), meets - 1), lambda o: F.struct(F.least("k", o).alias("i"), F.greatest("k", o).alias("j"))))
    rows = members.select("key", "id", "c", "k", cell.alias("cell")).select("key", "cell.i", "cell.j", "id", "c", "k").join(known, "id")

    def link(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, c, k = (table.column(n).to_numpy() for n in ("id", "c", "k"))
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        raw = [np.frombuffer(x.as_buffer(), U) for x in table.column("set")]
        size = np.array([len(x) for x in raw])
        flat, owner = np.concatenate(raw), np.repeat(np.arange(len(raw)), size)
        value, at, often = np.unique(flat, return_inverse=True, return_counts=True)
        shared = often[at] > 1  # what only one has is in no intersection
        at, owner = at[shared], owner[shared]
        cols = np.unique(at)
        at = np.searchsorted(cols, at)
        left, right = np.flatnonzero(k == i), np.flatnonzero(k == j)
        inter = np.zeros((len(left), len(right)))
        order = np.argsort(at, kind="stable")
        at, owner = at[order], owner[order]
        for lo in range(0, len(cols), 2048):
            x = np.zeros((len(raw), 2048), np.float32)
            s = slice(*np.searchsorted(at, [lo, lo + 2048]))
            x[owner[s], at[s] - lo] = 1
            inter += x[left] @ x[right].T
        ok = _similar(inter, size[left, None], size[None, right], percent) & (c[left, None] != c[None, right])
        a, b = np.nonzero(ok)
        a, b = ids[left[a]], ids[right[b]]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return rows.groupBy("key", "i", "j").applyInArrow(link, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, *, shingle: int = 3, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept, class_id (smallest id of equal sets) and h (hash of the text)."""
    chunks_for(percent)  # refuses what it can't find, before any work
    cols = docs.select(ranked_id(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    rows = save(signed(cols, shingle), "signed")
    one = F.min(F.struct("id", "h", "sig")).alias("m")
    null = F.lit((1 << 63) - 1)
    # A class's node is its smallest id; without any, a negative number made from its set.
    node = F.when(F.col("m.id") != null, F.col("m.id")).otherwise(-1 - F.shiftrightunsigned(F.xxhash64("s1", "s2", "n"), 1))
    classes = rows.filter("n > 0").groupBy("s1", "s2", "n").agg(one)
    classes = save(classes.select("s1", "s2", "n", node.alias("id"), F.col("m.id").alias("own"), "m.h", "m.sig"), "classes")

    keys = save(chunk_keys(classes, percent), "keys")
    shared = keys.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1")
    met = save(keys.join(shared, "key"), "met")
    score = met.groupBy("id").agg(F.sum("c").alias("score"))
    scored = met.select("key", "id").join(score, "id")
    head = scored.groupBy("key").agg(F.max(F.struct("score", (-F.col("id")).alias("m"))).alias("top")).select("key", (-F.col("top.m")).alias("b"))
    star = met.select("key", F.col("id").alias("a")).join(head, "key").filter("a != b").select("a", "b").distinct()
    star = save(star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "star")
    links = save(confirmed(star, classes, cols, shingle, percent), "confirmed")
    comp = components(links)

    # Keys whose classes are not of one component yet: all pairs across components that were not compared.
    open_ = met.select("key", "id").join(comp, "id", "left").select("key", "id", F.coalesce("component", "id").alias("c"))
    # Keys with the same classes are looked at once.
    same = [F.count("*").alias("m"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y")]
    mixed = open_.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), *same).filter("lo != hi")
    mixed = mixed.groupBy("m", "x", "y").agg(F.min("key").alias("key")).select("key", "m")
    open_ = save(open_.join(mixed, "key"), "open")
    few = open_.filter(F.col("m") <= FEW)
    left, right = (few.select("key", F.col("id").alias(x), F.col("c").alias(f"c{x}")) for x in "ab")
    across = left.join(right, "key").filter("ca != cb and a < b").select("a", "b").distinct().join(star, ["a", "b"], "left_anti")
    more = confirmed(across, classes, cols, shingle, percent)
    more = more.unionByName(links_in_cells(open_.filter(F.col("m") > FEW).drop("m"), classes, cols, shingle, percent))
    # The first components are links too: a node and its component.
    comp = components(comp.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more))

    # A component's id is the smallest of its classes' ids. ``first``: the node that keeps a text where it has none.
    known = classes.select("s1", "s2", "n", "id", F.col("own").alias("class_id"), F.col("h").alias("class_h")).join(comp, "id", "left")
    known = known.withColumn("component", F.coalesce("component", "id"))
    least = known.groupBy("component").agg(F.min("class_id").alias("component_id"), F.min("id").alias("first"))
    known = known.join(least, "component").select("s1", "s2", "n", "class_id", "component_id", F.when(F.col("id") == F.col("first"), F.col("class_h")).alias("first_h"))
    out = rows.drop("sig").join(known, ["s1", "s2", "n"], "left")
    plain = lambda c: F.when(c != null, c)
    own = F.coalesce("component_id", "id")
    # Without ids, rows of one text are copies; a row without shingles is alone.
    first = F.col("component_id").isNull() | (F.col("id") != null) | F.coalesce(F.col("h") == F.col("first_h"), F.lit(False))
    return out.select(
        plain(F.col("id")).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        plain(own).alias("component_id"),
        ((F.col("id") == own) & first).alias("kept"),
        plain(F.coalesce("class_id", "id")).alias("class_id"),
        "h",
    )


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that stay, one row of each component, with all their columns."""
    near = near_duplicates(docs, id_col=id_col, text_col=text_col, **options).filter("kept")
    stay = near.select(ranked_id("doc_id").alias("_id"), F.col("h").alias("_h")).distinct()
    rows = docs.join(stay, (ranked_id(id_col) == F.col("_id")) & (F.xxhash64(text_col) == F.col("_h")))
    return rows.dropDuplicates(["_id", "_h"]).select(*(docs[c] for c in docs.columns))


def near_duplicate_digest(docs: DataFrame, **options) -> DataFrame:
    return near_duplicates(docs, **options).select("doc_id", "n_shingles", "component_id", "kept")
