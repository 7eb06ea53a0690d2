"""A6 in the plane: the sum of all pair distances by a tree of squares, N log N.

1. Equal points become one row with a count. Points are sorted by their place on
   a Z curve: its leading bits name the square of each level that holds a point.
2. From pairs of neighbouring squares (a square is its own neighbour) Spark goes
   down level by level. A pair of at most ``pairs`` point pairs is left to a task
   that computes them; any other falls into pairs of the next level's squares.
   Of those, neighbours go on, the rest lie at least a square's width apart.
3. Over squares apart the distance is smooth: it is interpolated at ``NODES``
   Chebyshev nodes an axis, to about 1e-14 of the sum (tested), less than the
   rounding of a plain sum. A square is then known by its weights at the nodes.

Each step is a join or an aggregate over rows, squares or pairs of squares; a
point goes to its own square and a bounded number of neighbours on each level
with such tiles, and no task holds more than a square and its neighbours. Of points that
squares of the last level can't part (2^-31 of the table's width), pairs of squares of
at most ``BLOCK_PAIRS`` point pairs are compared in blocks of a bounded size; beyond,
the points of such squares get a tree of their own.
"""

from __future__ import annotations

import math
from collections import Counter
from contextlib import ExitStack
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.plans import storage
from lodestar.plans.storage import local_frame

DEPTH = 31
NODES = 18
#: Point pairs that a task computes rather than parting them.
TILE_PAIRS = 1 << 20
BLOCK_ROWS = 1 << 10
#: Of squares of the last level, point pairs that are compared in blocks: N times its root at most, in all.
BLOCK_PAIRS = 1 << 32
#: Below this width squared distances have lost their digits, and no tree is built.
TINY = 1e-140


def distance_sum(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> float:
    """Sum of the distances of all (row of a, row of b) pairs with their counts."""
    total, step = 0.0, max(1, (1 << 16) // max(1, len(b)))
    for s in range(0, len(a), step):
        d = a[s : s + step, 0, None] - b[None, :, 0]
        e = a[s : s + step, 1, None] - b[None, :, 1]
        d *= d
        e *= e
        d += e
        total += float(na[s : s + step] @ (np.sqrt(d, out=d) @ nb))
    return total


def _spaced(v: np.ndarray) -> np.ndarray:
    """The low 31 bits with a zero before each."""
    v = v.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        v = (v | (v << np.uint64(shift))) & np.uint64(mask)
    return v


def _packed(z: np.ndarray) -> np.ndarray:
    """Every other bit of z: the opposite of ``_spaced``."""
    v = z.astype(np.uint64) & np.uint64(0x5555555555555555)
    for shift, mask in ((1, 0x3333333333333333), (2, 0x0F0F0F0F0F0F0F0F), (4, 0x00FF00FF00FF00FF), (8, 0x0000FFFF0000FFFF), (16, 0x00000000FFFFFFFF)):
        v = (v | (v >> np.uint64(shift))) & np.uint64(mask)
    return v


def _cos(u: np.ndarray) -> np.ndarray:
    """Rows x NODES: the Chebyshev polynomials at u in [-1, 1]."""
    out = np.ones((len(u), NODES))
    out[:, 1] = u
    for k in range(2, NODES):
        out[:, k] = 2 * u * out[:, k - 1] - out[:, k - 2]
    return out


@lru_cache(maxsize=1)
def _nodes() -> tuple[np.ndarray, np.ndarray]:
    """Nodes in [-1, 1], and the matrix from sums of polynomials to weights at the nodes."""
    t = np.cos(np.pi * (np.arange(NODES) + 0.5) / NODES)
    m = _cos(t) * (2 / NODES)
    m[:, 0] /= 2
    return t, m


@lru_cache(maxsize=128)
def _kernel(dx: int, dy: int) -> np.ndarray:
    """Distances between the nodes of two squares of width 1, the second moved by (dx, dy)."""
    t = (_nodes()[0] + 1) / 2
    gx = t[:, None] - t[None, :] - dx
    gy = t[:, None] - t[None, :] - dy
    return np.sqrt(gx[:, None, :, None] ** 2 + gy[None, :, None, :] ** 2).reshape(NODES**2, NODES**2)


def _column(rb: pa.RecordBatch, name: str) -> np.ndarray:
    return rb.column(rb.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def _one(rows: pa.Table) -> pa.RecordBatch:
    return rows.combine_chunks().to_batches()[0]


def _points(rb: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([_column(rb, "x"), _column(rb, "y")])


def _cell(level: int):
    return F.shiftright("z", 2 * (DEPTH - level))


def _by_place(points: DataFrame, corner: tuple[float, float], side: float) -> DataFrame:
    """Distinct points ``z, x, y, n`` in order of ``z``, from ``x, y, n``."""

    def place(batches):
        for rb in batches:
            at = [np.clip(np.floor((_column(rb, c) - o) * (2.0**DEPTH / side)), 0, 2**DEPTH - 1) for c, o in zip("xy", corner)]
            z = _spaced(at[0]) | _spaced(at[1]) << np.uint64(1)
            yield pa.RecordBatch.from_arrays([pa.array(z.astype(np.int64)), *rb.columns], ["z", "x", "y", "n"])

    return points.mapInArrow(place, "z bigint, x double, y double, n double").repartitionByRange("z").sortWithinPartitions("z")


def _next_pairs(pts: DataFrame, split: DataFrame, level: int) -> DataFrame:
    """Pairs of squares of ``level`` that hold points, from pairs of the level above: ``a, b, dx, dy, na, nb``."""
    i, j = F.expr("c % 4"), F.expr("c div 4")
    kids = split.select("a", "b", "dx", "dy", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("c")).select(
        (F.col("a") * 4 + i).alias("a"),
        (F.col("b") * 4 + j).alias("b"),
        (F.col("dx") * 2 + (j % 2) - (i % 2)).cast("int").alias("dx"),
        (F.col("dy") * 2 + F.expr("c div 8") - F.expr("c div 2 % 2")).cast("int").alias("dy"),
    )
    held = pts.groupBy(_cell(level).alias("cell")).agg(F.count("*").alias("m"))
    for side in "ab":
        kids = kids.join(held.select(F.col("cell").alias(side), F.col("m").alias("n" + side)), side)
    return kids.where("a <= b").select("a", "b", "dx", "dy", "na", "nb")


def _weights(pts: DataFrame, far: DataFrame, levels: list[int], corner: tuple[float, float], side: float) -> DataFrame:
    """Weights at the nodes of every square in ``far``: ``level, cell, w``."""
    cells = far.select("level", F.explode(F.array("a", "b")).alias("cell")).distinct()
    rows = [pts.withColumn("cell", _cell(v)).join(cells.where(F.col("level") == v), "cell").select("level", "cell", "x", "y", "n") for v in levels]

    def partial(batches):
        for rb in batches:
            if not rb.num_rows:
                continue
            level, cell, n = (_column(rb, c) for c in ("level", "cell", "n"))
            order = np.lexsort((cell, level))
            level, cell, n = level[order], cell[order], n[order]
            width = side * 2.0**-level
            t = []
            for c, o, z in (("x", corner[0], cell), ("y", corner[1], cell >> 1)):
                low = o + _packed(z).astype(np.float64) * width  # exact: width is a power of two
                t.append(_cos(np.clip((_column(rb, c)[order] - low) / width * 2 - 1, -1, 1)))
            tx, ty = t[0] * n[:, None], t[1]
            new = np.flatnonzero(np.append(True, (np.diff(cell) != 0) | (np.diff(level) != 0)))
            end = np.append(new[1:], len(cell))
            w = [(tx[s:e].T @ ty[s:e]).tobytes() for s, e in zip(new, end)]
            yield pa.RecordBatch.from_arrays([pa.array(level[new]), pa.array(cell[new]), pa.array(w, pa.binary())], ["level", "cell", "w"])

    def whole(part: pa.Table) -> pa.Table:
        w = sum(np.frombuffer(v.as_py(), np.float64).reshape(NODES, NODES) for v in part.column("w"))
        m = _nodes()[1]
        return pa.table({"level": part.column("level").slice(0, 1), "cell": part.column("cell").slice(0, 1), "w": pa.array([(m @ w @ m.T).tobytes()], pa.binary())})

    schema = "level int, cell bigint, w binary"
    return reduce(DataFrame.unionByName, rows).mapInArrow(partial, schema).groupBy("level", "cell").applyInArrow(whole, schema)


def _far_sum(far: DataFrame, weights: DataFrame, side: float) -> DataFrame:
    both = far.select("level", "a", "b", "dx", "dy")
    for c in "ab":
        both = both.join(weights.select("level", F.col("cell").alias(c), F.col("w").alias("w" + c)), ["level", c])

    def run(batches):
        total = 0.0
        for rb in batches:
            if not rb.num_rows:
                continue
            wa, wb = (np.stack([np.frombuffer(v.as_buffer(), np.float64) for v in rb.column(rb.schema.get_field_index(c))]) for c in ("wa", "wb"))
            off = np.column_stack([_column(rb, "dx"), _column(rb, "dy")])
            for dx, dy in np.unique(off, axis=0):
                k = np.flatnonzero((off == (dx, dy)).all(1))
                s = ((wa[k] @ _kernel(int(dx), int(dy))) * wb[k]).sum(1)
                total += float(s @ (side * 2.0 ** -_column(rb, "level")[k]))
        yield pa.RecordBatch.from_arrays([pa.array([2.0 * total])], ["s"])

    return both.select("level", "dx", "dy", "wa", "wb").mapInArrow(run, "s double")


def _near_sum(pts: DataFrame, near: DataFrame, levels: list[int]) -> DataFrame:
    """Pairs of squares of few point pairs: a square meets all its later neighbours in one tile."""
    own = near.groupBy("level", F.col("a").alias("home")).agg(F.max(F.expr("if(a = b, 2, 1)")).alias("role")).withColumn("cell", F.col("home"))
    guests = near.where("a <> b").select("level", F.col("a").alias("home"), F.lit(0).alias("role"), F.col("b").alias("cell"))
    members = own.unionByName(guests)
    rows = [pts.withColumn("cell", _cell(v)).join(members.where(F.col("level") == v), "cell").select("level", "home", "role", "x", "y", "n") for v in levels]

    def fn(tile: pa.Table) -> pa.Table:
        rb = _one(tile)
        role, p, n = _column(rb, "role"), _points(rb), _column(rb, "n")
        mine = role > 0
        s = 2.0 * distance_sum(p[mine], n[mine], p[~mine], n[~mine])
        if role.max() == 2:
            s += distance_sum(p[mine], n[mine], p[mine], n[mine])
        return pa.table({"s": [s]})

    return reduce(DataFrame.unionByName, rows).groupBy("level", "home").applyInArrow(fn, "s double")


def _blocks_sum(pts: DataFrame, left: DataFrame) -> DataFrame:
    """Pairs of squares of the last level that still hold many points, in tiles of two blocks."""
    k = lambda n: F.ceil(F.col(n) / BLOCK_ROWS).cast("int")
    tiles = left.withColumn("ka", k("na")).withColumn("kb", k("nb"))
    tiles = tiles.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("ka") - 1))).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("kb") - 1)))
    tiles = tiles.where("a < b or i <= j")
    key = ["a", "b", "i", "j"]
    first = tiles.select(*key, F.lit(True).alias("mine"), F.col("a").alias("z"), F.col("i").alias("blk"))
    second = tiles.where("a < b or i < j").select(*key, F.lit(False).alias("mine"), F.col("b").alias("z"), F.col("j").alias("blk"))
    sizes = left.select(F.explode(F.array(F.struct(F.col("a").alias("z"), F.col("na").alias("m")), F.struct(F.col("b").alias("z"), F.col("nb").alias("m")))).alias("r")).select("r.*").distinct()
    dealt = pts.join(sizes, "z").withColumn("blk", F.pmod(F.xxhash64("x", "y"), k("m")).cast("int"))

    def fn(tile: pa.Table) -> pa.Table:
        rb = _one(tile)
        mine, p, n = _column(rb, "mine").astype(bool), _points(rb), _column(rb, "n")
        same = (_column(rb, "a")[0], _column(rb, "i")[0]) == (_column(rb, "b")[0], _column(rb, "j")[0])
        other = mine if same else ~mine
        return pa.table({"s": [(1.0 if same else 2.0) * distance_sum(p[mine], n[mine], p[other], n[other])]})

    return dealt.join(first.unionByName(second), ["z", "blk"]).groupBy(*key).applyInArrow(fn, "s double")


def plane_distance_sum(values: DataFrame, low: tuple[float, float], high: tuple[float, float], pairs: int = TILE_PAIRS) -> float:
    """Sum of the distances of all ordered pairs of ``values`` (``x, y``: finite, between ``low`` and ``high``)."""
    counted = values.groupBy("x", "y").agg(F.count("*").cast("double").alias("n"))
    return _tree_sum(counted, low, high, pairs)


def _own_trees(pts: DataFrame, left: DataFrame, pairs: int) -> float:
    """Pairs of squares of the last level with too many point pairs for blocks: T(a) of a square with itself,
    T(a and b) - T(a) - T(b) of two, where T sums over all pairs of some squares' points by a tree of their own."""
    times = Counter()
    for r in left.select("a", "b").collect():  # a number that BLOCK_PAIRS bounds: such squares are few
        times[r["a"], r["b"]] += 1
        if r["a"] != r["b"]:
            times[r["a"], r["a"]] -= 1
            times[r["b"], r["b"]] -= 1
    total = 0.0
    for squares, k in sorted(times.items()):
        if k:
            points = pts.where(F.col("z").isin(*set(squares))).select("x", "y", "n")
            ends = points.agg(*(f(c) for f in (F.min, F.max) for c in "xy")).first()
            total += k * _tree_sum(points, ends[:2], ends[2:], pairs)
    return total


def _tree_sum(points: DataFrame, low: tuple[float, float], high: tuple[float, float], pairs: int) -> float:
    """``plane_distance_sum`` of distinct points with their counts: ``x, y, n``."""
    spark = points.sparkSession
    span = max(h - v for h, v in zip(high, low))
    if span == 0:
        return 0.0
    side = 2.0 ** (math.ceil(math.log2(span)) + 1)
    # Corners of squares are multiples of their widths, so places within a square are exact.
    corner = tuple(math.floor(v / (side / 4)) * (side / 4) for v in low)
    with ExitStack() as kept:
        pts = kept.enter_context(storage.prepared(_by_place(points, corner, side), "plane", stored=True))
        split = local_frame(spark, [(0, 0, 0, 0)], "a bigint, b bigint, dx int, dy int")
        far, near, left = {}, {}, None
        for level in range(1, DEPTH + 1):
            next_ = kept.enter_context(storage.prepared(_next_pairs(pts, split, level), "plane-pairs", stored=True))
            apart, small = F.greatest(F.abs("dx"), F.abs("dy")) > 1, F.col("na") * F.col("nb") <= pairs
            kind = F.when(apart, "far").when(small, "near").otherwise("split")
            kinds = {r["kind"] for r in next_.select(kind.alias("kind")).distinct().collect()}
            tagged = next_.withColumn("level", F.lit(level))
            if "far" in kinds:
                far[level] = tagged.where(apart)
            if "near" in kinds:
                near[level] = tagged.where(~apart & small)
            if "split" not in kinds:
                break
            split = next_.where(~apart & ~small)
            left = split if level == DEPTH else None
        sums, trees = [], 0.0
        if far:
            all_far = reduce(DataFrame.unionByName, far.values())
            weights = kept.enter_context(storage.prepared(_weights(pts, all_far, list(far), corner, side), "plane-weights", stored=True))
            sums.append(_far_sum(all_far, weights, side))
        if near:
            sums.append(_near_sum(pts, reduce(DataFrame.unionByName, near.values()), list(near)))
        if left is not None:
            many = (F.col("na") * F.col("nb") > BLOCK_PAIRS) & F.lit(side * 2.0**-DEPTH > TINY)
            sums.append(_blocks_sum(pts, left.where(~many)))
            trees = _own_trees(pts, left.where(many), pairs)
        return trees + float(reduce(DataFrame.unionByName, sums).agg(F.sum("s").alias("s")).first()["s"] or 0.0)
