"""Exact top-k by inner product: descending norms, SVD-rotated partial sums, Cauchy-Schwarz bounds.

Components are turned into integers, so scores are exact. Candidates are dealt
into blocks by descending length. Queries first meet a bounded set of the
longest vectors, which gives each a lower bound of its k-th score. A block is
visited only by the query blocks with a query whose length times the block's
largest length reaches that bound. Inside a block tiles come in descending
length and end when no query can reach its bound any more; the first rotated
dimensions give partial sums, and the residual lengths bound the rest, so only
the survivors get an exact integer product.

Defined results: rows whose id or vector is null, or whose vector holds a null
or non-finite component, take no part; a shorter vector counts as padded with
zeros; rows of one id count once (with the smallest vector, bytewise), and a
query never meets its own id; ties go to the smaller id; scores must fit a
signed 64-bit integer; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm._common import save

#: Vectors of a candidate block, of a query block, of a tile; longest vectors that all queries meet first.
BLOCK, QUERIES, TILE, SEEDS = 4096, 1024, 512, 1024
FIRST_DIMS = 16
PACKED = "n int, ids binary, ints binary, top double"
FOUND = "query_id long, vec_id long, score long"


def _ints(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of valid vectors and their integers, padded to the widest of the batch."""
    off = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    flat = col.values.slice(off[0], off[-1] - off[0]).cast(pa.float64())
    x = flat.to_numpy(zero_copy_only=False)
    bad = ~np.isfinite(x)
    n, off = np.diff(off), off - off[0]
    row = np.repeat(np.arange(len(col)), n)
    ok = np.asarray(col.is_valid()) & (np.bincount(row[bad], minlength=len(col)) == 0)
    out = np.zeros((len(col), int(n.max()) if len(n) else 0), np.int64)
    good = ~bad
    place = np.arange(len(x)) - np.repeat(off[:-1], n)
    out[row[good], place[good]] = np.floor(256.0 * x[good]).astype(np.int64)
    return np.flatnonzero(ok), out[ok]


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, dim: int) -> DataFrame:
    """Valid rows, one per id: vec_id, ints (``dim`` little-endian 64-bit integers), norm."""

    def run(batches):
        for b in batches:
            if b.num_rows:
                i, v = _ints(b.column(1))
                v = np.pad(v, ((0, 0), (0, dim - v.shape[1])))
                raw = [r.tobytes() for r in v.astype("<i8")]
                norm = np.sqrt((v.astype(np.float64) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(i)), pa.array(raw, pa.binary()), pa.array(norm)], names=["vec_id", "ints", "norm"])

    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v")).filter("vec_id is not null and v is not null")
    rows = rows.mapInArrow(run, "vec_id long, ints binary, norm double")
    return rows.groupBy("vec_id").agg(F.min(F.struct("ints", "norm")).alias("v")).select("vec_id", "v.ints", "v.norm")


def _matrix(raw: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(raw, "<i8").reshape(-1, dim)


def rotation(vectors: DataFrame, dim: int) -> np.ndarray:
    """Right singular vectors of all vectors, largest first; the Gram matrix is summed by Spark, a row per dimension."""

    def gram(batches):
        g = np.zeros((dim, dim))
        for b in batches:
            v = _matrix(b"".join(b.column(0).to_pylist()), dim).astype(np.float64)
            g += v.T @ v
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim), pa.int32()), pa.array(list(g), pa.list_(pa.float64()))], names=["d", "row"])

    cells = vectors.select("ints").mapInArrow(gram, "d int, row array<double>").select("d", F.posexplode("row").alias("e", "x"))
    got = cells.groupBy("d", "e").agg(F.sum("x").alias("x")).collect()  # dim x dim numbers
    g = np.zeros((dim, dim))
    for r in got:
        g[r["d"], r["e"]] = r["x"]
    return np.linalg.eigh(g)[1][:, ::-1].copy()


def packed(vectors: DataFrame, size: int, dim: int) -> DataFrame:
    """Rows of at most ``size`` vectors by descending length, with their largest length."""

    def run(batches: Iterator[pa.RecordBatch]):
        ids, raw, top = [], [], 0.0

        def row():
            return pa.RecordBatch.from_pydict({"n": pa.array([len(ids)], pa.int32()), "ids": [np.array(ids, "<i8").tobytes()], "ints": pa.array([b"".join(raw)], pa.binary()), "top": [top]})

        for b in batches:
            for i, v, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                top = n if not ids else top
                ids.append(i)
                raw.append(v)
                if len(ids) == size:
                    yield row()
                    ids, raw = [], []
        if ids:
            yield row()

    ordered = vectors.repartitionByRange(F.desc("norm")).sortWithinPartitions(F.desc("norm"), "vec_id")
    return ordered.mapInArrow(run, PACKED)


def search(q_ids, q, bound, c_ids, c, k: int, rot: np.ndarray):
    """Per query: its k best of the candidates (in descending length) that reach ``bound``, as (query, id, score) arrays."""
    qf, cf = q.astype(np.float64) @ rot, c.astype(np.float64) @ rot
    d = min(FIRST_DIMS, rot.shape[1])
    q_len, c_len = np.linalg.norm(qf, axis=1), np.linalg.norm(cf, axis=1)
    q_rest, c_rest = np.linalg.norm(qf[:, d:], axis=1), np.linalg.norm(cf[:, d:], axis=1)
    bound = bound.astype(np.float64)
    out_q, out_c, out_s = [], [], []
    for a in range(0, len(c), TILE):
        live = np.flatnonzero(q_len * c_len[a] * (1 + 1e-9) + 1e-6 >= bound)  # tiles come in descending length
        if not len(live):
            break
        t = slice(a, a + TILE)
        most = qf[live, :d] @ cf[t, :d].T + q_rest[live, None] * c_rest[None, t]
        slack = 1e-9 * q_len[live, None] * c_len[None, t] + 1e-6
        i, j = np.nonzero(most + slack >= bound[live, None])
        i, j = live[i], j + a
        for lo in range(0, len(i), 1 << 17):
            s = np.einsum("nd,nd->n", q[i[lo : lo + (1 << 17)]], c[j[lo : lo + (1 << 17)]])
            out_q.append(i[lo : lo + (1 << 17)])
            out_c.append(j[lo : lo + (1 << 17)])
            out_s.append(s)
        # The k-th best so far, of candidates other than the query's own rows, lifts the bound.
        if out_q:
            qi, cj, s = (np.concatenate(x) for x in (out_q, out_c, out_s))
            order = np.lexsort((c_ids[cj], -s, qi))
            qi, cj, s = qi[order], cj[order], s[order]
            own = c_ids[cj] == q_ids[qi]
            qi, cj, s = qi[~own], cj[~own], s[~own]
            first = np.searchsorted(qi, qi)
            best = np.arange(len(qi)) - first < k
            qi, cj, s = qi[best], cj[best], s[best]
            out_q, out_c, out_s = [qi], [cj], [s]
            last = np.arange(len(qi)) - np.searchsorted(qi, qi) == k - 1
            bound[qi[last]] = np.maximum(bound[qi[last]], s[last])
    if not out_q:
        return (np.zeros(0, np.int64),) * 3
    qi, cj, s = (np.concatenate(x) for x in (out_q, out_c, out_s))
    return q_ids[qi], c_ids[cj], s


def top_inner_products(vectors: DataFrame, *, k: int = 5, every: int = 50, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    dim = vectors.agg(F.max(F.size(vec_col)).alias("d")).first()["d"] or 0
    dim = max(dim, 1)
    all_ = save(integer_vectors(vectors, id_col, vec_col, dim), "vectors")
    rot = rotation(all_, dim)
    seeds = all_.orderBy(F.desc("norm"), "vec_id").limit(SEEDS).collect()  # the longest vectors, at most SEEDS
    s_ids = np.array([r["vec_id"] for r in seeds], np.int64)
    seed = spark.sparkContext.broadcast((s_ids, _matrix(b"".join(bytes(r["ints"]) for r in seeds), dim)))
    floor = np.iinfo(np.int64).min

    def bounded(batches):
        """Query blocks with a lower bound of each query's k-th score."""
        for b in batches:
            for n, ids, ints, _ in zip(*(b.column(i).to_pylist() for i in range(4))):
                q_ids, q = np.frombuffer(ids, "<i8"), _matrix(ints, dim)
                c_ids, c = seed.value
                got, _, s = search(q_ids, q, np.full(len(q), -np.inf), c_ids, c, k, rot)
                low = np.full(len(q), np.iinfo(np.int64).max)
                order = np.argsort(q_ids)
                at = order[np.searchsorted(q_ids, got, sorter=order)]
                np.minimum.at(low, at, s)
                low = np.where(np.bincount(at, minlength=len(q)) >= k, low, floor)
                length = np.sqrt((q.astype(np.float64) ** 2).sum(1))
                # The least length of a candidate that may reach some query's bound.
                need = np.where(low == floor, -np.inf, np.divide(low - 1e-6, length * (1 + 1e-9), out=np.where(low > 0, np.inf, -np.inf), where=length > 0))
                yield pa.RecordBatch.from_pydict({"q_ids": [ids], "q": pa.array([ints], pa.binary()), "bounds": [low.tobytes()], "need": [float(need.min())]})

    queries = packed(all_.filter(F.col("vec_id") % every == 0), QUERIES, dim).mapInArrow(bounded, "q_ids binary, q binary, bounds binary, need double")
    queries = save(queries, "queries").withColumn("qb", F.monotonically_increasing_id())
    blocks = save(packed(all_, BLOCK, dim).withColumn("block", F.monotonically_increasing_id()), "blocks")
    # One number per block of vectors: the blocks that a query block must visit are the longest ones.
    visits = queries.select("qb", "need").join(F.broadcast(blocks.select("block", "top")), F.col("top") >= F.col("need")).select("qb", "block")
    work = visits.join(queries.select("qb", "q_ids", "q", "bounds"), "qb").join(blocks.select("block", "ids", "ints"), "block")

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                q_ids, q, low, c_ids, c = (b.column(j)[i].as_buffer() for j in range(5))
                low = np.frombuffer(low, np.int64)
                low = np.where(low == floor, -np.inf, low.astype(np.float64))
                x = search(np.frombuffer(q_ids, "<i8"), _matrix(q, dim), low, np.frombuffer(c_ids, "<i8"), _matrix(c, dim), k, rot)
                yield pa.RecordBatch.from_arrays([pa.array(y) for y in x], names=["query_id", "vec_id", "score"])

    found = work.select("q_ids", "q", "bounds", "ids", "ints").mapInArrow(run, FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
