"""Token-id files in Simple-8b: 64-bit words whose top 4 bits say how many ids of how many bits follow.

``write_tokens`` range-partitions documents by id, encodes them in order and
writes a *token dataset*: Parquet files (so that any store Spark can write
will do) whose rows are chunks. A chunk holds whole documents in id order: their
ids, their token counts, the little-endian 64-bit words and, per block of 1024
ids, the offset of its first word. Blocks decode independently and all words of
a chunk decode at once. ``read_tokens`` returns the documents of a dataset.

Selectors 2 to 15 hold (60, 1), (30, 2) ... (1, 60) ids and bits; selector 1
holds 120 zeros; selector 0 escapes: the next word is one raw 64-bit id.

Defined results: a null text is an empty document (its end id alone); rows of
equal id stand in any order; null ids come first; an empty table gives an empty
dataset; columns other than id and text are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.llm._common import binaries, scratch_dir
from lodestar.llm.tokens import default_path, encoded

BLOCK = 1024
#: Ids and bits of selectors 1 to 15.
COUNT = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
CHUNK = "shard int, chunk int, first long, doc_ids array<long>, counts array<long>, n_ids long, block_words array<int>, words binary"


def _width(ids: np.ndarray) -> np.ndarray:
    """Bits of each id: 0 for 0, up to 64."""
    if not len(ids) or ids.max() < 1 << 53:
        return np.frexp(ids.astype(np.float64))[1].astype(np.uint8)
    w = np.zeros(len(ids), np.uint8)
    for b in range(64):
        w += (ids >> np.uint64(b)) > 0
    return w


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and, per block of ``BLOCK`` ids, the offset of its first word.

    The widest selector that fits is found for every position at once; then all
    blocks walk from word to word in step.
    """
    ids = np.ascontiguousarray(ids, np.uint64)
    blocks = -(-len(ids) // BLOCK)
    if not blocks:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    x = np.zeros(blocks * BLOCK, np.uint64)
    x[: len(ids)] = ids
    width = _width(x).reshape(blocks, BLOCK)
    pad = np.concatenate([width, np.zeros((blocks, 120), np.uint8)], axis=1)  # past a block all fits; the count cuts it off
    choice = np.full((blocks, BLOCK), 16, np.uint8)  # 16 less the selectors that fit: where one fits, so do all after it
    span, m = 1, pad  # m: largest width among the next ``span``
    for s in range(15, 0, -1):
        n = int(COUNT[s])
        while span < n:
            step = min(span, n - span)
            m = np.maximum(m[:, : m.shape[1] - step], m[:, step:])
            span += step
        fits = m[:, :BLOCK] <= BITS[s]
        if not fits.any():
            break
        choice -= fits
    choice &= 15  # none fits: 0, the escape
    lane, at = np.arange(blocks), np.zeros(blocks, np.int64)
    where, sel = [], []
    while len(lane):
        s = choice[lane, at]
        where.append(lane * BLOCK + at)
        sel.append(s)
        at = at + COUNT[s]
        live = at < BLOCK
        lane, at = lane[live], at[live]
    where, sel = np.concatenate(where), np.concatenate(sel)
    order = np.argsort(where)
    where, sel = where[order], sel[order]
    real = where < len(ids)  # words of padding alone
    where, sel = where[real], sel[real]
    place = np.arange(len(where)) + np.cumsum(sel == 0) - (sel == 0)
    words = np.zeros(len(where) + int((sel == 0).sum()), np.uint64)
    y = np.concatenate([x, np.zeros(120, np.uint64)])
    end = (where // BLOCK + 1) * BLOCK
    for s in range(16):
        i = np.flatnonzero(sel == s)
        if s == 0:
            words[place[i] + 1] = y[where[i]]
            continue
        w = np.full(len(i), s << 60, np.uint64)
        for k in range(int(COUNT[s]) if BITS[s] else 0):
            src = where[i] + k
            w |= np.where(src < end[i], y[src], np.uint64(0)) << np.uint64(k * int(BITS[s]))
        words[place[i]] = w
    first = np.searchsorted(where, np.arange(blocks) * BLOCK)
    return words, place[first].astype(np.int32)


def decode(words: np.ndarray, block_words: np.ndarray, n_ids: int) -> np.ndarray:
    """All ids of ``encode``; any run of blocks decodes alike from its offsets."""
    words, block_words = np.asarray(words, np.uint64), np.asarray(block_words, np.int64)
    out = np.zeros(n_ids, np.uint64)
    if not n_ids:
        return out
    sel = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    for i in np.flatnonzero(sel == 0):  # escapes; a raw word is no selector
        if not raw[i] and i + 1 < len(words):
            raw[i + 1] = True
    n = np.where(raw, 0, COUNT[sel])
    done = np.cumsum(n) - n
    block = np.searchsorted(block_words, np.arange(len(words)), side="right") - 1
    start = done - done[block_words][block] + block * BLOCK
    limit = np.minimum((block + 1) * BLOCK, n_ids)
    for s in range(16):
        i = np.flatnonzero((sel == s) & ~raw)
        if s == 0:
            out[start[i]] = words[i + 1]
        elif BITS[s]:
            mask, w = np.uint64((1 << int(BITS[s])) - 1), words[i]
            for k in range(int(COUNT[s])):
                ok = start[i] + k < limit[i]
                out[start[i][ok] + k] = (w[ok] >> np.uint64(k * int(BITS[s]))) & mask
    return out


def write_tokens(docs: DataFrame, path: str | None = None, *, end_id: int = 2, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write the ids of ``docs`` in ascending order of id as a token dataset; its path (under the shared folder if not given)."""
    spark = docs.sparkSession
    path = path or f"{scratch_dir(spark)}/lodestar-llm/tokens-{uuid.uuid4().hex}"
    tokenizer = tokenizer or default_path()

    def run(batches):
        from pyspark import TaskContext

        shard, chunk, first = TaskContext.get().partitionId(), 0, 0
        for b, ids, bounds in encoded(batches, "text", tokenizer, 4 << 20):
            flat = np.insert(ids, bounds[1:], end_id)
            words, offsets = encode(flat)
            counts = np.diff(bounds) + 1
            one = pa.array([0, b.num_rows], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()),
                    pa.array([chunk], pa.int32()),
                    pa.array([first], pa.int64()),
                    pa.ListArray.from_arrays(one, b.column(0)),
                    pa.ListArray.from_arrays(one, pa.array(counts, pa.int64())),
                    pa.array([len(flat)], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(offsets)], pa.int32()), pa.array(offsets)),
                    binaries(words.astype("<u8"), [0, len(words)]),
                ],
                names=["shard", "chunk", "first", "doc_ids", "counts", "n_ids", "block_words", "words"],
            )
            chunk, first = chunk + 1, first + len(flat)

    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = cols.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(run, CHUNK).write.option("compression", "zstd").parquet(path)
    return path


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens, ids (unsigned 32-bit, little-endian)."""
    chunks = spark.read.schema(CHUNK).parquet(path)
    # One row a shard: the running total over shards is small however long the shards are.
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").alias("_n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    schema = "shard int, doc_id long, start long, n_tokens long, ids binary"

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                c = {n: b.column(k)[i] for k, n in enumerate(b.schema.names)}
                n = c["counts"].values.to_numpy()
                ids = decode(np.frombuffer(c["words"].as_buffer(), "<u8"), c["block_words"].values.to_numpy(), c["n_ids"].as_py())
                edge = np.concatenate([[0], np.cumsum(n)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(n), c["shard"].as_py()), pa.int32()),
                        c["doc_ids"].values,
                        pa.array(edge[:-1] + c["first"].as_py()),
                        pa.array(n),
                        binaries(ids.astype("<u4"), edge),
                    ],
                    names=["shard", "doc_id", "start", "n_tokens", "ids"],
                )

    docs = chunks.select("shard", "first", "doc_ids", "counts", "n_ids", "block_words", "words").mapInArrow(run, schema)
    return docs.join(F.broadcast(base), "shard").select("doc_id", (F.col("start") + F.col("_base")).alias("start"), "n_tokens", "ids")


def token_digest(docs: DataFrame, **options) -> DataFrame:
    """Write ``docs`` as a token dataset, read it back: place, count and CRC-32 of each document's ids."""
    path = write_tokens(docs, **options)
    return read_tokens(docs.sparkSession, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
