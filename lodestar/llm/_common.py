"""Shared helpers of the training-data operators: tables, scratch copies, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one NumPy step works on; a longer single text is a step of its own.
STEP_BYTES = 1 << 20

_scratch: dict[str, list[str]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of the session (``spark.checkpoint.dir``).

    Local sessions without one get a temporary folder; on a cluster a missing
    setting is an error, since executors do not share a machine's own folders.
    """
    d = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    if not spark.sparkContext.master.startswith(("local[", "local")) or "cluster" in spark.sparkContext.master:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lodestar-llm-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/lodestar-llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def release_scratch(spark: SparkSession) -> None:
    """Delete every scratch copy of this application; results that were not written yet need them."""
    for path in _scratch.pop(spark.sparkContext.applicationId, []):
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def ranked_id(col: str = "doc_id"):
    """A non-null order of ids: null comes last."""
    return F.coalesce(F.col(col).cast("long"), F.lit((1 << 63) - 1))


def train_fold(df: DataFrame, mod: int, held: int, col: str = "doc_id"):
    """True where crc32(id as text) mod ``mod`` is ``held``; a null id is never held out."""
    return F.coalesce((F.crc32(F.col(col).cast("string").cast("binary")) % mod) == held, F.lit(False))


def strings(col: pa.Array) -> pa.Array:
    """A string column without nulls, as 64-bit-offset strings starting at offset 0."""
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    return col.fill_null("")


def steps(batches: Iterator[pa.RecordBatch], text: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about ``limit`` bytes of ``text`` (one row at least)."""
    import numpy as np
    import pyarrow.compute as pc

    for b in batches:
        if b.num_rows == 0:
            continue
        size = np.cumsum(pc.binary_length(b.column(b.schema.get_field_index(text))).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
        i = 0
        while i < b.num_rows:
            done = size[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(size, done + limit, side="right")))
            yield b.slice(i, j - i)
            i = j
        pa.default_memory_pool().release_unused()  # workers live on: give back what the batch took


def binaries(flat, bounds) -> pa.Array:
    """One binary value per ``bounds`` pair of the contiguous array ``flat`` (bounds in elements)."""
    import numpy as np

    raw = np.ascontiguousarray(flat)
    off = (np.asarray(bounds, np.int64) * raw.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(off) - 1, [None, pa.py_buffer(off.tobytes()), pa.py_buffer(raw.tobytes())])


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def bitmap_of(df: DataFrame, col: str, bits: int):
    """Broadcast bitmap of the top ``bits`` bits of a 64-bit hash column: ``2^(bits - 3)`` bytes, however many rows there are.

    Spark packs the bits into 64-bit words, so at most ``2^(bits - 6)`` rows come to the driver.
    """
    import numpy as np

    top = f"shiftrightunsigned({col}, {64 - bits})"
    words = df.select(F.expr(f"cast(shiftright({top}, 6) as int)").alias("word"), F.expr(f"shiftleft(1L, cast({top} & 63 as int))").alias("bit"))
    got = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect()
    out = np.zeros(1 << (bits - 6), "<i8")
    out[[r["word"] for r in got]] = [r["bits"] for r in got]
    return df.sparkSession.sparkContext.broadcast(out.view(np.uint8))


def has_bit(bitmap, top):
    """Whether the bitmap has each of the (already shifted) top bits."""
    import numpy as np

    return (bitmap[(top >> np.uint64(3)).astype(np.int64)] >> (top & np.uint64(7)).astype(np.uint8)) & 1 > 0
