"""Keeping iterated inputs close, and cutting lineage where it matters.

The iterative operators collect only K x D numbers per round and inline them
as literals, so their plans do not grow from round to round. What they reuse
is the prepared point set (ids and feature columns only). ``prepared`` yields

* the input itself where it is a plain scan of enough Parquet files, so a large
  columnar table is iterated on in place and never copied;
* else a Parquet copy under the session's checkpoint folder (the cluster's
  shared folder): the lineage is cut and the files survive any executor loss;
* else, without such a folder, the cache (memory and disk, recomputed from the
  deterministic lineage if blocks are lost).

Whatever was made is gone when the ``with`` block ends, however it ends.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder: one set on the context first, else the session's ``spark.checkpoint.dir``."""
    return spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)


def spread(df: DataFrame, key: str = "id") -> DataFrame:
    """Hash-partition on ``key`` when the input has fewer files than the session has cores.

    Small inputs (one Parquet file is one partition) would otherwise run every
    round on a single core. At scale the input has far more files than the
    cluster has cores and no shuffle is added. Nothing is run to decide.
    """
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n, key) if len(df.inputFiles()) < n else df


def plain_scan(df: DataFrame) -> bool:
    """Whether the plan only scans Parquet files, filters and projects."""
    node = df._jdf.queryExecution().optimizedPlan()
    kind = lambda x: x.getClass().getSimpleName()
    while kind(node) in ("Project", "Filter"):
        node = node.child()
    if kind(node) != "LogicalRelation" or kind(node.relation()) != "HadoopFsRelation":
        return False
    return kind(node.relation().fileFormat()) == "ParquetFileFormat"


@contextmanager
def prepared(df: DataFrame, name: str = "points", checkpoint: bool | None = None, stored: bool = False):
    """A reusable form of an iterated input for the time of the ``with`` block.

    ``checkpoint``: True forces the Parquet copy, False the cache. ``stored``: never in
    place, for columns that must be the same on every read (row numbers).
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark) if checkpoint in (None, True) else None
    if checkpoint is None and not stored and plain_scan(df):
        yield df
    elif base:
        path = f"{base.rstrip('/')}/lodestar-{name}-{uuid.uuid4().hex}"
        try:
            df.write.mode("errorifexists").parquet(path)
            yield spark.read.schema(df.schema).parquet(path)
        finally:
            _delete(spark, path)
    else:
        kept = df.persist(StorageLevel.MEMORY_AND_DISK_DESER)
        try:
            yield kept
        finally:
            kept.unpersist()


class Rounds:
    """Rounds of an iteration, each committed as a small table ``round=N`` in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _has(self, name: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def done(self) -> list[list]:
        """The rows of every round from 1 on that was committed whole."""
        out = []
        while self._has(f"round={len(out) + 1}/_SUCCESS"):
            out.append(self.spark.read.parquet(f"{self.path}/round={len(out) + 1}").collect())
        return out

    def commit(self, number: int, rows, schema: str) -> None:
        local_frame(self.spark, rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/round={number}")


_held: dict[str, list] = {}


def held(df: DataFrame, name: str) -> DataFrame:
    """A stored copy that results are read from: it stays until ``release``."""
    spark = df.sparkSession
    base = checkpoint_dir(spark)
    mine = _held.setdefault(spark.sparkContext.applicationId, [])
    if not base:
        kept = df.persist(StorageLevel.MEMORY_AND_DISK_DESER)
        mine.append(kept.unpersist)
        return kept
    path = f"{base.rstrip('/')}/lodestar-{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    mine.append(lambda: _delete(spark, path))
    return spark.read.schema(df.schema).parquet(path)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, gone with ``release``. Only a local session without a folder gets one of this machine."""
    base = checkpoint_dir(spark)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lodestar-ckpt-"))
        base = checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/lodestar-{name}-{uuid.uuid4().hex}"
    _held.setdefault(spark.sparkContext.applicationId, []).append(lambda: _delete(spark, path))
    return path


def release(spark: SparkSession) -> None:
    """Delete what ``held`` stored for this application; results not read yet need it."""
    for drop in _held.pop(spark.sparkContext.applicationId, []):
        drop()


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def local_frame(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small driver-side result (K rows, a trace) as a DataFrame via Arrow."""
    import pandas as pd
    from pyspark.sql.types import _parse_datatype_string

    st = _parse_datatype_string(schema)
    pdf = pd.DataFrame([tuple(r) for r in rows], columns=st.names)
    if pdf.empty:
        return spark.createDataFrame([], st)
    return spark.createDataFrame(pdf, st)
