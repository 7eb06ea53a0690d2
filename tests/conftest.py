import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .appName("lodestar-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lodestar-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def frame(spark):
    """Build an (id, features) frame from a list of vectors."""

    def make(vecs, ids=None, parts=None):
        ids = list(range(len(vecs))) if ids is None else ids
        df = spark.createDataFrame(
            [(int(i), [float(x) for x in v]) for i, v in zip(ids, vecs)], "id bigint, features array<double>"
        )
        return df.repartition(parts) if parts else df

    return make
