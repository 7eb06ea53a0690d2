import os
import tempfile

from pyspark.sql import functions as F

import pytest

from lodestar.sources import parse_vectors, read_text_vectors, seeded_sample, table_vectors


def test_text_rejects(spark):
    lines = ["1,2,3", "", "4,x,6", "7,8", ".28,1e1,-3\r", "1,2,3,4", " 5 , 6 ,7"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "id bigint, value string")
    pv = parse_vectors(df, dim=3)
    ok = {r.id: list(r.features) for r in pv.points.collect()}
    bad = {r.id: r.reason for r in pv.rejects.collect()}
    assert ok[0] == [1.0, 2.0, 3.0]
    assert ok[4] == [0.28, 10.0, -3.0]
    assert ok[6] == [5.0, 6.0, 7.0]
    assert bad == {1: "non_numeric", 2: "non_numeric", 3: "width", 5: "width"}


def test_text_file_crlf_and_blank_line(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"5.1,3.5\r\n4.9,3\r\n.28,1e1\r\n")
    got = read_text_vectors(spark, str(tmp_path / "a.txt"), ids="position")
    assert got.points.count() == 3 and got.rejects.count() == 0
    assert list(got.points.orderBy("id").first().features) == [5.1, 3.5]
    (tmp_path / "b.txt").write_text("5.1,3.5,one\n4.9,3.0,two\n\n")
    labelled = read_text_vectors(spark, str(tmp_path / "b.txt"), dim=3)
    # the label is no number, and the blank line is rejected too
    assert labelled.points.count() == 0 and labelled.rejects.count() == 3


def test_ids_do_not_depend_on_splits(spark, tmp_path):
    path = str(tmp_path / "v.txt")
    with open(path, "w") as fh:
        fh.write("\n".join(f"{i},{i * 2}" for i in range(4000)))
    one = {r.id: list(r.features) for r in read_text_vectors(spark, path).points.collect()}
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        spark.conf.set("spark.sql.files.openCostInBytes", "1024")
        src = read_text_vectors(spark, path).points
        assert src.rdd.getNumPartitions() > 4
        assert {r.id: list(r.features) for r in src.collect()} == one and len(one) == 4000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_no_row_decides_the_width(spark):
    rows = [(0, [1.0])] + [(i, [1.0, 2.0]) for i in range(1, 100)]
    df = spark.createDataFrame(rows, "k long, v array<double>")
    with pytest.raises(ValueError, match="differ in width"):
        table_vectors(df, "k", array_col="v")
    got = table_vectors(df, "k", array_col="v", dim=2)
    assert got.points.count() == 99 and [r.id for r in got.rejects.collect()] == [0]
    lines = spark.createDataFrame([(0, "1"), (1, "1,2"), (2, "1,2")], "id bigint, value string")
    with pytest.raises(ValueError, match="differ in width"):
        parse_vectors(lines)


def test_text_ids_follow_line_order(spark):
    d = tempfile.mkdtemp(prefix="lodestar-txt-")
    path = os.path.join(d, "v.txt")
    with open(path, "w") as fh:
        fh.write("\n".join(f"{i},{i * 2}" for i in range(50)))
    pts = read_text_vectors(spark, path, ids="position").points.orderBy("id").collect()
    assert [r.features[0] for r in pts] == [float(i) for i in range(50)]


def test_table_vectors_nulls(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 1.0), (None, 1.0, 1.0), (3, 4.0, 5.0)], "k long, a double, b double")
    pv = table_vectors(df, "k", feature_cols=["a", "b"])
    assert sorted(r.id for r in pv.points.collect()) == [1, 3]
    assert pv.rejects.count() == 2
    arr = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, [1.0, None])], "k long, v array<double>")
    pv2 = table_vectors(arr, "k", array_col="v", dim=2)
    assert [r.id for r in pv2.points.collect()] == [1]


def test_seeded_sample_partition_invariant(spark, frame):
    vecs = [[float(i), float(i % 7)] for i in range(300)]
    a = [r.id for r in seeded_sample(frame(vecs), 25).orderBy("seq").collect()]
    b = [r.id for r in seeded_sample(frame(vecs, parts=7), 25).orderBy("seq").collect()]
    assert a == b and len(set(a)) == 25


def test_projection_prunes_columns(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    pv = table_vectors(li, "l_orderkey", feature_cols=["l_quantity", "l_discount"])
    plan = pv.points._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in plan and "l_returnflag" not in plan


def test_distinct_seeds_under_heavy_duplication(spark, frame):
    from lodestar.sources import seed_vectors

    vecs = [[1.0, 1.0]] * 200 + [[2.0, 2.0]] * 3 + [[3.0, 3.0]]
    want = seed_vectors(frame(vecs), 3, distinct=True)
    assert sorted(map(tuple, want)) == [(1.0, 1.0), (2.0, 2.0), (3.0, 3.0)]
    assert seed_vectors(frame(vecs, parts=3), 3, distinct=True) == want
    with pytest.raises(ValueError):
        seed_vectors(frame(vecs), 4, distinct=True)
    assert len(seed_vectors(frame(vecs), 150)) == 150  # the plain mode at any k


def test_shared_paths_and_held_tables_go_with_release(spark):
    from lodestar.plans import storage

    path = storage.shared_path(spark, "probe")
    spark.range(3).write.parquet(path)
    kept = storage.held(spark.range(5), "probe")
    assert kept.count() == 5 and spark.read.parquet(path).count() == 3
    files = kept.inputFiles()
    storage.release(spark)
    exists = lambda p: (q := spark._jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(spark._jsc.hadoopConfiguration()).exists(q)
    assert not exists(path) and not any(exists(f) for f in files)
