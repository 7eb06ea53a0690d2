import importlib
import sys

import pytest

import corpus_pipeline as cp
from test_files_and_packing import check_packed
from test_near_duplicates import brute
from test_repeats_and_leaks import brute_dedup, brute_leaks

SF = "/root/testdata/sf0.001"


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert [n for n, _ in cp.STAGES] == ["quality_classifier", "near_dedup", "substring_dedup", "decontamination", "best_fit_packing"]
    kept = cp.quality_classifier(spark, docs, SF).cache()
    labels = {r.doc_id: r.quality == 1 and r.toxic == 0 for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    stayed = rows(kept)
    agree = [(i in stayed) == good for i, good in labels.items()]
    assert kept.columns == cp.COLUMNS and sum(agree) > 0.9 * len(agree)

    near = cp.near_dedup(spark, kept, SF).cache()
    comp = brute([(i, r.text) for i, r in stayed.items()], 5, 80)
    assert set(rows(near)) == {i for i, (_, c) in comp.items() if c == i} and near.columns == cp.COLUMNS

    sub = cp.substring_dedup(spark, near, SF).cache()
    want = brute_dedup([(i, r.text) for i, r in rows(near).items()], 20)
    assert set(rows(sub)) == set(want) and sub.columns == cp.COLUMNS
    assert all(len(r.text.split()) == want[i][0] - want[i][1] and r.n_chars == len(r.text) for i, r in rows(sub).items())

    clean = cp.decontamination(spark, sub, SF).cache()
    leaks = brute_leaks([(i, r.text) for i, r in rows(sub).items()], bench)
    assert set(rows(clean)) == {i for i, v in leaks.items() if not v[4]} and clean.columns == cp.COLUMNS

    packed = cp.packing(spark, clean, SF).collect()
    assert check_packed(packed, {i: r.text for i, r in rows(clean).items()}, 2048) > 0

    got = cp.run(spark, SF).collect()
    assert {r.doc_id for r in got} == set(rows(clean))


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
        docs = out if out.columns == cp.COLUMNS else docs


def test_entry_does_without_the_subpackage(monkeypatch):
    import __spark_entry__ as entry

    assert {"pipeline", "op1_best_fit_packing"} <= set(entry.queries())
    for name in [m for m in sys.modules if m.startswith("lodestar.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)

    class Gone:
        def find_spec(self, name, path=None, target=None):
            if name == "corpus_pipeline" or name.startswith("lodestar.llm"):
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    monkeypatch.setattr(sys, "meta_path", [Gone(), *sys.meta_path])
    import lodestar

    monkeypatch.delattr(lodestar, "llm", raising=False)
    without = importlib.reload(entry)
    try:
        assert "pipeline" not in without.queries() and "kmeans_lloyd" in without.queries()
    finally:
        monkeypatch.undo()
        importlib.reload(entry)


@pytest.mark.parametrize("name", ["op2_substring_dedup", "op3_minhash_near_dedup", "op4_decontamination", "op6_exact_topk"])
def test_queries_against_sql(spark, name):
    import __spark_entry__ as entry
    from tools.oracle_check import compare, duck

    res = compare(spark, duck(SF), name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert res["ok"], res
