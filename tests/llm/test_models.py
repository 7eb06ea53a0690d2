import random
import re
import zlib
from collections import Counter
from math import floor, log10

import numpy as np
import pyarrow as pa
import pytest

from lodestar.llm import topk
from lodestar.llm._text import NON_SPACE, word_hash, words
from lodestar.llm.brown import Model, _edges, best_classes, fit, hash_slices, own_classes, read_chunks, score
from lodestar.llm.langid import identify
from lodestar.llm.quality import classify, classify_digest, fit as fit_quality, label_model
from lodestar.llm.topk import top_inner_products

SF = "/root/testdata/sf0.001"


def fold(i, m):
    return zlib.crc32(str(i).encode()) % m


def brute_topk(rows, k=5, every=50):
    v = {i: [floor(256.0 * float(np.float32(x))) for x in xs] for i, xs in rows if i is not None and xs is not None and all(x is not None and np.isfinite(x) for x in xs)}
    out = set()
    for q in v:
        if q % every == 0:
            s = sorted(((-sum(a * b for a, b in zip(v[q], v[c])), c) for c in v if c != q))[:k]
            out |= {(q, r + 1, c, -n) for r, (n, c) in enumerate(s)}
    return out


@pytest.mark.parametrize("block,tile", [(4096, 512), (16, 5)])
def test_topk_against_brute_force(spark, monkeypatch, block, tile):
    for name, value in (("BLOCK", block), ("QUERIES", block), ("TILE", tile), ("SEEDS", block // 2)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(3)
    rows = [(int(i), (rng.normal(0, rng.choice([0.1, 1, 3]), 8) * [4, 2, 1, 1, 0.5, 0.1, 0.1, 0.01]).tolist()) for i in rng.permutation(400)]
    rows += [(i, rows[3][1]) for i in range(1000, 1020)]  # ties
    rows += [(500, None), (550, [1.0, None] + [0.0] * 6), (600, [float("nan")] * 8), (650, [float("inf")] * 8), (None, [9.0] * 8), (700, [0.0] * 8), (750, [1.0, 2.0]), (800, [])]
    df = spark.createDataFrame([(i, v, 0.0, "x") for i, v in rows], "vec_id long, embedding array<float>, norm double, ints string")
    got = {tuple(r) for r in top_inner_products(df.repartition(3)).collect()}
    assert got == brute_topk(rows)


def test_topk_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert top_inner_products(spark.createDataFrame([], schema)).count() == 0
    assert top_inner_products(spark.createDataFrame([(0, [1.0])], schema)).count() == 0
    two = spark.createDataFrame([(0, [1.0]), (0, [1.0]), (3, [0.5])], schema)
    assert [tuple(r) for r in top_inner_products(two).collect()] == [(0, 1, 3, 256 * 128)]


def test_language_id(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(10**6 + i, t, "en", "s", 0) for i, t in enumerate([None, "", "12 + 3!", "١٢", "x" * 50_000])] + [(None, "the and of", None, "s", 0)]
    got = identify(docs.unionByName(spark.createDataFrame(odd, docs.schema)))
    rows = {r.doc_id: r for r in got.collect()}
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    assert [rows[10**6 + i].lang_pred for i in range(4)] == ["und"] * 4 and rows[10**6].score == 0.0
    assert rows[None].lang_pred == "en" and not rows[None].held_out
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert all(rows[i].held_out == (fold(i, 4) == 2) for i in truth)
    held = [i for i in truth if rows[i].held_out]
    assert np.mean([rows[i].lang_pred == truth[i] for i in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_language_id_without_training_rows(spark):
    schema = "doc_id long, text string, lang string"
    assert identify(spark.createDataFrame([], schema)).count() == 0
    assert identify(spark.createDataFrame([(1, "a b", None)], schema).repartition(1)).first().lang_pred == "und"


def brute_base(rows):
    split = {i: [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0d]+", t or "")] + ["\n"] for i, t in rows}
    c = Counter(w for i, ws in split.items() if fold(i, 5) != 1 for w in ws)
    n, v = sum(c.values()), len(c)
    return {i: (fold(i, 5) == 1, len(ws), sum(c[w] > 0 for w in ws), n, sum(log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for i, ws in split.items()}


def sentences(rng, n):
    kinds = [[f"{p}{i}" for i in range(12)] for p in ("det", "adj", "noun", "verb")]
    return [" ".join(rng.choice(kinds[k % 4]) for k in range(rng.randint(0, 60))) for _ in range(n)]


def test_language_model(spark):
    rng = random.Random(6)
    rows = list(enumerate(sentences(rng, 400) + [None, "", "Never SEEN words", "é\tà"]))
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, chunk int, types int").repartition(4)
    got = {r.doc_id: r for r in score(df, core=64, endings=64, classes=8).collect()}
    want = brute_base(rows)
    for i, (held, n, known, total, base) in want.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, abs=1e-9) and r.score <= 0
    held = [i for i, w in want.items() if w[0] and w[1] > 20]
    assert sum(got[i].score for i in held) > 0.8 * sum(got[i].base_score for i in held)


def test_language_model_is_a_distribution(spark):
    rng = random.Random(1)
    rows = spark.createDataFrame(list(enumerate(sentences(rng, 60))), "doc_id long, text string")
    chunks = read_chunks(rows.selectExpr("doc_id", "false as held_out", "text")).cache()
    m, _ = fit(chunks, core=20, endings=16, classes=6)
    words, ends = Counter(), {}
    for r in chunks.collect():
        t = np.frombuffer(r.types, "<u8").tolist()
        words.update(dict(zip(t, np.frombuffer(r.counts, "<u4").tolist())))
        ends.update(zip(t, np.frombuffer(r.ends, "<u2").tolist()))
    types = np.array(sorted(words), "<u8")
    ends = np.array([ends[t] for t in sorted(words)], "<u2")
    total = np.array([words[int(t)] for t in types], "<i8")
    for v in range(0, len(types), 7):  # after any word, all next words and an unseen one
        tokens = np.stack([np.full(len(types), v), np.arange(len(types))], 1).ravel()
        both = m.score(types, ends, total, tokens, np.full(len(types), 2))[2]
        one = m.score(types, ends, total, np.array([v]), np.array([1]))[2][0]
        assert 0.9 < (10 ** (both - one)).sum() <= 1 + 1e-9


def test_words_outside_the_core_have_classes_of_their_own(spark):
    # Two words of one ending, so of one unit: one stands where "cat" does, one where "go" does.
    rows = list(enumerate(["the cat to go"] * 100 + ["the abxyz to efxyz"] * 20))
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "false as held_out", "text").repartition(3)
    chunks = read_chunks(docs).cache()
    model, _ = fit(chunks, core=4, endings=16, classes=8)
    got, pairs, v = own_classes(chunks, model)
    of = {}
    for r in got.collect():
        mine = chunks.filter(f"chunk = {r.chunk}").first()
        types = np.frombuffer(mine.types, "<u8")
        edge = _edges(types, hash_slices(chunks))
        of.update(zip(types[edge[r.slice] : edge[r.slice + 1]].tolist(), np.frombuffer(r.k, "<u2").tolist()))
    text = "the cat to go abxyz efxyz"
    k = dict(zip(text.split(), (of[h] for h in word_hash(words(pa.array([text], pa.large_string()), NON_SPACE, lower=True)).tolist())))
    assert k["abxyz"] == k["cat"] != k["efxyz"] == k["go"]
    assert pairs.sum() == 0 and v.sum() == 0  # words move, none is lost
    want = Counter({0: 120})  # all tokens by class
    for w, n in zip(text.split(), [120, 100, 120, 100, 20, 20]):
        want[k[w]] += n
    assert {c: n for c, n in enumerate(Model(*model.tables, pairs, v).class_n.tolist()) if n} == dict(want)


def test_best_classes_against_a_plain_exchange():
    rng = np.random.default_rng(3)
    classes, n_words = 7, 40
    left = rng.poisson(1.0, (n_words, classes))
    old = rng.integers(1, classes, n_words)
    pairs = rng.integers(1, 50, (classes, classes))
    np.add.at(pairs.T, old, left)
    word, before = np.nonzero(left)
    got = best_classes(word, before, left[word, before], old, pairs)
    xlogx = lambda x: (x * np.log(np.maximum(x, 1e-300))).sum()
    for w in range(n_words):
        likelihood = []
        for c in range(1, classes):
            p = pairs.astype(float)
            p[:, old[w]] -= left[w]
            p[:, c] += left[w]
            likelihood.append(xlogx(p) - xlogx(p.sum(0)))
        if left[w].any():
            assert likelihood[got[w] - 1] == pytest.approx(max(likelihood), abs=1e-9)
        else:
            assert got[w] == old[w]


def test_language_model_odd_tables(spark):
    schema = "doc_id long, text string"
    assert score(spark.createDataFrame([], schema)).count() == 0
    i = next(i for i in range(99) if fold(i, 5) == 1)
    r = score(spark.createDataFrame([(i, "a b")], schema)).first()
    assert (r.train_tokens, r.n_known, r.base_score, r.score) == (0, 0, 0.0, 0.0)
    r = score(spark.createDataFrame([(None, "a b"), (None, "a b")], schema)).collect()
    assert len(r) == 2 and r[0].train_tokens == 6 and not r[0].held_out


def test_label_model_finds_the_liar():
    rng = np.random.default_rng(0)
    truth = rng.random(3000) < 0.3
    say = lambda acc, quiet: np.where(rng.random(3000) < quiet, 2, np.where(rng.random(3000) < acc, truth, ~truth))
    p, table = label_model(np.stack([say(0.9, 0.3), say(0.85, 0.2), say(0.55, 0), say(0.99, 0.7)], 1).astype(int))
    assert ((p > 0.5) == truth).mean() > 0.9
    assert table[0, 1, 1] > table[2, 1, 1]


def quality_frame(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_quality_on_labels_held_back(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    learn = labels.filter("doc_id % 2 = 0")
    got = {r.doc_id: r.kept for r in classify_digest(docs, learn).collect()}
    test = [(r.quality == 1 and r.toxic == 0, got[r.doc_id]) for r in labels.filter("doc_id % 2 = 1").collect()]
    good, bad = ([k for t, k in test if t is want] for want in (True, False))
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.25


def test_quality_odd_rows(spark):
    docs, labels = quality_frame(spark)
    odd = docs.limit(40).selectExpr("doc_id", "text", "lang as quality_x", "1 as votes")
    odd = odd.unionByName(spark.createDataFrame([(None, None, "q", 1), (5, "", "q", 1), (5, "", "q", 1), (6, "!" * 200_000, "q", 1)], odd.schema))
    got = classify(odd, labels.limit(0))
    assert got.count() == 44 and got.columns == ["doc_id", "text", "quality_x", "votes", "quality_score", "quality_kept"]
    assert got.filter("quality_score is null or quality_score < 0 or quality_score > 1").count() == 0
    assert classify(odd.limit(0), labels).count() == 0
    twice = labels.unionByName(labels.selectExpr("doc_id", "0 as quality", "toxic"))
    assert fit_quality(odd, twice).documents > 0


def test_the_labels_table_is_a_labeller_whose_accuracy_is_estimated():
    rng = np.random.default_rng(6)
    truth = rng.random(8000) < 0.4

    def say(right):
        return np.where(rng.random(8000) < right, truth, ~truth).astype(int)

    v = np.stack([say(0.9), say(0.88), say(0.92), say(0.85)], 1)
    p, table = label_model(v)
    assert 0.84 < table[-1, 0, 0] < 0.93 and 0.84 < table[-1, 1, 1] < 0.93  # true 0.85; the prior is worth 1,000 of 8,000
    assert abs(table[0, 0, 0] - 0.9) < 0.03 and ((p > 0.5) == truth).mean() > 0.95


def test_the_fit_does_not_depend_on_how_rows_arrive(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    a, b = fit_quality(docs, labels), fit_quality(docs.repartition(7), labels.repartition(3))
    assert a.documents == b.documents
    for x, y in zip(a.scorers, b.scorers, strict=True):
        assert np.allclose(x.weights, y.weights) and np.isclose(x.bias, y.bias)
