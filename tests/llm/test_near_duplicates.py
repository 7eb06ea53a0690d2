import random

import numpy as np
import pytest

from lodestar.llm import neardup
from lodestar.llm.components import components
from lodestar.llm.neardup import near_duplicates, one_of_each

SCHEMA = "doc_id long, text string, source string"


def shingles(text, k):
    w = [x for x in "".join(c if c not in " \t\n\x0b\x0c\r" else " " for c in (text or "")).split(" ") if x]
    w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in w]
    return {tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set()


def brute(rows, k=3, percent=85):
    sets = {i: shingles(t, k) for i, t, *_ in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def copies(rng, base, n, most):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, most)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("few,block", [(16, 512), (2, 7)])
def test_groups_against_brute_force(spark, monkeypatch, few, block):
    monkeypatch.setattr(neardup, "FEW", few)
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(3)
    texts = []
    for g in range(4):  # many near copies around the threshold, and lone texts
        texts += copies(rng, [f"w{rng.randrange(300)}" for _ in range(90)], 40, 7)
    texts += [" ".join(f"w{rng.randrange(300)}" for _ in range(60)) for _ in range(30)]
    texts += ["one", "ONE", "one two", "One  two", "", "  ", None, "a b c"]
    rng.shuffle(texts)
    rows = [(i * 3, t, "s") for i, t in enumerate(texts)]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(5))
    want = brute(rows)
    assert result(got) == want
    assert {r.doc_id for r in got.filter("kept").collect()} == {i for i, (_, c) in want.items() if c == i}


def test_other_thresholds(spark):
    rng = random.Random(8)
    rows = [(i, t, "s") for i, t in enumerate(copies(rng, [f"w{i}" for i in range(50)], 30, 3))]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA), shingle=5, percent=80)
    assert result(got) == brute(rows, 5, 80)


def test_odd_rows(spark):
    rows = [(None, "a b c d", "s"), (None, None, "s"), (4, "a b c d", "s"), (4, "a b c d", "s"), (4, "x y z", "s"), (9, "x y z", "s")]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id) == [(4, 1, 4), (4, 2, 4), (4, 2, 4), (9, 1, 4)]
    assert sorted((r.n_shingles, r.component_id) for r in got if r.doc_id is None) == [(0, None), (2, 4)]
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    odd = spark.createDataFrame(rows, SCHEMA).selectExpr("doc_id", "text", "1 as id", "2 as h", "3 as n", "4 as sig")
    assert near_duplicates(odd).count() == 6


def test_one_row_of_each_stays(spark):
    rows = [(5, "a b c d e f", "p"), (5, "a b c d e f", "p"), (2, "A B c d e f", "q"), (7, None, "r"), (8, "g h", "s")]
    got = one_of_each(spark.createDataFrame(rows, SCHEMA))
    assert sorted(tuple(r) for r in got.collect()) == [(2, "A B c d e f", "q"), (7, None, "r"), (8, "g h", "s")]


def test_components_of_long_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1100)] + [(500, 499), (499, 498)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {**{i: 0 for i in range(1, 61)}, **{i: 1000 for i in range(1001, 1100)}, 499: 498, 500: 498}
    assert got == want


def test_null_ids_are_not_one_document(spark):
    rng = random.Random(21)

    def near(tag):  # two near copies
        w = [f"{tag}{i}" for i in range(80)]
        return " ".join(w), " ".join(w[:40] + [f"x{rng.randrange(10**6)}"] + w[41:])

    (a9, a), (b1, b2), (c9, c), (d, d100), (e, e1) = (near(t) for t in "abcde")
    e2 = e1[:-3] + "E79"
    lone = "nothing else has these words"
    rows = [(9, a9, "s"), (None, a, "s"), (None, lone, "s"), (None, lone, "s"), (None, b1, "s"), (None, b2, "s")]
    rows += [(200, c9, "s"), (None, c, "s"), (None, d, "s"), (100, d100, "s"), (None, e, "s"), (None, e1, "s"), (None, e2, "s"), (None, None, "s")]
    for df in (spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(rows, SCHEMA).repartition(3)):
        got = {}
        for r in near_duplicates(df).collect():
            got.setdefault((r.doc_id, r.n_shingles), set()).add(r.component_id)
        assert got[9, 78] == {9} and got[100, 78] == {100} and got[200, 78] == {200}
        assert got[None, 78] == {9, 100, 200, None} and got[None, 3] == {None} and got[None, 0] == {None}
        stay = [r.text for r in one_of_each(df).collect()]
        assert a9 in stay and c9 in stay and d100 in stay and not {a, c, d} & set(stay)
        assert stay.count(lone) == 1 and stay.count(None) == 1
        assert len({b1, b2} & set(stay)) == 1 and len({e, e1, e2} & set(stay)) == 1
        assert len(stay) == 7


def test_chunks_follow_the_similarity(spark):
    assert neardup.chunks_for(85) == 14 and neardup.chunks_for(80) == 16
    assert all(2 * neardup.chunks_for(p) - 1 >= neardup.radius_of(p) for p in range(80, 101))
    for percent in range(71, 101):
        s = percent / 100
        assert (1 - s**4 - 4 * (1 - s) * s**3) ** neardup.chunks_for(percent) <= 2.1e-8
    with pytest.raises(ValueError):
        near_duplicates(spark.createDataFrame([(1, "a b c d", "s")], SCHEMA), percent=70)
    # Two errors in each of the first eight chunks: only a later chunk has a key in common.
    a, b = [7] * 64, [7] * 64
    for c in range(8):
        b[4 * c] = b[4 * c + 1] = 8
    sig = lambda x: bytearray(b"".join(v.to_bytes(2, "little") for v in x))
    df = spark.createDataFrame([(1, sig(a)), (2, sig(b))], "id long, sig binary")
    shared = lambda percent: neardup.chunk_keys(df, percent).groupBy("key").count().filter("count > 1").count()
    assert shared(85) == 24 and shared(80) == 32


def test_all_signatures_within_the_distance_share_a_key(spark):
    """Pigeonhole: errors dealt as evenly as can be over the chunks, and at random, at every distance up to the threshold."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 15, 64).astype("<u2")
    for percent in (80, 85, 92):
        radius, rows = neardup.radius_of(percent), [(0, bytearray(base.tobytes()))]
        for d in range(1, radius + 1):
            even = [4 * (i % 16) + i // 16 for i in range(64)]
            for at in [even[:d], *(rng.permutation(64)[:d] for _ in range(20))]:
                x = base.copy()
                x[at] += 1 << 15
                rows.append((len(rows), bytearray(x.tobytes())))
        keys = neardup.chunk_keys(spark.createDataFrame(rows, "id long, sig binary"), percent)
        own = keys.filter("id = 0").select("key")
        assert keys.join(own, "key", "left_semi").select("id").distinct().count() == len(rows)
