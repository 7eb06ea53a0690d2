"""Periodic runs against the definition, on random and adverse sequences, and as a query on documents."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from lodestar.llm.periodic import periodic_runs, run_digest, runs_of


def plain_runs(words, least=12):
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                s = words[i : j + q]
                if not any(s[p:] == s[:-p] for p in range(1, q)):
                    out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def sequences():
    rng = random.Random(5)
    yield []
    yield list("a" * 11)
    yield list("a" * 12)
    yield list("a" * 200)
    yield list("a" * 40 + "b" * 40)
    yield list("ab" * 30 + "a" + "ab" * 30)
    fib = ["a", "ab"]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    yield list(fib[-1])
    for _ in range(150):
        n, k = rng.randint(1, 260), rng.choice([1, 2, 3, 30])
        x = [rng.randrange(k) for _ in range(n)]
        for _ in range(rng.randint(0, 4)):
            a, p, m = rng.randrange(n), rng.randint(1, 40), rng.randint(2, 120)
            unit = [rng.randrange(k + 50) for _ in range(p)]
            x[a:a] = [unit[i % p] for i in range(m)]
        yield x


@pytest.mark.parametrize("least", [12, 5, 2, 31])
def test_runs_equal_the_definition(least):
    docs = list(sequences())
    flat = np.array([hash(w) % (1 << 40) for d in docs for w in d], np.int64)
    ids = np.unique(flat, return_inverse=True)[1]
    first = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    s, e, q = runs_of(ids, first, least)
    home = np.searchsorted(first, s, side="right") - 1
    for d, x in enumerate(docs):
        at = home == d
        assert list(zip((s - first[d])[at], (e - s)[at], q[at])) == plain_runs(x, least), x


def test_one_word_repeated_a_million_times_is_one_run_and_quick():
    t = time.time()
    s, e, q = runs_of(np.zeros(1_000_000, np.int64), np.array([0, 1_000_000]))
    assert (s.tolist(), e.tolist(), q.tolist()) == ([0], [1_000_000], [1])
    assert time.time() - t < 60


def plain_digest(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    row = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *row, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_query_equals_brute_force(spark):
    rng = random.Random(2)
    rows = [(None, "x " * 20), (1, None), (2, ""), (3, " \t\x0b "), (4, "one word"), (4, "one word " * 9), (7, "é\x85ü " * 14)]
    for i in range(10, 300):
        words = [rng.choice(["ja", "nein", "Öl", "x", f"w{rng.randrange(99)}"]) for _ in range(rng.randint(0, 90))]
        if i % 3 == 0 and words:
            words += words[-rng.randint(1, len(words)) :] * rng.randint(1, 5)
        rows.append((i, rng.choice([" ", "\n", "  "]).join(words)))
    assert sum(i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 10
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in run_digest(docs).collect()]
    assert sorted(got, key=str) == sorted((plain_digest(*r) for r in rows), key=str)


def test_query_equals_brute_force_on_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("length(text) < 5000")
    got = {r["doc_id"]: tuple(r) for r in run_digest(docs).collect()}
    want = {r["doc_id"]: plain_digest(*r) for r in docs.select("doc_id", "text").collect()}
    assert got == want
    assert any(r[1] for r in got.values())


def test_long_text_empty_table_and_extra_columns(spark):
    rows = [(1, "a b c " * 120_000 + "z", 5, "n"), (2, "w" * 300_000, 6, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int, n_words string")
    a, b = sorted(periodic_runs(df, keep=["runs"]).collect())
    assert [tuple(r) for r in a[3]] == [(0, 360_000, 3)] and a[4] == "a b c z" and a[1] == 5
    assert b[2] == 1 and b[3] == [] and b[4] == "w" * 300_000
    assert periodic_runs(df.limit(0)).count() == 0
    assert run_digest(df.limit(0)).columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
