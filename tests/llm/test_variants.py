"""Spelling variants against brute force over all pairs, with planted slips, ties, long words and odd rows."""

import random
import re
import zlib
from collections import Counter

from lodestar.llm.variants import TEXT_KEY, spelling_variants, word_counts


def plain_counts(rows, edit, least=7, count=2):
    words = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if edit and h % edit == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= least and n >= count}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows, edit=None, least=7, ratio=10):
    counts = plain_counts(rows, edit, least)
    out, form, n_near = [], {}, {}
    for w, n in counts.items():
        close = [v for v in counts if near(w, v)]
        n_near[w] = len(close)
        best = min(close, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, n_near[w], counts[form[w]] if form[w] else None))
    return sorted(out)


def compare(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in spelling_variants(df, **more).collect())
    want = plain_variants(rows, more.get("edit"), more.get("least_letters", 7), more.get("ratio", 10))
    assert got == want
    return got


def test_small_alphabet_where_nearly_all_words_are_near(spark):
    rng = random.Random(1)
    rows = []
    for i in range(120):
        words = ["".join(rng.choice("ab") for _ in range(rng.randint(3, 6))) for _ in range(int(rng.paretovariate(0.7)) % 400 + 1)]
        rows.append((i, " ".join(words + [rng.choice(words)] * rng.randint(0, 300))))
    got = compare(spark, rows, least_letters=4, ratio=2)
    assert any(r[1] for r in got) and any(r[2] not in (r[0], r[1]) for r in got)
    compare(spark, rows, edit=3, least_letters=3, ratio=2)


def test_query_rules_on_planted_slips(spark):
    rng = random.Random(4)
    base = ["Verständnis", "PROGRAMMING", "straßenbahn", "çirconflexe", "aaaaaaaab", "mississippi", "Zeitungen"]
    rows = [(None, "Programming programming"), (5, None), (6, ""), (7, "abcdefg abcdefg"), (7, "abcdefg×abcdefg÷ abcdef1g"), (8, "ĀbcdefgĀ Ābcdefg")]
    for i in range(20, 400):
        out = []
        for _ in range(30):
            w = rng.choice(base)
            if rng.random() < 0.05:
                k = rng.randrange(len(w))
                w = w[:k] + rng.choice(["", "e", "ÿ", "xy"]) + w[k + rng.randint(0, 1) :]
            out.append(w)
        rows.append((i, rng.choice([" ", ",", "1"]).join(out)))
    got = compare(spark, rows, edit=31)
    assert any(r[1] == "programming" for r in got)
    compare(spark, rows, edit=None)


def test_long_words_around_the_length_of_text_prefixes(spark):
    rng = random.Random(9)
    rows = []
    for i, m in enumerate([TEXT_KEY - 1, TEXT_KEY, TEXT_KEY + 1, TEXT_KEY + 2, 3 * TEXT_KEY, 3000]):
        w = "".join(rng.choice("abé") for _ in range(m))
        k = rng.randrange(1, m - 1)
        kin = [w, w[:k] + "z" + w[k + 1 :], w[:k] + "z" + w[k:], w[:k] + w[k + 1 :], w[1:], w[:-1], w + "q", "q" + w]
        for j, v in enumerate(kin):
            rows.append((10 * i + j, " ".join([v] * (40 if j == 0 else 2 + j % 2))))
    got = compare(spark, rows)
    assert sum(r[1] is not None for r in got) > 30


def test_one_word_of_very_many_letters_and_empty_table(spark):
    w = "ab" * 50_000
    rows = [(1, w), (2, w), (3, w[1:]), (4, w[1:])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {len(r["word"]): r["n_near"] for r in spelling_variants(df).collect()}
    assert got == {100_000: 1, 99_999: 1}
    assert spelling_variants(df.limit(0)).count() == 0
    extra = df.selectExpr("doc_id", "text", "1 as n", "2 as word", "3 as wid")
    assert {r["n"] for r in word_counts(extra).collect()} == {2}
