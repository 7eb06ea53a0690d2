import hashlib
import random
import re

from lodestar.llm import substring
from lodestar.llm.decontam import contamination, contamination_digest, decontaminate
from lodestar.llm.licenses import TEMPLATES, scan_licenses
from lodestar.llm.substring import dedup_digest, dedup_substrings, gaps, ungaps

import numpy as np

SCHEMA = "doc_id long, text string, h long, id string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "clash") for i, t in rows], SCHEMA).repartition(4)


def passages(seed, n=60, vocabulary=400):
    rng = random.Random(seed)
    parts = [[f"w{rng.randrange(vocabulary)}" for _ in range(rng.randint(5, 60))] for _ in range(12)]
    out = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += rng.choice(parts) if rng.random() < 0.6 else [f"w{rng.randrange(vocabulary)}" for _ in range(rng.randint(1, 40))]
        out.append(rng.choice([" ", "\n", " \t "]).join(words))
    return out


def brute_dedup(rows, k):
    first, words = {}, {}
    for i, t in rows:
        words[i] = re.findall(r"[^\x20\x09-\x0d]+", t or "")
        for s in range(len(words[i]) - k + 1):
            key = tuple(words[i][s : s + k])
            first[key] = min(first.get(key, (i, s)), (i, s))
    out = {}
    for i, w in words.items():
        gone = {s + j for s in range(len(w) - k + 1) if first[tuple(w[s : s + k])] < (i, s) for j in range(k)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def got_dedup(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()}


def test_dedup_against_brute_force(spark, monkeypatch):
    texts = passages(1)
    rows = [(i * 7 % 601, t) for i, t in enumerate(texts + [None, "", " \n ", "é " * 50, "a b " * 300])]
    docs = frame(spark, rows)
    assert got_dedup(dedup_digest(docs, window=20)) == brute_dedup(rows, 20)
    assert got_dedup(dedup_digest(docs, window=3)) == brute_dedup(rows, 3)
    monkeypatch.setattr(substring, "FLUSH", 50)  # many partial sketches and emissions
    assert got_dedup(dedup_digest(docs, window=20)) == brute_dedup(rows, 20)


def test_a_full_sketch_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(substring, "_cells", lambda h, row: h & np.uint64(3))
    rows = list(enumerate(passages(5, 30)))
    assert got_dedup(dedup_digest(frame(spark, rows))) == brute_dedup(rows, 20)


def test_dedup_odd_rows(spark):
    long = " ".join(f"x{i}" for i in range(30))
    rows = [(3, long), (3, long), (None, long), (5, "y " + long), (None, None)]
    got = sorted((r.doc_id or -1, r.n_words, r.n_removed) for r in dedup_digest(frame(spark, rows)).collect())
    # rows of one id tie; a null id comes last
    assert got == [(-1, 0, 0), (-1, 30, 30), (3, 30, 0), (3, 30, 0), (5, 31, 30)]
    assert dedup_digest(frame(spark, rows).limit(0)).count() == 0
    kept = dedup_substrings(frame(spark, rows), keep=("h", "id")).filter("doc_id = 5").first()
    assert (kept.kept_text, kept.h, kept.id) == ("y", 1, "clash")


def test_rows_of_one_id_with_different_texts(spark):
    long = " ".join(f"x{i}" for i in range(20))
    rows = [(1, long), (4, long + " a"), (4, long + " b")]
    got = sorted((r.doc_id, r.kept_text) for r in dedup_substrings(frame(spark, rows)).collect())
    assert got == [(1, long), (4, "a"), (4, "b")]


def test_gap_code():
    for x in ([0], [254], [255], [256, 256, 900], [0, 1, 1, 510, 511, 1 << 20]):
        assert ungaps(gaps(np.array(x))).tolist() == x


def item_words(t):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))


def brute_leaks(docs, items, k=10):
    wins = {}
    for i, t in items:
        w = item_words(t)
        m = min(len(w), k)
        for s in range(len(w) - m + 1 if m else 0):
            wins.setdefault(tuple(w[s : s + m]), set()).add(str(i))
    out = {}
    for i, t in docs:
        w = item_words(t)
        hit, found = set(), set()
        for m in {len(x) for x in wins}:
            for s in range(len(w) - m + 1):
                if (x := tuple(w[s : s + m])) in wins:
                    hit |= set(range(s, s + m))
                    found |= wins[x]
        out[i] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


def test_decontamination_against_brute_force(spark):
    rng = random.Random(4)
    items = [(i, " ".join(f"w{rng.randrange(500)}" for _ in range(rng.choice([0, 1, 3, 9, 10, 11, 40])))) for i in range(40)] + [(99, None), (98, "Été Ü 12"), (5, "same again")]
    docs = []
    for i in range(120):
        w = [f"W{rng.randrange(500)}" for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):  # parts of items, with other punctuation and case
            part = (rng.choice(items)[1] or "").upper().split()
            part = part[rng.randint(0, 5) :]
            at = rng.randint(0, len(w))
            w[at:at] = part
        docs.append((i, rng.choice([" ", ", ", "-"]).join(w)))
    docs += [(200, None), (201, "été ü 12!"), (202, "")]
    bench = spark.createDataFrame([(i, t, 0, "z") for i, t in items], "item_id long, text string, size int, fp string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in contamination_digest(frame(spark, docs), bench).collect()}
    want = brute_leaks(docs, items)
    assert got == want and any(v[4] for v in want.values()) and not all(v[4] for v in want.values())
    clean = decontaminate(frame(spark, docs), bench)
    assert {r.doc_id for r in clean.collect()} == {i for i, v in want.items() if not v[4]}
    assert clean.columns == ["doc_id", "text", "h", "id"]


def test_decontamination_odd_rows(spark):
    bench = spark.createDataFrame([(None, "one two three"), (None, None)], "item_id long, text string")
    docs = frame(spark, [(None, "One, two three four"), (1, "one two"), (1, "one two three"), (1, "one two three")])
    got = sorted((r.doc_id or 0, r.n_words, r.n_hit, r.n_items) for r in contamination_digest(docs, bench).collect())
    assert got == [(0, 4, 3, 0), (1, 2, 0, 0), (1, 3, 3, 0), (1, 3, 3, 0)]
    assert contamination(docs, bench.limit(0)).filter("n_hit > 0").count() == 0
    assert contamination_digest(docs.limit(0), bench).count() == 0


def test_licenses(spark):
    rng = random.Random(2)
    noise = lambda n: " ".join(f"w{rng.randrange(900)}" for _ in range(n))
    docs, want = [], set()
    names = sorted(TEMPLATES)
    for i in range(80):
        name = names[i % len(names)]
        words = TEMPLATES[name].upper().split()
        if i >= 40 and len(words) > 30:
            words[len(words) // 2] = "changed"  # still over 0.8 of the shingles
        docs.append((i, f"{noise(rng.randint(0, 90))}\n{'  '.join(words)}\n{noise(rng.randint(0, 70))}"))
        want.add((i, name))
    want |= {(i, "apache-2.0-short") for i, n in want if n == "apache-2.0-header"}
    docs += [(90, None), (91, ""), (92, noise(500)), (93, "all rights are reserved"), (94, "Permission is hereby granted")]
    got = scan_licenses(frame(spark, docs)).collect()
    assert {(r.doc_id, r.template) for r in got} == want
    assert all(0.8 <= r.containment <= 1 for r in got) and len(got) == len(want)
    assert scan_licenses(frame(spark, docs).limit(0)).count() == 0
    own = spark.createDataFrame([("none", ""), ("null", None), ("two", "alpha beta")], "template string, text string")
    twice = frame(spark, [(None, "x ALPHA beta y alpha beta"), (7, "alpha gamma beta")])
    assert [tuple(r) for r in scan_licenses(twice, own).collect()] == [(None, "two", 1.0, 1)]


def test_no_license_is_missed_in_longer_texts(spark):
    rng = random.Random(31)
    vocabulary = [f"w{i}" for i in range(20000)]
    noise = lambda n: rng.choices(vocabulary, k=n)
    own = {f"own{n}": " ".join(f"t{n}x{i}" for i in range(n)) for n in (5, 6, 7, 8, 9, 10, 12, 17, 33)}
    docs, want = [], set()
    for name, text in own.items():
        for _ in range(2000):
            docs.append((len(docs), " ".join(noise(rng.randint(20, 40)) + text.split() + noise(30))))
            want.add((docs[-1][0], name))
    known = spark.createDataFrame(list(own.items()), "template string, text string")
    got = scan_licenses(frame(spark, docs), known).collect()
    assert {(r.doc_id, r.template) for r in got} == want and all(r.containment == 1 for r in got)
    # A lower bound finds parts: two of the ten-word template's six shingles.
    part = frame(spark, [(i, " ".join(noise(30) + own["own10"].split()[2:8] + noise(30))) for i in range(300)])
    got = scan_licenses(part, known, containment=0.3).collect()
    assert {(r.doc_id, r.template) for r in got} == {(i, "own10") for i in range(300)}


def test_long_templates_have_enough_bands(spark):
    rng = random.Random(32)
    text = [f"t{i}" for i in range(257)]  # half of its class's words: the smallest similarity
    docs = []
    for i in range(600):
        noise = lambda: [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(300, 700))]  # noqa: B023, E731
        docs.append((i, " ".join(noise() + text[:100] + ["x"] + text[101:] + noise())))
    known = spark.createDataFrame([("long", " ".join(text))], "template string, text string")
    assert {r.doc_id for r in scan_licenses(frame(spark, docs), known).collect()} == set(range(600))


def test_license_families(spark):
    gpl = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."
    texts = {
        "gpl-2.0-notice": gpl.format("General Public License", "2"),
        "lgpl-2.1-notice": gpl.format("Lesser General Public License", "2.1").replace("program", "library"),
        "lgpl-3.0-notice": gpl.format("Lesser General Public License", "3"),
        "agpl-notice": gpl.format("Affero General Public License", "3"),
        "gpl-3.0-notice": gpl.format("General Public License", "3"),
        "gpl-2.0-only-notice": "under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
        "mpl-2.0": "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n * file, You can obtain one at http://mozilla.org/MPL/2.0/. */",
        "bsd-3-clause": "Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "cc0-1.0": "To the extent possible under law, Ann has waived all copyright and related or neighboring rights to this dictionary.",
        "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    }
    names = list(texts)
    got = {}
    for r in scan_licenses(frame(spark, [(i, f"a b c {texts[n]} d e") for i, n in enumerate(names)])).collect():
        got.setdefault(names[r.doc_id], set()).add(r.template)
    # The notices of the other GNU licenses hold most of the one of GPL-3.0, too.
    assert {n: got[n] - {"gpl-3.0-notice"} or got[n] for n in names} == {n: {n} for n in names}


def test_bands_retrieve_every_template_and_brute_force_agrees(spark):
    from lodestar.llm.licenses import LEAST_BANDED, _class, _plan

    for name, text in TEMPLATES.items():
        n = len(re.findall("[0-9a-z]+", text.lower()))
        m = n - 4
        keys, bands = _plan(m, int(_class(np.array([n]))[0]), 0.8) if m > 0 else (1, 0)
        assert (bands > 0) == (m >= LEAST_BANDED), name
    sp = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rng = random.Random(12)
    rows = [(r.doc_id, r.text) for r in sp.collect()]
    names = sorted(TEMPLATES)
    for i in range(1500):  # contexts of every template, with a word in it changed at times
        words = TEMPLATES[names[i % len(names)]].split()
        if i % 2 and len(words) > 8:
            words[rng.randrange(len(words))] = "changed"
        noise = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(0, 120))]
        cut = rng.randint(0, len(noise))
        rows.append((10_000 + i, " ".join(noise[:cut] + words + noise[cut:])))
    shingles = {}
    for name in names:
        w = re.findall("[0-9a-z\x80-\U0010ffff]+", TEMPLATES[name].lower())
        k = min(5, len(w))
        shingles[name] = k, len(w), {tuple(w[s : s + k]) for s in range(len(w) - k + 1)}
    want = {}
    for i, t in rows:
        w = re.findall("[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in t))
        for name, (k, n, own) in shingles.items():
            at = [s for s in range(len(w) - k + 1) if tuple(w[s : s + k]) in own]
            # whole occurrences: a stretch of the template's length holds enough of its shingles
            best = max((len({tuple(w[s : s + k]) for s in at if a <= s <= a + n - k}) for a in at), default=0) / len(own)
            if best >= 0.8:
                want[i, name] = best
    got = {(r.doc_id, r.template): r.containment for r in scan_licenses(frame(spark, rows)).collect()}
    assert set(want) <= set(got) and len(want) > 1000
    assert all(got[key] >= share - 1e-9 for key, share in want.items())
    assert all(share >= 0.8 for share in got.values())
