import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestar.llm import tokens
from lodestar.llm.packing import _Instance, best_fit, dominating, pack, pack_digest, plan, reduce_instance
from lodestar.llm.tokenfile import decode, encode, read_tokens, token_digest, write_tokens

SCHEMA = "doc_id long, text string, ids string, part int"
TEXTS = ["", None, " a  b\n\n c  d", "don't  \n it'll &'s 'tis", "<|endoftext|> hi", "é è  ô’s", "a b　c", "x" * 300, "word " * 3000, "Ünï, cödé! 12,5 %%% " * 40]


def library(text):
    tok = tokens.Encoder(tokens.default_path()).tok
    return tok.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def frame(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, "clash", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_encoder_equals_the_library():
    import pyarrow as pa

    ids, bounds = tokens.Encoder(tokens.default_path())(pa.array(TEXTS, pa.string()))
    for i, t in enumerate(TEXTS):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == library(t)


def test_encoder_forgets_and_goes_on(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(tokens, "CACHE_PIECES", 2)
    enc = tokens.Encoder(tokens.default_path())
    for _ in range(3):
        ids, bounds = enc(pa.array(TEXTS[:6], pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [library(t) for t in TEXTS[:6]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50256), st.integers(0, (1 << 64) - 1)), max_size=400), st.integers(0, 1200))
def test_simple8b_round_trip(some, zeros):
    x = np.array(some + [0] * zeros + some[::-1], np.uint64)
    words, blocks = encode(x)
    assert decode(words, blocks, len(x)).tolist() == x.tolist()


def test_simple8b_packs():
    assert len(encode(np.ones(6000, np.uint64))[0]) < 6000 / 50
    assert len(encode(np.full(6000, 50000, np.uint64))[0]) <= 6000 / 3 + 6


def test_token_file(spark):
    docs = frame(spark, TEXTS, ids=[9, 3, 70, 5, 2, 11, 1, 8, 40, 6])
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_digest(docs).collect()}
    at = 0
    for i, t in sorted(zip([9, 3, 70, 5, 2, 11, 1, 8, 40, 6], TEXTS)):
        ids = [*library(t), 2]
        assert got[i] == (at, len(ids), crc(ids))
        at += len(ids)
    path = write_tokens(docs.limit(0))
    assert read_tokens(spark, path).count() == 0


def test_token_file_with_odd_ids(spark):
    docs = frame(spark, ["a b", "c", "a b", "a b"], ids=[None, 4, 4, 4])
    rows = sorted((r.start, r.n_tokens) for r in token_digest(docs).collect())
    assert [s for s, _ in rows] == [sum(n for _, n in rows[:k]) for k in range(4)]


def check_packed(rows, docs, capacity):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by_doc) == set(docs)
    for i, pieces in by_doc.items():
        ids = [*library(docs[i]), 0]
        pieces.sort()
        at = 0
        for k, (piece, start, length, c) in enumerate(pieces):
            assert (piece, start) == (k, at) and c == crc(ids[start : start + length])
            assert length == capacity or k == 0
            at += length
        assert at == len(ids) and (len(pieces) == 1 or len(ids) > capacity)
    for parts in by_seq.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= capacity
    return len(by_seq)


def test_packing(spark):
    rng = np.random.default_rng(1)
    texts = TEXTS + [" ".join(["ab"] * int(n)) for n in rng.integers(0, 90, 150)]
    rows = pack_digest(frame(spark, texts), capacity=64).collect()
    n = check_packed(rows, dict(enumerate(texts)), 64)
    assert n <= 1.03 * sum(r.length for r in rows) / 64 + 1
    assert pack_digest(frame(spark, texts).limit(0)).count() == 0
    whole = pack(frame(spark, ["a b", None, "a b"], ids=[1, None, 1])).sequences().collect()
    assert sorted(len(r.ids) // 4 for r in whole) == [1, 3, 3] and {r.sequence_id for r in whole} == {0}


@settings(max_examples=80, deadline=None)
@given(st.integers(3, 24), st.data())
def test_reduction_keeps_the_optimum(c, data):
    sizes = data.draw(st.lists(st.integers(1, c), min_size=1, max_size=8))
    hist = {s: sizes.count(s) for s in sizes}

    def optimum(items):
        items, best = sorted(items, reverse=True), [len(items)]

        def go(k, bins):
            if len(bins) >= best[0]:
                return
            if k == len(items):
                best[0] = len(bins)
                return
            for room in sorted(set(bins)):
                if room >= items[k]:
                    b = list(bins)
                    b.remove(room)
                    go(k + 1, [*b, room - items[k]])
            go(k + 1, [*bins, c - items[k]])

        go(0, [])
        return best[0]

    x = _Instance(dict(hist), c)
    fixed = sum(k for _, k in reduce_instance(x))
    rest = [s for s, n in x.n.items() for _ in range(n)]
    assert fixed + (optimum(rest) if rest else 0) == optimum(sizes)
    assert plan(hist, c).sequences >= optimum(sizes)


def test_dominating_sets():
    assert dominating(_Instance({9: 1, 5: 1}, 10), 9) == [9]
    assert dominating(_Instance({6: 1, 4: 1, 3: 1, 1: 5}, 10), 6) == [6, 4]
    assert dominating(_Instance({6: 1, 3: 1, 2: 3, 1: 9}, 10), 6) is None
    assert sum(k for _, k in best_fit(_Instance({5: 7}, 10))) == 4


@pytest.mark.parametrize("n", [1, 1000])
def test_plan_is_exact_for_any_count(n):
    p = plan({2048: n, 1000: 2 * n, 48: n, 24: 2 * n}, 2048)
    assert p.sequences == -(-4144 * n // 2048)
