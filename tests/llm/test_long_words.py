"""Words of over 4,096 bytes: different words stay different, in the hash and in the operators that use it."""

import zlib

import numpy as np
import pyarrow as pa

from lodestar.llm._text import NON_SPACE, word_hash, words
from lodestar.llm.brown import score
from lodestar.llm.decontam import contamination_digest
from lodestar.llm.neardup import near_duplicate_digest
from lodestar.llm.substring import dedup_digest

LONG = "m" * 6000
#: Two bytes 4,096 apart changed so that weights that repeat and differ by an odd factor would cancel.
OTHER = LONG[:100] + "j" + LONG[101:4196] + "n" + LONG[4197:]


def hashes(texts):
    return word_hash(words(pa.array(texts, pa.large_string()), NON_SPACE))


def test_hashes_of_long_words():
    block = ["".join(chr(97 + (i * 7 + j) % 26) for i in range(4096)) for j in range(3)]
    texts = [LONG, OTHER, *block, block[0] + block[1], block[1] + block[0], "".join(block), block[0] + block[2] + block[1], LONG[:-1], LONG[:4096], LONG[:4097]]
    rng = np.random.default_rng(1)
    for _ in range(500):  # changes at the same place of two blocks
        x = bytearray(LONG.encode() * 2)
        p = int(rng.integers(0, 4000))
        x[p] += int(rng.integers(-9, 9))
        x[p + 4096] += int(rng.integers(-9, 9))
        texts.append(x.decode())
    got = hashes(texts)
    assert len(set(got.tolist())) == len(set(texts))
    alone = np.array([hashes([t])[0] for t in texts[:12]])
    assert (got[:12] == alone).all()  # a word's hash doesn't depend on what else is in the batch
    short = ["a", "bc", "x" * 4096]
    assert (hashes([*short, LONG])[:3] == hashes(short)).all()


def test_operators_tell_long_words_apart(spark):
    few = " ".join(f"w{i}" for i in range(19))
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    got = dedup_digest(frame([(1, f"{few} {LONG}"), (2, f"{few} {OTHER}"), (3, f"{few} {LONG}")])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (2, 0), (3, 20)]
    got = near_duplicate_digest(frame([(1, f"a b {LONG}"), (2, f"a b {OTHER}"), (3, f"a b {LONG}")])).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (2, 2), (3, 1)]
    items = spark.createDataFrame([(1, OTHER)], "item_id long, text string")
    got = contamination_digest(frame([(1, f"x {LONG}"), (2, f"x {OTHER}")]), items).collect()
    assert sorted((r.doc_id, r.n_hit) for r in got) == [(1, 0), (2, 1)]
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    train = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 != 1)
    got = {r.doc_id: r.n_known for r in score(frame([(train, LONG), (held, OTHER)])).collect()}
    assert got == {train: 2, held: 1}
