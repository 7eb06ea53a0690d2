"""SentencePiece encoding and decoding against the library, whose own results are the measure."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from lodestar.llm.pieces import Model, _model, decode_pieces, encode_pieces, piece_digest

PATH = P.path("piece_bpe_32k.model")
ALPHABET = ["a", "e", "th", "ing", " ", "  ", "\n", "\t", "▁", "0", "17", "é", "ß", "😀", "漢", "字", "ﬁ", "Ａ", "́", "㍿", "​", "　", "<s>", "\x00", " ", "क्ष", "."]


def library(path=PATH):
    return sentencepiece.SentencePieceProcessor(model_file=path)


def samples(n=400, seed=3):
    rng = random.Random(seed)
    yield from ["", " ", "   ", "▁", " ▁ ", "​", "\n", "a", "😀", "é" * 200, "x" * 300, " " * 100 + "y", "ab" * 90 + "漢" * 50]
    for _ in range(n):
        yield "".join(rng.choice(ALPHABET) for _ in range(rng.randint(1, 60)))


def check_encoding(path, texts):
    sp, model = library(path), _model(path)
    ids, begin, end, bounds = model.encode(pa.array(texts))
    for i, t in enumerate(texts):
        want = sp.encode(t, return_type="proto").pieces
        at = slice(bounds[i], bounds[i + 1])
        assert ids[at].tolist() == [p.id for p in want], repr(t)
        assert list(zip(begin[at].tolist(), end[at].tolist())) == [(p.begin, p.end) for p in want], repr(t)
    for with_end in (False, True):
        full = [sp.encode(t) + [2] * with_end for t in texts]
        n = np.cumsum([0, *map(len, full)])
        got = model.decode(np.array([x for f in full for x in f], np.int32), n)
        assert [g.decode() for g in got] == [sp.decode(f) for f in full]


def test_ids_spans_and_texts_equal_the_library():
    check_encoding(PATH, list(samples()))


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "nfkc_cf"])
@pytest.mark.parametrize("prefix,squeeze", [(True, True), (True, False), (False, False), (False, True)])
def test_compiled_character_maps(tmp_path, rule, prefix, squeeze):
    """The vocabulary of the given model behind the compiled map of a rule set (a file for this test only)."""
    spec = pb.ModelProto()
    spec.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
    proto = pb.ModelProto()
    with open(PATH, "rb") as f:
        proto.ParseFromString(f.read())
    proto.normalizer_spec.CopyFrom(spec.normalizer_spec)
    proto.normalizer_spec.add_dummy_prefix = prefix
    proto.normalizer_spec.remove_extra_whitespaces = squeeze
    proto.normalizer_spec.escape_whitespaces = True
    path = str(tmp_path / "m.model")
    with open(path, "wb") as f:
        f.write(proto.SerializeToString())
    sp, model = library(path), _model(path)
    texts = [t for t in samples(250)]
    ids, begin, end, bounds = model.encode(pa.array(texts))
    for i, t in enumerate(texts):
        want = sp.encode(t, return_type="proto").pieces
        at = slice(bounds[i], bounds[i + 1])
        assert ids[at].tolist() == [p.id for p in want], repr(t)
        assert list(zip(begin[at].tolist(), end[at].tolist())) == [(p.begin, p.end) for p in want], repr(t)


def test_decoding_any_ids_equals_the_library():
    sp, model, rng = library(), _model(PATH), random.Random(8)
    byte = range(3, 259)
    for _ in range(300):
        ids = [rng.choice([0, 1, 2, 259, 28705, rng.choice(byte), rng.choice(byte), rng.randrange(32000)]) for _ in range(rng.randint(0, 12))]
        if ids[:1] == [0]:
            ids[0] = 300  # white space after a leading unknown piece is the library's own affair
        (got,) = model.decode(np.array(ids, np.int32), np.array([0, len(ids)]))
        assert got.decode() == sp.decode(ids), ids


def test_other_models_are_refused(tmp_path):
    proto = pb.ModelProto()
    with open(PATH, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    path = str(tmp_path / "u.model")
    with open(path, "wb") as f:
        f.write(proto.SerializeToString())
    with pytest.raises(ValueError, match="BPE"):
        Model(path)


def test_query_equals_the_library_on_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sp = library()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for r in docs.select("doc_id", "text").collect():
        ids = sp.encode(r["text"] or "", add_eos=True)
        want[r["doc_id"]] = (len(ids), sha(" ".join(map(str, ids))), sha(sp.decode(ids)))
    assert {r["doc_id"]: tuple(r)[1:4] for r in piece_digest(docs).collect()} == want


def test_odd_rows_and_extra_columns(spark):
    rows = [(None, "a b", 1, "x"), (1, None, 2, "y"), (1, "", 3, None), (1, "", 3, None), (2, "w" * 100_000 + " 漢" * 50_000 + " " * 100_000, 4, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int, k0 string")
    got = encode_pieces(df, keep=["doc_id", "k0"])
    assert got.columns == ["doc_id", "k0", "ids", "begins", "ends"]
    for r in got.collect():
        text = next(x[1] for x in rows if x[0] == r["doc_id"] and x[3] == r["k0"]) or ""
        assert r["ids"] == library().encode(text, add_eos=True)
        raw = text.encode()
        assert b"".join(raw[b:e] for b, e in zip(r["begins"], r["ends"])) == raw and r["begins"][-1] == len(raw)
    back = {(r["doc_id"], r["k0"]): r["text"] for r in decode_pieces(got, keep=["doc_id", "k0"]).collect()}
    assert back == {(x[0], x[3]): x[1] or "" for x in rows}
    assert piece_digest(df.limit(0)).count() == 0
    none = spark.createDataFrame([(1, None), (2, [None, 300])], "doc_id long, ids array<int>")
    assert sorted(decode_pieces(none).collect()) == [(1, ""), (2, "om")]
