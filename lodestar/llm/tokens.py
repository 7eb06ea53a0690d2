"""Token ids of whole texts by the ``tokenizers`` library, each distinct piece encoded once per task.

A byte-level BPE with the usual split pattern never merges across the start of
a run of white space, nor between an ASCII letter and ASCII punctuation (but for
an apostrophe before a letter). A text is cut there, and its ids are the ids of
its pieces in order. Arrow's dictionary encoding finds the distinct pieces, and
the library encodes each once. Texts with white space outside ASCII are encoded
whole.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lodestar.llm._common import steps, strings
from lodestar.llm._text import buffer_of

#: Distinct pieces whose ids a worker remembers; beyond that it forgets them all and goes on.
CACHE_PIECES = 700_000
_WIDE_SPACE = r"[\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _kinds() -> np.ndarray:
    """ASCII bytes: 1 white space, 2 letter, 3 punctuation, 4 apostrophe; 0 anything else."""
    t = np.zeros(256, np.uint8)
    for a, b in ((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)):
        t[a : b + 1] = 3
    t[0x27] = 4
    for a in (0x41, 0x61):
        t[a : a + 26] = 2
    t[0x20] = 1
    t[0x09:0x0E] = 1
    return t


class Encoder:
    """Ids of whole texts; special-token strings inside a text are ordinary text, none are added."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers

        self.tok = tokenizers.Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        # The memo hangs on the library's module: a worker that runs many tasks keeps it.
        self.memo = vars(tokenizers).setdefault("_lodestar_pieces", {}).setdefault(path, {})
        if not self.memo:
            self.forget()

    def forget(self):
        self.memo.update(known=pa.array([], pa.large_string()), flat=np.zeros(0, np.uint32), lens=np.zeros(0, np.int64))

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for i in range(0, len(texts), 256):
            out += [np.array(e.ids, np.uint32) for e in self.tok.encode_batch_fast(texts[i : i + 256], add_special_tokens=False)]
        return out

    def _pieces(self, distinct: pa.Array, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and lengths of the pieces ``distinct[code]``."""
        if len(self.memo["known"]) > CACHE_PIECES:
            self.forget()
        m = self.memo
        at = pc.index_in(distinct, value_set=m["known"])
        new = at.is_null()
        if at.null_count:
            fresh = distinct.filter(new)
            # One space or none before the text: such pieces are encoded many to a call, parted by line feeds.
            easy = pc.match_substring_regex(fresh, r"^ ?\S")
            joined, other = fresh.filter(easy), fresh.filter(pc.invert(easy))
            runs = [self._joined(joined.slice(i, 1 << 16).to_pylist()) for i in range(0, len(joined), 1 << 16)]
            alone = self._library(other.to_pylist())
            m["flat"] = np.concatenate([m["flat"], *(r[0] for r in runs), *alone])
            m["lens"] = np.concatenate([m["lens"], *(r[1] for r in runs), np.array([len(x) for x in alone], np.int64)])
            place = np.empty(len(fresh), np.int64)
            e = easy.to_numpy(zero_copy_only=False)
            place[e], place[~e] = np.arange(len(joined)), len(joined) + np.arange(len(other))
            got = np.empty(len(distinct), np.int64)
            new = new.to_numpy(zero_copy_only=False)
            got[new], got[~new] = len(m["known"]) + place, at.drop_null().to_numpy()
            m["known"] = pa.concat_arrays([m["known"], joined, other])
        else:
            got = at.to_numpy()
        lens = m["lens"]
        return gather(m["flat"], np.cumsum(lens) - lens, lens, got[code])

    def _joined(self, pieces: list[str], each: int = 256) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and lengths of pieces that hold no line feed."""
        texts = ["\n".join(pieces[i : i + each]) + "\n" for i in range(0, len(pieces), each)]
        got = [e.ids for i in range(0, len(texts), 16) for e in self.tok.encode_batch_fast(texts[i : i + 16], add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(got), np.uint32)
        (feed,) = self.tok.encode("\n", add_special_tokens=False).ids
        at = np.flatnonzero(flat == feed)
        if len(at) != len(pieces):
            raise ValueError("the tokenizer joins line feeds with other text")
        return flat[flat != feed], np.diff(at, prepend=-1) - 1

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, bounds)``: text i has ids[bounds[i]:bounds[i + 1]]."""
        texts = strings(texts)
        raw = buffer_of(texts)[0]
        wide = np.zeros(0, bool)
        if any((raw == lead).any() for lead in (0xC2, 0xE1, 0xE2, 0xE3)):  # first bytes of white space outside ASCII
            wide = pc.match_substring_regex(texts, _WIDE_SPACE).to_numpy(zero_copy_only=False)
        if wide.any():
            whole = {int(i): x for i, x in zip(np.flatnonzero(wide), self._library(texts.filter(pa.array(wide)).to_pylist()))}
            ids, b = self._narrow(pc.if_else(pa.array(wide), pa.scalar("", pa.large_string()), texts))
            all_ = [whole.get(i, ids[b[i] : b[i + 1]]) for i in range(len(texts))]
            return np.concatenate(all_), np.concatenate([[0], np.cumsum([len(x) for x in all_])]).astype(np.int64)
        return self._narrow(texts)

    def _narrow(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        buf, off = buffer_of(texts)
        if not len(buf):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        kind = _kinds()[buf]
        space, letter, mark = kind == 1, kind == 2, kind >= 3
        cut = np.zeros(len(buf) + 1, bool)
        cut[off] = True
        cut[1:-1] |= (space[1:] & ~space[:-1]) | (letter[:-1] & mark[1:]) | ((kind[:-1] == 3) & letter[1:])
        at = np.flatnonzero(cut)
        n = len(at) - 1
        raw = pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(at.astype(np.int64).tobytes()), pa.py_buffer(buf)])
        coded = raw.dictionary_encode()
        ids, each = self._pieces(coded.dictionary, coded.indices.to_numpy(zero_copy_only=False))
        done = np.concatenate([[0], np.cumsum(each)])
        return ids, done[np.searchsorted(at, off)]


def gather(flat: np.ndarray, first: np.ndarray, lens: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``flat[first[i]:first[i] + lens[i]]`` for i in ``at``, end to end, and their lengths."""
    n = lens[at]
    base = np.cumsum(n) - n
    take = np.arange(int(n.sum())) + np.repeat(first[at] - base, n)
    return flat[take], n


def encoded(batches: Iterator[pa.RecordBatch], text: str, path: str, limit: int = 6 << 20):
    """``(batch, ids, bounds)`` for Arrow batches of bounded text size."""
    enc = Encoder(path)
    for b in steps(batches, text, limit):
        ids, bounds = enc(b.column(b.schema.get_field_index(text)))
        yield b, ids, bounds
