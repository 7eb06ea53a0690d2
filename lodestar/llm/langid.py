"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, everything but letters becomes one space, and runs of 1
to 3 characters (a space at either end of a word included) are hashed into
``buckets``. Counts per language and bucket are summed by Spark over all
training documents; the log-probability matrix (languages x buckets, a fixed
size per language) goes to every task, which scores batches in NumPy.

Defined results: a null text or one without a letter is ``und`` with score 0,
as is every text if no language was learned; ties go to the language that sorts
first; a null id is never held out; repeated rows count as often as they occur;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm._common import steps, strings, train_fold
from lodestar.llm._text import U, buffer_of, mix

BUCKETS = 1 << 16
SIZES = (1, 2, 3)
UNKNOWN = "und"


def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(texts: pa.Array, letters: np.ndarray, buckets: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Per size, ``(bucket, text index)`` of every n-gram, text after text; and whether each text has a letter."""
    buf, off = buffer_of(strings(pc.utf8_lower(strings(texts))))
    raw = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
    seen = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])[off]
    doc = np.repeat(np.arange(len(off) - 1), np.diff(seen))
    ok = letters[raw] if len(raw) else np.zeros(0, bool)
    has = np.bincount(doc[ok], minlength=len(off) - 1) > 0
    # A space before each word, and one after each text's last.
    before = ok.copy()
    before[1:] &= ~ok[:-1] | (doc[1:] != doc[:-1])
    at = np.flatnonzero(ok)
    n = 1 + before[at]
    last = np.ones(len(at), bool)
    last[:-1] = doc[at][1:] != doc[at][:-1]
    end = np.cumsum(n + last)
    chars, owner = np.full(int(end[-1]) if len(at) else 0, 0x20, U), np.repeat(doc[at], n + last)
    chars[end - 1 - last] = raw[at]
    out = []
    for k in SIZES:
        if len(chars) < k:
            continue
        h = np.full(len(chars) - k + 1, k, U)
        for j in range(k):
            h = h << U(21) | chars[j : j + len(h)]
        same = owner[: len(h)] == owner[k - 1 :]
        if k == 1:
            same &= chars != 0x20
        out.append(((mix(h[same]) >> U(40)).astype(np.int64) & (buckets - 1), owner[: len(h)][same]))
    return out, has


def train(docs: DataFrame, *, buckets: int = BUCKETS, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages, and log10 P(bucket | language) with the log10 prior in a last column."""
    docs = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("text is not null and lang is not null")

    def count(batches):
        letters, langs, total, rows = _letters(), {}, np.zeros((0, buckets), np.int64), np.zeros(0, np.int64)
        for b in steps(batches, "text"):
            code = np.array([langs.setdefault(x, len(langs)) for x in b.column(1).to_pylist()], np.int64)
            new = len(langs) - len(rows)
            total, rows = np.pad(total, ((0, new), (0, 0))), np.pad(rows, (0, new))
            rows += np.bincount(code, minlength=len(langs))
            for g, doc in grams(b.column(0), letters, buckets)[0]:
                total += np.bincount(code[doc] * buckets + g, minlength=total.size).reshape(total.shape)
        for x, c in langs.items():
            k = np.flatnonzero(total[c])
            yield pa.RecordBatch.from_pydict({"lang": pa.array([x] * (len(k) + 1)), "bucket": pa.array(np.append(k, buckets), pa.int32()), "n": pa.array(np.append(total[c][k], rows[c]), pa.int64())})

    summed = docs.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(summed["lang"].unique())
    n = np.zeros((len(langs), buckets + 1))
    n[np.searchsorted(langs, summed["lang"].to_numpy(str)) if langs else [], summed["bucket"].to_numpy(int)] = summed["n"].to_numpy()
    p = np.empty_like(n)
    p[:, :buckets] = np.log((n[:, :buckets] + 0.5) / (n[:, :buckets].sum(1, keepdims=True) + 0.5 * buckets))
    p[:, buckets] = np.log(n[:, buckets] / max(n[:, buckets].sum(), 1))
    return langs, p


def predict(docs: DataFrame, langs: list[str], logp: np.ndarray, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (posterior probability of the predicted language)."""
    buckets = logp.shape[1] - 1
    model = docs.sparkSession.sparkContext.broadcast(logp)  # fixed size per language

    def run(batches):
        letters, m = _letters(), model.value
        for b in steps(batches, text_col):
            found, has = grams(b.column(b.schema.get_field_index(text_col)), letters, buckets)
            s = np.tile(m[:, buckets], (b.num_rows, 1))
            for g, doc in found:
                first = np.flatnonzero(np.diff(doc, prepend=-1))
                for k in range(len(langs)):
                    s[doc[first], k] += np.add.reduceat(m[k][g], first)
            known = has & bool(langs)
            best = s.argmax(1) if langs else np.zeros(b.num_rows, int)
            top = 1 / np.exp(s - s.max(1, keepdims=True)).sum(1) if langs else np.zeros(b.num_rows)
            name = pa.array([langs[i] if k else UNKNOWN for i, k in zip(best, known)], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, name, pa.array(np.where(known, top, 0.0))], names=[*b.schema.names, "lang_pred", "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, lang_pred string, score double")


def identify(docs: DataFrame, *, folds: int = 4, held: int = 2, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """Learn from the documents outside the held-out fold; per document: doc_id, held_out, lang_pred, score."""
    langs, logp = train(docs.filter(~train_fold(docs, folds, held, id_col)), text_col=text_col, lang_col=lang_col, **options)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), train_fold(docs, folds, held, id_col).alias("held_out"), F.col(text_col).alias("text"))
    return predict(rows, langs, logp).select("doc_id", "held_out", "lang_pred", "score")
