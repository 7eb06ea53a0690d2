"""Quality classifier from weak labels: labellers, expectation-maximisation, hashed linear scorers.

Two things make a document bad, junk and toxicity, and each has its labellers:
they look at a text, or at the ``labels`` table, and vote bad, good or nothing;
they overlap and err. Expectation-maximisation estimates how often each votes
what on bad and on good documents and gives each document a posterior label.
(Text labellers start without trust; the labels table, where it has a row, has
a prior belief of ``TRUST``, worth ``PRIOR`` documents.) These posteriors train a linear
scorer for junk and one for toxicity over hashed words, word beginnings (for
stems that inflect) and levels of the text's statistics, which score every
document; votes and labels are no inputs of a score.

The labellers run, and the model is fitted, on at most ``LABELLED`` documents
that the labels table covers and ``PLAIN`` others, chosen by a hash of their
ids; these two bounds are all that is bounded. Their votes, a few bytes a
document, go to the driver for expectation-maximisation; features are counted on
Spark, and of each document only the chosen ones, at most 2 x FEATURES bits, go
to the driver for the scorers' fits. So its memory follows from the bounds, not
from the texts.

Defined results: a null or empty text has no words and is scored by its
statistics alone; a null id takes no part in fitting and is scored; repeated
rows score alike; several labels of one id count as the worst; without any
document to fit on every score is 1; other columns are kept and never read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm._common import save, steps, strings
from lodestar.llm._text import ALNUM, NON_SPACE, U, mix, word_hash, words

LABELLED, PLAIN = 10_000, 2_000
BUCKETS = 1 << 18
BAD, GOOD, NONE = 1, 0, 2
#: Words that the insult labeller looks for.
INSULTS = "clown disgusting dumb fool garbage idiot imbecile jerk loser moron pathetic scum stupid trash worthless".split()
#: Bytes of the word beginnings that are features besides whole words.
BEGINNINGS = (4, 5)
#: Prior belief in the labels table's votes, and its weight in documents: beyond that many its accuracy is estimated as any other's.
TRUST, PRIOR = 0.995, 1_000.0
#: Features of a scorer: significance, in standard deviations, and number at most.
SIGNIFICANCE, FEATURES = 5.0, 512
#: A statistic is a feature for each of these values that it exceeds.
LEVELS = (0.0, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.5, 0.7)


def _hash_of(texts: list[str]) -> np.ndarray:
    return word_hash(words(pa.array([" ".join(texts)], pa.large_string()), ALNUM, lower=True))


def statistics(texts: pa.Array) -> np.ndarray:
    """Per text, shares in 0 to 1: words equal to the word before; punctuation of all other than white space; capitals of
    ASCII letters; words that are a bar; words of over 20 bytes; insults."""
    w = words(texts, NON_SPACE)
    plain = words(texts, ALNUM, lower=True)
    insults = np.isin(word_hash(plain), _hash_of(INSULTS))
    n = np.diff(w.first)
    doc, h = w.doc(), word_hash(w)
    k = len(n)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    size = w.end - w.start
    bar = (size == 1) & (w.buf[w.start] == 0x7C)
    b = w.buf
    upper, lower = (b >= 0x41) & (b <= 0x5A), (b >= 0x61) & (b <= 0x7A)
    mark = ((b >= 0x21) & (b <= 0x2F)) | ((b >= 0x3A) & (b <= 0x40)) | ((b >= 0x5B) & (b <= 0x60)) | ((b >= 0x7B) & (b <= 0x7E))

    def per(x):  # over the bytes of each text's words
        c = np.concatenate([[0], np.cumsum(x, dtype=np.int64)])
        return np.bincount(doc, c[w.end] - c[w.start], k)

    words_ = np.maximum(n, 1)
    caps, small = per(upper), per(lower)
    return np.stack(
        [
            np.bincount(doc, again, k) / words_,
            per(mark) / np.maximum(np.bincount(doc, size, k), 1),
            np.where(caps + small >= 20, caps / np.maximum(caps + small, 1), 0),
            np.bincount(doc, bar, k) / words_,
            np.bincount(doc, size > 20, k) / words_,
            np.bincount(plain.doc(), insults, k) / words_,
        ],
        1,
    )


def votes(stats: np.ndarray, junk: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A column per labeller of junk and of toxicity; the last is the labels table (1, 0, or -1 without a label)."""
    repeats, marks, capitals, bars, _, insults = stats.T
    plain = (repeats < 0.05) & (marks < 0.10) & (capitals < 0.3) & (bars < 0.02)
    table = [np.where(x < 0, NONE, np.where(x > 0, BAD, GOOD)) for x in (junk, toxic)]
    of_junk = [np.where(x > most, BAD, NONE) for x, most in ((repeats, 0.2), (marks, 0.15), (capitals, 0.6), (bars, 0.1))]
    return np.stack([*of_junk, np.where(plain, GOOD, NONE), table[0]], 1), np.stack([np.where(insults > 0, BAD, NONE), table[1]], 1)


def label_model(v: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation: P(bad) per document, and P(vote | class) as labeller x class (good, bad) x vote."""
    table, label = np.zeros((v.shape[1], 2, 3)), v[:, -1]
    p = np.where(label == BAD, 0.95, np.where(label == GOOD, 0.05, np.where((v[:, :-1] == BAD).any(1), 0.8, 0.2)))
    hot = np.stack([v == x for x in range(3)], 2).astype(float)
    for _ in range(rounds):
        for c, w in ((GOOD, 1 - p), (BAD, p)):
            n = np.einsum("d,dlx->lx", w, hot) + 0.5
            table[:, c] = n / n.sum(1, keepdims=True)
            # The labels table: its votes with the prior belief in them; no row says nothing.
            n = n[-1, :2] + PRIOR * np.where(np.arange(2) == c, TRUST, 1 - TRUST)
            table[-1, c] = [*(n / n.sum()), 1.0]
        prior = np.clip(p.mean(), 1e-3, 1 - 1e-3)
        log = np.einsum("dlx,lcx->dc", hot, np.log(table)) + np.log([1 - prior, prior])
        p = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -50, 50)))
    return p, table


def features(texts: pa.Array, stats: np.ndarray, only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each text's distinct words, word beginnings and levels of its statistics, and the text of each.

    ``only``: per bucket, whether it is wanted.
    """
    w = words(texts, ALNUM, lower=True)
    h, doc = [word_hash(w)], [w.doc()]
    for k in BEGINNINGS:
        long = np.flatnonzero(w.end - w.start > k)
        part = w._replace(start=w.start[long], end=w.start[long] + k)
        h.append(mix(word_hash(part), k))
        doc.append(doc[0][long])
    row, stat, level = np.nonzero(stats[:, :, None] > np.array(LEVELS))
    h = np.concatenate([*h, mix((stat * len(LEVELS) + level).astype(U), 77)])
    doc = np.concatenate([*doc, row])
    bucket = (h >> U(64 - 18)).astype(np.int64)
    if only is not None:
        wanted = only[bucket]
        bucket, doc = bucket[wanted], doc[wanted]
    key = np.unique(doc << 18 | bucket)
    return key & (BUCKETS - 1), key >> 18


class Scorer(NamedTuple):
    weights: np.ndarray
    bias: float

    def p_bad(self, feats: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(np.bincount(doc, self.weights[feats], n) + self.bias, -50, 50)))


def chosen_features(df: np.ndarray, bad: np.ndarray, n: int, mean: float) -> np.ndarray:
    """Which of the features of ``df`` documents, ``bad`` of them bad, differ significantly from the mean of all ``n``."""
    z = np.abs(bad - mean * df) / np.sqrt(np.maximum(mean * (1 - mean) * df, 1e-9)) * (df >= 4)
    order = np.argsort(-z, kind="stable")[:FEATURES]
    return np.sort(order[z[order] >= SIGNIFICANCE])


def train_scorer(x: np.ndarray, cols: np.ndarray, df: np.ndarray, target: np.ndarray, rounds: int = 30, l2: float = 0.01) -> Scorer:
    """Logistic regression by damped Newton steps on 0/1 rows ``x`` of the columns ``cols``; rare ones are held back more."""
    n, mean = len(target), float(np.clip(target.mean(), 1e-6, 1 - 1e-6))
    x = np.concatenate([x, np.ones((n, 1), x.dtype)], axis=1)
    w = np.append(np.zeros(len(cols)), np.log(mean / (1 - mean)))
    pen = np.append(l2 * n / np.maximum(df, 1), 1e-6)

    def line(u):
        return np.concatenate([x[i : i + 1024] @ u for i in range(0, n, 1024)])

    def loss(u):
        y = line(u)
        return (np.logaddexp(0, y) - target * y).sum() + 0.5 * (pen * u * u).sum()

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(line(w), -30, 30)))
        v = np.maximum(p * (1 - p), 1e-6)
        curve, slope = np.diag(pen), pen * w
        for i in range(0, n, 1024):  # in double precision, a part at a time
            part = x[i : i + 1024].astype(np.float64)
            curve = curve + (part * v[i : i + 1024, None]).T @ part
            slope = slope + part.T @ (p - target)[i : i + 1024]
        step = np.linalg.solve(curve, slope)
        size, now = 1.0, loss(w)
        while size > 1e-4 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-4:
            break
    full = np.zeros(BUCKETS)
    full[cols] = w[:-1]
    return Scorer(full, float(w[-1]))


class Fitted(NamedTuple):
    scorers: tuple[Scorer, ...]  # of junk, of toxicity
    votes: tuple[np.ndarray, ...]  # P(vote | class) of each labeller of junk, of toxicity
    documents: int


def fit(docs: DataFrame, labels: DataFrame, *, labelled: int = LABELLED, plain: int = PLAIN, id_col: str = "doc_id", text_col: str = "text") -> Fitted:
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text")).filter("id is not null")
    ids = texts.select("id").distinct()
    known = labels.select(F.col("doc_id").cast("long").alias("id"), (1 - F.col("quality")).alias("junk"), "toxic")
    known = known.filter("id is not null").groupBy("id").agg(*(F.coalesce(F.max(c), F.lit(-1)).cast("long").alias(c) for c in ("junk", "toxic")))
    with_label = ids.join(known, "id").orderBy(F.xxhash64("id")).limit(labelled)
    without = ids.orderBy(F.xxhash64(F.col("id") + 1)).limit(plain).join(known, "id", "left_anti")
    chosen = with_label.unionByName(without.withColumns({c: F.lit(-1).cast("long") for c in ("junk", "toxic")}))

    # The chosen ids, at most ``labelled + plain``, go to the tasks; one text an id stays.
    sample = texts.join(F.broadcast(chosen), "id").groupBy("id", "junk", "toxic").agg(F.min(F.struct("h", "text")).alias("t"))
    sample = save(sample.select("id", F.col("t.text").alias("text"), "junk", "toxic"), "labelled")

    def look(batches):
        for b in steps(batches, "text"):
            got = votes(statistics(strings(b.column(1))), b.column(2).to_numpy(), b.column(3).to_numpy())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([x.tobytes() for x in v.astype("u1")]) for v in got)], ["id", "junk", "toxic"])

    rows = sample.mapInArrow(look, "id long, junk binary, toxic binary").orderBy("id").collect()  # a few bytes a document
    if not rows:
        return Fitted((Scorer(np.zeros(BUCKETS), -50.0),), (), 0)
    ids_ = np.array([r["id"] for r in rows], np.int64)
    models = [label_model(np.stack([np.frombuffer(r[c], "u1") for r in rows]).astype(int)) for c in ("junk", "toxic")]
    targets, n = np.stack([p for p, _ in models]), len(rows)
    del rows

    def counts(batches):
        total = np.zeros((1 + len(targets), BUCKETS))
        for b in steps(batches, "text"):
            t = strings(b.column(1))
            f, doc = features(t, statistics(t))
            at = np.searchsorted(ids_, b.column(0).to_numpy())[doc]
            for row, w in zip(total, (None, *targets[:, at])):
                row += np.bincount(f, w, BUCKETS)
        seen = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(seen), *(pa.array(x[seen]) for x in total)], ["bucket", "df", "junk", "toxic"])

    sums = sample.mapInArrow(counts, "bucket long, df double, junk double, toxic double").groupBy("bucket").agg(*(F.sum(c).alias(c) for c in ("df", "junk", "toxic")))
    sums = sums.filter("df >= 4").toPandas().sort_values("bucket")  # BUCKETS rows at most
    bucket, df = sums["bucket"].to_numpy(), sums["df"].to_numpy()
    picks = [chosen_features(df, sums[c].round(6).to_numpy(), n, float(np.clip(t.mean(), 1e-6, 1 - 1e-6))) for c, t in zip(("junk", "toxic"), targets)]
    either = np.unique(np.concatenate(picks))
    wanted = bucket[either]
    only = np.zeros(BUCKETS, bool)
    only[wanted] = True

    def packed(batches):
        for b in steps(batches, "text"):
            t = strings(b.column(1))
            f, doc = features(t, statistics(t), only)
            x = np.zeros((b.num_rows, len(wanted)), bool)
            x[doc, np.searchsorted(wanted, f)] = True
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in np.packbits(x, axis=1)], pa.binary())], ["id", "x"])

    bits = sample.mapInArrow(packed, "id long, x binary").orderBy("id").collect()  # 2 x FEATURES bits a document at most
    x = np.unpackbits(np.stack([np.frombuffer(r["x"], np.uint8) for r in bits]), axis=1)
    scorers = []
    for pick, target in zip(picks, targets):
        part = x[:, np.searchsorted(either, pick)].astype(np.float32)
        scorers.append(train_scorer(part, bucket[pick], df[pick], target))
    return Fitted(tuple(scorers), tuple(t for _, t in models), n)


def classify(docs: DataFrame, labels: DataFrame, *, reject: float = 0.5, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with ``quality_score`` (1 less the larger of P(junk) and P(toxic)) and ``quality_kept`` (neither reaches ``reject``)."""
    fitted = fit(docs, labels, text_col=text_col, **options).scorers
    scorers = docs.sparkSession.sparkContext.broadcast([tuple(m) for m in fitted])  # plain arrays: workers need no copy of this package

    def run(batches):
        models = [Scorer(*m) for m in scorers.value]
        weighty = np.any([m.weights != 0 for m in models], axis=0)
        for b in steps(batches, text_col):
            t = strings(b.column(b.schema.get_field_index(text_col)))
            f, doc = features(t, statistics(t), weighty)
            p = np.max([m.p_bad(f, doc, b.num_rows) for m in models], axis=0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(1 - p), pa.array(p < reject)], names=[*b.schema.names, "quality_score", "quality_kept"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, quality_score double, quality_kept boolean")


def classify_digest(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    rows = docs.select("doc_id", "text")
    return classify(rows, labels, **options).select("doc_id", F.col("quality_score").alias("score"), F.col("quality_kept").alias("kept"))
