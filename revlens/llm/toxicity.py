"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct hashes of its words, its adjacent word
pairs and its pairs one word apart (ASCII letters lower-cased, punctuation
dropped).  Every coordinate has its own learning rate, and L1 keeps only the
coordinates that carry weight, so the model is a short list of (index,
weight) that is sent to all tasks; its size is bounded by ``2**bits``.  Rate, L1,
weight of the toxic rows and the bias are chosen on a fifth of the learning sample.

Defined results: a null or empty text has no feature and scores the bias
alone; without any usable label the score is 0; a document with several label
rows is toxic if any says so; null labels are ignored; repeated documents are
scored row by row; extra columns pass through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from . import _text as T

BITS = 20
MAX_TRAIN_DOCS = 12000
FOLDS = 5


@dataclass(frozen=True)
class Setting:
    """Learning rate, L1 and how often a toxic row counts."""
    alpha: float
    l1: float
    positive: float


SETTINGS = (Setting(4, 16, 2), Setting(4, 8, 1), Setting(2, 1, 1))


@dataclass(frozen=True)
class Model:
    """Sparse weights; ``bias`` is None when nothing could be learned."""
    index: np.ndarray
    weight: np.ndarray
    bias: float | None
    bits: int = BITS


def hashed_features(buf, off, bits: int):
    """Rows and indices of all features of a block (repeats included)."""
    starts, ends, rows = T.find_words(buf, off, T.IS_ALNUM)
    w = T.hash_words(buf, starts, ends)
    shift = np.uint64(64 - bits)
    out_r, out_i = [rows], [T.mix64(w) >> shift]
    with np.errstate(over="ignore"):
        for gap, salt in ((1, 0x51ED270B0B5B1A37), (2, 0x2545F4914F6CDD1D)):
            if len(w) > gap:
                same = rows[:-gap] == rows[gap:]
                pair = T.mix64(w[:-gap] * np.uint64(salt) + w[gap:])
                out_r.append(rows[:-gap][same])
                out_i.append(pair[same] >> shift)
    return np.concatenate(out_r), np.concatenate(out_i).astype(np.int64)


def _extract(bits):
    def run(batches):
        for batch in batches:
            for lo, buf, off in T.text_blocks(batch.column("text")):
                rows, idx = hashed_features(buf, off, bits)
                key = np.unique(rows.astype(np.int64) << bits | idx)
                n = len(off) - 1
                bounds = np.searchsorted(key, np.arange(n + 1, dtype=np.int64) << bits)
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()),
                                                 pa.array((key & ((1 << bits) - 1)).astype(np.int32)))
                part = batch.slice(lo, n)
                yield pa.RecordBatch.from_arrays([part.column("h"), part.column("toxic"), lists], ["h", "toxic", "idx"])
    return run


def ftrl(xs, ys, bits: int, setting: Setting, beta: float = 1.0, l2: float = 0.01, epochs: int = 4) -> np.ndarray:
    """Weights after ``epochs`` passes over the rows in their order; the last one is the bias, free of L1."""
    size = (1 << bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    penalty = np.full(size, setting.l1)
    penalty[-1] = 0.0

    def weights(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * penalty[i]) / ((beta + np.sqrt(n[i])) / setting.alpha + l2)
        return np.where(np.abs(zi) <= penalty[i], 0.0, w)

    for _ in range(epochs):
        for x, y in zip(xs, ys):
            i = np.append(x, size - 1)
            w = weights(i)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            if y:
                g *= setting.positive
            root = np.sqrt(n[i])
            n[i] += g * g
            z[i] += g - (np.sqrt(n[i]) - root) / setting.alpha * w
    return weights(np.arange(size))


def best_cut(margin: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
    """Largest F1 of ``margin >= cut`` and its cut: between two margins, as near to 0 as F1 allows."""
    order = np.argsort(-margin, kind="stable")
    m, t = margin[order], truth[order]
    f1 = 2 * np.cumsum(t) / (np.arange(1, len(t) + 1) + max(1, t.sum()))
    ends = np.append(m[1:] < m[:-1], True)  # equal margins are taken together
    best = f1[ends].max()
    cuts = []
    for i in np.flatnonzero(ends & (f1 >= best)):
        below = m[i + 1] if i + 1 < len(m) else m[i] - 2.0
        cuts.append(float(np.clip(0.0, 0.75 * below + 0.25 * m[i], 0.25 * below + 0.75 * m[i])))
    return float(best), min(cuts, key=abs)


def choose(xs, ys, bits: int, settings, **steps) -> tuple[Setting, float]:
    """Setting and cut with the best F1 on every ``FOLDS``-th row after learning from the others.

    Equal F1 goes to the smaller log loss, then to the setting listed first.  Where the
    fold holds one label only, the log loss decides and the cut is 0.
    """
    if len(xs) < FOLDS:
        return settings[0], 0.0
    fold = [i for i in range(len(xs)) if i % FOLDS == 0]
    rest = [i for i in range(len(xs)) if i % FOLDS]
    truth = np.array([ys[i] for i in fold]) > 0
    marks = []
    for setting in settings:
        w = ftrl([xs[i] for i in rest], [ys[i] for i in rest], bits, setting, **steps)
        margin = np.clip([w[xs[i]].sum() + w[-1] for i in fold], -35, 35)
        f1, cut = best_cut(margin, truth) if truth.any() and not truth.all() else (0.0, 0.0)
        marks.append((-f1, np.log1p(np.exp(np.where(truth, -margin, margin))).mean(), cut))
    k = min(range(len(settings)), key=lambda i: marks[i][:2])
    return settings[k], marks[k][2]


def _learn(bits, settings, steps):
    """Choose setting and cut on a fold of the bounded sample, then learn from all of it."""
    def run(batches):
        xs, ys = [], []
        for batch in batches:
            values = batch.column("idx")
            for i in range(len(values)):
                xs.append(np.asarray(values[i].values, dtype=np.int64))
                ys.append(float(batch.column("toxic")[i].as_py()))
        if xs:
            setting, cut = choose(xs, ys, bits, settings, **steps)
            w = ftrl(xs, ys, bits, setting, **steps)
            w[-1] -= cut
            keep = np.flatnonzero(w)
            keep = keep if len(keep) and keep[-1] == 1 << bits else np.append(keep, 1 << bits)
            yield pa.RecordBatch.from_arrays([pa.array(keep), pa.array(w[keep])], ["index", "weight"])
    return run


def fit(docs: DataFrame, labels: DataFrame, usable=None, max_train_docs: int = MAX_TRAIN_DOCS, bits: int = BITS,
        settings: tuple[Setting, ...] = SETTINGS, beta: float = 1.0, l2: float = 0.01, epochs: int = 4) -> Model:
    """Learn from at most ``max_train_docs`` labelled documents (smallest id hashes).

    ``usable`` is an optional condition on ``doc_id`` (held-out rows excluded).  Rate, L1 and
    the weight of the toxic rows are the entry of ``settings`` that does best on a fifth of the
    sample; the bias is moved so that the best cut there lies at a score of 0.5.
    """
    spark = docs.sparkSession
    lab = labels.select("doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    if usable is not None:
        lab = lab.where(usable)
    ids = (lab.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
           .withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(max_train_docs))
    # the id list is bounded by max_train_docs, so it may be sent to every task
    sample = (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("h", "toxic", "text")
              .mapInArrow(_extract(bits), "h long, toxic int, idx array<int>"))
    sample = sample.orderBy("h", "toxic").limit(max_train_docs)
    rows = (sample.coalesce(1).sortWithinPartitions("h", "toxic")
            .mapInArrow(_learn(bits, settings, {"beta": beta, "l2": l2, "epochs": epochs}), "index long, weight double").collect())
    bias = [w for i, w in rows if i == 1 << bits]
    kept = [(i, w) for i, w in rows if i < 1 << bits]
    return Model(np.array([k for k, _ in kept], np.int64), np.array([w for _, w in kept], float),
                 bias[0] if bias else None, bits)


def score_texts(texts: pa.Array, model: Model, dense: np.ndarray) -> np.ndarray:
    """Probability of label 1 for every text of an Arrow array."""
    out = np.zeros(len(texts))
    if model.bias is None:
        return out
    for lo, buf, off in T.text_blocks(texts):
        rows, idx = hashed_features(buf, off, model.bits)
        hit = np.flatnonzero(dense[idx])
        key = np.unique(rows[hit].astype(np.int64) << model.bits | idx[hit])
        total = np.bincount(key >> model.bits, dense[key & ((1 << model.bits) - 1)], minlength=len(off) - 1)
        out[lo:lo + len(off) - 1] = 1.0 / (1.0 + np.exp(-np.clip(total + model.bias, -35, 35)))
    return out


def _dense(model: Model) -> np.ndarray:
    w = np.zeros(1 << model.bits)
    w[model.index] = model.weight
    return w


def score(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """All columns of ``docs`` plus the score; an existing column ``out`` is replaced."""
    docs = docs.drop(out) if out in docs.columns else docs
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        dense = _dense(m)
        for batch in batches:
            s = pa.array(score_texts(batch.column("text"), m, dense))
            yield pa.RecordBatch.from_arrays([*batch.columns, s], [*batch.schema.names, out])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(out, DoubleType())]))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that score below ``threshold``, columns unchanged."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        dense = _dense(m)
        for batch in batches:
            yield batch.filter(pa.array(score_texts(batch.column("text"), m, dense) < threshold))

    return docs.mapInArrow(run, docs.schema)
