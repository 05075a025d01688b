"""Toxicity: a factorization machine over hashed terms.

A document is its set of distinct terms: words (ASCII lower case, surrounding punctuation off).
A term's weight and factor vector are the sums of those of its hashed features (the word, its
first four and its first six bytes), so inflected and unseen forms share what their stem has
learned. The score is the logistic of

    bias + sum of term weights + mean pairwise interaction,

where the interaction of two terms is the inner product of their factor vectors; the sum over
all pairs comes from the usual identity (square of the sum minus sum of squares, halved) and is
divided by the number of terms, so that long texts do not outgrow short ones.

Fitting takes a bounded sample of the labelled rows (``sample_positive`` and ``sample_negative``
rows expected at most, chosen by a hash of the id); the bias is corrected by the class counts of
all labelled rows. Scoring is one map over the documents: no shuffle, whole texts, the model is
two arrays of fixed size.

Edge cases: null and empty texts score by the bias alone. Labels that are null, rows without a
partner, and repeated label rows are accepted (a null label is no label). With no labels of one
class, every score is the share of toxic labels (0.0 without any). Extra columns are ignored by
``fit`` and kept by ``score``; the columns that ``score`` adds replace columns of the same name.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pieces, raw_bytes, schema_with

PUNCTUATION = b".,!?;:|()[]{}\"'#$%&*-_<>/"


@dataclass(frozen=True)
class Params:
    bits: int = 18
    factors: int = 4
    epochs: int = 8
    rate: float = 0.3
    decay: float = 2e-4
    batch: int = 64
    min_support: int = 3
    sample_positive: int = 3000
    sample_negative: int = 5000
    seed: int = 11


@dataclass(frozen=True)
class Model:
    """``table``: per feature its weight and factors; a constant model has no table."""
    bias: float
    table: np.ndarray | None


def terms(text: bytes) -> list[bytes]:
    """Distinct terms in sorted order: the sum of their weights does not depend on hashing order."""
    return sorted({w.strip(PUNCTUATION) for w in text.lower().split()} - {b""})


def features(words: list[bytes], bits: int) -> np.ndarray:
    """Three feature numbers per term."""
    mask, crc = (1 << bits) - 1, zlib.crc32
    flat = [x & mask for w in words for x in (crc(w), crc(w[:4], 1), crc(w[:6], 2))]
    return np.array(flat, np.int32).reshape(-1, 3)


def logit(model: Model, rows: np.ndarray) -> float:
    if model.table is None or not len(rows):
        return model.bias
    e = model.table[rows].sum(axis=1, dtype=np.float64)
    total, v = e.sum(axis=0), e[:, 1:]
    return model.bias + total[0] + 0.5 * float((total[1:] ** 2).sum() - (v * v).sum()) / len(rows)


def learn(docs: list[np.ndarray], labels: np.ndarray, p: Params) -> Model:
    """Mini-batch Adagrad on the logistic loss; features seen in fewer than
    ``min_support`` documents stay zero."""
    size, rng = 1 << p.bits, np.random.default_rng(p.seed)
    support = np.zeros(size, np.int64)
    for d in docs:
        support[np.unique(d)] += 1
    alive = (support >= p.min_support).astype(np.float32)[:, None]
    table = np.zeros((size, 1 + p.factors), np.float32)
    table[:, 1:] = rng.normal(0, 0.02, (size, p.factors))
    table *= alive
    speed, bias, bias_speed = np.full_like(table, 1e-2), 0.0, 1e-2
    for _ in range(p.epochs):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), p.batch):
            pick = [i for i in order[at:at + p.batch] if len(docs[i])]
            if not pick:
                continue
            counts = np.array([len(docs[i]) for i in pick])
            rows = np.concatenate([docs[i] for i in pick])
            starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
            e = table[rows].sum(axis=1)
            total = np.add.reduceat(e, starts, axis=0)
            squares = np.add.reduceat(e[:, 1:] ** 2, starts, axis=0).sum(axis=1)
            z = bias + total[:, 0] + 0.5 * ((total[:, 1:] ** 2).sum(axis=1) - squares) / counts
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[pick]).astype(np.float32)
            doc = np.repeat(np.arange(len(pick)), counts)
            grad = np.empty_like(e)
            grad[:, 0] = err[doc]
            grad[:, 1:] = (err / counts)[doc, None] * (total[doc, 1:] - e[:, 1:])
            used, place = np.unique(rows, return_inverse=True)
            place = place.reshape(rows.shape)
            g = np.stack([np.bincount(place.ravel(), np.repeat(grad[:, c], 3), len(used))
                          for c in range(grad.shape[1])], axis=1).astype(np.float32)
            g = g / len(pick) + p.decay * table[used]
            speed[used] += g * g
            table[used] -= p.rate * g / np.sqrt(speed[used]) * alive[used]
            b = float(err.mean())
            bias_speed += b * b
            bias -= p.rate * b / bias_speed ** 0.5
    return Model(bias, table)


def fit(docs: DataFrame, labels: DataFrame, p: Params = Params(), doc_id: str = "doc_id", text: str = "text",
        label: str = "toxic", use: Column | None = None) -> Model:
    """Fit on labelled documents; ``use`` (a condition on the id column ``doc_id``) keeps rows out."""
    truth = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("y")) \
        .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1))
    truth = truth.where(use) if use is not None else truth
    n = {r["y"]: r["n"] for r in truth.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        share = 1.0 - 1e-6 if n.get(1) else 1e-6
        return Model(float(np.log(share / (1 - share))), None)
    unit = F.pmod(F.xxhash64("doc_id", F.lit(p.seed)), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("y") == 1, min(1.0, p.sample_positive / n[1])).otherwise(min(1.0, p.sample_negative / n[0]))
    chosen = truth.where(unit < share)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id")  # bounded sample

    def encode(batches):
        for b in pieces(batches, 500):
            yield pa.record_batch([pa.array([features(terms(x), p.bits).tobytes() for x in raw_bytes(b["text"])]),
                                   b["y"], b["doc_id"]], names=["rows", "y", "doc_id"])

    got = rows.mapInArrow(encode, "rows binary, y int, doc_id " + dict(rows.dtypes)["doc_id"]).toPandas()
    got = got.sort_values(["doc_id", "y", "rows"], kind="stable")
    docs_ = [np.frombuffer(x, np.int32).reshape(-1, 3) for x in got["rows"]]
    y = got["y"].to_numpy(np.float32)
    if len(set(y)) < 2:
        return Model(float(np.log(n[1] / n[0])), None)
    model = learn(docs_, y, p)
    shift = np.log(n[1] / n[0]) - np.log(y.sum() / (len(y) - y.sum()))
    return Model(model.bias + float(shift), model.table)


def score(docs: DataFrame, model: Model, p: Params = Params(), text: str = "text",
          threshold: float = 0.5) -> DataFrame:
    """``docs`` plus score (0 to 1) and predicted (1 if score >= ``threshold``)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("score", "predicted")

    def run(batches):
        m = shared.value
        for b in pieces(batches, 500):
            z = np.array([logit(m, features(terms(x), p.bits)) for x in raw_bytes(b[text])], np.float64)
            s = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.record_batch([*b.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                  names=[*b.schema.names, "score", "predicted"])

    return kept.mapInArrow(run, schema_with(kept, score="double", predicted="int"))
