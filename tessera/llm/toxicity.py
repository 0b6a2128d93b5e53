"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over hashed words and word beginnings of five bytes (present or not) is
trained from confirmed toxic texts and unlabelled texts only. The risk is corrected by the
class prior: risk = prior * loss(positive as 1) + max(0, loss(unlabelled as 0) - prior *
loss(positive as 0)); where the second part would turn negative it counts as 0, which keeps
a flexible model from fitting the unlabelled positives as clean.

The prior is the share of toxic rows among the labelled training rows unless it is given.
Training reads at most about ``max_positive`` confirmed and ``max_unlabelled`` unlabelled
distinct texts, chosen by hash; scoring reads every whole text.

Defined cases: null and empty texts have no features and get the model's base score, as do
texts without known features; without any confirmed text every score is the prior, or 0.
Null ids and null labels are not learnt from. Repeated rows score alike. All input
columns are kept; the added column takes a variant of its name if the input has it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, class_table, fresh, grouped_by_bytes, hashed_words, trainable, unit_hash, written

BITS = 20
PREFIXES = (5,)
MAX_POSITIVE = 4000
MAX_UNLABELLED = 12000
MAX_FEATURES = 4096
MIN_SUPPORT = 0.005
WORD = class_table(lambda b: b >= 128 or 48 <= b <= 57 or 97 <= b <= 122)


@dataclass
class Model:
    """Weight of each hashed feature (mostly 0) and the bias."""

    weights: np.ndarray
    bias: float


def prepared(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "replace")


def present(texts: list[bytes], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text index, feature id) pairs among the features marked in ``wanted``."""
    owners, ids = [], []
    for most in (0, *PREFIXES):
        for i, words in hashed_words(texts, WORD, most):
            gram = (words >> np.uint64(64 - BITS)).astype(np.int64)
            gram = gram[wanted[gram]]
            owners.append(np.full(len(gram), i))
            ids.append(gram)
    if not owners:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    both = np.unique(np.concatenate(owners).astype(np.int64) << BITS | np.concatenate(ids))
    return both >> BITS, both & ((1 << BITS) - 1)


def _feature_counts(sample: DataFrame, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with each wanted feature, at most 2**BITS rows to the driver."""

    def count(parts):
        import pyarrow as pa

        total = np.zeros(1 << BITS, np.int64)
        for batch in parts:
            texts = [prepared(t) for t in batch.column(0).to_pylist()]
            for part in grouped_by_bytes(texts, 512):
                total += np.bincount(present(texts[part], wanted)[1], minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["f", "n"])

    got = sample.select("text").mapInArrow(count, "f long, n long").groupBy("f").agg(F.sum("n").alias("n"))
    got = got.where(F.col("n") >= 2).toPandas().sort_values("f")
    return got["f"].to_numpy(np.int64), got["n"].to_numpy(np.float64)


def _matrix(sample: DataFrame, chosen: np.ndarray) -> np.ndarray:
    """Rows x chosen features of 0/1; at most 2 bytes a feature and row to the driver."""
    wanted = np.zeros(1 << BITS, bool)
    wanted[chosen] = True

    @F.pandas_udf("binary")
    def columns(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            texts, out = [prepared(t) for t in s], []
            for part in grouped_by_bytes(texts, 512):
                owner, ids = present(texts[part], wanted)
                cut = np.searchsorted(owner, np.arange(part.stop - part.start + 1))
                at = np.searchsorted(chosen, ids).astype(np.uint16)
                out += [at[a:b].tobytes() for a, b in zip(cut, cut[1:])]
            yield pd.Series(out, dtype=object)

    rows = sorted(sample.select(columns(F.col("text")).alias("x")).toPandas()["x"])
    x = np.zeros((len(rows), len(chosen)), np.uint8)
    for i, r in enumerate(rows):
        x[i, np.frombuffer(r, np.uint16)] = 1
    return x


def fit_nnpu(xp: np.ndarray, xu: np.ndarray, prior: float, start: np.ndarray, epochs: int = 40, batches: int = 8, rate: float = 0.03, decay: float = 1e-5, seed: int = 3):
    """Linear non-negative PU risk with the logistic loss, Adam over mini-batches from the
    weights ``start``."""
    rng = np.random.default_rng(seed)
    w = np.append(start, np.log(prior / (1 - prior)))
    m, v, t = np.zeros_like(w), np.zeros_like(w), 0

    def grads(x: np.ndarray):
        """Loss as 0, gradient as 1, gradient as 0 (means over the rows)."""
        x1 = np.concatenate([x.astype(np.float32), np.ones((len(x), 1), np.float32)], axis=1)
        f = np.clip(x1 @ w, -30, 30)
        s = 1 / (1 + np.exp(-f))
        return np.logaddexp(0, f).mean(), x1.T @ (s - 1) / len(x), x1.T @ s / len(x)

    for _ in range(epochs):
        pairs = zip(np.array_split(rng.permutation(len(xp)), batches), np.array_split(rng.permutation(len(xu)), batches))
        for ip, iu in pairs:
            if not len(ip) or not len(iu):
                continue
            loss_p0, up, down_p = grads(xp[ip])
            loss_u0, _, down_u = grads(xu[iu])
            rest = down_u - prior * down_p
            g = prior * up + (rest if loss_u0 - prior * loss_p0 >= 0 else 0.0)
            g[:-1] += decay * w[:-1]
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", prior: float | None = None, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> Model:
    """Fit from ``labels`` (doc_id, toxic) on the trainable ids and from the texts alone."""
    bounded_batches(docs.sparkSession)
    known = labels.where(trainable() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n, n_toxic = known.agg(F.count("*"), F.coalesce(F.sum((F.col("toxic") == 1).cast("long")), F.lit(0))).first()
    empty = Model(np.zeros(1 << BITS, np.float32), -30.0)
    if not n_toxic:
        return empty
    prior = float(np.clip(n_toxic / n if prior is None else prior, 1e-4, 0.9))
    base = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).where(trainable())
    n_docs = base.count()
    # At most about max_positive ids: a bounded side.
    ids = known.where("toxic = 1").where(unit_hash(F.col("doc_id"), seed=21) < max_positive / n_toxic).select("doc_id")
    confirmed = written(base.join(F.broadcast(ids), "doc_id", "left_semi").dropDuplicates(["text"]), "toxic-confirmed")
    unlabelled = written(base.where(unit_hash(F.col("doc_id"), seed=22) < max_unlabelled / max(n_docs, 1)).dropDuplicates(["text"]), "toxic-unlabelled")
    n_p, n_u = confirmed.count(), unlabelled.count()
    if not n_p or not n_u:
        return empty
    ids_p, in_p = _feature_counts(confirmed, np.ones(1 << BITS, bool))
    wanted = np.zeros(1 << BITS, bool)
    wanted[ids_p] = True
    in_u = np.zeros(1 << BITS)
    ids_u, counts = _feature_counts(unlabelled, wanted)
    in_u[ids_u] = counts
    # Share of the texts with a feature that are toxic, by the prior and one standard error
    # to the careful side: kept from one half on.
    found = in_u[ids_p] + 1
    toxic_share = prior * ((in_p - np.sqrt(in_p)) / n_p) / ((found + np.sqrt(found)) / (n_u + 1))
    useful = (toxic_share >= 0.5) & (in_p >= max(3, MIN_SUPPORT * n_p))
    order = np.lexsort((ids_p, -in_p))
    chosen = np.sort(ids_p[[i for i in order if useful[i]][:MAX_FEATURES]])
    if not len(chosen):
        return Model(empty.weights, float(np.log(prior / (1 - prior))))
    share = np.clip(toxic_share[np.searchsorted(ids_p, chosen)], 0.5, 0.99)
    start = np.log(share / (1 - share)) - np.log(prior / (1 - prior))
    w, bias = fit_nnpu(_matrix(confirmed, chosen), _matrix(unlabelled, chosen), prior, start)
    weights = np.zeros(1 << BITS, np.float32)
    weights[chosen] = w
    return Model(weights, bias)


def score_texts(model: Model, texts: list[str | None]) -> np.ndarray:
    ready, out, wanted = [prepared(t) for t in texts], np.empty(len(texts)), model.weights != 0
    for part in grouped_by_bytes(ready, 512):
        owner, ids = present(ready[part], wanted)
        f = np.bincount(owner, model.weights[ids], part.stop - part.start) + model.bias
        out[part] = 1 / (1 + np.exp(-np.clip(f, -30, 30)))
    return out


def score(docs: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with one more double column, the probability of being toxic; its name."""
    name = fresh(docs.columns, "toxicity")

    @F.pandas_udf("double")
    def rate(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield pd.Series(score_texts(model, [None if t is None else t for t in s]))

    return docs.withColumn(name, rate(F.col(text))), name
