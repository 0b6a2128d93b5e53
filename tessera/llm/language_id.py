"""Language ID by error-correcting output codes.

Every language gets a codeword of +1/-1 bits, far from the others. One binary classifier
for each bit reads hashed byte n-grams; decoding takes the language whose codeword loses
least, each bit weighted by how well its classifier did on its own training rows. A small
gap between the two nearest codewords flags the text as ambiguous.

Training reads a bounded, hash-chosen sample of labelled rows (``max_rows`` in
expectation, spread evenly over languages); prediction reads every whole text.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and not
ambiguous; without any labelled row everything is ``und``; with one language every text
with a letter gets it, with score 1. Rows with a null language or id are never learnt
from. Repeated rows are predicted alike. All input columns are kept; the added columns
take a variant of their name if the input has it.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, byte_grams, fresh, grouped_by_bytes, trainable, unit_hash

UNDECIDED = "und"
BITS = 12
ORDERS = (1, 2, 3)
MAX_ROWS = 1600
MAX_LANGUAGES = 1000
AMBIGUOUS_BELOW = 0.1
RESULT = "lang string, score double, ambiguous boolean"
_LETTER = re.compile(r"[^\W\d_]")
# Everything below 128 that is not a lower-case letter counts as a space.
_SPACED = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


@dataclass
class Model:
    """Languages, their codewords (languages x bits), and one linear classifier a bit."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray


def prepared(text: str) -> bytes:
    return (" " + text.lower() + " ").encode("utf-8", "replace").translate(_SPACED)


def features(texts: list[bytes]) -> np.ndarray:
    """Unit vectors: square roots of the n-gram shares of each text."""
    dim = 1 << BITS
    counts = np.zeros(len(texts) * dim, np.float32)
    for owner, gram in byte_grams(texts, ORDERS, BITS):
        counts += np.bincount(owner * dim + gram, minlength=len(counts)).astype(np.float32)
    x = np.sqrt(counts.reshape(len(texts), dim))
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """+1/-1 matrix of ``k`` rows: the exhaustive code for few languages, else the best of
    several random codes by its smallest distance between rows."""
    if k <= 1:
        return np.zeros((k, 0), np.int8)
    if k <= 6:
        columns = [(1, *c) for c in itertools.product((1, -1), repeat=k - 1) if -1 in c]
        return np.array(columns, np.int8).T
    rng, bits, best, distance = np.random.default_rng(seed), 10 * int(np.ceil(np.log2(k))), None, -1
    for _ in range(20):
        code = rng.choice(np.array([1, -1], np.int8), (k, bits))
        gap = (bits - code.astype(np.int32) @ code.T.astype(np.int32)) // 2
        np.fill_diagonal(gap, bits)
        if gap.min() > distance and (np.abs(code.sum(0)) < k).all():
            best, distance = code, gap.min()
    if best is None:
        raise ValueError(f"no usable code for {k} languages")
    return best


def fit_bits(x: np.ndarray, y: np.ndarray, steps: int = 250, rate: float = 0.5, decay: float = 1e-5):
    """Logistic regression for all bits at once (Adam, full batch). y: rows x bits of +1/-1.
    All in single precision, as ``x`` and ``y`` are."""
    w, b = np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    back = np.ascontiguousarray(x.T)
    m, v = [np.zeros_like(w), np.zeros_like(b)], [np.zeros_like(w), np.zeros_like(b)]
    for t in range(1, steps + 1):
        pull = -y / (1 + np.exp(np.clip(y * (x @ w + b), -30, 30))) / len(x)
        for p, g, i in ((w, back @ pull + decay * w, 0), (b, pull.sum(0), 1)):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            p -= rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return w, b


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", max_rows: int = MAX_ROWS) -> Model:
    """Fit on at most about ``max_rows`` of the trainable rows with a language and a text."""
    bounded_batches(docs.sparkSession)
    rows = docs.where(trainable(doc_id) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    # One row a language; more than MAX_LANGUAGES of them is an error, not a cut.
    sizes = rows.groupBy(F.col(lang).alias("k")).agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(r["k"] for r in sizes)
    code = codewords(len(languages))
    if len(languages) < 2:
        return Model(languages, code, np.zeros((1 << BITS, 0)), np.zeros(0), np.zeros(0))
    each = max_rows / len(languages)
    share = F.create_map(*[F.lit(v) for r in sizes for v in (r["k"], float(min(1.0, each / r["n"])))])

    @F.pandas_udf("binary")
    def vector(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            texts, out = [prepared(t) for t in s], []
            for part in grouped_by_bytes(texts, 64):
                out += [row.astype(np.float16).tobytes() for row in features(texts[part])]
            yield pd.Series(out, dtype=object)

    chosen = rows.where(unit_hash(F.col(doc_id), seed=8) < share[F.col(lang)])
    got = chosen.select(F.col(lang).alias("k"), vector(F.col(text)).alias("x")).toPandas()
    got = got.sort_values(["k", "x"], kind="stable")  # the fit must not depend on row order
    x = np.stack([np.frombuffer(b, np.float16) for b in got["x"]]).astype(np.float32)
    y = code[np.searchsorted(languages, got["k"])].astype(np.float32)
    w, b = fit_bits(x, y)
    right = ((x @ w + b) * y > 0).mean(0)
    trust = np.maximum(right - 0.5, 1e-3)
    return Model(languages, code, w.astype(np.float32), b, trust / trust.sum())


def decode(model: Model, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss-weighted decoding: index of the nearest codeword, its probability, and the gap
    by which the next codeword loses more."""
    losses = np.logaddexp(0, -margins[:, None, :] * model.code[None]) @ model.trust
    best = losses.argmin(1)
    p = np.exp(-(losses - losses.min(1, keepdims=True)) * margins.shape[1])
    ranked = np.sort(losses, axis=1)
    return best, 1 / p.sum(1), ranked[:, 1] - ranked[:, 0]


def predict_texts(model: Model, texts: list[str | None]) -> pd.DataFrame:
    lang, score = np.full(len(texts), UNDECIDED, object), np.zeros(len(texts))
    unsure = np.zeros(len(texts), bool)
    known = [i for i, t in enumerate(texts) if t is not None and _LETTER.search(t)]
    if len(model.languages) == 1:
        lang[known], score[known] = model.languages[0], 1.0
    elif model.languages:
        ready = [prepared(texts[i]) for i in known]
        for part in grouped_by_bytes(ready, 256):
            best, p, gap = decode(model, features(ready[part]) @ model.weights + model.bias)
            at = known[part]
            lang[at], score[at], unsure[at] = np.array(model.languages, object)[best], p, gap < AMBIGUOUS_BELOW
    return pd.DataFrame({"lang": lang, "score": score, "ambiguous": unsure})


def predict(docs: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with one more column, a struct of lang, score and ambiguous; its name."""
    name = fresh(docs.columns, "language")

    @F.pandas_udf(RESULT)
    def guess(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in parts:
            yield predict_texts(model, [None if t is None else t for t in s])

    return docs.withColumn(name, guess(F.col(text))), name
