"""Quality classifier learned from trusted positives and unlabelled text.

The risk is the non-negative unbiased one: with the class prior p, positives P and unlabelled rows U,
p * mean_P loss(+) + max(0, mean_U loss(-) - p * mean_P loss(-)), logistic loss, a linear model over standardised features.
Where the bracket turns negative, the step goes against it, so the model cannot win by fitting positives as if they were known
not to be negative. No negative label is read. The prior is estimated from the same rows: a plain classifier of P against U
is fitted on one half, and on the other half the smallest ratio of U's share to P's share above a threshold bounds the share of
positives in U.

Features are shares of pairs of character classes, and statistics of words and lines; they don't depend on the language.
Training takes a sample of ``positives`` and ``unlabelled`` rows on average, chosen by a hash of the id; all rows are scored.

Defined cases: null text is empty text, and scored; without positives or unlabelled rows every score is 0.5; labels for
unknown documents count for nothing; a document with several labels is positive if one of them is.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.common import utf8
from shelfwise.llm.simhash import word_pieces

GROUPS = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", b".", b",;:", b"!?",
          b"#$%&*+=~^<>\\_@", b"|/", b"'\"()[]{}-`"]
CLASSES = len(GROUPS) + 2
_class = np.full(256, len(GROUPS), np.uint8)  # control characters
_class[128:] = len(GROUPS) + 1
for _i, _g in enumerate(GROUPS):
    _class[list(_g)] = _i
DIMS = CLASSES * CLASSES + CLASSES + 9


def features(data: bytes) -> np.ndarray:
    """Shares of classes and class pairs, and statistics of words and lines, of a whole text."""
    out, codes = np.zeros(DIMS), _class[np.frombuffer(data, np.uint8)]
    n = len(codes)
    if not n:
        return out
    pairs = np.zeros(CLASSES * CLASSES)
    for i in range(0, n, 1 << 20):
        piece = codes[i:i + (1 << 20) + 1].astype(np.intp)
        pairs += np.bincount(piece[:-1] * CLASSES + piece[1:], minlength=len(pairs))
    out[:len(pairs)] = np.sqrt(pairs / n)
    out[len(pairs):len(pairs) + CLASSES] = np.bincount(codes, minlength=CLASSES) / n
    words, size, square, count = Counter(), 0, 0, 0
    for piece in word_pieces(data):
        words.update(piece)
        lengths = np.array([len(w) for w in piece], float)
        size, square, count = size + lengths.sum(), square + (lengths ** 2).sum(), count + len(piece)
    lines = [x for x in data.split(b"\n") if x.strip()]
    mean = size / max(count, 1)
    out[-9:] = [np.log1p(n), np.log1p(count), mean, np.sqrt(max(0.0, square / max(count, 1) - mean ** 2)),
                len(words) / max(count, 1), max(words.values(), default=0) / max(count, 1), np.log1p(n / max(len(lines), 1)),
                1 - len(set(lines)) / max(len(lines), 1), 1.0]
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _descend(grad, dims: int, steps: int, rate: float = 0.05) -> np.ndarray:
    """Adam with a rate that falls to zero."""
    w, m, v = np.zeros(dims), np.zeros(dims), np.zeros(dims)
    for t in range(1, steps + 1):
        g = grad(w)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= rate * (1 - t / (steps + 1)) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return w


def class_prior(pos: np.ndarray, unl: np.ndarray, steps: int = 200) -> float:
    """The share of positives in ``unl``, bounded from above with a margin for small counts."""

    def grad(w):
        gp, gu = _sigmoid(pos[::2] @ w) - 1, _sigmoid(unl[::2] @ w)
        return gp @ pos[::2] / len(gp) + gu @ unl[::2] / len(gu) + 1e-3 * w

    w = _descend(grad, pos.shape[1], steps)
    p, u = np.sort(pos[1::2] @ w), np.sort(unl[1::2] @ w)
    if not len(p) or not len(u):
        return 0.5
    at = np.quantile(p, np.linspace(0, 0.9, 200))
    share_p, share_u = (1 - np.searchsorted(x, at) / len(x) for x in (p, u))
    margin = np.sqrt(1 / len(p)) + np.sqrt(1 / len(u))
    best = np.argmin((share_u + margin) / np.maximum(share_p, 1e-9))
    return float(np.clip(share_u[best] / max(share_p[best], 1e-9), 0.05, 0.99))


def fit_arrays(pos: np.ndarray, unl: np.ndarray, steps: int = 500, l2: float = 1e-4) -> dict:
    """The model from feature rows of positives and of unlabelled documents."""
    if not len(pos) or not len(unl):
        return {"w": np.zeros(DIMS), "mean": np.zeros(DIMS), "std": np.ones(DIMS), "prior": 0.5}
    mean, std = unl.mean(0), np.maximum(unl.std(0), 1e-3)
    mean[-1], std[-1] = 0, 1  # the constant feature
    pos, unl = (np.clip((x - mean) / std, -6, 6) for x in (pos, unl))
    prior = class_prior(pos, unl)

    def grad(w):
        zp, zu = pos @ w, unl @ w
        bracket = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        up = prior * (_sigmoid(zp) - 1) @ pos / len(pos)
        down = _sigmoid(zu) @ unl / len(unl) - prior * _sigmoid(zp) @ pos / len(pos)
        return (up + down if bracket >= 0 else -down) + l2 * w

    return {"w": _descend(grad, DIMS, steps), "mean": mean, "std": std, "prior": prior}


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
        positives: int = 6000, unlabelled: int = 12000) -> dict:
    """The model from ``docs``; of ``labels`` only the rows with label 1 are read."""
    known = labels.where(F.col(label) == 1).select(F.col(key).alias("key")).distinct()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    n_pos, n_all = rows.select("key").join(known, "key", "left_semi").count(), rows.count()
    u = F.shiftrightunsigned(F.xxhash64("key", F.lit(7)), 11) / F.lit(float(1 << 53))
    v = F.shiftrightunsigned(F.xxhash64("key", F.lit(8)), 11) / F.lit(float(1 << 53))
    chosen = known.where(u < positives / max(n_pos, 1))
    as_pos = rows.where(u < positives / max(n_pos, 1)).join(chosen, "key", "left_semi").select("text", F.lit(True).alias("positive"))
    as_unl = rows.where(v < unlabelled / max(n_all, 1)).select("text", F.lit(False).alias("positive"))

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = [features(b).astype(np.float32).tobytes() for b in utf8(pdf.text)]
            yield pd.DataFrame({"positive": pdf.positive, "x": x})

    found = as_pos.unionByName(as_unl).mapInPandas(vectors, "positive boolean, x binary").toPandas()
    found = found.sort_values(["positive", "x"], ignore_index=True)
    found = found.sample(frac=1, random_state=1)
    arrays = [np.frombuffer(b"".join(found.x[found.positive == p]), np.float32).reshape(-1, DIMS).astype(float) for p in (True, False)]
    return fit_arrays(*arrays)


def score_bytes(data: bytes, model: dict) -> float:
    return float(_sigmoid(np.clip((features(data) - model["mean"]) / model["std"], -6, 6) @ model["w"]))


def score(docs: DataFrame, model: dict, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability that a document is of quality."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def value(texts: pd.Series) -> pd.Series:
        return pd.Series([score_bytes(b, shared.value) for b in utf8(texts)], dtype="float64")

    return docs.withColumn(out, value(F.col(text)))
