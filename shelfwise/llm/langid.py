"""Language identification by nearest centroids of character n-grams.

A text is the TF-IDF vector of its letter n-grams (one to three code points, case folded, everything but letters taken as a
blank), hashed into ``DIMS`` cells and scaled to length one. Each language is several centroids, found by spherical k-means.
A text gets the language of the centroid with the largest cosine. It is *rejected* where its cosine distance to that centroid
is larger than nearly all distances seen in training.

Document frequencies are counted over all training rows. Clustering takes a sample of ``per_language`` rows a language on
average, chosen by a hash of the id; that is the one bound here.

Defined cases: a null text and a text without a letter are ``und`` with score 0; rows without language don't train; without any
training row every text is ``und``; equal cosines go to the language that sorts first. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F

DIMS = 8192
PIECE = 1 << 20
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        table = np.zeros(0x110000, bool)
        for m in LETTER.finditer("".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))):
            i = m.start()
            table[i if i < 0xD800 else i + 0x800] = True
        _letters.append(table)
    return _letters[0]


def ngram_counts(text: str) -> np.ndarray:
    """Counts of hashed letter n-grams. Long texts are read piece by piece; n-grams over a seam count too."""
    table, counts, tail = _letter_table(), np.zeros(DIMS), np.zeros(0, np.uint32)
    for at in range(0, len(text), PIECE):
        piece = text[at:at + PIECE].lower().encode("utf-32-le", "surrogatepass")
        new = np.frombuffer(piece, np.uint32)
        new = np.where(table[new], new, np.uint32(0))
        codes = np.concatenate([tail, new])
        gram, some = codes.copy(), codes > 0
        for n in (1, 2, 3):
            if n > 1:
                gram = gram[:-1] * np.uint32(0x01000193) + codes[n - 1:]
                some = some[:-1] | (codes[n - 1:] > 0)
            fresh = max(0, len(tail) - n + 1)  # earlier ones were counted with the last piece
            h = (gram[fresh:] + np.uint32(n)) * np.uint32(0x9E3779B1)
            h = ((h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA77)) >> np.uint32(19)
            counts += np.bincount(h[some[fresh:]], minlength=DIMS)
        tail = codes[-2:]
    return counts


def _unit(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    return v / max(np.linalg.norm(v), 1e-12)


def _frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros(DIMS, np.int64)
    for pdf in batches:
        for text in pdf.text:
            total += ngram_counts(text) > 0
    cells = np.flatnonzero(total)
    yield pd.DataFrame({"cell": cells, "n": total[cells]})


def _cluster(vectors: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from farthest-first seeds; also each centroid's radius of acceptance."""
    seeds = [vectors.mean(0)]
    while len(seeds) < min(k, len(vectors)):
        seeds.append(vectors[np.argmin(np.max(vectors @ np.array(seeds).T, axis=1))])
    centres = np.array(seeds)
    for _ in range(rounds):
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
        own = np.argmax(vectors @ centres.T, axis=1)
        centres = np.array([vectors[own == i].sum(0) if (own == i).any() else c for i, c in enumerate(centres)])
    centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    near = vectors @ centres.T
    own, distance = np.argmax(near, axis=1), 1 - near.max(1)
    every = np.quantile(distance, 0.995)
    radius = [max(every, np.quantile(distance[own == i], 0.995)) if (own == i).any() else every for i in range(len(centres))]
    return centres, np.array(radius) * 1.1


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", clusters: int = 4,
        per_language: int = 400) -> dict:
    """The model learned from all given rows with a language: ``langs``, ``centres``, ``radius``, ``idf``."""
    train = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(F.col(key)).alias("h")).where(
        "text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r.lang: r["count"] for r in train.groupBy("lang").count().collect()}
    model = {"langs": [], "centres": np.zeros((0, DIMS)), "radius": np.zeros(0), "idf": np.ones(DIMS)}
    if not sizes:
        return model
    n = sum(sizes.values())
    found = train.select("text").mapInPandas(_frequencies, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    df = np.zeros(DIMS)
    for r in found.collect():
        df[r.cell] = r.n
    idf = model["idf"] = np.log((1 + n) / (1 + df)) + 1

    share = F.create_map(*[F.lit(x) for l, m in sizes.items() for x in (l, min(1.0, per_language / m))])
    chosen = train.where((F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53))) <= share[F.col("lang")])

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            v = [_unit(ngram_counts(t), idf).astype(np.float32) for t in pdf.text]
            yield pd.DataFrame({"lang": pdf.lang, "h": pdf.h, "v": [x.tobytes() if x.any() else None for x in v]})

    def centroids(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("h")
        c, r = _cluster(np.array([np.frombuffer(b, np.float32) for b in pdf.v], float), clusters)
        return pd.DataFrame({"lang": pdf.lang.iloc[0], "v": [x.astype(np.float32).tobytes() for x in c], "r": r})

    rows = chosen.select("text", "lang", "h").mapInPandas(vectors, "lang string, h long, v binary").where(
        "v IS NOT NULL").groupBy("lang").applyInPandas(centroids, "lang string, v binary, r double").collect()
    rows.sort(key=lambda r: (r.lang, bytes(r.v)))
    model["langs"] = [r.lang for r in rows]
    model["centres"] = np.array([np.frombuffer(r.v, np.float32) for r in rows], float).reshape(-1, DIMS)
    model["radius"] = np.array([r.r for r in rows])
    return model


def predict_text(text: str | None, model: dict) -> tuple[str, float, bool]:
    """Language, score and rejection of one text. The score is a softmax over the languages' best cosines."""
    if not isinstance(text, str) or not model["langs"] or not LETTER.search(text):
        return UNKNOWN, 0.0, True
    near = model["centres"] @ _unit(ngram_counts(text), model["idf"])
    best: dict[str, int] = {}
    for i, l in enumerate(model["langs"]):
        if l not in best or near[i] > near[best[l]]:
            best[l] = i
    langs = sorted(best)
    top = np.array([near[best[l]] for l in langs])
    i = int(np.argmax(top))
    odds = np.exp((top - top[i]) / 0.05)
    return langs[i], float(1 / odds.sum()), bool(1 - top[i] > model["radius"][best[langs[i]]])


def predict(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``docs`` with a struct ``language`` (lang_pred, score, rejected), from the whole text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def language(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([predict_text(t, shared.value) for t in texts], columns=["lang_pred", "score", "rejected"])

    return docs.withColumn("language", language(F.col(text)))
