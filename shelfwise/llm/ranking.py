"""Ranked lexical search by dense blocked multiplication of item weights and document impacts.

A score is a sum over the item's terms of a whole weight times a whole impact, so a tile of documents times a tile of items is a
matrix product in float64 that BLAS does. It is exact: item tiles are cut where the weights of their vocabulary, times the largest
impact, could reach 2^53, and partial products of a longer item are added as 64-bit integers.

1. The items are cut into tiles of ``ITEMS`` with a compact vocabulary each: only words of the tile's items are columns.
2. One scan of the whole texts keeps, for each document, its number of terms and the places and counts of the vocabulary words.
   The documents and terms are counted over all rows; document frequencies are counted in each task and then summed.
3. Each task multiplies tiles of ``DOCUMENTS`` rows and keeps the ``k`` best of every item so far. A tile first finds its k-th
   best value, keeps all that reach it, and lets the smaller id win among equals, so a cut never depends on the order of rows.
4. The lists of the tasks are merged in two steps of row numbers.

Item vocabularies go to the tasks in groups of at most ``POSTINGS`` (item, term) pairs, which bounds the broadcast; more items
take more scans. An item is held whole. The document side is never collected.

Defined cases: a null or empty text has no terms, is in no list, and counts in no total; an item without terms, or whose terms no
document has, gets no rows; repeated documents rank one after the other; a null doc_id comes after all others; repeated items get
a list each; items with a null item_id too; no documents or no items give no rows; a very long text is one row, held whole while its
terms are counted; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from shelfwise.llm.common import LAST_ID, stored

K = 10
ITEMS = 64
DOCUMENTS = 1024
POSTINGS = 2_000_000
COLUMNS = 4096
#: Whole impacts are below this, as (1000000000 * tf) div (1000 * tf + 8 * m) is.
IMPACT = 1_000_000
EXACT = 1 << 53
_SPACES = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))
FOLD = bytes(_SPACES[c] + 32 if 0x41 <= c <= 0x5A else _SPACES[c] for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """Runs of digits, letters and all characters beyond ASCII, with A-Z in lower case; in UTF-8 no other byte is below 0x80."""
    return text.translate(FOLD).split() if text else []


class Tile:
    """Items with their common vocabulary: ``at`` holds the columns of a group's vocabulary, ``weights`` is (columns, items)."""

    def __init__(self, items: list[int], lists: list[np.ndarray], weight: np.ndarray):
        self.items = np.asarray(items)
        at = np.unique(np.concatenate(lists)) if lists else np.empty(0, np.int64)
        self.at = at[weight[at] > 0]
        self.parts = cuts(weight[self.at])
        table = np.zeros((len(self.at), len(items)))
        for j, words in enumerate(lists):
            words = words[weight[words] > 0]
            table[np.searchsorted(self.at, words), j] = weight[words]
        self.weights = table

    def scores(self, dense: np.ndarray) -> np.ndarray:
        """(documents, items) of ``dense`` (documents, columns), exact."""
        total = np.zeros((len(dense), len(self.items)), np.int64)
        for a, z in self.parts:
            total += (dense[:, a:z] @ self.weights[a:z]).astype(np.int64)
        return total


def cuts(weight: np.ndarray, columns: int = COLUMNS) -> list[tuple[int, int]]:
    """Runs of columns, each so short that no sum of its weights times impacts reaches 2^53."""
    out, start, total = [], 0, 0
    for i, w in enumerate(weight.tolist()):
        if i > start and (total + w) * IMPACT >= EXACT or i - start >= columns:
            out.append((start, i))
            start, total = i, 0
        total += w
    return out + [(start, len(weight))] * (len(weight) > start)


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    """floor(1000 * ln((2N + 2) / (2 df + 1))) of words that occur; 0 for others."""
    w = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df.astype(np.float64) + 1))).astype(np.int64)
    return np.where(df > 0, w, 0)


def best(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of one item, the ``k`` highest scores above 0 with their ids; equal scores by ascending id."""
    keep = np.flatnonzero(score > 0)
    if len(keep) > k:
        least = np.partition(score[keep], len(keep) - k)[len(keep) - k]
        keep = keep[score[keep] >= least]
    order = keep[np.lexsort((ids[keep], -score[keep]))][:k]
    return score[order], ids[order]


def _vocabulary(items: DataFrame, text: str) -> DataFrame:
    """``items`` (item, ...) with ``words``: the different terms of an item."""
    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"item": pdf.item, "words": [sorted(set(terms(t))) for t in pdf.text]})

    return items.select("item", F.col(text).cast("binary").alias("text")).mapInPandas(words, "item long, words array<binary>")


def _counted(docs: DataFrame, vocabulary, doc_id: str, text: str) -> DataFrame:
    """(doc_id, n, at, tf) of documents with terms: the number of all terms, the vocabulary places that occur, and how often."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = vocabulary.value
        for pdf in batches:
            rows = []
            for key, text in zip(pdf.doc_id.tolist(), pdf.text):
                found = terms(text)
                if found:
                    at, tf = np.unique(np.fromiter((p for p in map(place.get, found) if p is not None), np.int64), return_counts=True)
                    rows.append((key, len(found), at.astype("<i4").tobytes(), tf.astype("<i8").tobytes()))
            yield pd.DataFrame(rows, columns=["doc_id", "n", "at", "tf"])

    narrow = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return stored(narrow.mapInPandas(count, "doc_id long, n long, at binary, tf binary"), "impacts")[0]


def _frequencies(counted: DataFrame, size: int) -> np.ndarray:
    """Documents with each word of the vocabulary; a task sends one row per word."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df = np.zeros(size, np.int64)
        for pdf in batches:
            df += np.bincount(np.frombuffer(b"".join(pdf["at"]), "<i4"), minlength=size)
        at = np.flatnonzero(df)
        yield pd.DataFrame({"word": at, "df": df[at]})

    out = np.zeros(size, np.int64)
    # As long as the vocabulary of a group, which POSTINGS bounds.
    for r in counted.select("at").mapInPandas(count, "word long, df long").groupBy("word").agg(F.sum("df").alias("df")).collect():
        out[r.word] = r.df
    return out


def _multiplied(counted: DataFrame, shared, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc_id, score, part): the best of each task."""
    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tiles, size = shared.value
        column = np.full(size, -1)
        top: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for pdf in batches:
            for a in range(0, len(pdf), DOCUMENTS):
                part = pdf.iloc[a:a + DOCUMENTS]
                ids = part.doc_id.to_numpy()
                m = 10 + (90 * part.n.to_numpy() * n_docs) // n_terms
                at, tf = np.frombuffer(b"".join(part["at"]), "<i4"), np.frombuffer(b"".join(part.tf), "<i8")
                row = np.repeat(np.arange(len(part)), [len(x) // 4 for x in part["at"]])
                impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[row])
                for tile in tiles:
                    column[tile.at] = np.arange(len(tile.at))
                    col = column[at]
                    mine = col >= 0
                    dense = np.zeros((len(part), len(tile.at)))
                    dense[row[mine], col[mine]] = impact[mine]
                    column[tile.at] = -1
                    score = tile.scores(dense)
                    for j in np.flatnonzero(score.max(axis=0, initial=0) > 0).tolist():
                        item = int(tile.items[j])
                        s, i = score[:, j], ids
                        if item in top:
                            # Rows below the k-th score so far cannot enter; equal ones may, by their id.
                            old_s, old_i = top[item]
                            reach = s >= (old_s[-1] if len(old_s) == k else 1)
                            s, i = np.concatenate([old_s, s[reach]]), np.concatenate([old_i, i[reach]])
                        top[item] = best(s, i, k)
        for item, (s, i) in top.items():
            yield pd.DataFrame({"item": item, "doc_id": i, "score": s})

    found = counted.mapInPandas(multiply, "item long, doc_id long, score long")
    return found.withColumn("part", F.spark_partition_id() % 256)


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
           k: int = K, postings: int = POSTINGS) -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of ``items`` its ``k`` highest-scoring rows of ``docs``."""
    spark = docs.sparkSession
    held, _ = stored(items.select(F.monotonically_increasing_id().alias("item"), F.col(item_id).alias("item_id"), F.col(item_text).alias("text")), "items")
    listed, _ = stored(_vocabulary(held, "text"), "item_words")
    total = listed.agg(F.sum(F.size("words"))).first()[0] or 0
    groups = -(-total // postings)
    found = None
    for g in range(groups):
        # A group holds about ``postings`` pairs.
        lists = {r.item: r.words for r in listed.where(F.pmod(F.xxhash64("item"), F.lit(groups)) == g).where(F.size("words") > 0).collect()}
        order = sorted(lists)
        place = {bytes(w): i for i, w in enumerate(sorted({bytes(w) for ws in lists.values() for w in ws}))}
        counted = _counted(docs, spark.sparkContext.broadcast(place), doc_id, text)
        totals = counted.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        weight = weights(_frequencies(counted, len(place)), totals.docs)
        tiles = []
        for a in range(0, len(order), ITEMS):
            group = order[a:a + ITEMS]
            tiles.append(Tile(group, [np.asarray([place[bytes(w)] for w in lists[i]], np.int64) for i in group], weight))
        if totals.docs:
            part = _multiplied(counted, spark.sparkContext.broadcast((tiles, len(place))), totals.docs, totals.terms, k)
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "item long, doc_id long, score long, part int")
    for keys in (["item", "part"], ["item"]):
        line = Window.partitionBy(*keys).orderBy(F.desc("score"), "doc_id")
        found = found.withColumn("rank", F.row_number().over(line)).where(F.col("rank") <= k)
    key = F.when(F.col("doc_id") != LAST_ID, F.col("doc_id"))
    return found.join(held.select("item", "item_id"), "item").select("item_id", "rank", key.alias("doc_id"), "score")
