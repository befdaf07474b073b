"""SimHash near-duplicates by segments with one wildcard bit.

Two 64-bit fingerprints that differ in at most three bits are cut into two segments of 32 bits; one of the segments then
differs in at most one bit (d bits need d // 2 + 1 segments). So each fingerprint is indexed under all segments, once for each
bit left out, and an equality join on (segment, bit left out, rest) meets every such pair. Candidates are verified on all 64 bits.

Only different fingerprints are joined: copies are one class. Inside a bucket the verified links are reduced to a spanning
forest before they leave the task, so what is written grows with the members and not with the pairs. A bucket of more than
``BUCKET`` fingerprints is cut into blocks, and each pair of blocks is a group of its own; nothing is left out.

Defined cases: a null text or one without words has fingerprint zero, linked like any other; a text of fewer words than a
shingle is one shingle; repeated rows get the same class; the smallest id of a class is null only if all its ids are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm import similar
from shelfwise.llm.common import LAST_ID, stored, utf8
from shelfwise.llm.components import components
from shelfwise.llm.phrases import small

BUCKET = 8192
PIECE = 1 << 21
SHINGLES = 1 << 15


def word_pieces(data: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text, in lists for pieces of about ``size`` bytes; a piece ends at white space."""
    at = 0
    while len(data) - at > size:
        end = at + size
        while end < len(data) and data[end] not in b" \t\n\v\f\r":
            end += 1
        yield data[at:end].split()
        at = end
    yield data[at:].split() if at else data.split()


def shingle_hashes(data: bytes, width: int) -> Iterator[np.ndarray]:
    """64-bit hashes of the shingles of ``width`` words, in pieces. Fewer words are one shingle; no words give nothing."""
    n, tail = 0, []
    for words in word_pieces(data.lower()):  # bytes.lower() changes A-Z only
        words = tail + words
        text = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1 if words else np.zeros(0, int)
        starts = np.concatenate([[0], ends[:-1] + 1]) if words else ends
        spans = list(zip(starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist()))
        for i in range(0, len(spans), SHINGLES):
            yield np.array([xxhash.xxh64_intdigest(text[s:e], 42) for s, e in spans[i:i + SHINGLES]], np.uint64)
        n += len(spans)
        tail = words[-(width - 1):] if width > 1 else []
    if not n and tail:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(tail), 42)], np.uint64)


def fingerprint(data: bytes, width: int = 3) -> int:
    """The 64-bit SimHash of UTF-8 bytes, as a signed integer."""
    ones, n = np.zeros(64, np.int64), 0
    for h in shingle_hashes(data, width):
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n += len(h)
    bits = np.packbits(2 * ones > n, bitorder="little") if n else np.zeros(8, np.uint8)
    return int(bits.view(np.int64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", width: int = 3, out: str = "fp") -> DataFrame:
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(x, width) for x in utf8(texts)], dtype="int64")

    return docs.withColumn(out, fp(F.col(text)))


def _forest(f: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between positions of ``f`` as (fingerprint, smallest linked fingerprint), one row for each linked one."""
    names, at = np.unique(np.concatenate([f[i], f[j]]), return_inverse=True)
    a, b, label = at[:len(i)], at[len(i):], np.arange(len(names))
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            break
        label = new
    on = label != np.arange(len(names))
    return names[on], names[label[on]]


def _bucket_links(key: np.ndarray, f: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of all pairs of one bucket that differ in at most ``most`` bits. Rows are sorted by key."""
    found, held, lag, first = [], 0, 1, np.arange(len(f))
    u = f.view(np.uint64)
    while len(first):
        first = first[first + lag < len(f)]
        first = first[key[first] == key[first + lag]]
        near = first[np.bitwise_count(u[first] ^ u[first + lag]) <= most]
        if len(near):
            found.append((near, near + lag))
            held += len(near)
        if held > 1 << 20:
            i, j = (np.concatenate(x) for x in zip(*found))
            a, b = _forest(f, i, j)
            where = {v: n for n, v in enumerate(f.tolist())}
            found = [(np.array([where[x] for x in a.tolist()], int), np.array([where[x] for x in b.tolist()], int))]
            held = len(a)
        lag += 1
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return _forest(f, *(np.concatenate(x) for x in zip(*found)))


def _links(most: int, limit: int | None):
    """Sorted (key, fp) rows to links; the members of a bucket above ``limit`` come out as (fp, null, key) instead."""

    def found(key: np.ndarray, f: np.ndarray) -> Iterator[pd.DataFrame]:
        if limit:
            size = np.diff(np.append(starts := np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key)))
            large = np.repeat(size > limit, size)
            if large.any():
                yield pd.DataFrame({"a": f[large], "b": pd.array([None] * int(large.sum()), "Int64"), "key": key[large]})
                key, f = key[~large], f[~large]
        a, b = _bucket_links(key, f, most)
        if len(a):
            yield pd.DataFrame({"a": a, "b": b, "key": pd.array([None] * len(a), "Int64")})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list = []
        for pdf in batches:
            held.append((pdf.key.to_numpy(), pdf.fp.to_numpy()))
            if held[0][0][-1] == held[-1][0][-1] and held[0][0][0] == held[-1][0][-1]:
                continue  # one bucket still
            key, f = (np.concatenate(x) for x in zip(*held))
            cut = np.searchsorted(key, key[-1])
            yield from found(key[:cut], f[:cut])
            held = [(key[cut:], f[cut:])]
        if held:
            yield from found(*(np.concatenate(x) for x in zip(*held)))

    return run


def links(fps: DataFrame, most: int = 3, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links that join all fingerprints (column ``fp``, distinct) differing in at most ``most`` bits.

    There are ``most`` // 2 + 1 segments. The fewer bits a segment has, the more chance meetings there are to verify.
    """
    parts = most // 2 + 1
    keys = []
    for bit in range(64):
        low, high = next((64 * i // parts, 64 * (i + 1) // parts) for i in range(parts) if bit < 64 * (i + 1) // parts)
        mask = (1 << high) - (1 << low) & ~(1 << bit)
        rest = F.shiftrightunsigned(F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)), low)
        # The key is the bit and the rest of its segment, or a hash of them where they don't fit; links are verified anyway.
        keys.append(rest + (bit << 32) if high - low <= 32 else F.xxhash64(rest, F.lit(bit)))
    keys = fps.select(F.explode(F.array(*keys)).alias("key"), "fp")
    schema = "a long, b long, key long"
    first, _ = stored(keys.repartition("key").sortWithinPartitions("key", "fp").mapInPandas(_links(most, bucket), schema), "links")
    out = first.where("b IS NOT NULL").select("a", "b")
    large = first.where("b IS NULL").select("key", F.col("a").alias("fp"))
    sizes = large.groupBy("key").agg(F.ceil(F.count(F.lit(1)) * 2 / bucket).cast("int").alias("blocks"))
    i, j = F.pmod(F.xxhash64("fp"), F.col("blocks")), F.explode(F.expr("sequence(0, blocks - 1)")).alias("j")
    cells = large.join(sizes, "key").select("key", "fp", i.alias("i"), j).select(
        F.xxhash64("key", F.least("i", "j"), F.greatest("i", "j")).alias("key"), "fp")
    more = cells.repartition("key").sortWithinPartitions("key", "fp").mapInPandas(_links(most, None), schema)
    return out.unionByName(more.select("a", "b")).distinct()


def _named(marked: DataFrame, most: int) -> DataFrame:
    """(fp, root, component_id) of every fingerprint in ``marked`` (doc_id, fp); ``root`` names the class."""
    fps = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(fps, most))
    named = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return stored(named.join(least, "root").select("fp", "root", "component_id"), "classes")[0]


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = 3, width: int = 3) -> DataFrame:
    """(doc_id, fp, component_id): the class of every row, named by the smallest id that links lead to."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    marked, _ = stored(with_fingerprint(own, width=width).select("doc_id", "fp"), "fingerprints")
    return marked.join(_named(marked, most), "fp").select("doc_id", "fp", "component_id")


def _verified(keys: DataFrame, own: DataFrame, least: float, shingle: int) -> DataFrame:
    """``keys`` (doc_id, _tag, root, ...) with ``root`` from links that are verified on the texts inside the classes given."""
    keys, _ = stored(keys, "candidates")
    texts = keys.groupBy("root", "_tag").agg(F.min("doc_id").alias("doc_id"))
    several = texts.groupBy("root").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("root")
    members, _ = stored(texts.join(several, "root", "left_semi"), "members")
    one = own.join(small(members), ["doc_id", "_tag"]).select("root", "_tag", "text").dropDuplicates(["root", "_tag"])
    roots = similar.classes(one, least, shingle).select(F.col("node").alias("_tag"), "root")
    return keys.drop("root").join(roots, "_tag", "left").withColumn("root", F.coalesce("root", "_tag"))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = 3, width: int = 3, least: float | None = None,
               shingle: int = 5) -> DataFrame:
    """One row of each class, with all columns: the smallest id, then the smallest hash of the text; one of equal rows.

    With ``least`` the classes of the fingerprints are candidates only: inside them two texts are linked if the Jaccard similarity
    of their sets of shingles of ``shingle`` words is ``least`` or more (`similar`).

    Only ids and hashes are compared; the rows are then sifted by a join against those that go.
    """
    key = {"_doc": F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)), "_tag": F.coalesce(F.xxhash64(text), F.lit(0))}
    own = docs.select(key["_doc"].alias("doc_id"), key["_tag"].alias("_tag"), F.col(text).alias("text"))
    marked, _ = stored(with_fingerprint(own, width=width).select("doc_id", "_tag", "fp"), "fingerprints")
    keys = marked.groupBy("doc_id", "_tag", "fp").agg(F.count(F.lit(1)).alias("n")).join(_named(marked, most), "fp")
    if least is not None:
        keys = _verified(keys, own, least, shingle)
    best = keys.groupBy("root").agg(F.min(F.struct("doc_id", "_tag")).alias("b"))
    judged, _ = stored(keys.join(best, "root").select(F.col("doc_id").alias("_doc"), "_tag", (
        (F.col("doc_id") == F.col("b.doc_id")) & (F.col("_tag") == F.col("b._tag"))).alias("first"), "n"), "judged")
    rows, on = docs.withColumns(key), ["_doc", "_tag"]
    once = rows.join(judged.where("NOT first OR n > 1").select(on), on, "left_anti")
    more = rows.join(judged.where("first AND n > 1").select(on), on, "left_semi").dropDuplicates(on)
    return once.unionByName(more).select(docs.columns)
