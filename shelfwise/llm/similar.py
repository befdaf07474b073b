"""Verified similarity inside candidate classes: links between texts whose sets of word shingles agree enough.

Two texts of one candidate class are linked if the Jaccard similarity of their whole shingle sets is at least a bound; the new
classes are the connected components of these links. Only what joins classes matters, so pairs that links join already are
not compared.

A class of at most ``BLOCK`` texts is one group of one task. A larger one is dealt at random to blocks, twice, which joins most of
its texts. What is not in its largest part after that meets all its texts, block by block, so no pair of two parts is left out.

Defined cases: a text of fewer words than a shingle is one shingle; texts without words, null among them, have one empty shingle
and equal each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm import simhash
from shelfwise.llm.common import stored, utf8
from shelfwise.llm.components import components

BLOCK = 128
#: Shingles of a block of long texts.
WEIGHT = 1 << 18


def shingle_set(data: bytes, width: int = 5) -> np.ndarray:
    """The distinct hashes of the shingles, sorted."""
    return np.unique(np.concatenate([*simhash.shingle_hashes(data, width)] or [np.zeros(1, np.uint64)]))


def joined(sets: list[np.ndarray], label: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Links between positions that join all sets of a similarity of ``least`` or more; equal labels are joined already."""
    size, label, links = np.array([len(s) for s in sets]), np.unique(label, return_inverse=True)[1], []
    start = np.cumsum(size) - size
    code = np.unique(np.concatenate(sets), return_inverse=True)[1]
    mine = np.zeros(int(code.max()) + 1, bool)
    for i in range(len(sets) - 1):
        other = label[i + 1:] != label[i]
        other &= np.minimum(size[i], size[i + 1:]) >= least * np.maximum(size[i], size[i + 1:]) - 1e-9
        if not other.any():
            continue
        own = code[start[i]:start[i] + size[i]]
        mine[own] = True
        both = np.add.reduceat(mine[code[start[i + 1]:]], start[i + 1:] - start[i + 1], dtype=np.int64)
        mine[own] = False
        for j in (i + 1 + np.flatnonzero(other & (both >= least * (size[i] + size[i + 1:] - both) - 1e-9))).tolist():
            if label[j] != label[i]:
                links.append((i, j))
                label[label == label[j]] = label[i]
    return links


def _links(groups: DataFrame, least: float) -> DataFrame:
    """(a, b): links inside the groups of (key, first, _tag, label, grams); those with ``first`` meet all, at the least."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def close() -> Iterator[pd.DataFrame]:
            if len(group) > 1:
                found = joined([np.frombuffer(r[3], np.uint64) for r in group], np.array([r[2] for r in group], np.int64), least)
                yield pd.DataFrame([(group[i][1], group[j][1]) for i, j in found], columns=["a", "b"]).astype("int64")

        group, last = [], None
        for pdf in batches:
            for r in zip(pdf.key.tolist(), pdf["_tag"].tolist(), pdf.label.tolist(), pdf.grams.tolist()):
                if r[0] != last:
                    yield from close()
                    group, last = [], r[0]
                group.append(r)
        yield from close()

    dealt = groups.repartition("key").sortWithinPartitions("key", F.desc("first"), "_tag")
    return dealt.select("key", "_tag", "label", "grams").mapInPandas(run, "a long, b long")


def _blocks(block: int, n: str, weight: str) -> Column:
    return F.ceil(F.greatest(F.col(n) / block, F.col(weight) / WEIGHT)).cast("int")


def _block(seed: int, blocks: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), "_tag"), F.col(blocks))


def classes(texts: DataFrame, least: float, width: int = 5, block: int = BLOCK) -> DataFrame:
    """(node, root) for ``texts`` (root, _tag, text): the tags that links join to a smaller one, and the smallest of their class."""

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sets = [shingle_set(x, width) for x in utf8(pdf.text)]
            yield pd.DataFrame({"root": pdf.root, "_tag": pdf["_tag"], "n": [len(s) for s in sets], "grams": [s.tobytes() for s in sets]})

    schema = "root long, _tag long, n long, grams binary"
    sets, _ = stored(texts.select("root", "_tag", "text").mapInPandas(grams, schema), "shingles")
    sizes = sets.groupBy("root").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("w")).select("root", _blocks(block, "k", "w").alias("blocks"))
    large, _ = stored(sizes.where("blocks > 1"), "large")
    cut = sets.join(large, "root", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    alone = {"first": F.lit(False), "label": F.col("_tag")}
    found, _ = stored(_links(cut.withColumns(alone | {"key": F.xxhash64("root", _block(1, "blocks"))}), least), "verified")
    if large.isEmpty():
        return components(found)
    cut = sets.join(large, "root")
    again, _ = stored(_links(cut.withColumns(alone | {"key": F.xxhash64("root", _block(2, "blocks"))}), least), "verified")
    found = found.unionByName(again)
    parts = cut.join(components(found).select(F.col("node").alias("_tag"), F.col("root").alias("label")), "_tag", "left")
    parts, _ = stored(parts.withColumn("label", F.coalesce("label", "_tag")), "parts")
    main = parts.groupBy("root", "label").agg(F.count(F.lit(1)).alias("k")).groupBy("root").agg(F.max(F.struct("k", "label")).alias("m"))
    rest, _ = stored(parts.join(main.select("root", F.col("m.label").alias("label")), ["root", "label"], "left_anti"), "rest")
    ahead = rest.groupBy("root").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("w")).select("root", _blocks(block, "k", "w").alias("ahead"))
    ahead, _ = stored(ahead, "ahead")
    at = lambda i, j: F.xxhash64("root", i, j)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias("each")
    cols = ["_tag", "label", "grams"]
    one = rest.join(ahead, "root").select("root", "ahead", *cols, each("blocks")).select(
        at(_block(1, "ahead"), F.col("each").cast("long")).alias("key"), F.lit(True).alias("first"), *cols)
    all_ = parts.join(ahead, "root").select("root", "blocks", *cols, each("ahead")).select(
        at(F.col("each").cast("long"), _block(1, "blocks")).alias("key"), F.lit(False).alias("first"), *cols)
    return components(found.unionByName(_links(one.unionByName(all_), least)))
