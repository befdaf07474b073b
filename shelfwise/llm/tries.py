"""The prefix trie of conversations, by van Emde Boas recursion over blocks of turns.

The depths 0, 1, 2, ... are dealt into blocks of ``LEAF``. A range of blocks is cut at half its depth: the upper trie is that of the
sequences up to the cut, and every prefix that ends at the cut is named and is the root of a lower trie. Both halves are then cut in
the same way, all ranges of one size in one job, until a range is a single block. So a sequence of n turns takes log2(n / LEAF) steps.

1. *Digests upward* (``_merged``): two neighbouring ranges of turns of one conversation give the digest of both.
2. *Names downward* (``starts``): the name of a range's first depth and the digest of its upper half give the name of the cut prefix.
   Names are pairs of 64-bit hashes; they are made row by row, so a first turn that a third of all conversations share is a hot key
   nowhere. Inside a block a name is that of the block's start and of the turns since.
3. *Nodes*: rows with equal depth and name are combined in each task, then shuffled. The smallest member of a node stands for it.
4. *Totals upward* (``grafted``): a block first sums its own part of every subtree; then, for ranges of growing size, the total of
   each prefix at the cut is grafted onto its ancestors in the upper half, which are read off the names of its smallest member.
   A node with a single member is a chain: its totals are known, and it only counts as a child.

Positions come from range-partitioned running counts, never from a window over a conversation; block lists hold ``LEAF`` turns.
Joins on a node's parent may meet a parent with very many children; Spark splits such a join. The ends of a node are hashed in the
order of their ids as a stream: sorted runs of at most ``RUN`` ids become one text each, and one task per node hashes these in turn.

Defined cases: a null role or text is empty; null turns come first; rows of one conversation with equal turns are ordered by role, then
text; repeated rows are turns of their own; rows with a null conv_id belong to no conversation and are left out; a conversation without
turns ends at the root; no rows give no nodes; a very long text is hashed where it is read and then only its length is kept; other
columns are not read. A node's ``saved`` is (members - 1) times the bytes of its last text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm.common import stored
from shelfwise.llm.prefix import running_sums

LEAF = 8
RUN = 10_000
#: Turns of a conversation that one join key covers at most.
SPREAD = 4096
HEAD = 9
NAME = ["n1", "n2"]
NODE = ["depth", *NAME]


def digest(*parts: Column) -> list[Column]:
    """Two independent 64-bit hashes."""
    return [F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)]


def positions(table: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos, t1, t2, bytes): every turn's place from 1, the digest of its role and text, and the bytes of its text."""
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    t1, t2 = digest(F.octet_length("_role"), F.col("_role"), F.col("_text"))
    rows = table.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).isNotNull().alias("_known"), F.coalesce(F.col(turn).cast("long"), F.lit(0)).alias("_turn"),
        empty(role).alias("_role"), empty(text).alias("_text"), F.lit(1).cast("long").alias("one"))
    rows = rows.withColumns({"t1": t1, "t2": t2, "bytes": F.octet_length("_text").cast("long")})
    placed = running_sums(rows, ["conv"], ["_known", "_turn", "_role", "_text"], {"before": "one"})
    return placed.select("conv", (F.col("before") + 1).alias("pos"), "t1", "t2", "bytes")


def rebuilt(turns: DataFrame, family: int = 5, share: int = HEAD) -> tuple[DataFrame, DataFrame]:
    """Conversations that open with those of the first of their family: (conv, pos, t1, t2, bytes), and (conv, length).

    Of the head conversation (conv - conv % family) come the first h = crc32(conv) % share turns, then the own turns after h.
    """
    own = turns.groupBy("conv").agg(F.max("pos").alias("n"))
    own = own.withColumns({"h": F.crc32(F.col("conv").cast("string")) % share, "base": F.col("conv") - F.col("conv") % family})
    head = turns.where((F.col("pos") < share) & (F.col("conv") % family == 0)).groupBy(F.col("conv").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "t1", "t2", "bytes"))).alias("head"))  # fewer than ``share`` turns
    convs, _ = stored(own.join(head, "base", "left").select(
        "conv", "n", "h", F.slice(F.coalesce("head", F.array().cast("array<struct<pos:long,t1:long,t2:long,bytes:long>>")), F.lit(1), F.col("h").cast("int")).alias("head")),
        "convs")
    taken = F.size("head").cast("long")
    given = convs.select("conv", F.explode("head").alias("x")).select("conv", "x.*")
    spread = convs.select("conv", "h", taken.alias("taken"), F.explode(F.sequence(F.lit(0), F.expr(f"n div {SPREAD}"))).alias("_part"))
    kept = turns.withColumn("_part", F.expr(f"pos div {SPREAD}")).join(spread, ["conv", "_part"]).where("pos > h").select(
        "conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "t1", "t2", "bytes")
    lengths = convs.select("conv", (taken + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("length"))
    return given.unionByName(kept), lengths


def _merged(level: DataFrame) -> DataFrame:
    """Digests of pairs of neighbouring full ranges."""
    odd = F.col("b") % 2 == 1
    pair = level.groupBy("conv", F.expr("b div 2").alias("b")).agg(
        *[F.max(F.when(odd if side else ~odd, F.col(c))).alias(f"{c}{side}") for side in (0, 1) for c in NAME])
    n1, n2 = digest(*[F.col(f"{c}{side}") for side in (0, 1) for c in NAME])
    return pair.where("n10 IS NOT NULL AND n11 IS NOT NULL").select("conv", "b", n1.alias("n1"), n2.alias("n2"))


def starts(blocks: DataFrame) -> tuple[DataFrame, int]:
    """(conv, b, s1, s2): the names of the prefixes at block starts, of conversations with a full block; and the levels of cuts."""
    d1, d2 = digest(F.col("turns.t1"), F.col("turns.t2"))
    full, _ = stored(blocks.where(F.size("turns") == LEAF).select("conv", "b", d1.alias("n1"), d2.alias("n2")), "digests")
    deepest = full.agg(F.max("b")).first()[0]
    depth = 0 if deepest is None else int(deepest + 1).bit_length()
    levels = [full]
    for _ in range(1, depth):
        levels.append(stored(_merged(levels[-1]), "digests")[0])
    now = full.where("b = 0").select("conv", "b", F.lit(0).cast("long").alias("s1"), F.lit(0).cast("long").alias("s2"))
    for halves in reversed(levels):
        upper = now.withColumn("b", 2 * F.col("b"))
        n1, n2 = digest(F.col("s1"), F.col("s2"), F.col("n1"), F.col("n2"))
        cut = upper.join(halves, ["conv", "b"]).select("conv", (F.col("b") + 1).alias("b"), n1.alias("s1"), n2.alias("s2"))
        now = stored(upper.unionByName(cut), "names")[0]
    return now, depth


def named(turns: DataFrame, lengths: DataFrame) -> tuple[DataFrame, int]:
    """(conv, b, names, bytes, length): the names of the depths b * LEAF, ... of a conversation, and the bytes of the turns that end there.

    A conversation has a row for every block that one of its depths is in, also for the turnless root.
    """
    blocks, _ = stored(turns.groupBy("conv", F.expr(f"(pos - 1) div {LEAF}").alias("b")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "t1", "t2", "bytes"))).alias("turns")), "blocks")  # LEAF turns at most
    begun, depth = starts(blocks)
    every = lengths.select("conv", "length", F.explode(F.sequence(F.lit(0), F.expr(f"length div {LEAF}"))).alias("b"))
    rows = every.join(blocks, ["conv", "b"], "left").join(begun, ["conv", "b"], "left")
    # The last turn of a full block ends at the next block's first depth.
    last = blocks.where(F.size("turns") == LEAF).select("conv", (F.col("b") + 1).alias("b"), F.element_at("turns", -1).getField("bytes").alias("ended"))
    rows = rows.join(last, ["conv", "b"], "left")
    start = F.struct(F.coalesce("s1", F.lit(0)).alias("n1"), F.coalesce("s2", F.lit(0)).alias("n2"))
    inner = F.slice(F.coalesce("turns", F.array().cast("array<struct<pos:long,t1:long,t2:long,bytes:long>>")), 1, LEAF - 1)
    rows = rows.select("conv", "b", "length", start.alias("start"), inner.alias("inner"), F.coalesce("ended", F.lit(0)).alias("ended"))

    def name(x: Column, i: Column) -> Column:
        so_far = F.slice("inner", F.lit(1), i + 1)
        n1, n2 = digest(F.col("start.n1"), F.col("start.n2"), so_far.getField("t1"), so_far.getField("t2"))
        return F.struct(n1.alias("n1"), n2.alias("n2"))

    names = F.concat(F.array("start"), F.transform("inner", name))
    return stored(rows.select("conv", "b", "length", names.alias("names"), F.concat(F.array("ended"), F.col("inner.bytes")).alias("bytes")), "paths")[0], depth


def members(paths: DataFrame) -> DataFrame:
    """(conv, depth, n1, n2, p1, p2, bytes, ends): a row for every prefix of every conversation, with the name of the prefix before it."""
    # The prefix before a block's first depth is the last one of the block before.
    before = paths.where(F.size("names") == LEAF).select("conv", (F.col("b") + 1).alias("b"), F.element_at("names", -1).alias("prior"))
    rows = paths.join(before, ["conv", "b"], "left")
    inside = rows.select("conv", "b", "length", "names", "bytes", "prior", F.posexplode("names").alias("i", "name"))
    depth = F.col("b") * LEAF + F.col("i")
    parent = F.when(F.col("i") == 0, F.col("prior")).otherwise(F.get("names", F.col("i") - 1))
    return inside.select("conv", depth.alias("depth"), "name.n1", "name.n2", parent.getField("n1").alias("p1"), parent.getField("n2").alias("p2"),
                         F.get("bytes", "i").alias("bytes"), (depth == F.col("length")).alias("ends"))


def grafted(shared: DataFrame, paths: DataFrame, depth: int) -> DataFrame:
    """(depth, n1, n2, leaves, saved): totals over the subtree of every node of ``shared`` (with its smallest member as ``conv``)."""
    def added(totals: DataFrame, gifts: DataFrame) -> DataFrame:
        sums = totals.select(*NODE, "leaves", "saved").unionByName(gifts.select(*NODE, "leaves", "saved")).groupBy(*NODE).agg(
            F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        return stored(sums, "totals")[0]

    at = shared.select(*NODE, "conv", F.expr(f"depth div {LEAF}").alias("b"), F.expr(f"cast(depth % {LEAF} as int)").alias("i"), "leaves", "saved")
    above = at.where("i > 0").drop(*NAME).join(paths.select("conv", "b", "names"), ["conv", "b"]).select(
        (F.col("b") * LEAF).alias("d0"), "leaves", "saved", F.posexplode(F.slice("names", F.lit(1), F.col("i"))).alias("j", "name"))
    totals = added(shared, above.select((F.col("d0") + F.col("j")).alias("depth"), "name.*", "leaves", "saved"))
    roots = shared.select(*NODE, "conv")
    for level in range(depth):
        half = 1 << level
        cut = totals.where(f"depth % {2 * half * LEAF} = {half * LEAF}").join(roots, NODE)
        b = F.expr(f"depth div {LEAF}")
        cut = cut.select("conv", "leaves", "saved", F.explode(F.sequence(b - half, b - 1)).alias("b"))
        gifts = cut.join(paths.select("conv", "b", "names"), ["conv", "b"]).select(
            (F.col("b") * LEAF).alias("d0"), "leaves", "saved", F.posexplode("names").alias("j", "name"))
        totals = added(totals, gifts.select((F.col("d0") + F.col("j")).alias("depth"), "name.*", "leaves", "saved"))
    return totals


def ends_digest(ends: DataFrame) -> DataFrame:
    """(depth, n1, n2, ends_sha256) of the nodes that conversations end at: their decimal ids in ascending order, comma-joined, hashed."""
    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys = pdf[NODE].to_numpy()
            new = [0, *((keys[1:] != keys[:-1]).any(axis=1).nonzero()[0] + 1).tolist()] if len(pdf) else []
            convs, out = pdf.conv.tolist(), []
            for a, z in zip(new, [*new[1:], len(pdf)]):
                for s in range(a, z, RUN):
                    part = convs[s:min(z, s + RUN)]
                    out.append((*keys[a].tolist(), part[0], ",".join(map(str, part))))
            yield pd.DataFrame(out, columns=[*NODE, "first", "ids"])

    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = None, None
        for pdf in batches:
            out = []
            for *now, _, ids in pdf[[*NODE, "first", "ids"]].itertuples(index=False, name=None):
                if now == key:
                    state.update(b"," + ids.encode())
                else:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = now, hashlib.sha256(ids.encode())
            yield pd.DataFrame(out, columns=[*NODE, "ends_sha256"])
        if key is not None:
            yield pd.DataFrame([(*key, state.hexdigest())], columns=[*NODE, "ends_sha256"])

    line = ends.select(*NODE, "conv").repartitionByRange(*NODE, "conv").sortWithinPartitions(*NODE, "conv")
    pieces = line.mapInPandas(runs, "depth long, n1 long, n2 long, first long, ids string")
    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInPandas(hashes, "depth long, n1 long, n2 long, ends_sha256 string")


def trie(sequences: DataFrame, lengths: DataFrame) -> DataFrame:
    """The nodes of the trie of ``sequences`` (conv, pos from 1, t1, t2, bytes); ``lengths`` (conv, length) also names those without turns.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)
    """
    paths, depth = named(sequences, lengths)
    rows = members(paths)
    nodes, _ = stored(rows.groupBy(*NODE).agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n"), F.max("bytes").alias("bytes"), F.max("p1").alias("p1"), F.max("p2").alias("p2"),
        F.count_if(F.col("ends")).alias("n_ends")), "nodes")
    up = nodes.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("n1"), F.col("p2").alias("n2"), "n")
    kids = up.groupBy(*NODE).agg(F.count(F.lit(1)).alias("children"), F.count_if(F.col("n") == 1).alias("chains"))
    full, _ = stored(nodes.join(kids, NODE, "left").withColumn("children", F.coalesce("children", F.lit(0))), "tree")
    shared = full.where("n > 1").select(
        *NODE, "conv", (F.coalesce("chains", F.lit(0)) + F.when(F.col("children") == 0, 1).otherwise(0)).alias("leaves"),
        ((F.col("n") - 1) * F.col("bytes")).alias("saved"))
    totals = grafted(shared, paths, depth)
    shas = ends_digest(rows.where("ends"))
    parents = full.where("n > 1").select((F.col("depth") + 1).alias("depth"), F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv").alias("parent"))
    out = full.join(totals, NODE, "left").join(shas, NODE, "left").join(parents, ["depth", "p1", "p2"], "left")
    # A node under a chain is of the same single conversation.
    parent = F.when(F.col("depth") > 0, F.coalesce("parent", "conv"))
    return out.select(
        F.col("conv").alias("conv_id"), "depth", parent.alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.coalesce("leaves", F.lit(1)).cast("long").alias("n_leaves"), F.coalesce("saved", F.lit(0)).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def conversation_trie(table: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The trie of the rebuilt conversations of a table."""
    turns, _ = stored(positions(table, conv, turn, role, text), "turns")
    sequences, lengths = rebuilt(turns)
    return trie(sequences, lengths)
