"""Best-fit packing of tokenised documents by a grouping genetic algorithm on islands.

A document is its token ids and an end id. Documents longer than a sequence are cut into full pieces, after a first piece that
takes what is left over. Full pieces are sequences of their own; the others are packed.

The pieces are dealt into blocks of about ``BLOCK`` by a hash. Each block is evolved on several islands: rows (block, island)
that Spark deals out, one population each. Crossover injects the well-filled bins of one parent whole into the other, drops
the bins that then hold a piece twice, and best-fits the displaced pieces again; mutation dissolves the worst bins. After each
round the best packing of an island migrates to the next island of its block by a join. The best one of all islands is taken.
The search starts from best-fit decreasing and keeps its best, so it never ends with more bins than that.

Defined cases: a null or empty text is the end id alone; repeated rows are packed as often as they occur; a null id is kept; no
rows give no rows. Special-token strings in a text get the ids that the tokenizer file gives them.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.common import stored

CAPACITY = 1024
END_ID = 2
BLOCK = 2048
ISLANDS = 2
ROUNDS = 2
POPULATION = 4
GENERATIONS = 4
PIECE = 1 << 20
CACHE = 300_000
SEAM = re.compile(r"(?<=\S)(?= \S)")
ODD_SPACE = ("  ", " \n", "\n ", "\t", "\r", "\v", "\f", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\xa0")
_encoders: dict[str, "Encoder"] = {}


def _byte_of_symbol() -> dict[str, int]:
    """The usual byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Known(dict):
    """Ids by piece of text, as bytes; forgets everything when it is full."""

    def __init__(self, prefix: str, encode):
        super().__init__()
        self.prefix, self.encode = prefix, encode

    def __missing__(self, word: str) -> bytes:
        ids = np.asarray(self.encode(self.prefix + word), "<u4").tobytes()
        if len(word) <= 64:
            if len(self) >= CACHE:
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    """Token ids of a byte-level BPE file of the ``tokenizers`` library, with word results remembered.

    A text is cut before single blanks between other characters, where no token can cross. Words of Latin text are merged by
    ``tiktoken`` over the same vocabulary; all others, and texts with special-token strings, go to the library itself.
    """

    def __init__(self, path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        special = {t.content for t in self.library.get_added_tokens_decoder().values()}
        symbols = _byte_of_symbol()
        ranks = {bytes(symbols[c] for c in s): i for s, i in self.library.get_vocab(with_added_tokens=False).items() if s not in special}
        self.special = sorted(special)
        self.fast = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.first, self.later = _Known("", self._word), _Known(" ", self._word)

    def _word(self, text: str) -> list[int]:
        latin = text.isascii() or max(text) < "ɐ" and "\x85" not in text and "\xa0" not in text
        return self.fast.encode_ordinary(text) if latin else self.library.encode(text, add_special_tokens=False).ids

    def _piece(self, text: str) -> bytes:
        try:
            text.encode("latin-1")
            odd = text.startswith(" ") or text.endswith(" ") or any(x in text for x in ODD_SPACE)
        except UnicodeEncodeError:
            odd = True
        if odd:
            words = SEAM.split(text)
            return b"".join(self.later[w[1:]] if w[:1] == " " and w[1:] else self.first[w] for w in words)
        words = text.split(" ")
        return self.first[words[0]] + b"".join(map(self.later.__getitem__, words[1:]))

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if any(s in text for s in self.special):
            return np.asarray(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        out, at = [], 0
        while len(text) - at > PIECE and (seam := SEAM.search(text, at + PIECE)):
            out.append(self._piece(text[at:seam.start()]))
            at = seam.start()
        return b"".join([*out, self._piece(text[at:])])


def encoder(path: str, pattern: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path, pattern)
    return _encoders[path]


def pieces(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
           end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document."""
    end = np.asarray([end_id], "<u4").tobytes()
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path, pattern)
        for pdf in batches:
            rows = []
            for key, value in zip(pdf.doc_id.astype("Int64"), pdf.text):
                ids = (enc.encode(value) if isinstance(value, str) and value else b"") + end
                n, at, number = len(ids) // 4, 0, 0
                while at < n:
                    to = at + ((n - at - 1) % capacity + 1)
                    part = ids[4 * at:4 * to]
                    rows.append((key, number, at, to - at, zlib.crc32(part)) + ((part,) if with_ids else ()))
                    at, number = to, number + 1
            out = pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")])
            yield out.astype({"doc_id": "Int64"})

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInPandas(cut, schema)


class Packing:
    """One solution: the bin of every piece. Bins are numbered from 0."""

    def __init__(self, bins: list[list[int]], lengths: list[int], capacity: int):
        self.bins = bins
        self.fill = [sum(map(lengths.__getitem__, b)) for b in bins]
        self.capacity = capacity

    def fitness(self) -> float:
        """Higher for fewer bins, then for fuller full ones."""
        return sum(f * f for f in self.fill) / max(1, len(self.fill)) / self.capacity ** 2


def best_fit(bins: list[list[int]], items: list[int], lengths: list[int], capacity: int) -> list[list[int]]:
    """Puts ``items`` in order into the fullest bins that take them; opens bins where none does."""
    bins = [list(b) for b in bins]
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by free space
    free = 0  # bit s is set if a bin has s free
    for n, b in enumerate(bins):
        s = capacity - sum(map(lengths.__getitem__, b))
        room[s].append(n)
        free |= 1 << s
    for item in items:
        size = lengths[item]
        fits = free >> size
        if fits:
            s = size + (fits & -fits).bit_length() - 1
            n = room[s].pop()
            if not room[s]:
                free ^= 1 << s
            bins[n].append(item)
        else:
            s, n = capacity, len(bins)
            bins.append([item])
        room[s - size].append(n)
        free |= 1 << (s - size)
    return bins


def _crossed(a: Packing, b: Packing, lengths: list[int], capacity: int, rng) -> Packing:
    """Well-filled bins of ``a`` go whole into ``b``; bins of ``b`` with a piece twice go, and what they lose is best-fitted."""
    well = [bin for bin, f in zip(a.bins, a.fill) if f >= 0.98 * capacity and rng.random() < 0.5]
    given = {i for bin in well for i in bin}
    kept = [bin for bin in b.bins if given.isdisjoint(bin)]
    homeless = sorted({i for bin in b.bins if not given.isdisjoint(bin) for i in bin} - given, key=lambda i: (-lengths[i], i))
    return Packing(best_fit(well + kept, homeless, lengths, capacity), lengths, capacity)


def _mutated(a: Packing, lengths: list[int], capacity: int, rng) -> Packing:
    """Dissolves the worst bins and some others, and best-fits their pieces."""
    order = np.argsort(a.fill, kind="stable")
    worst = max(1, len(order) // 50)
    gone = {*order[:worst].tolist(), *rng.integers(0, len(order), 2 * worst).tolist()}
    items = sorted((i for n in gone for i in a.bins[n]), key=lambda i: (-lengths[i], i))
    return Packing(best_fit([b for n, b in enumerate(a.bins) if n not in gone], items, lengths, capacity), lengths, capacity)


def evolve(lengths: list[int], seeds: list[list[list[int]]], capacity: int, seed: int, population: int = POPULATION,
           generations: int = GENERATIONS) -> list[list[int]]:
    """The best packing of one island after some generations; ``seeds`` are packings to start from."""
    rng = np.random.default_rng(seed)
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    group = [Packing(b, lengths, capacity) for b in seeds] or [Packing(best_fit([], order, lengths, capacity), lengths, capacity)]
    while len(group) < population:
        noisy = np.asarray(lengths) * rng.uniform(0.9, 1.1, len(lengths))
        group.append(Packing(best_fit([], np.argsort(-noisy, kind="stable").tolist(), lengths, capacity), lengths, capacity))
    bound = -(-sum(lengths) // capacity)
    rank = lambda p: (len(p.bins), -p.fitness())
    for _ in range(generations):
        group.sort(key=rank)
        if len(group[0].bins) == bound:
            break
        children = [_crossed(group[i], group[j], lengths, capacity, rng) for i, j in ((0, 1), (1, 0), (0, 2))]
        children.append(_mutated(group[0], lengths, capacity, rng))
        group = sorted(group + children, key=rank)[:population]
    return min(group, key=rank).bins


def _genome(bins: list[list[int]], n: int) -> bytes:
    at = np.zeros(n, np.int32)
    for k, b in enumerate(bins):
        at[b] = k
    return at.tobytes()


def _bins(genome: bytes) -> list[list[int]]:
    at = np.frombuffer(genome, np.int32)
    order = np.argsort(at, kind="stable")
    return [x.tolist() for x in np.split(order, np.flatnonzero(np.diff(at[order])) + 1)]


def pack(cut: DataFrame, capacity: int = CAPACITY, block: int = BLOCK, islands: int = ISLANDS, rounds: int = ROUNDS) -> DataFrame:
    """``cut`` (pieces with ``length``) with sequence_id and offset."""
    held, _ = stored(cut.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    full = held.where(F.col("length") >= capacity).select(*cut.columns, (2 * F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    part = held.where(F.col("length") < capacity)
    blocks = max(1, -(-part.count() // block))
    groups = part.groupBy(F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("uid", F.col("length").cast("int").alias("size")))).alias("items"))
    schema = "block int, island int, uids array<long>, sizes array<int>, own binary, n_bins int, fitness double"
    state = groups.select("block", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
                          F.col("items.uid").alias("uids"), F.col("items.size").alias("sizes"), F.lit(None).cast("binary").alias("own"),
                          F.lit(None).cast("binary").alias("migrant"))
    tasks = min(blocks * islands, 4096)

    def step(round_no: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                rows = []
                for r in pdf.itertuples(index=False):
                    sizes = [int(x) for x in r.sizes]
                    seeds = [_bins(g) for g in (r.own, r.migrant) if g is not None]
                    bins = evolve(sizes, seeds, capacity, int(r.block) * 1009 + int(r.island) * 31 + round_no)
                    fitness = Packing(bins, sizes, capacity).fitness()
                    rows.append((r.block, r.island, r.uids, r.sizes, _genome(bins, len(sizes)), len(bins), fitness))
                yield pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")])

        return run

    for round_no in range(rounds):
        done, _ = stored(state.repartition(tasks, "block", "island").mapInPandas(step(round_no), schema), "islands")
        elite = done.select("block", ((F.col("island") + 1) % islands).alias("island"), F.col("own").alias("migrant"))
        state = done.drop("n_bins", "fitness").join(elite, ["block", "island"])
    best = done.groupBy("block").agg(F.min_by(F.struct("uids", "sizes", "own"), F.struct("n_bins", -F.col("fitness"), "island")).alias("b")).select("b.*")

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for uids, sizes, own in zip(pdf.uids, pdf.sizes, pdf.own):
                bins = _bins(own)
                order = np.concatenate([np.asarray(b, int) for b in bins])
                uid, size = np.asarray(uids, np.int64)[order], np.asarray(sizes, np.int64)[order]
                starts = np.cumsum([0] + [len(b) for b in bins[:-1]])
                before = np.cumsum(size) - size
                count = [len(b) for b in bins]
                yield pd.DataFrame({"uid": uid, "sequence_id": np.repeat(2 * uid[starts] + 1, count),
                                    "offset": before - np.repeat(before[starts], count)})

    placed = best.mapInPandas(places, "uid long, sequence_id long, offset long")
    return part.join(placed, "uid").select(*cut.columns, "sequence_id", "offset").unionByName(full)
