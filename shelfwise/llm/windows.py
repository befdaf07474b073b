"""Removal of repeated word windows, with a count-min prefilter.

Pass one hashes every window of ``width`` words of every text into a count-min sketch (`sketch`). Pass two groups exactly, by a
128-bit digest of the words themselves, the windows whose estimate is two or more; windows that occur once and collide in the
sketch drop out there, and none that repeats can be missing. A word is removed if a window that covers it also starts earlier:
in a document with a smaller id, or earlier in the same document.

A task of pass two settles repeats inside its own part at once and sends on only its first start of each window, so a window
that a third of all documents share reaches the exact grouping once for each task. Different texts of one id, null among them, that
start a window at the same place are all sent: which of them goes is known only when the first start of all tasks is.

Words are separated by ASCII white space; case and characters stay as they are. Defined cases: null and empty texts have no
words; a text shorter than a window keeps all; repeated rows of one document start at the same place, so they don't remove each
other; a null id comes last; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm import sketch
from shelfwise.llm.common import LAST_ID, mixed, stored, utf8
from shelfwise.llm.simhash import word_pieces

WIDTH = 20
BASE = np.uint64(0x5851F42D4C957F2D)
#: Its inverse modulo 2^64, so that sums of powers can be moved.
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
PIECE = 1 << 20
HELD = 1 << 18
#: Bytes of text for a window; sizes the sketch, not the result.
BYTES = 6
#: Bits of the key filter for each row with repeats, and of one of its parts; bits in all, at most.
KEY_BITS, PART_BITS, MAX_KEY_BITS = 8, 1 << 15, 1 << 30
_powers: dict[int, np.ndarray] = {}
_blank = np.zeros(256, bool)
_blank[list(b" \t\n\v\f\r")] = True


def _power(base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        known = _powers[int(base)] = np.cumprod(steps, dtype=np.uint64)
    return known[:n]


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash for every word of the UTF-8 bytes, read in pieces that end at white space."""
    out = []
    for at, end in _spans(data):
        b = np.frombuffer(data, np.uint8, end - at, at)
        word = np.concatenate([[False], ~_blank[b], [False]])
        edges = np.flatnonzero(word[1:] != word[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.concatenate([[np.uint64(0)], np.cumsum((b.astype(np.uint64) + np.uint64(1)) * _power(BASE, len(b)), dtype=np.uint64)])
        out.append(mixed((sums[ends] - sums[starts]) * _power(INVERSE, len(b) + 1)[starts]))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _spans(data: bytes) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        while end < len(data) and not _blank[data[end]]:
            end += 1
        yield at, end
        at = end


def window_hashes(data: bytes, width: int) -> np.ndarray:
    """A 64-bit hash for every window of ``width`` words."""
    words = word_hashes(data)
    if len(words) < width:
        return np.zeros(0, np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(words * _power(BASE, len(words)), dtype=np.uint64)])
    n = len(words) - width + 1
    return mixed((sums[width:] - sums[:-width]) * _power(INVERSE, n))


def word_list(data: bytes) -> list[bytes]:
    return [w for piece in word_pieces(data) for w in piece]


def first_starts(d: np.ndarray, doc: np.ndarray, pos: np.ndarray, tag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the first starts of each digest (two columns of ``d``), and a mask of all that start later.

    Rows of one id may start a window at the same place; each different text of them (``tag``) is a first start.
    """
    order = np.lexsort((tag, pos, doc, d[:, 1], d[:, 0]))
    same = np.append(False, (d[order[1:]] == d[order[:-1]]).all(1))
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    late = (doc[order] != doc[order[head]]) | (pos[order] != pos[order[head]])
    again = same & np.append(False, tag[order[1:]] == tag[order[:-1]])
    later = np.zeros(len(order), bool)
    later[order] = late
    return order[~late & ~again], later


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of consecutive values in a sorted array."""
    if not len(values):
        return values, values
    cut = np.flatnonzero(np.append(True, np.diff(values) > 1))
    return values[cut], np.diff(np.append(cut, len(values)))


FOUND = "doc long, tag long, pos int, size int, d1 long, d2 int"
SPANS = "doc long, tag long, pos int, size int"


def _merged(doc: np.ndarray, tag: np.ndarray, pos: np.ndarray) -> pd.DataFrame:
    """Places as spans of consecutive ones."""
    order = np.lexsort((pos, tag, doc))
    doc, tag, pos = doc[order], tag[order], pos[order]
    same = np.append(False, (np.diff(doc) == 0) & (np.diff(tag) == 0) & (np.diff(pos) <= 1))
    cut = np.flatnonzero(~same[:len(doc)])
    size = pos[np.append(cut[1:], len(doc)) - 1] - pos[cut] + 1 if len(doc) else pos
    return pd.DataFrame({"doc": doc[cut], "tag": tag[cut], "pos": pos[cut].astype(np.int32), "size": size.astype(np.int32)})


def settle_part(rows: list) -> pd.DataFrame:
    """Candidates of a task as (doc, tag, pos, digest): repeats inside it as spans, and its first starts, with size 0."""
    doc, tag, pos, digest = (np.concatenate(x) for x in zip(*rows))
    first, later = first_starts(digest, doc, pos, tag)
    spans = _merged(doc[later], tag[later], pos[later]).assign(d2=np.int32(0))
    spans["d1"] = spans.tag  # only deals them out
    sent = pd.DataFrame({"doc": doc[first], "tag": tag[first], "pos": pos[first].astype(np.int32), "size": np.int32(0),
                         "d1": digest[first, 0], "d2": digest[first, 1].astype(np.int32)})
    return pd.concat([spans, sent])[["doc", "tag", "pos", "size", "d1", "d2"]]


def settle_all(found: DataFrame) -> DataFrame:
    """The spans of all parts: those settled before, and the starts that are not the first of their digest anywhere."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        head = None  # digest, doc and pos of the group that may go on
        for pdf in batches:
            yield pdf.loc[pdf["size"] > 0, ["doc", "tag", "pos", "size"]]
            pdf = pdf[pdf["size"] == 0]
            if not len(pdf):
                continue
            cols = np.stack([pdf[c].to_numpy(np.int64) for c in ("d1", "d2", "doc", "pos")], axis=1)
            tag = pdf.tag.to_numpy()
            if head is not None:
                cols, tag = np.concatenate([head, cols]), np.append(0, tag)
            same = np.append(False, (cols[1:, :2] == cols[:-1, :2]).all(1))
            first = np.maximum.accumulate(np.where(same, 0, np.arange(len(cols))))
            late = (cols[:, 2:] != cols[first][:, 2:]).any(1)
            yield _merged(cols[late, 2], tag[late], cols[late, 3])
            head = cols[first[-1]][None]

    return found.repartition("d1").sortWithinPartitions("d1", "d2", "doc", "pos").mapInPandas(run, SPANS)


def repeated_windows(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc, tag, spans): for every row of ``docs`` (doc, tag, text) with some, the runs of windows that start earlier elsewhere."""
    size = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    maps = sketch.build(docs.select("text"), lambda pdf: (window_hashes(b, width) for b in utf8(pdf.text)), sketch.bits_for(size // BYTES))
    shared = docs.sparkSession.sparkContext.broadcast(maps)

    def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, held = [], 0
        for pdf in batches:
            for doc, tag, data in zip(pdf.doc, pdf.tag, utf8(pdf.text)):
                pos = np.flatnonzero(sketch.maybe_repeated(window_hashes(data, width), shared.value))
                if not len(pos):
                    continue
                text = b" ".join(words := word_list(data))
                ends = np.cumsum([len(w) + 1 for w in words]) - 1
                starts = np.append(0, ends[:-1] + 1)
                digest = b"".join(hashlib.blake2b(text[s:e], digest_size=12).digest() + b"\0\0\0\0" for s, e in zip(
                    starts[pos].tolist(), ends[pos + width - 1].tolist()))
                rows.append((np.full(len(pos), doc), np.full(len(pos), tag), pos, np.frombuffer(digest, np.int64).reshape(-1, 2)))
                held += len(pos)
                if held >= HELD:
                    yield settle_part(rows)
                    rows, held = [], 0
        if held:
            yield settle_part(rows)

    return gathered(settle_all(docs.mapInPandas(candidates, FOUND)))


def gathered(spans: DataFrame) -> DataFrame:
    """(doc, tag, spans): the spans of each row, at most one for each of its places."""
    return spans.groupBy("doc", "tag").agg(F.collect_list(F.struct("pos", "size")).alias("spans"))


def covered(spans, n: int, width: int) -> np.ndarray:
    """A mask of the ``n`` places that windows of ``width`` starting in the given runs cover."""
    step = np.zeros(n + 1, np.int64)
    if spans is not None and len(spans):
        pos, size = (np.array([s[k] for s in spans], np.int64) for k in ("pos", "size"))
        np.add.at(step, pos, 1)
        np.add.at(step, np.minimum(pos + size - 1 + width, n), -1)
    return np.cumsum(step[:-1]) > 0


def remove_repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): every row with the words that stay, joined by single blanks."""
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                      F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)).alias("doc"), F.xxhash64(text).alias("tag"))
    spans, _ = stored(repeated_windows(own.select("doc", "tag", "text"), width), "spans")

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for key, value, data in zip(pdf.doc_id.astype("Int64"), pdf.spans, utf8(pdf.text)):
                words = word_list(data)
                gone = covered(value, len(words), width)
                left = [w for w, g in zip(words, gone) if not g] if gone.any() else words
                rows.append((key, len(words), len(words) - len(left), b" ".join(left).decode("utf-8", "surrogatepass")))
            yield pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept"]).astype({"doc_id": "Int64"})

    # Texts of rows that lose nothing are not shuffled.
    bits = min(MAX_KEY_BITS, max(PART_BITS, 1 << (KEY_BITS * spans.count()).bit_length()))
    part, place = _place(bits)
    may = spans.groupBy(part.alias("_part")).agg(F.bitmap_construct_agg(place).alias("_bits"))
    may, _ = stored(may, "keys")  # bits / 8 bytes
    marked = own.join(F.broadcast(may), F.col("_part") == part, "left").withColumn("_may", F.coalesce(_bit(F.col("_bits"), place), F.lit(False)))
    whole = marked.where("NOT _may").select("doc_id", "text", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))
    cut = marked.where("_may").select("doc_id", "text", "doc", "tag").join(spans, ["doc", "tag"], "left").select("doc_id", "text", "spans")
    return whole.unionByName(cut).mapInPandas(keep, "doc_id long, n_words long, n_removed long, kept string")


def _place(bits: int) -> tuple[Column, Column]:
    """Part and bit of a row's key in a filter of ``bits``, a power of two. Keys may share a bit."""
    at = F.xxhash64("doc", "tag").bitwiseAND(F.lit(bits - 1))
    return F.floor(at / PART_BITS).cast("int"), (at % PART_BITS).cast("long")


def _bit(bitmap: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (place % 8 + 1).cast("int"))) > 0
