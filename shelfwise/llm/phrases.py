"""Benchmark decontamination with a positional inverted index.

The index is a table of postings (token, row, position) in the shared scratch folder, written by the tasks that scan the texts
and sorted by token inside each file, so a read for few tokens skips most of each file. It is not shuffled. An index for a
known test set holds only that set's tokens; without one it holds all. A posting of the empty token, which no text has, keeps
the row's id and number of words.

A search never starts from a frequent word where a rarer one serves: in every window of ``width`` words of a test item the
rarest word by corpus count is an anchor. The postings of the anchors, moved back by their place in the item, give alignments
(item, row, shift). Each is intersected with the list of the next rarer word of a window that has the anchor, then with a third
one, each moved by its own place; only the few alignments left are intersected with all words of the item, in the rows
they name. Runs of agreeing words as long as a window are exact phrase matches; the other positions that agree near them
give proximity matches.

Everything is joins and aggregates of columns. A side is broadcast only if it counts at most ``SMALL`` rows; beyond that the
join shuffles.

Defined cases: a null or empty text has no words; an item with fewer words than a window, but not none, is one window; an item
without words is in no row; repeated rows are judged alike; ids may be null; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.llm.aliases import LOWER, UPPER
from shelfwise.llm.common import stored

BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WIDTH = 10
#: Tables that count fewer rows than this are broadcast; larger ones are joined by a shuffle.
SMALL = 200_000


def words(text: Column) -> Column:
    """Words of digits, letters and all characters beyond ASCII, before A-Z are lower-cased. Null has none."""
    return F.coalesce(F.array_remove(F.split(text, BETWEEN), ""), F.array().cast("array<string>"))


def folded(word: Column) -> Column:
    """A-Z in lower case, all else as it is; ``lower`` would change other alphabets too."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def small(df: DataFrame, bound: int = SMALL) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``bound`` rows, which are counted first."""
    return F.broadcast(df) if df.count() <= bound else df


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", terms: DataFrame | None = None) -> DataFrame:
    """The stored postings (token, row, pos, doc_id): of the given ``terms`` (token), or of all words.

    ``doc_id`` is set in the postings of the empty token only, whose ``pos`` is the number of words of the row.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), words(F.col(text)).alias("w"))
    rows = rows.select("row", "doc_id", F.posexplode(F.concat("w", F.array(F.lit("")))).alias("pos", "word"))  # the last is at the number of words
    posts = rows.select(folded(F.col("word")).alias("token"), "row", "pos", F.when(F.col("word") == "", F.col("doc_id")).alias("doc_id"))
    if terms is not None:
        wanted, _ = stored(terms.select("token").unionByName(docs.sparkSession.createDataFrame([("",)], "token string")).distinct(), "terms")
        posts = posts.join(small(wanted), "token")
    return stored(posts.sortWithinPartitions("token"), "postings")[0]


def item_words(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, item_id, n, p, token): every word of every row of ``items``."""
    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col(item_id).alias("item_id"), words(F.col(text)).alias("w"))
    rows = rows.select("item", "item_id", F.size("w").alias("n"), F.posexplode("w").alias("p", "token"))
    return stored(rows.withColumn("token", folded(F.col("token"))), "items")[0]


def anchor_terms(terms: DataFrame, counts: DataFrame, width: int = WIDTH, depth: int = 3) -> DataFrame:
    """(item, n, p0, t0, p1, t1, ...): the places and tokens of the rarest words of every window, each set of them once.

    Windows with a word that no text has are left out. Ties go to the first word of the window.
    """
    known = terms.join(counts, "token", "left")
    starts = F.explode(F.expr(f"sequence(greatest(0, p - {width - 1}), least(p, greatest(0, n - {width})))")).alias("s")
    inside = known.select("item", "n", "p", "token", "f", starts)
    rare = inside.groupBy("item", "n", "s").agg(
        F.sort_array(F.collect_list(F.struct("f", "p", "token"))).alias("t"), F.count("f").alias("c"))  # ``width`` words at most
    rare = rare.where("c = size(t)")
    at = lambda i: F.element_at("t", F.least(F.lit(i + 1), F.size("t")))
    cols = [x for i in range(depth) for x in (at(i).getField("p").alias(f"p{i}"), at(i).getField("token").alias(f"t{i}"))]
    return rare.select("item", "n", *cols).distinct()


def alignments(index: DataFrame, anchors: DataFrame, depth: int = 3) -> DataFrame:
    """(item, row, shift): where the ``depth`` rarest words of some window of the item agree; ``shift`` is the item's first place."""
    found = small(anchors).join(index.select(F.col("token").alias("t0"), "row", F.col("pos").alias("at")), "t0").withColumn(
        "shift", F.col("at") - F.col("p0"))
    found = found.select("item", "row", "shift", *[c for i in range(1, depth) for c in (f"p{i}", f"t{i}")])
    for i in range(1, depth):
        used = anchors.select(F.col(f"t{i}").alias("token")).distinct()
        posts = index.join(small(used), "token", "left_semi").select(F.col("token").alias(f"t{i}"), "row", F.col("pos").alias("at"))
        rest = [c for j in range(i + 1, depth) for c in (f"p{j}", f"t{j}")]
        found = found.withColumn("at", F.col("shift") + F.col(f"p{i}")).join(posts, [f"t{i}", "row", "at"], "left_semi").select(
            "item", "row", "shift", *rest).distinct()
    return found


def matches(index: DataFrame, terms: DataFrame, found: DataFrame, width: int = WIDTH) -> DataFrame:
    """(item, item_id, row, start, length, near): exact runs of at least a window's words, as maximal spans of the row.

    ``near`` counts the words of the item that agree with the row at the same shift anywhere, the proximity of the match.
    """
    wanted = found.join(terms, "item").select("item", "item_id", "n", "p", "token", "row", (F.col("shift") + F.col("p")).alias("pos"), "shift")
    posts = index.join(small(found.select("row").distinct()), "row", "left_semi").select("token", "row", "pos")
    agree = wanted.join(posts, ["token", "row", "pos"])
    line = Window.partitionBy("item", "row", "shift")
    runs = agree.withColumn("g", F.col("p") - F.row_number().over(line.orderBy("p")))
    spans = runs.groupBy("item", "item_id", "n", "row", "shift", "g").agg(F.min("pos").alias("start"), F.count(F.lit(1)).cast("int").alias("length"))
    near = spans.withColumn("near", F.sum("length").over(line))
    return near.where(F.col("length") >= F.least(F.lit(width), "n")).select("item", "item_id", "row", "start", "length", "near")


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """A report for every row of ``docs``, and the matched spans.

    The report has doc_id, n_words, n_hit (words inside a match), n_items, items_sha256 and contaminated.
    """
    terms = item_words(items, item_id, item_text)
    index = build_index(docs, doc_id, text, terms.select("token").distinct())
    counts, _ = stored(index.where("token != ''").groupBy("token").agg(F.count(F.lit(1)).alias("f")), "counts")
    anchors, _ = stored(anchor_terms(terms, counts, width), "anchors")
    found, _ = stored(alignments(index, anchors), "alignments")
    spans, _ = stored(matches(index, terms, found, width), "spans")
    before = F.max(F.col("start") + F.col("length")).over(Window.partitionBy("row").orderBy("start", "length", "item").rowsBetween(
        Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("start") + F.col("length") - F.greatest("start", F.coalesce("before", F.lit(0))))
    hits = spans.select("row", "item_id", "start", "length", before.alias("before")).groupBy("row").agg(
        F.sum(fresh).alias("n_hit"), F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("ids"))
    none = F.array().cast("array<string>")
    rows = index.where("token = ''").select("row", "doc_id", F.col("pos").cast("long").alias("n_words"))
    report = rows.join(hits, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("ids", none)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("ids", none), ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))
    return report, spans
