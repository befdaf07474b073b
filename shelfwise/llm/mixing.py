"""A training mix of sources with target weights, cut at each source's exact budget.

Every document gets a random key from a hash of its id. Inside each source the documents are range-sorted by key and their sizes
summed by distributed prefix sums, so the order of a source is spread over as many tasks as it needs. A budget above the size
of a source takes whole epochs of it; what is left is taken from the front of the order, and the document at the cut is taken
in part, so a source gives its budget to the word.

Targets share the total by weight, and none exceeds ``most`` times its source: t = min(most * size, x * weight), with one x for
all. x is found exactly from the sources in the order of size over weight, again by prefix sums: no loop, and no list of
sources on the driver.

Defined cases: a null or empty text has size 0 and gives 0 words; a null source is a source of its own, after all others; an
empty source text is a source; repeated rows count as often as they occur; rows of one id are ordered by size and text; a null id
has the key of the empty text; no documents give no rows; a total of 0 gives targets of 0; a very long text is one row like
any other, and is only cut where the budget ends inside it. Other columns are not read, or carried as they are if named in
``keep`` (none of them may be called like an output).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm.common import stored
from shelfwise.llm.prefix import running_sums

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST = 3


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(doc_id: Column, seed: int) -> Column:
    """60 random bits from an id."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(_none, _source, source_size, target) of the sources in ``sizes`` (_none, _source, source_size)."""
    held, _ = stored(sizes.withColumn("one", F.lit(1).cast("long")), "sources")
    ranked = running_sums(held, [], ["_none", "_source"], {"place": "one"})
    given = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    weighed, _ = stored(ranked.select("_none", "_source", "source_size", given.alias("w"), (most * F.col("source_size")).alias("cap")), "weights")
    weighed = weighed.withColumn("full_at", F.col("cap") / F.col("w"))
    whole = weighed.agg(F.struct(F.sum("source_size").alias("t"), F.sum("w").alias("w"))).scalar()
    before = running_sums(weighed, [], ["full_at", "_none", "_source"], {"caps": "cap", "ws": "w"})
    # What the other sources and this one share by weight once all sources that fill up earlier are full.
    level = before.withColumn("_t", whole).withColumn("x", (F.col("_t.t") - F.col("caps")) / (F.col("_t.w") - F.col("ws")))
    # The sources that do not fill up at their own level are those of a suffix; the first of them has the level of all.
    open_, _ = stored(level.select("_none", "_source", "source_size", "w", "cap", "full_at", "x"), "levels")
    final = open_.where("x <= full_at").agg(F.min_by("x", F.struct("full_at", "_none", "_source"))).scalar()
    target = F.least(F.col("cap").cast("double"), F.coalesce(final, F.lit(0.0)) * F.col("w"))
    return open_.select("_none", "_source", "source_size", target.alias("target"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[int] = WEIGHTS,
        most: int = MOST, seed: int = 13, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken[, keep]) of every document; ``taken`` counts repeats.

    ``target`` is that of the source. The words that a source gives are its target rounded to a whole number.
    """
    kept = [F.col(f"`{c}`") for c in keep]
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).isNull().alias("_none"), F.coalesce(F.col(source), F.lit("")).alias("_source"),
        n_words(F.col(text)).alias("size"), random_key(F.col(doc_id), seed).alias("_random"), F.xxhash64(text).alias("_text"), *kept)
    held, _ = stored(rows, "sized")
    goals, _ = stored(targets(held.groupBy("_none", "_source").agg(F.sum("size").alias("source_size")), weights, most), "targets")
    budget = F.floor(F.col("target") + 0.5).cast("long")
    lines = running_sums(held, ["_none", "_source"], ["_random", "doc_id", "size", "_text"], {"_before": "size"}, goals)
    epochs = F.when(F.col("source_size") > 0, F.expr(f"floor(target + 0.5) div source_size")).otherwise(0).cast("long")
    rest = budget - epochs * F.col("source_size") - F.col("_before")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return lines.select("doc_id", F.when(~F.col("_none"), F.col("_source")).alias("source"), "size", "source_size", "target",
                        taken.cast("long").alias("taken"), *[F.col(f"`{c}`") for c in keep])


def passages(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The texts of a mix that kept them: (doc_id, source, epoch, text, words), one row per document and epoch.

    Only the last epoch of a document can be cut short; then its words are joined by one space. Documents without words in
    the mix are left out.
    """
    epoch = F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))).alias("epoch")
    part = mixed.where("taken > 0").select("doc_id", "source", "size", "taken", F.col(text).alias("_whole"), epoch)
    words = F.least(F.col("size"), F.col("taken") - (F.col("epoch") - 1) * F.col("size"))
    cut = F.array_join(F.slice(F.regexp_extract_all("_whole", F.lit(f"({WORD})")), F.lit(1), words.cast("int")), " ")
    return part.select("doc_id", "source", "epoch", F.when(words < F.col("size"), cut).otherwise(F.col("_whole")).alias("text"), words.alias("words"))
