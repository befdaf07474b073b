"""Delimited text with line breaks inside quoted fields, read by many tasks per file.

Spark's own reader takes one task per file as soon as a field may hold a line break. Here the lines of a file are read in byte
ranges, as any text, and the records are put together again:

1. A task does not know whether its range begins inside a quoted field, so it follows its lines under both assumptions and reports
   how the range would end under each. That is one row per range.
2. These rows, in the order of the ranges, tell how each range really begins.
3. Each task cuts its lines into records. The pieces of a record that crosses the end of a range, two per range at most, are
   joined by a small shuffle.

Spark's parser then reads each record. A quote opens a field only at its start and is doubled inside, as in ``delimited.QUOTING``.
Line breaks inside fields come out as ``\\n``, as they do from Spark's reader. A record is held whole; an unclosed quote makes the
rest of its file one record. Empty files and folders give no records.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

RANGE = ["file", "start"]
#: Ranges that begin inside a field, if fewer, are broadcast; else lines are shuffled by range, which keeps their order by number.
MANY_RANGES = 500_000


def ends_inside(line: str, inside: bool, sep: str) -> bool:
    """Whether a line ends inside a quoted field, if it begins inside one or at the start of a record."""
    at = 0
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('""', at):
                at += 2
                continue
            inside = False
        elif line.startswith('"', at):
            inside, at = True, at + 1
            continue
        at = line.find(sep, at)
        if at < 0:
            return False
        at += len(sep)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _range_ends(lines: DataFrame, sep: str) -> DataFrame:
    """(file, start, out, in): whether a range ends inside a field if it begins outside or inside one."""
    def follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, ends = None, (False, True)
        for pdf in batches:
            done = []
            for file, start, value in pdf.itertuples(index=False, name=None):
                if (file, start) != key:
                    if key:
                        done.append((*key, *ends))
                    key, ends = (file, start), (False, True)
                if value is not None:
                    ends = ends_inside(value, ends[0], sep), ends_inside(value, ends[1], sep)
            yield pd.DataFrame(done, columns=[*RANGE, "out", "in"])
        if key:
            yield pd.DataFrame([(*key, *ends)], columns=[*RANGE, "out", "in"])

    # Lines without a quote change nothing; only their range matters.
    quoted = lines.select(*RANGE, F.when(F.col("value").contains('"'), F.col("value")).alias("value"))
    return quoted.mapInPandas(follow, "file string, start long, out boolean, in boolean")


def range_starts(ends: DataFrame) -> DataFrame:
    """(file, start) of the ranges that begin inside a field.

    A range that ends alike under both assumptions settles what follows it; one that ends otherwise than it begins swaps it.
    """
    line = Window.partitionBy("file").orderBy("start")  # one row per range
    swaps = F.sum(F.expr("CASE WHEN out AND NOT in THEN 1 ELSE 0 END")).over(line.rowsBetween(Window.unboundedPreceding, 0))
    rows = ends.select(*RANGE, "out", "in", swaps.alias("swaps"))
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    settled = F.last(F.when(F.col("out") == F.col("in"), F.struct("out", "swaps")), ignorenulls=True).over(before)
    so_far = F.lag("swaps", 1, 0).over(line)
    odd = (so_far - F.coalesce(settled.getField("swaps"), F.lit(0))) % 2 == 1
    return rows.withColumn("begins", F.coalesce(settled.getField("out"), F.lit(False)) != odd).where("begins").select(*RANGE)


def _records(lines: DataFrame, sep: str) -> DataFrame:
    """(file, start, kind, value) of ``lines`` with ``inside``: whole records, and the pieces of those that cross a range.

    A ``head`` ends a record of an earlier range, a ``tail`` begins one that goes on, ``through`` is a range without either.
    """
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, inside, kind, held = None, False, "whole", []
        for pdf in batches:
            out = []
            for file, start, value, begins in pdf.itertuples(index=False, name=None):
                if (file, start) != key:
                    if held:
                        out.append((*key, "tail" if kind == "whole" else "through", "\n".join(held)))
                    key, inside, held = (file, start), bool(begins), []
                    kind = "head" if inside else "whole"
                if '"' in value:
                    inside = ends_inside(value, inside, sep)
                if inside or held or kind == "head":
                    held.append(value)
                if not inside:
                    out.append((*key, kind, "\n".join(held) if held else value))
                    kind, held = "whole", []
            yield pd.DataFrame(out, columns=[*RANGE, "kind", "value"])
        if held:
            yield pd.DataFrame([(*key, "tail" if kind == "whole" else "through", "\n".join(held))], columns=[*RANGE, "kind", "value"])

    return lines.select(*RANGE, "value", "inside").mapInPandas(cut, "file string, start long, kind string, value string")


def read_records(spark: SparkSession, path: str, sep: str, header: bool = True) -> tuple[DataFrame, str]:
    """The records of a file or folder as one string column ``value``, and the first header line ('' without ``header``).

    The header of every file is left out.
    """
    lines = _lines(spark, path)
    inside = range_starts(_range_ends(lines, sep)).withColumn("inside", F.lit(True))
    if inside.count() <= MANY_RANGES:
        marked = lines.join(F.broadcast(inside), RANGE, "left")  # keeps the order of the lines
    else:
        numbered = lines.withColumn("no", F.monotonically_increasing_id()).join(inside, RANGE, "left")
        marked = numbered.repartition(*RANGE).sortWithinPartitions(*RANGE, "no")
    pieces = _records(marked.withColumn("inside", F.coalesce("inside", F.lit(False))), sep)
    parts = pieces.where("kind != 'whole'")
    begun = F.sum((F.col("kind") == "tail").cast("int")).over(Window.partitionBy("file").orderBy("start", F.col("kind") == "tail"))
    crossing = parts.withColumn("no", begun).groupBy("file", "no").agg(
        F.min("start").alias("start"), F.array_sort(F.collect_list(F.struct("start", "value"))).alias("p"))
    joined = crossing.select("file", "start", F.array_join(F.col("p.value"), "\n").alias("value"))
    records = pieces.where("kind = 'whole'").select("file", "start", "value").unionByName(joined)
    text = F.regexp_replace(F.regexp_replace("value", "\r\n", "\n"), "\r$", "")
    records = records.withColumn("value", text).where(F.trim("value") != "")
    if not header:
        return records.select("value"), ""
    # The first line of each file; a header holds no line break.
    names = lines.where("start = 0").select(F.regexp_replace("value", "\r$", "").alias("value")).first()
    first = "" if names is None else names["value"]
    return records.where((F.col("start") != 0) | (F.col("value") != first)).select("value"), first


def parse(records: DataFrame, reader) -> DataFrame:
    """The records through Spark's parser; ``reader`` carries its options and schema."""
    strings = getattr(records._jdf, "as")(records.sparkSession._jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(reader._jreader.csv(strings), records.sparkSession)
