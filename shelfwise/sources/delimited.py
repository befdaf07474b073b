"""Delimited text: typed, inferred and raw-line readers, and the typed export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shelfwise.functions.parsing import is_valid_text, strip
from shelfwise.sources.records import parse, read_records

SEP = ";"
# Quotes are doubled inside quoted fields.
QUOTING = {"sep": SEP, "header": "true", "quote": '"', "escape": '"'}


def _plain(spark: SparkSession):
    return spark.read.options(**QUOTING, multiLine="false")


def _quoted(spark: SparkSession):
    # The records come without their header line.
    return spark.read.options(**{**QUOTING, "header": "false"})


def read_typed(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = True) -> DataFrame:
    """A missing path raises an error.

    Fields may hold line breaks; ``multi_line=False`` saves the look for them where data is known to have none. Either way a
    file is read by as many tasks as it has byte ranges.
    """
    if not multi_line:
        return _plain(spark).schema(schema).csv(path)
    return parse(read_records(spark, path, SEP)[0], _quoted(spark).schema(schema))


def read_inferred(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Column types from the data, rows that do not fit filled with nulls."""
    infer = {"inferSchema": "true", "mode": "PERMISSIVE"}
    if not multi_line:
        return _plain(spark).options(**infer).csv(path)
    records, header = read_records(spark, path, SEP)
    names = _plain(spark).options(header="true").csv(spark.sparkContext.parallelize([header])).columns
    return parse(records, _quoted(spark).options(**infer)).toDF(*names)


def read_columns(spark: SparkSession, path: str, schema: T.StructType | str, cols: Sequence[str], multi_line: bool = True) -> DataFrame:
    """Only the named columns."""
    return read_typed(spark, path, schema, multi_line).select(*cols)


def read_lines(spark: SparkSession, path: str, sep: str = SEP) -> tuple[DataFrame, list[str]]:
    """S3: token lists of the raw lines; every line equal to the header is dropped."""
    lines = spark.read.text(path)
    header = lines.first()["value"]
    pattern = "[" + sep + "]"
    return lines.where(F.col("value") != header).select(F.split("value", pattern).alias("tokens")), header.split(sep)


def token_at(header: Sequence[str], col: str) -> Column:
    """The token of a column; lines that are too short give ''."""
    return F.coalesce(strip(F.get(F.col("tokens"), F.lit(header.index(col)))), F.lit(""))


def line_counts(tokens: DataFrame, header: Sequence[str], name_col: str) -> DataFrame:
    """Lines with the right number of tokens, the others, and distinct names among the former."""
    ok = F.size("tokens") == len(header)
    name = token_at(header, name_col)
    return tokens.agg(
        F.count_if(ok).alias("total"), F.count_if(~ok).alias("invalid"),
        F.count_distinct(F.when(ok & is_valid_text(name), name)).alias("names"),
    )


def parsed_counts(df: DataFrame, key: str, name_col: str) -> DataFrame:
    """P10: rows whose key was parsed, the others, and distinct names among the former."""
    ok = F.col(key).isNotNull()
    name = strip(F.col(name_col))
    return df.agg(
        F.count_if(ok).alias("total"), F.count_if(~ok).alias("invalid"),
        F.count_distinct(F.when(ok & is_valid_text(name), name)).alias("names"),
    )


def integrity_audit(spark: SparkSession, path: str, schema: T.StructType | str, key: str, name_col: str, multi_line: bool = True) -> DataFrame:
    """Both readings of one file side by side, whether they agree, and the rows between them."""
    tokens, header = read_lines(spark, path)
    a = line_counts(tokens, header, name_col).select(F.struct("*").alias("l")).scalar()
    b = parsed_counts(read_typed(spark, path, schema, multi_line), key, name_col)
    return b.select(a.alias("l"), F.struct("*").alias("p")).select(
        F.col("l.total").alias("lines_total"), F.col("l.names").alias("lines_names"),
        F.col("l.invalid").alias("lines_invalid"), F.col("p.total").alias("parsed_total"),
        F.col("p.names").alias("parsed_names"), F.col("p.invalid").alias("parsed_invalid"),
        ((F.col("l.total") == F.col("p.total")) & (F.col("l.names") == F.col("p.names"))).alias("agree"),
        (F.col("p.total") - F.col("l.total")).alias("row_difference"),
    )


def typed_for_export(df: DataFrame) -> DataFrame:
    """Nulls become 0, 0.0 or '' by column type."""
    fill = lambda f: "" if isinstance(f.dataType, T.StringType) else 0
    return df.select(*[
        F.coalesce(F.col(f"`{f.name}`"), F.lit(fill(f)).cast(f.dataType)).alias(f.name) for f in df.schema.fields
    ])


def write_csv(df: DataFrame, folder: str, name: str, suffix: str = "", order: Sequence[str] = ()) -> str:
    """One table as a folder of CSV parts; ``order`` sorts the whole table over its parts."""
    path = f"{folder}/{name}{suffix}.csv"
    out = typed_for_export(df)
    if order:
        out = out.orderBy(*order)
    out.write.mode("overwrite").options(
        **QUOTING, ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path)
    return path


def export_tables(folder: str, meta: DataFrame, tags: DataFrame, text: DataFrame, panel: DataFrame,
                  suffix: str = "") -> dict[str, str]:
    return {
        "games_metadata": write_csv(meta, folder, "games_metadata", suffix),
        "games_tags": write_csv(tags, folder, "games_tags", suffix),
        "games_text": write_csv(text, folder, "games_text", suffix),
        "games_timeseries": write_csv(panel, folder, "games_timeseries", suffix, ["appid", "month"]),
    }
