"""Column profiling: nulls, domains, near-constant tests, dictionary, defaults."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from shelfwise import vocab
from shelfwise.functions.rounding import round_to
from shelfwise.operators.filters import role_of, stage_of
from shelfwise.operators.groups import top_k_per_key
from shelfwise.operators.ordered import column_medians, medians


#: Columns profiled by one aggregate: Spark compiles aggregates of at most 100 fields, wider ones are interpreted row by row.
PROFILED = 16


def _q(c: str):
    return F.col(f"`{c}`")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls and blank strings of every column in one pass; only columns that have some."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(df.columns):
        aggs.append(F.count_if(_q(c).isNull()).alias(f"u{i}"))
        aggs.append((F.count_if(F.trim(_q(c)) == "") if c in text else F.lit(0)).cast("bigint").alias(f"b{i}"))
    parts = ", ".join(f"'{c}', u{i}, b{i}" for i, c in enumerate(df.columns))
    rows = df.agg(*aggs).selectExpr("_n", f"stack({len(df.columns)}, {parts}) AS (column, nulls, blanks)")
    pct = lambda c: round_to(F.try_divide(F.col(c) * 100, F.col("_n")), 1)
    return rows.where("nulls > 0 OR blanks > 0").select(
        "column", "nulls", "blanks", pct("nulls").alias("pct_nulls"), pct("blanks").alias("pct_blanks")
    )


def _long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[_q(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column", "value")


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows per (column, value) for many columns in one shuffle; null is a value."""
    return _long(df, cols).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def domains(df: DataFrame, cols: Sequence[str], k: int = 10) -> DataFrame:
    """Most frequent values of each column; a column that is absent is reported as such."""
    present = [c for c in cols if c in df.columns]
    top = top_k_per_key(value_counts(df, present), ["column"], [F.desc("n"), F.asc_nulls_first("value")], k)
    out = top.select("column", "value", "n", F.lit(True).alias("present"))
    missing = [c for c in cols if c not in present]
    if not missing:
        return out
    gone = df.sparkSession.createDataFrame([(c,) for c in missing], "column string")
    gone = gone.withColumns({"n": F.lit(0).cast("bigint"), "present": F.lit(False)})
    return out.unionByName(gone, allowMissingColumns=True)


def top_shares(df: DataFrame, cols: Sequence[str], skip_nulls: bool = False) -> DataFrame:
    """Share of the most frequent value, exact wherever it exceeds one half.

    A value on more than half of the rows is also the median, so a first pass
    of sketches names one candidate per column and a second pass counts it.
    Neither pass shuffles rows. Values that a double cannot hold go through a
    52-bit hash; the second pass counts the values with the candidate's hash,
    which are checked to be a single one. Where no value reaches one half, the
    share given is below it. ``df`` is read twice for every ``PROFILED`` columns,
    those only, so a long plan is best stored first.
    """
    if len(cols) > PROFILED:
        parts = [top_shares(df, cols[a:a + PROFILED], skip_nulls) for a in range(0, len(cols), PROFILED)]
        return reduce(DataFrame.unionByName, parts)
    types = {f.name: f.dataType for f in df.schema.fields}
    exact = (T.ByteType, T.ShortType, T.IntegerType, T.FloatType, T.DoubleType)

    def ordinal(c):
        if isinstance(types[c], exact):
            return _q(c)
        return F.when(_q(c).isNotNull(), F.shiftrightunsigned(F.xxhash64(_q(c).cast("string")), 12))

    cand = df.agg(*[F.percentile_approx(ordinal(c), 0.5, 1_000).alias(f"c{i}") for i, c in enumerate(cols)])
    with_cand = df.select(
        *[_q(c) for c in cols], cand.select(F.struct(*cand.columns).alias("s")).scalar().alias("_cand")
    )
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        match = ordinal(c) == F.col(f"_cand.c{i}")
        aggs += [
            F.count_if(match).alias(f"h{i}"),
            F.count_if(_q(c).isNull()).alias(f"u{i}"),
            F.coalesce(F.min(F.when(match, _q(c))) == F.max(F.when(match, _q(c))), F.lit(True)).alias(f"o{i}"),
            (F.coalesce(F.min(_q(c)) == F.max(_q(c)), F.lit(True))).alias(f"k{i}"),
        ]
    parts = ", ".join(f"'{c}', h{i}, u{i}, o{i}, k{i}" for i, c in enumerate(cols))
    rows = with_cand.agg(*aggs).selectExpr("_n", f"stack({len(cols)}, {parts}) AS (column, hits, nulls, one, constant)")
    hits = F.when(F.col("one"), F.col("hits")).otherwise(
        F.raise_error(F.lit("two values share a hash")).cast("bigint"))
    if skip_nulls:
        share = F.try_divide(hits, F.col("_n") - F.col("nulls"))
        few = F.col("constant")
    else:
        share = F.try_divide(F.greatest(hits, F.col("nulls")), F.col("_n"))
        few = (F.col("constant") & (F.col("nulls") == 0)) | (F.col("nulls") == F.col("_n"))
    return rows.select("column", share.alias("top_share"), few.alias("single_value"))


def near_constant(df: DataFrame, cols: Sequence[str], mode: str = "master",
                  limit: float = vocab.NEAR_CONSTANT_SHARE) -> DataFrame:
    """Columns that carry no information, as (column, near_constant).

    master: null is a value. stage1: nulls are left out. flags: for 0/1 columns,
    the larger of mean and 1 - mean, nulls left out; one pass.
    """
    if mode == "flags":
        wide = df.agg(*[
            e for i, c in enumerate(cols)
            for e in (F.avg(_q(c).cast("double")).alias(f"m{i}"), (F.min(_q(c)) == F.max(_q(c))).alias(f"k{i}"))
        ])
        parts = ", ".join(f"'{c}', m{i}, k{i}" for i, c in enumerate(cols))
        rows = wide.selectExpr(f"stack({len(cols)}, {parts}) AS (column, p, one)")
        p = F.coalesce("p", F.lit(0.0))
        test = F.coalesce(F.col("one"), F.lit(True)) | (F.greatest(p, 1 - p) >= limit)
        return rows.select("column", test.alias("near_constant"))
    if limit <= 0.5:
        # No sketch can name the candidates: count every value.
        counts = value_counts(df, cols)
        counts = counts.where("value IS NOT NULL") if mode == "stage1" else counts
        stats = counts.groupBy("column").agg((F.max("n") / F.sum("n")).alias("s"), F.count(F.lit(1)).alias("v"))
        names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
        test = (F.col("v") < 2) | (F.col("s") >= limit)
        return names.join(stats, "column", "left").select("column", F.coalesce(test, F.lit(True)).alias("near_constant"))
    shares = top_shares(df, cols, skip_nulls=mode == "stage1")
    return shares.select("column", (F.col("single_value") | (F.coalesce("top_share", F.lit(1.0)) >= limit))
                         .alias("near_constant"))


def flag_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Ends, known values and ones of columns of whole numbers: (column, n, low, high, known, ones); compiled, without sketches."""
    if len(cols) > PROFILED:
        return reduce(DataFrame.unionByName, [flag_counts(df, cols[a:a + PROFILED]) for a in range(0, len(cols), PROFILED)])
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(cols):
        aggs += [F.min(_q(c)).cast("bigint").alias(f"l{i}"), F.max(_q(c)).cast("bigint").alias(f"h{i}"),
                 F.count(_q(c)).alias(f"k{i}"), F.count_if(_q(c) == 1).alias(f"o{i}")]
    parts = ", ".join(f"'{c}', l{i}, h{i}, k{i}, o{i}" for i, c in enumerate(cols))
    return df.agg(*aggs).selectExpr("n", f"stack({len(cols)}, {parts}) AS (column, low, high, known, ones)")


def kept_columns(df: DataFrame, cols: Sequence[str], mode: str = "master") -> list[str]:
    """Names of informative columns; the result has one row per column.

    One pass of counts settles the whole numbers that hold only 0, 1 and null; the other columns go through ``near_constant``.
    """
    whole = [f.name for f in df.schema.fields if f.name in cols and isinstance(f.dataType, T.IntegralType)]
    bad, left = set(), [c for c in cols if c not in whole]
    for r in flag_counts(df, whole).collect() if whole else []:
        if r["known"] and (r["low"] < 0 or r["high"] > 1):
            left.append(r["column"])
            continue
        parts = [r["ones"], r["known"] - r["ones"], *([r["n"] - r["known"]] if mode == "master" else [])]
        if sum(p > 0 for p in parts) < 2 or max(parts) / sum(parts) >= vocab.NEAR_CONSTANT_SHARE:
            bad.add(r["column"])
    if left:
        bad |= {r["column"] for r in near_constant(df, left, mode).where("near_constant").collect()}
    return [c for c in cols if c not in bad]


def dictionary(df: DataFrame) -> DataFrame:
    """Role, stage, type and statistics of every column.

    Distinct counts of all columns share one shuffle of counts by column and value; a value is 96 bits of hash, so no text leaves
    its task. Null is a value.
    """
    cols, numeric = df.columns, set(numeric_columns(df))
    value = lambda c: F.when(_q(c).isNotNull(), F.struct(F.xxhash64(_q(c)).alias("x"), F.hash(_q(c)).alias("y")))
    hashed = df.select(*[value(c).alias(c) for c in cols]).unpivot([], cols, "column", "value")
    counts = hashed.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    stats = counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("n_unique"), (F.max("n") / F.sum("n")).alias("top_share")
    )
    nz = df.agg(*[
        (round_to(F.avg((_q(c).isNull() | (_q(c) != 0)).cast("double")) * 100, 1) if c in numeric
         else F.lit(None).cast("double")).alias(c) for c in cols
    ]).unpivot([], cols, "column", "pct_nonzero")
    roles = df.sparkSession.createDataFrame(
        [(i, c, role_of(c), stage_of(role_of(c)), t) for i, (c, t) in enumerate(df.dtypes)],
        "position int, column string, role string, etapa string, dtype string",
    )
    near = (F.col("role") != "id") & (
        (F.col("n_unique") < 2) | (F.col("top_share") >= vocab.NEAR_CONSTANT_SHARE))
    return roles.join(stats, "column").join(nz, "column").select(
        "position", "column", "role", "etapa", "dtype", "n_unique", "pct_nonzero", near.alias("near_constant"),
        (F.col("role").startswith("feature_") & ~near).alias("use_as_feature"),
    )


def numeric_defaults(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Median, minimum and maximum of each numeric column; ``df`` is read several times, so a long plan is best stored first."""
    wide = df.agg(*[e for c in cols for e in (F.min(c).cast("double").alias(f"lo_{c}"),
                                              F.max(c).cast("double").alias(f"hi_{c}"))])
    parts = ", ".join(f"'{c}', `lo_{c}`, `hi_{c}`" for c in cols)
    ends = wide.selectExpr(f"stack({len(cols)}, {parts}) AS (column, min, max)")
    return ends.join(column_medians(df, cols), "column").select("column", "median", "min", "max")


def category_defaults(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Every category of each column as a row, the most frequent (lowest on a tie) marked."""
    counts = value_counts(df, cols).where(F.col("value").isNotNull())
    modes = counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("m"), F.col("value").alias("v")))
                                         .alias("_top")).select(F.col("column").alias("_mc"), "_top")
    return counts.join(modes, F.col("column") == F.col("_mc")).select(
        "column", "value", "n", (F.col("value") == F.col("_top.v")).alias("is_default"))


def columns_with_nulls(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """One pass; the result is one row."""
    if not cols:
        return []
    row = df.agg(*[F.count_if(_q(c).isNull()).alias(f"u{i}") for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if row[f"u{i}"]]


def impute(df: DataFrame, flags: Sequence[str], numbers: Sequence[str] | None = None) -> DataFrame:
    """Flags 0, numbers the column median, text ''.

    Only numbers that have a null are touched; an integer column among them
    becomes double, as its median may lie between two integers. Nulls are
    looked for and medians found by passes over ``df``, so a table with a long
    plan is best stored first. Pass ``numbers`` to skip the look for nulls.
    """
    flags = set(flags)
    if numbers is None:
        maybe = {f.name for f in df.schema.fields if f.nullable}
        numbers = columns_with_nulls(df, [c for c in numeric_columns(df) if c in maybe and c not in flags])
    found = medians(df, {c: _q(c) for c in numbers}) if numbers else {}
    cols = []
    for c, t in df.dtypes:
        if c in flags:
            cols.append(F.coalesce(_q(c), F.lit(0)).cast("int").alias(c))
        elif c in numbers:
            cols.append(F.coalesce(_q(c).cast("double"), F.lit(found.get(c)).cast("double")).alias(c))
        elif t == "string":
            cols.append(F.coalesce(_q(c), F.lit("")).alias(c))
        else:
            cols.append(_q(c))
    return df.select(*cols)
