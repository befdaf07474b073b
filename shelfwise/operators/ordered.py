"""Order statistics and seeded samples whose work spreads over tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from shelfwise.functions.features import md5_order


#: A selection ends by ranking at most this many values or rows of a key in one list.
SMALL = 10_000
#: Quantiles per pass; each pass leaves about 4 / GRID of the values that were left.
GRID = 500


class _Search:
    """The middle ranks of one set of values, and the open range (low, high) that still hides them."""

    def __init__(self) -> None:
        self.low, self.high = float("-inf"), float("inf")
        self.n: int | None = None
        self.ranks: list[int] = []
        self.found: dict[int, float] = {}
        self.skip = 0
        self.inside = 0

    def open_ranks(self) -> list[int]:
        return [r for r in self.ranks if r not in self.found]

    def narrow(self, below: int, at_low: int, inside: int, at_high: int, grid: list[float] | None) -> None:
        """Counts of a pass: values below ``low``, equal to it, inside, equal to ``high``; and quantiles of those inside."""
        if self.n is None:
            self.n = at_low + inside + at_high
            self.ranks = sorted({(self.n + 1) // 2, self.n // 2 + 1}) if self.n else []
        self.skip, self.inside = below + at_low, inside
        for r in self.open_ranks():
            if not below < r <= self.skip + inside + at_high:
                raise ValueError("a middle rank lies outside its range")
            if r <= self.skip:
                self.found[r] = self.low
            elif r > self.skip + inside:
                self.found[r] = self.high
        left = self.open_ranks()
        if left and not self.small():
            # One step of the grid on either side covers the error of the quantiles.
            lo = (left[0] - self.skip) * GRID // inside - 1
            hi = -(-(left[-1] - self.skip) * GRID // inside) + 1
            self.low = grid[lo] if lo >= 0 else self.low
            self.high = grid[hi] if hi <= GRID else self.high

    def small(self, bound: int | None = None) -> bool:
        return self.inside <= (SMALL if bound is None else bound)

    def median(self) -> float | None:
        return (self.found[self.ranks[0]] + self.found[self.ranks[-1]]) / 2 if self.ranks else None


def _counted(v: Column, low: Column, high: Column, accuracy: int) -> Column:
    inside = (v > low) & (v < high)
    grid = F.percentile_approx(F.when(inside, v), [i / GRID for i in range(GRID + 1)], accuracy)
    return F.struct(F.count_if(v < low), F.count_if(v == low), F.count_if(inside), F.count_if((v == high) & (high > low)), grid)


def _nth(v: Column, low: Column, high: Column, places: Column) -> Column:
    """The values at the given places of the sorted list of those inside, which are few."""
    values = F.array_sort(F.collect_list(F.when((v > low) & (v < high), v)))
    return F.transform(places, lambda i: F.element_at(values, i.cast("int")))


def medians(df: DataFrame, values: dict[str, Column], accuracy: int = 10_000) -> dict[str, float]:
    """Exact medians of several expressions; nulls and NaN are left out, names without values are missing.

    Selection by repeated narrowing: a pass counts the values below, at the ends of and inside a range per name, and takes
    quantiles of those inside, which give the next, hundred times smaller range. It ends when a rank falls on an end of the range,
    as with many equal values, or when few values are left. No value is shuffled; a pass returns one row.
    """
    clean = {k: F.when(~F.isnan(c.cast("double")), c.cast("double")) for k, c in values.items()}
    state = {k: _Search() for k in values}
    todo = list(values)
    while todo:
        row = df.agg(*[_counted(clean[k], F.lit(state[k].low), F.lit(state[k].high), accuracy).alias(f"s{i}") for i, k in enumerate(todo)]).first()
        for i, k in enumerate(todo):
            state[k].narrow(*row[i])
        todo = [k for k in todo if state[k].open_ranks() and not state[k].small()]
    last = [k for k in values if state[k].open_ranks()]
    if last:
        places = lambda s: F.array(*[F.lit(r - s.skip) for r in s.open_ranks()])
        row = df.agg(*[_nth(clean[k], F.lit(state[k].low), F.lit(state[k].high), places(state[k])).alias(f"s{i}") for i, k in enumerate(last)]).first()
        for i, k in enumerate(last):
            state[k].found.update(zip(state[k].open_ranks(), row[i]))
    return {k: s.median() for k, s in state.items() if s.n}


def grouped_median(df: DataFrame, key: str, value: str, accuracy: int = 10_000) -> DataFrame:
    """Exact median per key, for keys of a bounded set (a fixed vocabulary); found as in ``medians``, for all keys at once."""
    spark, key_type = df.sparkSession, df.schema[key].dataType
    v = F.col(value).cast("double")
    rows = df.select(F.col(key).alias("_k"), v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    everything = F.lit(float("-inf")), F.lit(float("inf"))
    state: dict[object, _Search] = {}
    # One row per key.
    for r in rows.groupBy("_k").agg(_counted(F.col("_v"), *everything, accuracy).alias("s")).collect():
        state[r["_k"]] = _Search()
        state[r["_k"]].narrow(*r["s"])

    def ranged(todo: list) -> DataFrame:
        table = [(k, state[k].low, state[k].high, [r - state[k].skip for r in state[k].open_ranks()]) for k in todo]
        schema = T.StructType().add("_sk", key_type).add("_low", "double").add("_high", "double").add("_places", T.ArrayType(T.LongType()))
        return rows.join(F.broadcast(spark.createDataFrame(table, schema)), F.col("_k").eqNullSafe(F.col("_sk")))

    while todo := [k for k, s in state.items() if s.open_ranks() and not s.small()]:
        for r in ranged(todo).groupBy("_k").agg(_counted(F.col("_v"), F.col("_low"), F.col("_high"), accuracy).alias("s")).collect():
            state[r["_k"]].narrow(*r["s"])
    last = [k for k, s in state.items() if s.open_ranks()]
    if last:
        few = ranged(last).where("_v > _low AND _v < _high").groupBy("_k", "_places").agg(F.array_sort(F.collect_list("_v")).alias("values"))
        for r in few.select("_k", F.transform("_places", lambda i: F.element_at("values", i.cast("int"))).alias("s")).collect():
            state[r["_k"]].found.update(zip(state[r["_k"]].open_ranks(), r["s"]))
    schema = T.StructType().add(key, key_type).add("median", "double")
    return spark.createDataFrame([(k, s.median()) for k, s in state.items() if s.n], schema)


def column_medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact median of each column, one row per column with values: (column, median)."""
    found = medians(df, {c: F.col(f"`{c}`") for c in cols})
    return df.sparkSession.createDataFrame(list(found.items()), "column string, median double")


def hash_cutoff(df: DataFrame, key: str, seed: int, take: Column, strata: Sequence[str] = (), digits: int = 4,
                small: int | None = None) -> DataFrame:
    """Per stratum the ``take``-th smallest (md5, key) pair; ``take`` may use ``_total``.

    Selection by radix: rows are counted by the next ``digits`` hexadecimal digits of their hash, and only those with the digits
    that hold the cut go on, until at most ``small`` rows of a stratum are left to rank. The number of levels grows with the
    logarithm of the rows. Strata are classes: there are few.
    """
    spark, small = df.sparkSession, SMALL if small is None else small
    rows = df.select(*[F.col(s).alias(f"_s{i}") for i, s in enumerate(strata)], F.col(key).alias("_key"), md5_order(F.col(key), seed).alias("_h"))
    mine = [f"_s{i}" for i in range(len(strata))]
    part = Window.partitionBy(*(mine or [F.lit(0)]))  # over at most 16 ** digits counts
    upto = part.orderBy("_d").rowsBetween(Window.unboundedPreceding, 0)
    schema = T.StructType([T.StructField(f"_c{i}", df.schema[s].dataType) for i, s in enumerate(strata)])
    schema = schema.add("_prefix", "string").add("_left", "long")

    def within(at: DataFrame, length: int) -> DataFrame:
        cond = F.substring("_h", 1, length) == F.col("_prefix")
        for i in range(len(strata)):
            cond = cond & F.col(f"_s{i}").eqNullSafe(F.col(f"_c{i}"))
        return rows.join(F.broadcast(at), cond)  # one row per stratum

    at, length = None, 0
    while True:
        some = rows.withColumns({"_prefix": F.lit(""), "_left": F.lit(None).cast("bigint")}) if at is None else within(at, length)
        counts = some.groupBy(*mine, "_prefix", "_left", F.substring("_h", length + 1, digits).alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
        wanted = take if at is None else F.col("_left")
        counts = counts.withColumn("_total", F.sum("_n").over(part)).withColumn("_need", wanted - F.sum("_n").over(upto) + F.col("_n"))
        cut = counts.where((F.col("_need") >= 1) & (F.col("_need") <= F.col("_n"))).select(*mine, F.concat("_prefix", "_d").alias("_prefix"), "_need", "_n")
        found = cut.collect()
        at = spark.createDataFrame([tuple(r)[:-1] for r in found], schema)
        length += digits
        if length >= 32 or all(r["_n"] <= small for r in found):
            break
    # Repeated keys count as often as they occur.
    last = within(at, length).groupBy(*mine, "_left", "_h", "_key").agg(F.count(F.lit(1)).alias("_n"))
    to = F.sum("_n").over(part.orderBy("_h", "_key").rowsBetween(Window.unboundedPreceding, 0))
    return last.withColumn("_to", to).where((F.col("_to") >= F.col("_left")) & (F.col("_to") - F.col("_n") < F.col("_left"))).select(
        *[F.col(f"_s{i}").alias(s) for i, s in enumerate(strata)], F.struct("_h", "_key").alias("_cut"))


def sample_n(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """Repeatable sample of ``n`` rows (all if there are fewer); ``key`` is unique."""
    total_or_n = F.least(F.lit(n), F.col("_total"))
    cut = hash_cutoff(df, key, seed, total_or_n).select("_cut").scalar()
    return df.where(F.struct(md5_order(F.col(key), seed).alias("_h"), F.col(key).alias("_key")) <= cut)


def stratified_test_flag(df: DataFrame, label: str, key: str, seed: int = 42, share: float = 0.2,
                         flag: str = "is_test") -> DataFrame:
    """M3: marks floor(share * n) rows of every class as test rows, repeatably."""
    cuts = hash_cutoff(df, key, seed, F.floor(F.col("_total") * share), [label])
    cuts = cuts.select(F.col(label).alias("_cl"), "_cut")
    # Found once, however often the rows are read.
    cuts = df.sparkSession.createDataFrame(cuts.collect(), cuts.schema)
    mine = F.struct(md5_order(F.col(key), seed).alias("_h"), F.col(key).alias("_key"))
    # One row per class.
    out = df.join(F.broadcast(cuts), F.col(label).eqNullSafe(F.col("_cl")), "left")
    return out.withColumn(flag, F.coalesce(mine <= F.col("_cut"), F.lit(False))).drop("_cl", "_cut")


def fold_of(key: Column, folds: int, seed: int = 42) -> Column:
    """Fold number of a key, from its hash."""
    return F.pmod(F.conv(F.substring(md5_order(key, seed), 1, 8), 16, 10).cast("bigint"), F.lit(folds)).cast("int")


# Plain orders. Spark runs orderBy + limit as a per-task top-n and one merge of n rows.

def top_n(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def both_ends(df: DataFrame, by: str, tie: str, n: int, side: str = "side") -> DataFrame:
    """T4: the ``n`` largest and the ``n`` smallest rows with a side column."""
    high = top_n(df, [F.desc(by), F.asc(tie)], n).withColumn(side, F.lit("positivos"))
    low = top_n(df, [F.asc(by), F.asc(tie)], n).withColumn(side, F.lit("negativos"))
    return high.unionByName(low)


def top_by_abs(df: DataFrame, by: str, tie: str, n: int) -> DataFrame:
    return top_n(df, [F.desc(F.abs(F.col(by))), F.asc(tie)], n)
