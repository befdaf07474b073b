"""From raw documents to packed training sequences, in five stages.

1. ``quality``: documents that the positive-unlabelled classifier scores below ``KEEP`` go.
2. ``near_duplicates``: of each class of near copies the row with the smallest id stays. Texts are near copies if the Jaccard
   similarity of their sets of five-word shingles is ``LEAST`` or more. Candidates are classes of SimHash over two-word shingles
   with links of at most ``BITS`` differing bits, which reach most such pairs; inside them the sets are compared as a whole.
3. ``repeated_text``: strings of 100 bytes that start earlier in the corpus are cut out of the texts; ``n_chars`` follows.
4. ``decontaminate``: documents that hold a passage of a benchmark item go.
5. ``pack``: what is left is tokenised, and packed into sequences of 1,024 tokens.

All stages but the last return the columns of ``documents``. ``run`` writes each stage to the shared scratch folder and reads it
back, so a lost executor repeats one stage's tasks only. Each stage works on all rows and whole texts. A stage with an empty
input gives an empty output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.llm import packing, phrases, quality, simhash, suffixes
from shelfwise.llm.common import held_out, stored

KEEP = 0.3
BITS = 9
LEAST = 0.8


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    model = quality.fit(docs.where(~held_out()), labels.where(~held_out()))
    return quality.score(docs, model, out="_score").where(F.col("_score") >= KEEP).drop("_score")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs, most=BITS, width=2, least=LEAST)


def repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = suffixes.remove_repeated(docs).withColumn("text", F.col("kept_text"))
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    keyed = docs.withColumn("_key", F.xxhash64("doc_id", "text"))
    report, _ = phrases.decontaminate(keyed.select("_key", "text"), items, doc_id="_key")
    return keyed.join(report.where("contaminated").select(F.col("doc_id").alias("_key")).distinct(), "_key", "left_anti").select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers as vocabularies

    path, pattern = vocabularies.path("byte_bpe_50k.json"), vocabularies.PATTERN
    return packing.pack(packing.pieces(docs, path, pattern))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicates),
    ("repeated_text", repeated_text),
    ("decontaminate", decontaminate),
    ("pack", pack),
]
ORACLE_SQL = None  # fingerprints, trained scores and token ids have no SQL; tests/llm compares each stage with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
