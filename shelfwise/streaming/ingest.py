"""ST2: incremental ingest of items not seen before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from shelfwise.session import path_kind


#: Keeps the state on the executors' disks, and writes only what a batch changed to the checkpoint.
STATE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
         "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


def first_seen(stream: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row, by ``order``, of every key that no earlier batch had.

    The keys that were seen are the state of an aggregate, with the time of their first batch. A batch looks up its own keys
    and gives on those whose first batch it is. Rows of a null key are one key.
    """
    rest = [c for c in stream.columns if c != key and c not in order]
    row = F.struct(*order, *rest)
    seen = stream.withColumn("_now", F.current_timestamp()).groupBy(key).agg(F.min("_now").alias("_since"), F.min_by(row, F.struct(*order)).alias("_row"))
    return seen.where(F.col("_since") == F.current_timestamp()).select(key, "_row.*").select(*stream.columns)


def ingest_new(stream: DataFrame, folder: str, checkpoint: str, key: str, order: Sequence[str],
               trigger: dict | None = None) -> StreamingQuery:
    """Appends the first row of every key that no earlier batch has stored.

    The work of a batch depends on its own rows, not on what is stored; see ``first_seen``. Batches write to their own folder,
    and a repeated batch, which has the time of its first run, writes the same again.
    """
    spark = stream.sparkSession
    before = {k: spark.conf.get(k, None) for k in STATE}

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        # A query keeps the settings it was started with.
        return (
            first_seen(stream, key, order).writeStream.outputMode("update").foreachBatch(store)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
        )
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def read_ingested(spark: SparkSession, folder: str, schema: T.StructType | None = None) -> DataFrame:
    """What has been stored. With the rows' ``schema`` a stream that has had no rows gives none; without it is an error."""
    if schema is None:
        return spark.read.parquet(folder).drop("batch")
    if path_kind(spark, folder) == "none":
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)
