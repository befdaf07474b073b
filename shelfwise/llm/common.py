"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.session import scratch_dir

#: A null id comes after every other id wherever ids are ordered.
LAST_ID = (1 << 63) - 1


def stored(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """Writes a table to the shared scratch folder; returns it read back, and its folder."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """True for the documents whose labels no model may see; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % folds == 0


def utf8(texts: pd.Series) -> Iterator[bytes]:
    """Texts as UTF-8, one at a time; null is empty."""
    return (t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts)


def mixed(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit integers so that every output bit depends on all input bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x
