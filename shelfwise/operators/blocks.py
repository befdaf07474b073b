"""Training rows as compressed blocks of numbers in the shared folder, which tasks go through one by one at every pass.

A block holds its columns one after the other, so flags take few bytes; a row group of the files has few megabytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfwise.session import scratch_dir

ROWS = 4096
CODEC = "zstd"


def flat(v: pa.Array) -> np.ndarray:
    """(rows, width) of an Arrow list column."""
    return v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1)


def squeezed(x: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(x.T).tobytes(), codec=CODEC, asbytes=True)


def opened(packed: bytes, n: int, width: int) -> np.ndarray:
    """The (n, width) matrix of a block."""
    return np.ascontiguousarray(np.frombuffer(pa.decompress(packed, n * width * 8, codec=CODEC)).reshape(width, n).T)


def pieces(n: int) -> Iterator[slice]:
    for a in range(0, n, ROWS):
        yield slice(a, min(n, a + ROWS))


def written(df: DataFrame, purpose: str) -> DataFrame:
    """A table of blocks, written so that neither its writer nor its readers hold many of them."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.option("parquet.block.size", 16 << 20).option("parquet.page.size.row.check.min", 4).option("compression", "uncompressed").parquet(path)
    return df.sparkSession.read.parquet(path)
