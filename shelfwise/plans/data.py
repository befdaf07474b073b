"""Bound tables of a session, built once per data folder."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from shelfwise.plans import catalogue as C
from shelfwise.plans.master import build_master, build_stage1
from shelfwise.session import materialise


def master(spark: SparkSession, sf: str) -> DataFrame:
    return build_master(C.metadata(spark, sf), C.tags(spark, sf), C.text(spark, sf), C.panel(spark, sf),
                        cuts=(C.FLOP_MAX, C.HIT_MIN))


def stage1(spark: SparkSession, sf: str) -> DataFrame:
    return build_stage1(C.metadata(spark, sf), C.tags(spark, sf), C.text(spark, sf))


def version(spark: SparkSession, sf: str) -> tuple:
    """Names, sizes and times of the files of a data folder; what was built from other files is built again."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found, todo = [], [path]
    while todo:
        for f in store.listStatus(todo.pop()):
            if f.isDirectory():
                todo.append(f.getPath())
            else:
                found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return spark.sparkContext.applicationId, *sorted(found)


@lru_cache(maxsize=4)
def _stored(key: tuple, sf: str, name: str) -> DataFrame:
    spark = SparkSession.active()
    return materialise({"master": master, "stage1": stage1}[name](spark, sf), name)


def stored(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """The feature table, written once and read by the queries of a session, as long as its folder stays as it is."""
    return _stored(version(spark, sf), sf, name)
