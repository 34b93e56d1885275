"""Parallelism of stages that spend their time in Python."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """`df` over at least as many partitions as the session has cores.

    A small table in one file is one task, whatever a text function costs; a
    table that is split enough already is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def dealt(df: DataFrame, times: int = 4) -> DataFrame:
    """`df` dealt evenly over `times` as many partitions as cores.

    For narrow rows, whose row groups say nothing of what they cost: a file
    split by bytes has as many partitions with rows as it has row groups.
    """
    return df.repartition(times * df.sparkSession.sparkContext.defaultParallelism)
