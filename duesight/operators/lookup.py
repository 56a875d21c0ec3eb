"""Small building blocks: first row per key, lowest row per key, optional predicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row of each key. Spark keeps one row per key and task before it shuffles."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")
    )


def lowest(df: DataFrame, key: str, by: str, value: str) -> DataFrame:
    """``key -> value`` of the row with the lowest ``by``, combined on the map side."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min_by(value, by).alias(value), F.min(by).alias(by))
        .select(key, *dict.fromkeys([by, value]))
    )


def left_lookup(rows: DataFrame, table: DataFrame, key: str, spread: str) -> DataFrame:
    """Left join of ``table`` on a ``key`` that may be NULL in ``rows``.

    Rows without the key get one of their own, made of the number ``spread``, that matches nothing, so they
    do not all meet in one shuffle partition. Keys of ``table`` are not negative.
    """
    own = F.coalesce(F.col(key), -1 - F.abs(F.col(spread)))
    return (
        rows.withColumn("_key", own).join(table.withColumnRenamed(key, "_key"), "_key", "left").drop("_key")
    )


def all_of(predicates: Sequence[Column]) -> Column:
    """Conjunction of any number of optional predicates."""
    return reduce(lambda left, right: left & right, predicates, F.lit(True))
