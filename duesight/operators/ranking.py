"""The place of each row in the order of its group, without bringing a group together."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Ranges that all rows are cut into, and sampled keys for each of them.
RANGES, SAMPLE = 64, 50


def _splitters(rows: DataFrame, key: Column, ranges: int, sample: int) -> list[Column]:
    """Keys that cut the rows into ranges, as literals; the driver gets ``ranges * sample`` keys, whatever the table."""
    n = rows.count()
    every = max(1, n // (ranges * sample))
    chosen = rows.select(key.alias("key")).filter(F.pmod(F.xxhash64("key"), F.lit(every)) == 0).distinct()
    keys = chosen.orderBy("key").limit(4 * ranges * sample).collect()
    picked = [keys[i * len(keys) // ranges].key for i in range(1, ranges)] if keys else []
    types = chosen.schema["key"].dataType
    found = list(dict.fromkeys(picked))
    return [F.struct(*[F.lit(value).cast(field.dataType).alias(field.name) for value, field in zip(one, types.fields, strict=True)]) for one in found]


def with_rank(rows: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "rank", ranges: int = RANGES, sample: int = SAMPLE) -> DataFrame:
    """``rows`` with their place (from 0) in the order of ``order`` among the rows of their group, nulls first.

    Sampled splitters cut all rows into ranges of group and order. Rows are numbered inside their range, and the
    number of a group's rows in earlier ranges is added. A group with very many rows lies in many ranges. ``rows`` is
    read three times, so it should be a table or cheap; equal rows get different places in any order.
    """
    key = F.struct(*group, *order)
    splitters = _splitters(rows, key, ranges, sample)
    # Splitters are in order, so the number of them up to a key is its range.
    place = reduce(lambda n, splitter: n + (key >= splitter).cast("int"), splitters, F.lit(0))
    placed = rows.withColumn("_range", place)
    own = F.row_number().over(Window.partitionBy("_range", *group).orderBy(*order))
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("_range", *group).agg(F.count(F.lit(1)).alias("_n"))
    past = counts.select(F.col("_range").alias("_of"), *[F.col(c).alias(f"_{c}") for c in group], F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_past"))
    same = reduce(lambda left, c: left & F.col(c).eqNullSafe(F.col(f"_{c}")), group, F.col("_range") == F.col("_of"))
    numbered = placed.withColumn("_own", own).join(past, same)
    return numbered.select(*rows.columns, (F.col("_past") + F.col("_own") - 1).alias(name))
