"""Rows and facts about their owner out of one aggregation."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Into how many tasks the rows of one owner are dealt. Facts go to each of them, so this is also how often they are copied.
SPREAD = 32


def beside_facts(
    rows: DataFrame,
    keys: Sequence[str],
    sums: Sequence[Column],
    fact_keys: Sequence[str],
    owner: Sequence[str],
    facts: Mapping[str, Callable[[Column], Column]],
    together: Sequence[str] | None = None,
    spread: int = SPREAD,
) -> DataFrame:
    """``rows`` added up by ``keys``, each with ``facts`` about its owner.

    GROUPING SETS add up ``sums`` by ``keys`` and, in the same pass, by the coarser ``fact_keys``; the source is
    read once. An owner's rows are then dealt out by a hash of ``together`` (all keys if not given), and its few
    fact rows go along to each part, where a window reads them: an owner with very many rows is no single task. A fact is
    an aggregate that gets a condition which says what a fact row is. Rows that agree in owner, ``together`` and
    ``_part`` lie in one task.
    """
    added = rows.groupingSets([list(keys), list(fact_keys)], *keys).agg(*sums, F.grouping_id().alias("_level"))
    own_part = F.pmod(F.hash(*(together or keys)), F.lit(spread))
    parts = F.when(F.col("_level") == 0, F.array(own_part)).otherwise(F.sequence(F.lit(0), F.lit(spread - 1)))
    dealt = added.withColumn("_part", F.explode(parts))
    of_owner = Window.partitionBy(*owner, "_part")
    is_fact = F.col("_level") != 0
    told = dealt.withColumns({name: fact(is_fact).over(of_owner) for name, fact in facts.items()})
    return told.filter(~is_fact).drop("_level")
