"""Document tables laid out by owner, so that a run for a few owners reads their part of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duesight.operators.lookup import left_lookup
from duesight.operators.routes import OWNER_SLOT, SHARED, owned_orders
from duesight.sources.tables import Tables

# Documents nobody sees: no owner's run reads them.
NOBODY = -2
SLOTS = 64


def _stored(rows: DataFrame, path: str) -> DataFrame:
    spark = rows.sparkSession
    # Rows of a slot go to several tasks, those of a project to one.
    dealt = rows.repartition(OWNER_SLOT, F.pmod("id", F.lit(16)))
    dealt.write.mode("overwrite").partitionBy(OWNER_SLOT).parquet(path)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != OWNER_SLOT)
    return spark.read.schema(f"{kinds}, {OWNER_SLOT} int").parquet(path)


def store_by_owner(t: Tables, folder: str, slots: int = SLOTS) -> Tables:
    """The same tables with invoices and stand-alone invoices stored by owner under ``folder``.

    A folder (slot) holds the documents of the owners with one remainder. Invoices of projects that several owners see lie once, in a slot of
    their own that every run reads; those of projects without an owner in one that only runs for all owners read. The layout
    follows the sales orders as they are now: store again when projects change hands.
    """
    own = F.pmod("bdm_id", F.lit(slots)).cast("int")
    owners = owned_orders(t).groupBy("project_id").agg(F.min("bdm_id").alias("bdm_id"), F.max("bdm_id").alias("last"))
    of_project = owners.select("project_id", F.when(F.col("bdm_id") == F.col("last"), own).otherwise(SHARED).alias(OWNER_SLOT))
    # The lookup drops its key, so it gets a copy.
    keyed = t.invoices.withColumn("_project", F.col("project_id"))
    placed = left_lookup(keyed, of_project.withColumnRenamed("project_id", "_project"), "_project", "id")
    invoices = placed.select(*t.invoices.columns, F.coalesce(OWNER_SLOT, F.lit(NOBODY)).alias(OWNER_SLOT))
    direct = t.direct_invoices.withColumn(OWNER_SLOT, F.coalesce(own, F.lit(NOBODY)))
    return t.replace(
        invoices=_stored(invoices, f"{folder}/invoices"),
        direct_invoices=_stored(direct, f"{folder}/direct_invoices"),
    ).with_slots(slots)
