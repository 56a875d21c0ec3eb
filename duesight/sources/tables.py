"""Access to the receivables tables, whatever they are stored in."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duesight.sources.schemas import PARTITION_COLUMNS, SCHEMAS, TEXT_KEYS


class Tables:
    """``tables.invoices`` and friends; each table is read on first use."""

    def __init__(self, read: Callable[[str], DataFrame]):
        self._read = read
        self._frames: dict[str, DataFrame] = {}
        self._lookups: dict[str, DataFrame] = {}
        # The owners a run is for (None: all), and into how many slots documents are laid out by owner.
        self.owners: DataFrame | None = None
        self.slots: int | None = None

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in SCHEMAS:
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = self._read(name)
        return self._frames[name]

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A lookup derived from these tables, built on first use and shared by all that need it."""
        if name not in self._lookups:
            self._lookups[name] = build()
        return self._lookups[name]

    def replace(self, **frames: DataFrame) -> Tables:
        """The same tables with some of them swapped."""
        copy = Tables(self._read)
        copy._frames = {**self._frames, **frames}
        copy.owners, copy.slots = self.owners, self.slots
        return copy

    def with_slots(self, slots: int) -> Tables:
        copy = self.replace()
        copy.slots = slots
        return copy

    def of_owners(self, owners: DataFrame) -> Tables:
        """The same tables for a run that reports to ``owners`` (column ``bdm_id``) only.

        Documents are cut down to what these owners see where they are read, before anything is joined to them.
        """
        copy = self.replace()
        copy.owners = owners.select("bdm_id").distinct()
        return copy


ZERO_DATE = r"^0000-00-00"
# Wide enough to see a decimal place that a column's type would drop.
_EXACT = T.DecimalType(38, 12)


def _held(column: Column, field: T.StructField, given: T.DataType) -> Column:
    """``column`` as the field's type; a value that would be lost or rounded is an error."""
    kept = column.try_cast(field.dataType)
    lost = kept.isNull()
    if isinstance(field.dataType, T.DecimalType):
        lost |= ~F.coalesce(column.try_cast(_EXACT) == kept.try_cast(_EXACT), F.lit(False))
    if isinstance(given, T.StringType):
        blank = F.btrim(column) == ""
        if isinstance(field.dataType, T.DateType):
            blank |= column.rlike(ZERO_DATE)
        lost &= ~blank
    problem = F.concat(F.lit(f"{field.name} can't hold "), column.cast("string"))
    return F.when(column.isNotNull() & lost, F.raise_error(problem)).otherwise(kept)


# The usual collation of the database: letters of either case, with or without accents, and trailing blanks are the same.
KEY_COLLATION = "UNICODE_CI_AI_RTRIM"


def collated(df: DataFrame, table: str, collation: str = KEY_COLLATION) -> DataFrame:
    """``df`` with the table's text keys as collated text: joins and groups compare them as the database does, and
    the text stays as it was written."""
    keys = TEXT_KEYS.get(table, ())
    return df.withColumns({key: F.col(key).cast(T.StringType(collation)) for key in keys if key in df.columns})


def conform(df: DataFrame, table: str, normalise_keys: bool = False) -> DataFrame:
    """Project ``df`` onto the table's schema.

    Columns that already have their type pass untouched, so filters on them still
    reach the file scan. Blank text and zero dates (``0000-00-00``) become NULL. Any other
    value that its type can't hold as it is stops the read with the column and the value.
    """
    schema = T.StructType.fromDDL(SCHEMAS[table])
    keys = TEXT_KEYS.get(table, ()) if normalise_keys else ()
    columns = []
    for field in schema:
        column = F.col(field.name)
        if df.schema[field.name].dataType != field.dataType:
            column = _held(column, field, df.schema[field.name].dataType)
        if field.name in keys:
            column = F.lower(F.rtrim(column))
        columns.append(column.alias(field.name))
    return df.select(*columns)


def file_tables(
    spark: SparkSession, folder: str, file_format: str = "parquet", normalise_keys: bool = False, collation: str | None = None
) -> Tables:
    """One data set per table under ``folder``; text formats are read as text and then cast. With a ``collation`` text
    keys are compared by it."""
    options = {"header": "true"} if file_format == "csv" else {}

    def read(name: str) -> DataFrame:
        frame = spark.read.format(file_format).options(**options).load(f"{folder}/{name}")
        rows = conform(frame, name, normalise_keys)
        return collated(rows, name, collation) if collation else rows

    return Tables(read)


def hash_predicates(column: str, parts: int) -> list[str]:
    """Conditions that split a table by a whole-number column into ``parts`` disjoint reads, each row in one of them.

    No range of the column has to be known, and a crowded range makes no read larger. NULL goes with the first.
    """
    rest = f"MOD(ABS({column}), {parts})"
    return [f"{rest} = 0 OR {column} IS NULL", *[f"{rest} = {part}" for part in range(1, parts)]]


# Tables that grow with the business and are split when a database is read; the others are small reference data.
LARGE_TABLES = (
    "invoices", "invoice_consolidations", "invoice_consolidation_details", "direct_invoices", "credit_notes", "credit_references",
    "projects", "project_so_masters", "sales_orders", "project_purchase_orders", "po_so_masters", "customers",
    "customer_contacts", "forex_conversions", "general_approvers", "mail_configurations", "scheduler_logs",
)


def jdbc_tables(
    spark: SparkSession,
    options: Mapping[str, str],
    key_ranges: Mapping[str, tuple[int, int]],
    partitions: int,
    renamed: Mapping[str, str] | None = None,
    normalise_keys: bool = False,
    collation: str | None = None,
) -> Tables:
    """Tables of a live database.

    ``options`` holds url, driver and credentials. A table is read by ``partitions`` tasks in parallel, split on its ``id`` or, if it
    has none, on its column in ``PARTITION_COLUMNS``: into ranges if it is named in ``key_ranges``, which an index serves best,
    else into classes of the column's remainder if it is one of ``LARGE_TABLES``. Spark adds the filters it pushes down to each read.
    """
    renamed = renamed or {}

    def load(name: str) -> DataFrame:
        table, column = renamed.get(name, name), PARTITION_COLUMNS.get(name, "id")
        if name not in key_ranges and name in LARGE_TABLES and partitions > 1:
            rest = dict(options)
            return spark.read.jdbc(rest.pop("url"), table, predicates=hash_predicates(column, partitions), properties=rest)
        reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
        if name in key_ranges:
            low, high = key_ranges[name]
            reader = reader.options(partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=partitions)
        return reader.load()

    def read(name: str) -> DataFrame:
        rows = conform(load(name), name, normalise_keys)
        return collated(rows, name, collation) if collation else rows

    return Tables(read)
