"""Owners, people in copy, configuration: the reference data around a report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duesight.functions.text import person_name
from duesight.operators.lookup import all_of, lowest
from duesight.operators.ranking import with_rank
from duesight.settings import (
    CC_FUNCTION_PREFIX,
    CRON_TYPE,
    DEPARTED_STATUSES,
    RECIPIENT_TYPES,
    REPORT_CONFIG_PARENT,
    SERVER_CONFIG_KEYS,
    SERVER_CONFIG_PARENT,
)
from duesight.sources.tables import Tables


def report_owners(t: Tables) -> DataFrame:
    """Everyone a report is made for; an owner unknown to the staff table keeps NULLs."""
    staff = t.employees.select(
        F.col("id").alias("bdm_id"),
        F.concat_ws(" ", "first_name", "last_name").alias("owner_name"),
        F.col("work_email_address").alias("email"),
        "employee_number",
        F.col("structure_name").alias("unit"),
    )
    owners = t.debtor_reports.select("bdm_id").distinct()
    named = owners.join(staff, "bdm_id", "left").distinct()
    return named.withColumn("owner_name", F.coalesce("owner_name", F.lit("")))


def active_owners(t: Tables) -> DataFrame:
    """Employees who have not left. An unknown status does not count as active."""
    staying = ~F.col("employment_status").isin(*DEPARTED_STATUSES)
    return t.employees.filter(staying).select(F.col("id").alias("bdm_id"))


def _staff_by_number(t: Tables, *values: str) -> DataFrame:
    """Employee number -> some columns of the employee with the lowest id."""
    chosen = t.employees.withColumn("_values", F.struct(*values))
    return lowest(chosen, "employee_number", "id", "_values").select("employee_number", "_values.*")


def owner_cc(t: Tables) -> DataFrame:
    """Name and address of everyone in copy, per owner; the last entry of a name wins.

    The copy list of an owner is a function named after the owner's employee
    number, in any case. Entries are reduced to one per function and person
    before they are joined to anything.
    """
    lists = report_owners(t).select(
        "bdm_id", F.lower(F.concat(F.lit(CC_FUNCTION_PREFIX), "employee_number")).alias("list_name")
    )
    functions = t.function_names.select(
        F.col("id").alias("function_id"), F.lower("name").alias("list_name")
    )
    entries = (
        t.general_approvers.filter(F.col("status") == 1)
        .groupBy("function_id", F.col("employee_id").alias("employee_number"))
        .agg(F.max("id").alias("entry_id"))
    )
    staff = _staff_by_number(t, "first_name", "last_name", "work_email_address")
    name = F.coalesce(person_name(F.col("first_name"), F.col("last_name")), F.lit(""))
    return (
        entries.join(functions, "function_id")
        .join(lists, "list_name")
        .join(staff, "employee_number")
        .filter(F.col("work_email_address").isNotNull())
        .groupBy("bdm_id", name.alias("cc_name"))
        .agg(F.max_by("work_email_address", "entry_id").alias("cc_email"))
    )


def recipients_by_type(
    t: Tables,
    types: str | Sequence[str] = RECIPIENT_TYPES,
    function_id: int | None = None,
    structure_id: int | None = None,
) -> DataFrame:
    """Mail addresses per function and kind, with how often each is configured.

    One row per address, not one list per function, so that a function with very
    many entries is no single row. ``greeting`` is the first name of the last
    ``to`` entry.
    """
    wanted = [types] if isinstance(types, str) else list(types)
    predicates = [F.col("mail_to_type").isin(*wanted)]
    if function_id is not None:
        predicates.append(F.col("function_id") == function_id)
    if structure_id is not None:
        predicates.append(F.col("structure_id") == structure_id)
    entries = (
        t.mail_configurations.filter(all_of(predicates))
        .groupBy("function_id", "mail_to_type", F.col("employee_id").alias("employee_number"))
        .agg(F.count(F.lit(1)).alias("entries"), F.max("id").alias("entry_id"))
        .join(_staff_by_number(t, "first_name", "work_email_address"), "employee_number")
    )
    greetings = (
        entries.filter(F.col("mail_to_type") == "to")
        .groupBy("function_id")
        .agg(F.max_by("first_name", "entry_id").alias("greeting"))
    )
    return (
        entries.groupBy("function_id", "mail_to_type", F.col("work_email_address").alias("email"))
        .agg(F.sum("entries").alias("entries"))
        .join(greetings, "function_id", "left")
    )


def recipient_lists(recipients: DataFrame, most: int = 1000) -> DataFrame:
    """The distinct addresses of each function as sorted lists, for a sink that wants them so.

    Lists come in numbered parts (from 0) of at most ``most`` addresses of each kind, so that no row holds a function
    with very many entries. Addresses are ranked over ranges of them, and no task orders a whole function.
    """
    kind = F.col("mail_to_type")
    rows = recipients.select("function_id", "greeting", "mail_to_type", "email")
    # No address comes last and fills no place of a list.
    ordered = rows.withColumn("missing", F.col("email").isNull())
    ranked = with_rank(ordered, ["function_id", "mail_to_type"], ["missing", "email"])
    parts = ranked.withColumn("part", F.floor(F.col("rank") / most))
    return parts.groupBy("function_id", "greeting", "part").agg(
        *[F.array_sort(F.collect_list(F.when(kind == name, F.col("email")))).alias(f"{name}_list") for name in RECIPIENT_TYPES]
    )


def config_map(t: Tables) -> DataFrame:
    """Key and value of every configuration group; the last entry of a key wins."""
    rows = t.configuration_values
    parents = rows.select(F.col("id").alias("parent_id"), F.col("configuration_key").alias("parent_key"))
    # Entries come down to the last of each parent and key before they meet their parent, and again
    # for parents of one name. Only numbers are grouped; the values of the winners are fetched by id.
    last = rows.filter("parent_id is not null").groupBy("parent_id", "configuration_key").agg(F.max("id").alias("id"))
    winners = last.join(parents, "parent_id").groupBy("parent_key", "configuration_key").agg(F.max("id").alias("id"))
    return winners.join(rows.select("id", "configuration_value"), "id").drop("id")


def config_map_merged(t: Tables) -> DataFrame:
    """The report's own settings, over which host and port of the mail server are laid."""
    settings = config_map(t)
    of_server = (F.col("parent_key") == SERVER_CONFIG_PARENT) & F.col("configuration_key").isin(*SERVER_CONFIG_KEYS)
    layered = settings.filter((F.col("parent_key") == REPORT_CONFIG_PARENT) | of_server)
    return (
        layered.groupBy("configuration_key")
        .agg(F.max_by(F.struct("configuration_value"), of_server.cast("int")).alias("last"))
        .select("configuration_key", "last.configuration_value")
    )


def config_lookup(t: Tables) -> DataFrame:
    """Job name -> its function id and its schedule id, the lowest of each."""
    functions = (
        t.function_names.filter(F.col("type") == CRON_TYPE)
        .groupBy("name")
        .agg(F.min("id").alias("function_id"))
    )
    schedules = (
        t.schedules.filter(F.col("status") == 1).groupBy("name").agg(F.min("id").alias("schedule_id"))
    )
    return functions.join(schedules, "name", "full")
