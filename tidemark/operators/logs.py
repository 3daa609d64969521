"""Logs and exceptions: filters, classification, paging."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text

# Names of events that an administrator's actions have, as LIKE patterns; "_" stands for itself.
ADMIN_ACTIONS = (
    r"\core\event\role_%",
    r"\core\event\plugin_%",
    r"\core\event\config_log_created",
    r"\core\event\user_created",
    r"\core\event\user_updated",
    r"\core\event\user_deleted",
    r"\core\event\user_password_updated",
    r"\core\event\user_loggedinas",
    r"\core\event\course_created",
    r"\core\event\course_updated",
    r"\core\event\course_deleted",
    r"\core\event\course_restored",
    r"\core\event\course_backup_created",
    r"\core\event\course_category_%",
)
DEFAULT_MESSAGE = "Web service exception"


def like_pattern(name: str) -> str:
    """A pattern in which only % is special."""
    return name.replace("\\", "\\\\").replace("_", "\\_")


def is_admin_action(event: Column) -> Column:
    return reduce(lambda a, b: a | b, [event.like(like_pattern(p)) for p in ADMIN_ACTIONS])


def without_admins(events: DataFrame, admins: str, track: bool = False, user: str = "userid") -> DataFrame:
    """Events of others than the comma-separated administrators, where these aren't tracked."""
    ids = [int(x) for x in admins.split(",") if x.strip().isdigit() and int(x) > 0]
    return events if track or not ids else events.where(~F.coalesce(F.col(user).isin(*ids), F.lit(False)))


def exceptions(events: DataFrame, other: str = "other") -> DataFrame:
    """Events whose JSON `other` has an exception, with its message: that of an object, or the text itself."""
    found = F.get_json_object(other, "$.exception")
    message = F.get_json_object(other, "$.exception.message")
    is_object = F.startswith(found, F.lit("{")) | F.startswith(found, F.lit("["))
    said = F.when(is_object, F.when(~text.is_empty(message), message)).otherwise(found)
    return events.where(~text.is_empty(found)).withColumn("error_message", text.cut_bytes(F.coalesce(said, F.lit(DEFAULT_MESSAGE)), 4096))


def switched_on(rows: DataFrame, switches: DataFrame, datatype: str = "datatype") -> DataFrame:
    """Rows whose datatype isn't switched off; without a switch it is on."""
    s = switches.select(F.col("datatype").alias("_d"), F.col("enabled").alias("_e"))
    return rows.join(s, F.col(datatype) == F.col("_d"), "left").where(F.coalesce("_e", F.lit(1)) != 0).drop("_d", "_e")


def scoped_completions(events: DataFrame) -> DataFrame:
    return events.where("courseid > 0 AND relateduserid > 0")


def filtered(log: DataFrame, **equal: str | None) -> DataFrame:
    """Equality on whichever of type, datatype and action is given."""
    for column, value in equal.items():
        if value:
            log = log.where(F.col(column) == value)
    return log


def page(rows: DataFrame, key: str, number: int, size: int = 100) -> DataFrame:
    """Page `number` (from 0), the highest keys first."""
    return rows.orderBy(F.desc(key)).offset(number * size).limit(size)


def pending(tasks: DataFrame, started: str = "timestarted") -> DataFrame:
    return tasks.agg(F.count_if(F.col(started).isNull()).alias("pending"))


def is_cron_field(value: Column) -> Column:
    return value.rlike(r"^[0-9*,\/-]+$")
