"""Small vocabularies: page kinds, states of a run, answers of the store, stale files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Context levels.
SYSTEM, USER, CATEGORY, COURSE, MODULE = 10, 30, 40, 50, 70
PAGES = ("course", "module", "user", "site", "other")
MEDIA = ("video", "audio")
IDLE_SECONDS = 120


def page_kind(level: Column) -> Column:
    return F.when(level == MODULE, "module").when(level == COURSE, "course").when(level == USER, "user").when(level.isin(SYSTEM, CATEGORY), "site").otherwise("other")


def run_class(state: Column, dropped: Column) -> Column:
    """Dropped data outranks everything; then no run yet; then whatever isn't ok."""
    return F.when(dropped > 0, "problem").when(F.coalesce(state, F.lit("")).isin("", "unknown"), "norun").when(state == "ok", "healthy").otherwise("problem")


def store_answer(status: Column, body: Column) -> Column:
    quota = F.lower(body).contains("quota") | F.lower(body).contains("slowdown")
    return F.when(status == 403, "s3_credential_invalid").when(status == 429, "s3_quota_exceeded").when(status >= 500, "s3_5xx").when(quota, "s3_quota_exceeded").otherwise("s3_other_4xx")


def stale_class(name: Column, parsed: Column, idle: Column, alive: Column, host: str, rotate_age: int = 120) -> Column:
    """unowned, stale or active. Another host's file, or one of unknown origin, is left alone for longer."""
    remote = max(IDLE_SECONDS, rotate_age + 60)
    own = F.coalesce(parsed["hostid"] == host, F.lit(False))
    gone = F.when(own, ~alive | (idle >= IDLE_SECONDS)).otherwise(idle >= remote)
    return F.when(parsed.isNull() & ~F.startswith(name, F.lit("events-")), "unowned").when(gone, "stale").otherwise("active")


def must_rotate(size: Column, age: Column, most_bytes: int = 64 << 20, most_age: int = 120) -> Column:
    return (size >= most_bytes) | (age >= max(1, most_age))
