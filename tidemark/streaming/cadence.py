"""When jobs run; an outer scheduler reads this."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Job:
    name: str
    every_seconds: int | None = None
    daily_at: str | None = None
    enabled: bool = True


# The cadence of the jobs.
JOBS = (
    Job("ship", every_seconds=60),
    Job("incremental", every_seconds=900),
    Job("migration", every_seconds=1800, enabled=False),
    Job("backfill", every_seconds=1800, enabled=False),
    Job("attendance", every_seconds=1800, enabled=False),
    Job("discovery", daily_at="02:50"),
    Job("full_snapshot", daily_at="03:00"),
)


def due(job: Job, now: int, last: int | None) -> bool:
    """Whether a job that last ran at an epoch second (UTC) is to run."""
    if not job.enabled:
        return False
    if job.every_seconds is not None:
        return last is None or now - last >= job.every_seconds
    hour, minute = map(int, job.daily_at.split(":"))
    slot = now - now % 86_400 + hour * 3600 + minute * 60
    slot = slot if slot <= now else slot - 86_400
    return last is None or last < slot
