"""Run windows of the periodic jobs: ``now`` is an argument, so runs repeat."""

from __future__ import annotations

from datetime import datetime, timedelta

DAY = "%Y-%m-%d"


def day_window(now: datetime, first: int = -1, last: int = 0) -> tuple[datetime, datetime]:
    """Midnight ``first`` days from now to midnight ``last`` days from now."""
    midnight = now.replace(hour=0, minute=0, second=0, microsecond=0)
    return midnight + timedelta(days=first), midnight + timedelta(days=last)


def last_hour(now: datetime) -> tuple[datetime, datetime]:
    """The whole hour before the current one."""
    top = now.replace(minute=0, second=0, microsecond=0)
    return top - timedelta(hours=1), top


def run_window(now: datetime, job: str, start: str | None = None, end: str | None = None) -> tuple[datetime, datetime]:
    """Default window of a job kind, overridden by explicit bounds."""
    lo, hi = {
        "day": lambda: day_window(now),
        "hour": lambda: last_hour(now),
        "month": lambda: day_window(now, -31, 0),
        "week": lambda: day_window(now, -8, -2),
    }[job]()
    return (datetime.fromisoformat(start) if start else lo, datetime.fromisoformat(end) if end else hi)


def day_folder(day: datetime) -> str:
    """Name of a daily directory: the day and the day after."""
    return f"{day.strftime(DAY)}--{(day + timedelta(days=1)).strftime(DAY)}"
