"""Which batch files a run reads: the requested window, its 15-minute boundaries, the file's address."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from urllib.parse import urlparse

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
STEP_MINUTES, LOOKBACK_MINUTES, MAX_FILES = 15, 60, 4
FILE_NAME = re.compile(r"\d{14}\.gkg\.csv\.zip")


@dataclass(frozen=True)
class Window:
    start: datetime
    end: datetime


def parse_instant(text: str) -> datetime:
    found = datetime.fromisoformat(text.replace("Z", "+00:00"))
    return found.replace(tzinfo=timezone.utc) if found.tzinfo is None else found.astimezone(timezone.utc)


def rolling_window(now: datetime) -> Window:
    return Window(now - timedelta(minutes=LOOKBACK_MINUTES), now)


def requested_window(start: str | None, end: str | None, now: datetime, deployed: bool = False) -> Window:
    """The interval asked for, or the last hour; a deployed run's stale zero-width interval gives the last hour too."""
    if not (start and end):
        return rolling_window(now)
    window = Window(parse_instant(start), parse_instant(end))
    if window.start > window.end:
        raise ValueError("the window's start must not be after its end")
    stale = now - window.end >= timedelta(minutes=STEP_MINUTES)
    return rolling_window(now) if deployed and window.start == window.end and stale else window


def floor_to_step(c: Column) -> Column:
    """The 15-minute boundary at or before a timestamp column."""
    return c - F.make_dt_interval(F.lit(0), F.lit(0), F.minute(c) % STEP_MINUTES, F.date_part(F.lit("SECOND"), c))


def batch_times(start: Column, end: Column, max_files: int = MAX_FILES) -> Column:
    """Array of the boundaries from start to end, both included; the last ``max_files`` of them, all if it isn't positive."""
    every = F.sequence(floor_to_step(start), floor_to_step(end), F.expr(f"INTERVAL {STEP_MINUTES} MINUTES"))
    return F.slice(every, F.greatest(F.size(every) - max_files + 1, F.lit(1)), max_files) if max_files > 0 else every


def select_batches(window: Window, max_files: int = MAX_FILES) -> list[datetime]:
    """The same on the driver."""
    step = timedelta(minutes=STEP_MINUTES)
    floor = lambda t: t.replace(minute=t.minute - t.minute % STEP_MINUTES, second=0, microsecond=0)
    first, last = floor(window.start), floor(window.end)
    found = [first + k * step for k in range((last - first) // step + 1)]
    return found[-max_files:] if max_files > 0 else found


def normal_host(netloc: str) -> str:
    return re.sub(r":\d+$", "", netloc.lower().strip()).rstrip(".")


def file_name(batch: datetime) -> str:
    return f"{batch:%Y%m%d%H%M%S}.gkg.csv.zip"


def batch_url(base_url: str, batch: datetime, allowed_host: str | None = None) -> str:
    """The address of a batch file; ``allowed_host`` is the only host that deployed runs may read from."""
    base = base_url.rstrip("/")
    parts = urlparse(base)
    host = normal_host(parts.netloc)
    if not parts.scheme or not host:
        raise ValueError("the base URL must be absolute and have a host")
    if allowed_host is not None and host != allowed_host:
        raise ValueError(f"host {host!r} is not allowed, only {allowed_host!r}")
    return f"{base}/{file_name(batch)}"


def check_download_url(url: str, batch: datetime, allowed_host: str) -> None:
    """Before the request and again after redirects: host and file name are the expected ones."""
    parts = urlparse(url)
    host, name = normal_host(parts.netloc), parts.path.rpartition("/")[2]
    if host != allowed_host:
        raise ValueError(f"download host {host or '<missing>'!r} is not {allowed_host!r}")
    if not FILE_NAME.fullmatch(name):
        raise ValueError(f"download file name {name!r} is not one of a batch file")
    if name != file_name(batch):
        raise ValueError(f"download file name {name!r} is not that of the batch, {file_name(batch)!r}")
