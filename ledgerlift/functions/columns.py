"""Column-level helpers (all JVM-side built-ins, no Python UDFs)."""

from __future__ import annotations

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values the detections must carry.
PATTERN_ID = "PatId1"
ACTION_TYPE = "UPGRADE"
DETECTION_TIMEZONE = "Asia/Kolkata"
DETECTION_TIME_FORMAT = "%Y-%m-%d %H:%M:%S"
DEFAULT_WEIGHT = 1.0


def detection_time_string(now: datetime | None = None) -> str:
    """Wall clock of the run in the detection time zone, as ``yyyy-MM-dd HH:mm:ss``.

    Taken once per batch on the driver, so every row of a batch carries the
    same value.  Pass ``now`` (or a ready string to the plans) for
    reproducible output.
    """
    now = now or datetime.now(ZoneInfo(DETECTION_TIMEZONE))
    if now.tzinfo is None:
        now = now.replace(tzinfo=ZoneInfo("UTC"))
    return now.astimezone(ZoneInfo(DETECTION_TIMEZONE)).strftime(DETECTION_TIME_FORMAT)


def weight_or_default(col: str | Column, default: float = DEFAULT_WEIGHT) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit(float(default)))


def ceil_div(num: str | Column, den: str | Column | int) -> Column:
    """Integer ceiling division for non-negative operands."""
    n = F.col(num) if isinstance(num, str) else num
    d = F.lit(den) if isinstance(den, int) else (F.col(den) if isinstance(den, str) else den)
    return F.floor((n + d - F.lit(1)) / d).cast("long")


def percent_of(part: str | Column, whole: str | Column, digits: int = 1) -> Column:
    p = F.col(part) if isinstance(part, str) else part
    w = F.col(whole) if isinstance(whole, str) else whole
    return F.round(p.cast("double") / w.cast("double") * F.lit(100.0), digits)


def name_contains(path_col: str | Column, needle: str) -> Column:
    """Case-insensitive substring test on a file name."""
    c = F.col(path_col) if isinstance(path_col, str) else path_col
    return F.lower(c).contains(needle.lower())
