"""Date and time texts of the station site."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Page time texts accepted by ``parse_page_time`` (tried in order). The site
# shows readings as "Jan 04, 2024 10:15"; the others are common exports.
PAGE_TIME_FORMATS = [
    "MMM d, yyyy H:m:s",
    "MMM d, yyyy H:m",
    "MMM d, yyyy h:m:s a",
    "MMM d, yyyy h:m a",
    "yyyy-MM-dd H:m:s",
    "yyyy-MM-dd H:m",
    "yyyy-MM-dd'T'H:m:s",
    "yyyy/MM/dd H:m:s",
    "yyyy/MM/dd H:m",
    "M/d/yyyy H:m:s",
    "M/d/yyyy H:m",
    "M/d/yyyy h:m a",
    "yyyy-MM-dd",
]

# Site date-range texts: 12-hour first, then 24-hour (same order as strptime
# attempts of the original); output "yyyy/MM/dd HH:mm".
SITE_DATE_PATTERNS = ["MMM d, yyyy h:m a", "MMM d, yyyy H:m"]
SITE_DATE_OUT = "yyyy/MM/dd HH:mm"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_page_time(text, formats: list[str] | None = None) -> Column:
    """Timestamp from a page time text, or null when no format fits."""
    t = F.trim(_c(text))
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in (formats or PAGE_TIME_FORMATS)])


def split_timestamp(ts) -> tuple[Column, Column]:
    """(Date, Time) of a timestamp: a date and an ``HH:mm:ss`` text."""
    ts = _c(ts)
    return F.to_date(ts), F.date_format(ts, "HH:mm:ss")


def parse_site_date(text) -> Column:
    """``yyyy/MM/dd HH:mm`` text of a site date, or null if neither format fits."""
    t = _c(text)
    parsed = F.coalesce(*[F.try_to_timestamp(t, F.lit(p)) for p in SITE_DATE_PATTERNS])
    return F.date_format(parsed, SITE_DATE_OUT)


def picker_text(day) -> Column:
    """Date picker text ``MMM dd, yyyy 00:00`` of a date column."""
    return F.concat(F.date_format(_c(day), "MMM dd, yyyy"), F.lit(" 00:00"))
