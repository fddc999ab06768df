"""Text helpers for searches, previews and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from logweir.settings import ERROR_SEVERITIES, PREVIEW_CHARS


def contains_ignore_case(columns: Sequence[str], term: str | None) -> Column:
    """Literal (not regex) case-insensitive substring test on the space-joined columns."""
    if not term:
        return F.lit(True)
    haystack = F.lower(F.concat_ws(" ", *[F.col(c).cast("string") for c in columns]))
    return haystack.contains(term.lower())


def preview(column: Column, chars: int = PREVIEW_CHARS) -> Column:
    return F.left(column, F.lit(chars))


def is_error(severity: Column) -> Column:
    return severity.isin(*ERROR_SEVERITIES)


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text with milliseconds and an explicit offset."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSxxx")


def clock_label(ts: Column) -> Column:
    """Axis label HH:mm."""
    return F.date_format(ts, "HH:mm")
