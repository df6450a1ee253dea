"""Display expressions used by the dashboard marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Display formats and lengths.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DAY_FORMAT = "yyyy-MM-dd"
SNIPPET_CHARS = 200
PREVIEW_CHARS = 100


def percent(part: Column, total: Column) -> Column:
    """Share in percent with one decimal, half up, in integer arithmetic; 0 when the total is 0."""
    part, total = part.cast("bigint"), total.cast("bigint")
    tenths = F.call_function("div", part * 2000 + total, total * 2)
    return F.when(total > 0, tenths / F.lit(10.0)).otherwise(F.lit(0.0))


def snippet(text: Column, chars: int = SNIPPET_CHARS) -> Column:
    shortened = F.concat(F.substring(text, 1, chars), F.lit("..."))
    return F.when(F.length(text) > chars, shortened).otherwise(text)


def preview(text: Column, chars: int = PREVIEW_CHARS) -> Column:
    return F.substring(F.coalesce(text, F.lit("")), 1, chars)


def or_not_available(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("N/A"))


def display_time(moment: Column, missing: str = "Unknown") -> Column:
    return F.coalesce(F.date_format(moment, TIME_FORMAT), F.lit(missing))


def display_day(moment: Column) -> Column:
    return F.date_format(moment, DAY_FORMAT)
