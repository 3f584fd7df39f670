"""Dates, times and numbers as people of a place write them.

Spark's record parser knows patterns with a locale; a text is a record of one field, so that all is
parsed and formatted in the JVM by tables made once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A delimiter that no text holds, and no quotes.
_ONE = {"sep": "\u0001", "quote": "\u0002", "escape": "\u0003", "mode": "PERMISSIVE"}


def _parsed(text: Column, kind: str, options: dict[str, str]) -> Column:
    return F.from_csv(F.when(F.trim(text) != "", F.trim(text)), f"v {kind}", _ONE | options)["v"]


def date(text: Column, pattern: str, locale: str) -> Column:
    """A date such as `14 février 2020` by `d MMMM yyyy` in `fr-FR`; null for any other text."""
    return _parsed(text, "date", {"dateFormat": pattern, "locale": locale})


def timestamp(text: Column, pattern: str, locale: str, time_zone: str = "UTC") -> Column:
    return _parsed(text, "timestamp", {"timestampFormat": pattern, "locale": locale, "timeZone": time_zone})


def number(text: Column, locale: str, kind: str = "decimal(38,10)") -> Column:
    """A decimal with the marks of the locale, such as `1.234,5` in `de-DE`; null for any other text."""
    # blanks between thousands, as in French, may be any of three
    t = F.regexp_replace(F.trim(text), "[   ](?=[0-9]{3})", " " if locale.lower().startswith("fr") else " ")
    return _parsed(t, kind, {"locale": locale})


def format_date(value: Column, pattern: str, locale: str) -> Column:
    return F.when(value.isNotNull(), F.to_csv(F.struct(value.alias("v")), _ONE | {"dateFormat": pattern, "locale": locale}))


def format_timestamp(value: Column, pattern: str, locale: str, time_zone: str = "UTC") -> Column:
    return F.when(value.isNotNull(), F.to_csv(F.struct(value.alias("v")), _ONE | {"timestampFormat": pattern, "locale": locale, "timeZone": time_zone}))
