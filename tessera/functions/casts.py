"""Lenient casts: bad text becomes null while ANSI mode stays on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_double(value: Column | str) -> Column:
    return _col(value).try_cast("double")


def to_long(value: Column | str) -> Column:
    return _col(value).try_cast("bigint")


def to_whole_long(value: Column | str) -> Column:
    """Text to bigint, truncating decimals without losing digits of long ids."""
    return F.coalesce(to_long(value), _col(value).try_cast("decimal(38,10)").try_cast("bigint"))


def to_int(value: Column | str) -> Column:
    """Text to int by way of double: "3.0" is 3, which a direct try_cast refuses."""
    return to_double(value).try_cast("int")


def to_date(value: Column | str) -> Column:
    return _col(value).try_cast("date")


def iso_millis_to_date(value: Column | str) -> Column:
    """Date of a text like 2024-05-06T23:59:59.000; any other form gives null.

    The cast parses without a pattern object and needs no time zone; the test in front
    of it keeps out the shorter forms that the cast alone would take.
    """
    exact = _col(value).rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}$")
    return F.when(exact, _col(value).try_cast("timestamp_ntz").cast("date"))


def flag(value: Column | str) -> Column:
    """"t" is true, any other text false, null stays null."""
    return _col(value) == F.lit("t")


def percent(value: Column | str) -> Column:
    return to_double(F.regexp_replace(_col(value), "%", ""))


def first_number(value: Column | str) -> Column:
    """First run of digits and dots in the text; null when there is none."""
    return to_double(F.nullif(F.regexp_extract(_col(value), r"([\d.]+)", 1), F.lit("")))
