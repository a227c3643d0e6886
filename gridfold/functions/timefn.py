"""Times as exact nanoseconds in BIGINT; Spark's own timestamps end at microseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = {"s": 1_000_000_000, "ms": 1_000_000, "us": 1_000, "ns": 1}
HOUR_NS = 3_600 * UNITS["s"]


def epoch_to_ns(value: Column, unit: str) -> Column:
    return value.cast("long") * F.lit(UNITS[unit])


def iso_to_timestamp(text: Column) -> Column:
    """ISO text with an offset; text without one is null."""
    return F.when(text.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), F.try_to_timestamp(text))


def held_ns(ts: Column) -> Column:
    """A timestamp's nanoseconds; null before 1677 and after 2262, where BIGINT doesn't hold them."""
    return F.try_multiply(F.unix_micros(ts), F.lit(1_000))


def iso_to_ns(text: Column) -> Column:
    """ISO text with an offset; text without one, or of a time beyond BIGINT, is null."""
    return held_ns(iso_to_timestamp(text))


def utc_to_ns(text: Column) -> Column:
    """ISO text in UTC itself (Z, or an offset of nothing); any other text is null."""
    return F.when(text.rlike(r"(Z|[+-]00:?00)$"), iso_to_ns(text))


def ns_to_iso(ns: Column) -> Column:
    at = F.timestamp_micros(((ns - F.pmod(ns, F.lit(UNITS["s"]))) / 1_000).cast("long"))
    return F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("."), F.lpad(F.pmod(ns, F.lit(UNITS["s"])).cast("string"), 9, "0"), F.lit("Z"))


def timestamp_ns(ts: Column, compat_float_ns: bool = False) -> Column:
    """Exact; or, on request, as it comes out where seconds are held in a double."""
    if compat_float_ns:
        return (F.unix_micros(ts).cast("double") / 1e6 * 1e9).cast("long")
    return F.unix_micros(ts) * 1_000


def half_month(day: Column) -> Column:
    return F.concat(F.date_format(day, "yyyy-MM"), F.when(F.dayofmonth(day) <= 15, "-a").otherwise("-b"))


def file_hour_ns(name: Column) -> Column:
    """The hour that a file's name ends in (``..._2026-05-01T07.parquet``), as nanoseconds."""
    hour = F.regexp_extract(name, r"_(\d{4}-\d{2}-\d{2}T\d{2})\.parquet$", 1)
    return F.unix_micros(F.try_to_timestamp(F.concat(hour, F.lit(":00:00Z")))) * 1_000
