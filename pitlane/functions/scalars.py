"""Scalar column functions. All are JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm_status(c: Column) -> Column:
    """Canonical state value -- trimmed, lower case."""
    return F.lower(F.trim(c))


def parse_duration(c: Column) -> Column:
    """B7: 'MM:SS' -> minutes + seconds/60; a number -> itself; NULL/garbage -> 0.0."""
    s = F.trim(c.cast("string"))
    parts = F.split(s, ":")
    mins = F.try_element_at(parts, F.lit(1)).try_cast("double")
    secs = F.try_element_at(parts, F.lit(2)).try_cast("double")
    val = F.when(F.size(parts) == 2, mins + secs / 60.0).when(F.size(parts) == 1, s.try_cast("double"))
    return F.coalesce(val, F.lit(0.0))


def safe_int(c: Column) -> Column:
    """int(float(x)) or NULL: parse as double, truncate toward zero (BIGINT; NULL beyond it)."""
    d = c.cast("string").try_cast("double")
    return F.when(d.isNotNull() & ~F.isnan(d) & (F.abs(d) < 9223372036854775808.0), d.cast("long"))


def season_start_year(d: Column, cutover_month: int = 10) -> Column:
    """Season starting year with an October cut-over."""
    return F.when(F.month(d) >= cutover_month, F.year(d)).otherwise(F.year(d) - 1)


def season_label(start_year: Column) -> Column:
    """Label 'YYYY-YY' from a start year."""
    return F.concat(start_year.cast("string"), F.lit("-"), F.lpad(((start_year + 1) % 100).cast("string"), 2, "0"))


def season_label_start(label: Column) -> Column:
    return F.substring(label, 1, 4).try_cast("int")


def season_label_finish(label: Column) -> Column:
    """Finish year from 'YYYY-YY': century of the start year, rolled over at 99->00."""
    start = season_label_start(label)
    yy = F.substring(label, 6, 2).try_cast("int")
    fin = F.floor(start / 100).cast("int") * 100 + yy
    return F.when(fin < start, fin + 100).otherwise(fin)


def business_date(ts_utc: Column, tz: str = "America/New_York", cutoff_hour: int = 4) -> Column:
    """UTC instant -> local calendar date, where the day starts at `cutoff_hour`.
    The input is read as a UTC wall-clock value (TIMESTAMP_NTZ), so the result
    does not depend on the session time zone."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), ts_utc.cast("timestamp_ntz"))
    return F.to_date(local - F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(cutoff_hour)))


def dow_sun0(d: Column) -> Column:
    """V9: day of week with Sunday = 0 (Spark's dayofweek is 1-based)."""
    return F.dayofweek(d) - 1


def fold_of(key: Column, k: int = 5) -> Column:
    """Frozen fold from md5 of the key text: first 8 hex digits mod k.
    Same value in DuckDB: CAST(('0x' || substr(md5(CAST(key AS VARCHAR)), 1, 8)) AS BIGINT) % k."""
    return (F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % k).cast("int")


def hash_unit(key: Column) -> Column:
    """Deterministic pseudo-random order key from md5 (same in DuckDB)."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")


def percent_text(x: Column, digits: int = 1) -> Column:
    """'%.1f%%' text with Python's half-even rounding (Java's formatter rounds half up)."""
    return F.when(x.isNotNull(), F.format_string(f"%.{digits}f%%", F.bround(x, digits)))


def round_half_even_binary(x: Column, digits: int = 0) -> Column:
    """Round the way numpy / pandas `.round(d)` does: rint(x * 10^d) / 10^d on
    the binary double (Spark's `round` rounds the decimal text half up)."""
    f = float(10 ** digits)
    return F.rint(x * f) / f
