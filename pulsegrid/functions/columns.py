"""Column expressions: event time, stamps, rounding, hash uniforms."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MICROS = 1_000_000

#: Digits kept of the two computed features, so that the order of a floating-point sum
#: cannot change a tree split.
FEATURE_DIGITS = 9


def epoch_to_timestamp(seconds: Column) -> Column:
    """Unix epoch seconds (double) to a timestamp, to the microsecond; null where none fits."""
    return F.timestamp_micros(F.round(seconds * F.lit(float(MICROS))).try_cast("bigint"))


def timestamp_to_epoch(ts: Column) -> Column:
    return F.unix_micros(ts).cast("double") / F.lit(float(MICROS))


def iso_stamp(ts: Column) -> Column:
    """ISO-8601 UTC, cut to whole seconds, whatever the session's time zone."""
    second = F.pmod(F.floor(F.unix_micros(ts) / MICROS), F.lit(86_400))
    clock = [second / 3600, second / 60 % 60, second % 60]
    parts = [F.lpad(F.floor(part).cast("string"), 2, "0") for part in clock]
    return F.concat(utc_date(ts).cast("string"), F.lit("T"), F.concat_ws(":", *parts), F.lit("Z"))


def utc_date(ts: Column) -> Column:
    """The UTC day of a timestamp, whatever the session's time zone."""
    days = F.floor(F.unix_micros(ts) / (86_400 * MICROS)).cast("int")
    return F.date_add(F.to_date(F.lit("1970-01-01")), days)


def utc_stamp(text: str) -> Column:
    """A timestamp from text without a zone, taken as UTC."""
    return F.lit(f"{text} UTC").cast("timestamp")


def settle_sql(value: str, digits: int = FEATURE_DIGITS) -> str:
    """SQL text of :func:`settle`."""
    return f"(bround({value}, {digits}) + 0.0D)"


def settle(value: Column, digits: int = FEATURE_DIGITS) -> Column:
    """Round half-even and turn a negative zero into zero."""
    return F.bround(value, digits) + F.lit(0.0)


def mode_label(mode: Column) -> Column:
    """Anomaly label: trimmed, lower case, ``normal`` when empty or missing."""
    return F.coalesce(F.nullif(F.lower(F.trim(mode)), F.lit("")), F.lit("normal"))


def uniform_sql(*tag: object) -> str:
    """SQL text of :func:`uniform`."""
    text = f"concat_ws('|', {', '.join(map(str, tag))})"
    return f"(double(bigint(conv(substring(md5({text}), 1, 13), 16, 10))) / {float(2**52)!r}D)"


def uniform(*tag: object) -> Column:
    """A uniform number in [0, 1) that depends only on the tag: 52 bits of its MD5.

    Unlike ``rand`` it is the same on every run, plan and partitioning, so a retried task
    draws what the lost one drew. The parts of a tag are numbers or SQL expressions.
    """
    return F.expr(uniform_sql(*tag))


def nearest_rank_sql(percent: float, count: str) -> str:
    """1-based rank of the nearest-rank percentile among ``count`` sorted values."""
    return f"greatest(1L, ceil({percent / 100.0!r}D * {count}))"


def value_grid_sql(value: str, cells_per_e_fold: int) -> str:
    """Number of the logarithmic cell of a value; never decreases as the value grows.

    A double spans 709 e-folds, so there are at most ``2 * 710 * cells_per_e_fold`` cells
    whatever the data holds.
    """
    return f"bigint(signum({value}) * floor(log1p(abs({value})) * {float(cells_per_e_fold)!r}D))"
