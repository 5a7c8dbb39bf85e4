"""Column helpers that keep the row-wise meaning of data-frame arithmetic in Spark SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

DAY_MICROS = 86_400_000_000


def clock_micros(ts: str) -> Column:
    """Microseconds of a zone-free time since 1970; no step of it looks at the session zone."""
    return F.expr(f"unix_date(to_date({ts})) * {DAY_MICROS} + (hour({ts}) * 3600 + minute({ts}) * 60) * 1000000L "
                  f"+ cast(extract(SECOND FROM {ts}) * 1000000 AS bigint)")


def floor_days(start: str, end: str) -> Column:
    """Whole elapsed days from start to end, floored toward minus infinity (not calendar days)."""
    return F.floor((clock_micros(end) - clock_micros(start)) / DAY_MICROS).cast("bigint")


def sum0(c) -> Column:
    """Sum that is 0 when every input is null."""
    return F.coalesce(F.sum(c), F.lit(0.0))


def share_true(cond: Column) -> Column:
    """Mean of a condition where null counts as false."""
    return F.avg(F.when(cond, F.lit(1.0).cast("double")).otherwise(F.lit(0.0).cast("double")))


def count_true(cond: Column) -> Column:
    return F.coalesce(F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))), F.lit(0)).cast("bigint")


def ratio(num, den, default=None) -> Column:
    """num/den, or ``default`` where the denominator is zero or null."""
    num, den = F.col(num) if isinstance(num, str) else num, F.col(den) if isinstance(den, str) else den
    out = F.try_divide(num.cast("double"), den.cast("double"))
    return out if default is None else F.coalesce(out, F.lit(float(default)))


def clamp(c: Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def sigmoid(c: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-c))


def order_hash(id_col, seed: int = 42, use: str = "split") -> Column:
    """Hex digest of seed, use and id: a reproducible random order that every engine can compute. Each seed and each use gives another order."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}:{use}:"), c.cast("string")))


def hash_number(id_col, seed: int = 42, use: str = "split", digits: int = 13) -> Column:
    """The leading hex digits of the order as an integer (52 bits by default)."""
    return F.conv(F.substring(order_hash(id_col, seed, use), 1, digits), 16, 10).cast("bigint")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """L2-normalised array; a zero vector stays as it is."""
    n = norm(a)
    return F.transform(a, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(x.cast("double")))


def any_of(conds: list[Column]) -> Column:
    return reduce(lambda x, y: x | y, conds)


def as_instant(ts: str) -> Column:
    """Zone-free time as the same clock time in UTC, whatever the session zone; event time needs an instant."""
    return F.timestamp_micros(clock_micros(ts))


def as_clock(ts: str) -> Column:
    """The UTC clock time of an instant, without a zone."""
    return F.expr(f"timestampadd(MICROSECOND, unix_micros({ts}), TIMESTAMP_NTZ '1970-01-01 00:00:00')")
