"""Guarded column expressions: null, zero and constant inputs have one stated result."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(x: ColumnLike | float | int) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(x)


def safe_div(a: ColumnLike | float, b: ColumnLike | float) -> Column:
    """a / b as double; null for a zero or null divisor."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def null_if_zero(x: ColumnLike) -> Column:
    return F.nullif(col(x), F.lit(0.0))


def strict_greatest(*xs: ColumnLike | float) -> Column:
    """Largest argument; null if any argument is null."""
    cs = [col(x) for x in xs]
    return F.when(reduce(lambda a, b: a & b, [c.isNotNull() for c in cs]), F.greatest(*cs))


def strict_least(*xs: ColumnLike | float) -> Column:
    """Smallest argument; null if any argument is null."""
    cs = [col(x) for x in xs]
    return F.when(reduce(lambda a, b: a & b, [c.isNotNull() for c in cs]), F.least(*cs))


def clip(x: ColumnLike, low: float, high: float) -> Column:
    """x held to [low, high]; null stays null."""
    return strict_least(strict_greatest(x, F.lit(float(low))), F.lit(float(high)))


def safe_ln(x: ColumnLike) -> Column:
    """Natural logarithm; null for x <= 0."""
    return F.when(col(x) > 0, F.ln(col(x)))


def ieee_div(a: ColumnLike, b: ColumnLike) -> Column:
    """a / b as doubles divide: infinite for a zero divisor, NaN for 0 / 0; null only for a null argument."""
    a, b = col(a).cast("double"), col(b).cast("double")
    by_zero = F.when(F.isnan(a) | (a == 0), float("nan")).when(a > 0, float("inf")).when(a < 0, float("-inf"))
    return F.when(b == 0, by_zero).otherwise(F.try_divide(a, b))


def ieee_ln(x: ColumnLike) -> Column:
    """Natural logarithm as of doubles: -Infinity for 0, NaN below."""
    x = col(x).cast("double")
    return F.when(x == 0, float("-inf")).when(x < 0, float("nan")).otherwise(F.ln(x))


def zero(x: ColumnLike) -> Column:
    """Null becomes 0.0."""
    return F.coalesce(col(x).cast("double"), F.lit(0.0))


def not_nan(x: ColumnLike, instead: float | None = None) -> Column:
    """NaN becomes instead."""
    return F.when(F.isnan(col(x)), F.lit(instead).cast("double")).otherwise(col(x))


def over(x: Column, w: WindowSpec | None) -> Column:
    return x if w is None else x.over(w)


def safe_corr(x: ColumnLike, y: ColumnLike, w: WindowSpec | None = None) -> Column:
    """Correlation of rows where both are present; null where either is constant. As group aggregate without w."""
    a = F.when(col(y).isNotNull(), col(x).cast("double"))
    b = F.when(col(x).isNotNull(), col(y).cast("double"))
    spread = over(F.stddev_pop(a), w) * over(F.stddev_pop(b), w)
    return F.when(spread > 1e-15, over(F.covar_pop(a, b), w) / spread)


def gated(x: Column, w: WindowSpec, n: int, on: Column | None = None) -> Column:
    """x where the frame is full: n rows, or n non-null values of `on`."""
    return F.when(F.count(F.lit(1) if on is None else on).over(w) == n, x)


def prefixed(df: DataFrame, prefix: str, keep: Iterable[str]) -> DataFrame:
    """All columns but those in keep get the prefix."""
    keep = set(keep)
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns])


def surrogate_key(*xs: ColumnLike) -> Column:
    """md5 of the arguments as text, joined by '-', nulls as a placeholder."""
    return F.md5(F.concat_ws("-", *[F.coalesce(col(x).cast("string"), F.lit("_null_")) for x in xs]))


def text_key(*xs: ColumnLike, null_propagates: bool = False) -> Column:
    """The arguments as text joined by '-'; a null argument is left out, or makes the key null."""
    cs = [col(x).cast("string") for x in xs]
    if not null_propagates:
        return F.concat_ws("-", *cs)
    return F.concat(*[p for k, c in enumerate(cs) for p in ([F.lit("-")] if k else []) + [c]])


def normalize_epoch(x: ColumnLike) -> Column:
    """Timestamp of an epoch number in seconds, milliseconds or microseconds, told by its size; null below 1e9."""
    v = col(x).cast("double")
    return (
        F.when(v > 1e14, F.timestamp_micros(v.cast("bigint")))
        .when(v > 1e12, F.timestamp_millis(v.cast("bigint")))
        .when(v > 1e9, F.timestamp_seconds(v.cast("bigint")))
    )


def r6(x: ColumnLike) -> Column:
    """Rounded to six decimals, negative zero as zero. The shift keeps values off exact halves, which engines round differently."""
    return F.round(col(x).cast("double") + F.lit(2.3e-8), 6) + F.lit(0.0)


def rounded(df: DataFrame) -> DataFrame:
    """Every double column through r6."""
    return df.select(*[r6(c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
