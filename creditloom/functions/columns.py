"""Null, ratio, clip and recode expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def ratio(num: Column, den: Column, strict_inf: bool = False) -> Column:
    """num / den. A zero denominator gives NULL, or a signed infinity when `strict_inf`.

    The strict form lets the infinity run through min/max/mean/sum exactly as IEEE arithmetic
    does; clean the finished aggregate with `finite`.
    """
    safe = F.try_divide(num, den)
    if not strict_inf:
        return safe
    return F.when(den == 0, F.when(num > 0, F.lit(INF)).when(num < 0, F.lit(-INF))).otherwise(safe)


def finite(c: Column) -> Column:
    """NaN and ±inf become NULL."""
    return F.when(~F.isnan(c) & (F.abs(c) != INF), c)


def clip_lower(c: Column, low: float = 0) -> Column:
    """Lower clip that keeps NULL (`greatest` would not)."""
    return F.when(c < low, F.lit(low)).otherwise(c)


def sentinel_to_null(c: Column, sentinel: float = 365243) -> Column:
    return F.nullif(c, F.lit(sentinel))


def recode(c: Column, mapping: Mapping[str, int]) -> Column:
    """Fixed dictionary lookup, unmapped values give NULL."""
    out = None
    for value, code in mapping.items():
        out = F.when(c == value, code) if out is None else out.when(c == value, code)
    return out if out is not None else F.lit(None)


def tokens_to_null(c: Column, tokens: tuple[str, ...]) -> Column:
    return F.when(~c.isin(*tokens), c)


def indicator(c: Column, value: object) -> Column:
    """1/0 membership in one category; NULL rows count as 0, `value=None` flags the NULL rows."""
    hit = c.isNull() if value is None else c == F.lit(value)
    return F.when(hit, 1).otherwise(0)


def decision(proba: Column, threshold: float, inclusive: bool = False) -> Column:
    """1 = refuse. Strict comparison unless `inclusive`."""
    return (proba >= threshold if inclusive else proba > threshold).cast("int")


def hms(seconds: Column) -> Column:
    """Seconds as h:mm:ss, rounded to the second (half to even), days as a prefix past 24 h."""
    s = F.bround(seconds).cast("long")
    days = F.floor(s / 86400)
    rest = F.pmod(s, F.lit(86400))
    clock = F.format_string("%d:%02d:%02d", F.floor(rest / 3600), F.floor(F.pmod(rest, F.lit(3600)) / 60),
                            F.pmod(rest, F.lit(60)))
    day_word = F.when(F.abs(days) == 1, F.lit(" day, ")).otherwise(F.lit(" days, "))
    return F.when(days != 0, F.concat(days.cast("string"), day_word, clock)).otherwise(clock)


def hm(seconds: Column) -> Column:
    """Seconds as hh:mm, rounded to the minute (half to even)."""
    m = F.bround(seconds / 60).cast("long")
    return F.format_string("%02d:%02d", F.floor(m / 60), F.pmod(m, F.lit(60)))
