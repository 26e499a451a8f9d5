"""Column expressions shared by the models. All are JVM-side built-ins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Remaining life in days up to which each bucket reaches.
TENOR_LIMITS = ((365, "0-1Y"), (1825, "1-5Y"), (3650, "5-10Y"))
LAST_TENOR = "10Y+"

# Days per year for the duration proxy, and one basis point.
DAYS_PER_YEAR = 365.0
BASIS_POINT = 0.0001


def normalise_ticker(raw: Column) -> Column:
    """Vendor symbol to book symbol: drop a trailing ``=X``, dots become ``_``.

    A fixed suffix and a single character need no regular expression, which would
    double the time of the scan it runs in.
    """
    bare = F.when(raw.endswith("=X"), raw.substr(F.lit(1), F.length(raw) - 2)).otherwise(raw)
    return F.translate(bare, ".", "_")


def direction_multiplier(direction: Column) -> Column:
    """+1 for LONG, -1 for SHORT, 0 for anything else (NULL included)."""
    return F.when(direction == "LONG", 1).when(direction == "SHORT", -1).otherwise(0)


def same_text(left: Column, right: Column | str) -> Column:
    """Case-insensitive equality."""
    return F.upper(left) == (right.upper() if isinstance(right, str) else F.upper(right))


def flag(predicate: Column) -> Column:
    """A predicate as a two-valued flag: NULL counts as false."""
    return F.coalesce(predicate, F.lit(False))


def band(value: Column, steps: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    """First label whose predicate holds. ``value`` is only for reading the call."""
    chain = None
    for predicate, label in steps:
        chain = F.when(predicate, label) if chain is None else chain.when(predicate, label)
    return chain.otherwise(otherwise)


def tenor_bucket(days: Column) -> Column:
    """Remaining-life bucket. NULL days fall in the last bucket; guard before calling."""
    return band(days, [(days <= limit, label) for limit, label in TENOR_LIMITS], LAST_TENOR)


def duration_years(days: Column) -> Column:
    """Duration proxy: years to maturity, never negative. Cast first, so that the
    division is a DOUBLE one and not a DECIMAL one."""
    return F.greatest(days.cast("double") / F.lit(DAYS_PER_YEAR), F.lit(0.0))


def percent_of(part: Column, whole: Column) -> Column:
    """``part`` as a rounded percentage of ``whole``; NULL when ``whole`` is zero."""
    return F.round(part / F.nullif(whole, F.lit(0.0)) * 100, 4)


def basel_zone(exceptions: Column) -> Column:
    return band(exceptions, [(exceptions >= 10, "RED"), (exceptions >= 5, "AMBER")], "GREEN")


def model_status(exceptions: Column) -> Column:
    return band(exceptions, [(exceptions >= 10, "REJECTED"), (exceptions >= 5, "REVIEW")], "ACCEPTED")


# Fixed value: parts of a unit of money that sums keep.
MILLIONTHS = 1_000_000


def money_parts(amount: Column) -> tuple[Column, Column]:
    """Whole units and millionths of an amount, as integers: their sums do not depend on the order of addition.

    An integer sum beyond 64 bits (9 x 10^18 units, or 9 x 10^12 amounts) is an error in ANSI mode.
    """
    whole = F.floor(amount)
    return whole, F.round((amount - whole) * MILLIONTHS).cast("bigint")


def money_of(whole: Column, millionths: Column) -> Column:
    """The amount of summed parts."""
    return whole.cast("double") + millionths / F.lit(float(MILLIONTHS))


def trade_noise(trade_id: Column, method: str = "hash") -> Column:
    """Per-trade factor near one that stands in for P&L no market move explains.

    ``hash`` is Spark's own hash, whose remainder may be negative. ``md5`` gives a
    value other engines can compute too, so results can be compared with them.
    """
    if method == "hash":
        seed = F.hash(trade_id) % 100
    elif method == "md5":
        seed = F.conv(F.substring(F.md5(trade_id), 1, 8), 16, 10).cast("bigint") % 100
    else:
        raise ValueError(f"unknown noise method {method!r}; use 'hash' or 'md5'")
    return F.lit(1.0) + seed.cast("double") / F.lit(10000.0)


def padded_id(prefix: str, number: Column, width: int) -> Column:
    """``prefix`` and the number with leading zeros; a number longer than ``width`` stays whole."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), "0"))
