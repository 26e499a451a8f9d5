"""The book: what the models need of the trades, summed.

Every model but concentration is linear in per-trade measures and groups by some of
``KEYS``. So the trades can be read once, reduced to the book, and the models run on
that; nothing they return changes. The same functions take single trades as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskrisk.functions import duration_years, tenor_bucket, trade_noise

KEYS = ("desk", "asset_class", "ticker", "currency", "direction", "direction_multiplier", "live_tenor")
SUMS = ("trades", "notional_usd", "gross_usd", "signed_usd", "net_exposure_usd", "gross_years", "signed_years", "noisy_usd")
# One value per ticker or currency.
FACTS = ("current_price", "latest_price_date", "fx_rate_vs_usd")


def trade_measures(positions: DataFrame, noise: str = "hash") -> DataFrame:
    """Positions with the measures of each trade; a book is returned as it is.

    A measure whose source columns are absent is left out, and one that no model asks
    for is pruned before it is computed. ``live_tenor`` is NULL once a trade matured.
    """
    if "trades" in positions.columns:
        return positions
    notional, side, days = F.col("notional_usd"), F.col("direction_multiplier"), F.col("days_to_maturity")
    years = duration_years(F.coalesce(days, F.lit(0)))
    sources = {
        "trades": (("trade_id",), F.col("trade_id").isNotNull().cast("bigint")),
        "gross_usd": (("notional_usd",), F.abs(notional)),
        "signed_usd": (("notional_usd", "direction_multiplier"), notional * side),
        "gross_years": (("notional_usd", "days_to_maturity"), F.abs(notional) * years),
        "signed_years": (("notional_usd", "direction_multiplier", "days_to_maturity"), notional * side * years),
        "noisy_usd": (
            ("notional_usd", "direction_multiplier", "trade_id"),
            notional * side * trade_noise(F.col("trade_id"), noise),
        ),
        "live_tenor": (("days_to_maturity",), F.when(days > 0, tenor_bucket(days))),
    }
    have = set(positions.columns)
    return positions.withColumns({name: value for name, (needs, value) in sources.items() if have.issuperset(needs)})


def position_book(positions: DataFrame, noise: str = "hash") -> DataFrame:
    """One row per combination of ``KEYS``, however many trades it stands for.

    The sums are combined map-side, so neither a hot desk nor a hot ticker sends more
    than one row per input partition and combination.
    """
    measured = trade_measures(positions, noise)
    return measured.groupBy(*KEYS).agg(
        *[F.sum(c).alias(c) for c in SUMS], *[F.max(c).alias(c) for c in FACTS]
    )
