"""Gold tables of the sample, built on stored silver as in a daily run."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskrisk.operators import settle, together
from deskrisk.plans.book import position_book
from deskrisk.plans.concentration import concentration_risk
from deskrisk.plans.exposure import breach_episodes, exposure_monitor
from deskrisk.plans.pnl import pnl_attribution, risk_adjusted_performance
from deskrisk.plans.sensitivity import equity_sensitivity, fx_sensitivity, rates_credit_sensitivity
from deskrisk.plans.stress import stress_testing
from deskrisk.plans.summary import risk_summary
from deskrisk.plans.value_at_risk import var_backtest, var_daily
from deskrisk.sources.sample import Sample


class SampleGold:
    """Each property is one gold table on the sample's run date.

    Tables that read silver once take it as it is. Those that read it several times
    share one written copy, as the daily run does.
    """

    def __init__(self, sample: Sample):
        self.sample = sample
        self.day = sample.run_date

    @cached_property
    def prices(self) -> DataFrame:
        return settle(self.sample.prices_cleaned.select("ticker", "price_date", "close_price"), "prices")

    @cached_property
    def positions(self) -> DataFrame:
        return settle(
            self.sample.positions_unpriced.select(
                "trade_id", "desk", "asset_class", "ticker", "counterparty", "direction", "currency",
                "notional_usd", "net_exposure_usd", "direction_multiplier", "days_to_maturity", "trade_date",
                "current_price", "latest_price_date", "fx_rate_vs_usd",
            ),
            "positions",
        )

    @cached_property
    def book(self) -> DataFrame:
        return settle(position_book(self.positions, noise="md5"), "book")

    @cached_property
    def var_daily(self) -> DataFrame:
        self._share_silver()
        return var_daily(self._book, self.prices, self.day)

    @cached_property
    def pnl_attribution(self) -> DataFrame:
        return pnl_attribution(self._book, self._prices, self.day, noise="md5")

    @cached_property
    def exposure_monitor(self) -> DataFrame:
        return exposure_monitor(self._book, self.sample.desk_limits, self.day)

    @cached_property
    def fx_sensitivity(self) -> DataFrame:
        return fx_sensitivity(self.sample.positions_unpriced, self.day)

    @cached_property
    def equity_sensitivity(self) -> DataFrame:
        return equity_sensitivity(self.sample.positions_enriched, self.sample.ticker_classifications, self.day)

    @cached_property
    def rates_credit_sensitivity(self) -> DataFrame:
        return rates_credit_sensitivity(self._positions, self.day)

    @cached_property
    def concentration_risk(self) -> DataFrame:
        return concentration_risk(self._positions, self.sample.ticker_classifications, self.day)

    @cached_property
    def stress_testing(self) -> DataFrame:
        self._share_silver()
        return stress_testing(
            self._book, self.sample.stress_scenarios, self.var_daily, self.sample.desk_limits, self.day
        )

    @cached_property
    def risk_adjusted_performance(self) -> DataFrame:
        self._share_silver()
        return risk_adjusted_performance(self.pnl_attribution, self.var_daily, self.exposure_monitor, self.day)

    @cached_property
    def limit_breach_log(self) -> DataFrame:
        return breach_episodes(self.sample.exposure_history(self._positions))

    def _backtest(self, pnl: DataFrame) -> DataFrame:
        """VaR of the run date held against every day of ``pnl``."""
        var = self.var_daily.select("desk", "asset_class", "var_97_5_usd")
        days = pnl.select("desk", F.col("pnl_date").alias("calculation_date"))
        return var_backtest(days.join(var, "desk"), pnl)

    @cached_property
    def var_backtest(self) -> DataFrame:
        self._share_silver()
        history = self.sample.pnl_history(self._book, self.prices)
        return self._backtest(settle(history, "pnl-history"))

    @cached_property
    def risk_summary(self) -> DataFrame:
        self._share_silver()
        self.book  # noqa: B018  (writes it)
        done = together(
            {
                "var": lambda: settle(self.var_daily, "var"),
                "pnl": lambda: settle(self.pnl_attribution, "pnl"),
                "history": lambda: settle(self.sample.pnl_history(self._book, self.prices), "pnl-history"),
                "concentration": lambda: self.concentration_risk,
            }
        )
        self.var_daily = done["var"]
        today = done["pnl"]
        days = done["history"].unionByName(today.select("desk", "pnl_date", "actual_pnl_usd"))
        return risk_summary(
            done["var"], self.exposure_monitor, today, self._backtest(days), self.stress_testing,
            done["concentration"], self.day,
        )

    # The properties with an underscore are the written copies once there are any.

    def _share_silver(self) -> None:
        together({"positions": lambda: self.positions, "prices": lambda: self.prices})

    @property
    def _positions(self) -> DataFrame:
        return self.__dict__.get("positions", self.sample.positions_unpriced)

    @property
    def _book(self) -> DataFrame:
        return self.__dict__.get("book", self._positions)

    @property
    def _prices(self) -> DataFrame:
        return self.__dict__.get("prices", self.sample.prices_cleaned)
