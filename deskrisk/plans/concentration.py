"""Concentration of exposure in six dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskrisk.functions import band, flag, money_of, money_parts, percent_of, tenor_bucket
from deskrisk.operators import rank_rows, settle

# The dimensions and the column each groups by.
DIMENSIONS = {
    "COUNTERPARTY": "counterparty",
    "INSTRUMENT": "ticker",
    "SECTOR": "sector",
    "GEOGRAPHY": "geography",
    "ASSET_CLASS": "asset_class",
    "MATURITY_BUCKET": "maturity_bucket",
}


# Gross and net exposure, each in whole units and millionths.
SUMS = ("gross_units", "gross_millionths", "net_units", "net_millionths")


def exposure_cube(positions: DataFrame, classifications: DataFrame) -> DataFrame:
    """Trades, gross and net exposure per desk, dimension and entity, in whole units and millionths (``SUMS``).

    One scan and one shuffle: GROUPING SETS over (desk, d) for each dimension d. Rows are
    combined map-side per set, so what is shuffled is bounded by the number of
    entities, not of trades nor of combinations of dimensions. Sector and geography
    are functions of the ticker and are derived from its rows afterwards.
    """
    days = F.coalesce("days_to_maturity", F.lit(0))
    book = positions.where("trade_id IS NOT NULL").select(
        "desk", "counterparty", "ticker", "asset_class", tenor_bucket(days).alias("maturity_bucket"),
        "trade_id", "notional_usd", "net_exposure_usd",
    )
    scanned = [c for c in DIMENSIONS.values() if c in book.columns]
    sets = book.groupingSets([["desk", c] for c in scanned], "desk", *scanned).agg(
        F.grouping_id().alias("_set"),
        F.count("trade_id").alias("position_count"),
        *[F.sum(part).alias(name) for name, part in zip(SUMS, (*money_parts(F.abs("notional_usd")), *money_parts(F.col("net_exposure_usd"))))],
    )
    # Bit i of the grouping id is 0 for the one dimension that is grouped by.
    kind, entity = F.lit(None).cast("string"), F.lit(None).cast("string")
    width = len(scanned)
    for i, column in enumerate(scanned):
        ours = F.col("_set") == (2**width - 1) - 2 ** (width - 1 - i)
        name = next(k for k, v in DIMENSIONS.items() if v == column)
        kind = F.when(ours, name).otherwise(kind)
        entity = F.when(ours, F.col(column)).otherwise(entity)
    measures = ("position_count", *SUMS)
    cube = sets.select("desk", kind.alias("concentration_type"), entity.alias("entity_name"), *measures)

    known = classifications.groupBy(F.upper("ticker").alias("_ticker")).agg(
        F.max("sector").alias("_sector"), F.max("geography").alias("_geography")
    )
    # Every row stays as it is; a ticker's row also counts for its sector and geography.
    entries = F.when(
        F.col("concentration_type") == "INSTRUMENT",
        F.array(
            F.struct(F.col("concentration_type").alias("kind"), F.col("entity_name").alias("entity")),
            F.struct(F.lit("SECTOR").alias("kind"), F.coalesce("_sector", F.lit("Unknown")).alias("entity")),
            F.struct(F.lit("GEOGRAPHY").alias("kind"), F.coalesce("_geography", F.lit("Unknown")).alias("entity")),
        ),
    ).otherwise(
        F.array(F.struct(F.col("concentration_type").alias("kind"), F.col("entity_name").alias("entity")))
    )
    on_ticker = (F.col("concentration_type") == "INSTRUMENT") & (F.upper("entity_name") == F.col("_ticker"))
    return (
        cube.join(known, on_ticker, "left")
        .select("desk", F.explode(entries).alias("_entry"), *measures)
        .groupBy("desk", F.col("_entry.kind").alias("concentration_type"), F.col("_entry.entity").alias("entity_name"))
        .agg(*[F.sum(m).alias(m) for m in measures])
    )


def concentration_risk(
    positions: DataFrame, classifications: DataFrame, run_date: Column
) -> DataFrame:
    """Shares, levels, ranks and the Herfindahl index per desk, dimension and entity.

    The cube is far smaller than the positions but is needed by several branches, so
    it is written once. Totals come from one dimension of it, as every dimension adds
    up to the whole book. Ties in rank go by desk and entity name. Money is summed in
    integers, so that neither ranks nor levels depend on the order of addition.
    """
    parts = settle(exposure_cube(positions, classifications), "exposure-cube")
    gross = money_of(F.sum(SUMS[0]), F.sum(SUMS[1]))
    by_class = parts.where(F.col("concentration_type") == "ASSET_CLASS")
    desks = by_class.groupBy("desk").agg(gross.alias("_desk_gross"))
    portfolio = by_class.agg(gross.alias("_portfolio_gross"))
    cube = parts.select(
        "desk", "concentration_type", "entity_name", "position_count",
        money_of(F.col(SUMS[0]), F.col(SUMS[1])).alias("gross_exposure_usd"),
        money_of(F.col(SUMS[2]), F.col(SUMS[3])).alias("net_exposure_usd"),
    )

    # One row per desk, and one row.
    shares = (
        cube.join(desks, "desk")
        .crossJoin(portfolio)
        .withColumns(
            {
                "pct_of_desk_total": percent_of(F.col("gross_exposure_usd"), F.col("_desk_gross")),
                "pct_of_portfolio_total": percent_of(F.col("gross_exposure_usd"), F.col("_portfolio_gross")),
            }
        )
        .drop("_desk_gross", "_portfolio_gross")
    )
    squares = shares.groupBy("desk", "concentration_type").agg(
        F.round(F.sum(F.pow("pct_of_desk_total", F.lit(2.0))), 2).alias("desk_hhi")
    )
    in_desk = rank_rows(
        shares, ["desk", "concentration_type"], "gross_exposure_usd", ["entity_name"], "desk_rank"
    )
    ranked = rank_rows(
        in_desk, ["concentration_type"], "gross_exposure_usd", ["desk", "entity_name"], "portfolio_rank"
    )
    of_desk, of_all = F.col("pct_of_desk_total"), F.col("pct_of_portfolio_total")
    return ranked.join(squares, ["desk", "concentration_type"]).select(
        run_date.cast("date").alias("as_of_date"),
        "desk", "concentration_type", "entity_name",
        F.col("position_count").cast("int").alias("position_count"),
        "gross_exposure_usd", "net_exposure_usd", F.abs("net_exposure_usd").alias("net_abs_exposure_usd"),
        "pct_of_desk_total", "pct_of_portfolio_total",
        band(of_all, [(of_all > 10, "HIGH"), (of_all > 5, "MEDIUM")], "LOW").alias("concentration_level"),
        band(of_desk, [(of_desk > 20, "HIGH"), (of_desk > 10, "MEDIUM")], "LOW").alias("desk_concentration_level"),
        F.col("desk_rank").cast("int").alias("desk_rank"),
        F.col("portfolio_rank").cast("int").alias("portfolio_rank"),
        "desk_hhi",
        flag(of_all > 25).alias("large_exposure_flag"),
    )
