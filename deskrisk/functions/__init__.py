from deskrisk.functions.columns import (  # noqa: F401
    band,
    basel_zone,
    direction_multiplier,
    duration_years,
    flag,
    model_status,
    money_of,
    money_parts,
    normalise_ticker,
    padded_id,
    percent_of,
    same_text,
    tenor_bucket,
    trade_noise,
)
