"""Traffic lights, and the breach log stepped day by day against the set-based form."""

import random
from datetime import date, timedelta

import pytest
from table_rows import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from deskrisk.operators import merge_frames
from deskrisk.plans.exposure import breach_episodes, breach_log_step, exposure_monitor, latest_limits
from deskrisk.sources.schemas import KEYS, UPDATES

LIMIT = "desk string, limit_usd double, approved_date date, _ingested_at timestamp_ntz"


def limits(spark, *lines):
    from datetime import datetime

    return spark.createDataFrame(
        [(d, float(x), date(2026, 1, day), datetime(2026, 1, 1, load)) for d, x, day, load in lines], LIMIT
    )


@pytest.mark.parametrize(
    "notionals, status, warns, breaches, used",
    [
        ((30.0, 25.0), "GREEN", False, False, 55.0),
        ((79.99996,), "AMBER", True, False, 80.0),  # rounded to four places before it is judged
        ((79.9999,), "GREEN", False, False, 79.9999),
        ((60.0, 35.0), "AMBER", True, False, 95.0),
        ((60.0, 40.0), "RED", False, True, 100.0),
        ((70.0, 65.0), "RED", False, True, 135.0),
    ],
)
def test_traffic_light(spark, book, day, notionals, status, warns, breaches, used):
    trades = [{"desk": "fx desk", "notional_usd": n, "direction": s} for n, s in zip(notionals, ("LONG", "SHORT"))]
    r = exposure_monitor(book(*trades), limits(spark, ("FX Desk", 100, 1, 1)), day).first()
    assert (r.limit_status, r.warning_flag, r.breach_flag, r.utilisation_pct) == (status, warns, breaches, used)
    short = sum(notionals[1:])
    assert r.gross_exposure_usd == pytest.approx(sum(notionals)) and r.position_count == len(notionals)
    assert r.long_exposure_usd == notionals[0] and r.short_exposure_usd == short
    assert r.net_exposure_usd == pytest.approx(notionals[0] - short)


def test_newest_limit_counts(spark):
    out = latest_limits(limits(spark, ("A", 1, 1, 9), ("A", 2, 2, 1), ("A", 3, 2, 5), ("B", 4, 1, 1)))
    assert {r.desk: r.limit_usd for r in out.collect()} == {"A": 3.0, "B": 4.0}


def test_desk_without_limit_has_no_row_and_zero_limit_fails(spark, book, day):
    positions = book({"desk": "A"}, {"desk": "B"})
    assert [r.desk for r in exposure_monitor(positions, limits(spark, ("a", 5, 1, 1)), day).collect()] == ["A"]
    with pytest.raises(PySparkException, match="DIVIDE_BY_ZERO"):
        exposure_monitor(positions, limits(spark, ("A", 0, 1, 1)), day).collect()


EXPOSURE = "desk string, as_of_date date, utilisation_pct double, breach_flag boolean, limit_usd double, gross_exposure_usd double"
FIRST = date(2026, 3, 2)


def history(spark, desks):
    """``{desk: [utilisation or None per run day]}``; None means no exposure that day."""
    lines = [
        (desk, FIRST + timedelta(days=i), u, u >= 100, 50.0 + i, u / 2)
        for desk, used in desks.items()
        for i, u in enumerate(used)
        if u is not None
    ]
    return spark.createDataFrame(lines, EXPOSURE)


def step_through(spark, exposure, days):
    """The log kept day by day, materialised after each merge."""
    log = None
    for i in range(days):
        changed = breach_log_step(log, exposure, F.lit(FIRST + timedelta(days=i)))
        full = changed if log is None else merge_frames(log, changed, KEYS["limit_breach_log"], UPDATES["limit_breach_log"][:7])
        log = spark.createDataFrame(full.collect(), changed.schema)
    return log


def test_one_episode_in_detail(spark):
    exposure = history(spark, {"D": [50.0, 101.0, 120.0, 120.0, 110.0, 90.0, 100.0]})
    closed, open_ = rows(breach_episodes(exposure), "breach_start_date")
    assert closed["breach_start_date"] == date(2026, 3, 3) and closed["breach_end_date"] == date(2026, 3, 7)
    assert closed["breach_duration_days"] == 4 and not closed["is_active"]
    assert closed["peak_utilisation_pct"] == 120.0 and closed["peak_utilisation_date"] == date(2026, 3, 5)
    assert closed["breach_start_utilisation_pct"] == 101.0 and closed["limit_usd"] == 51.0
    assert open_["is_active"] and open_["breach_end_date"] is None and open_["breach_duration_days"] == 1
    assert open_["warning_start_date"] is None and open_["warning_duration_days"] is None


def test_stepping_equals_the_set_based_form(spark):
    rng = random.Random(3)
    desks = {d: [rng.choice((None, 60.0, 99.9999, 100.0, 105.5, 130.25)) for _ in range(9)] for d in "ABC"}
    desks["ALWAYS"] = [150.0 + i for i in range(9)]
    desks["EMPTY-DAYS"] = [110.0, None, None, 110.0, None, 110.0, 110.0, 110.0, 90.0]
    exposure = history(spark, desks)
    want = rows(breach_episodes(exposure))
    assert rows(step_through(spark, exposure, 9)) == want and len(want) > 6


@pytest.mark.parametrize("days", [2, 3])
def test_repeating_a_day_changes_nothing(spark, days):
    exposure = history(spark, {"D": [50.0, 101.0, 120.0]})
    log = step_through(spark, exposure, days)
    again = breach_log_step(log, exposure, F.lit(FIRST + timedelta(days=days - 1)))
    assert rows(merge_frames(log, again, KEYS["limit_breach_log"], UPDATES["limit_breach_log"][:7])) == rows(log)


def test_no_breach_no_rows(spark, day):
    exposure = history(spark, {"D": [50.0, 60.0]})
    assert breach_episodes(exposure).isEmpty()
    assert breach_log_step(None, exposure, F.lit(FIRST)).isEmpty()


def test_spellings_of_a_desk_share_one_limit(spark):
    lines = [("FX Desk", 5.0, date(2026, 1, 1)), ("fx desk", 7.0, date(2026, 2, 1))]
    out = latest_limits(spark.createDataFrame(lines, "desk string, limit_usd double, approved_date date"))
    assert [r.limit_usd for r in out.collect()] == [7.0]
