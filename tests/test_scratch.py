"""Settled tables end with the run that wrote them."""

import os

from deskrisk.operators import scratch_of_run, settle, together


def folder(df):
    return os.path.dirname(df.inputFiles()[0].removeprefix("file:"))


def test_a_run_removes_its_own_tables_alone(spark):
    kept = settle(spark.range(3), "kept")
    with scratch_of_run(spark):
        outer = settle(spark.range(4), "outer")
        with scratch_of_run(spark):
            inner = together({n: lambda n=n: settle(spark.range(n), "inner") for n in (5, 6)})
            places = [folder(df) for df in inner.values()]
            assert [df.count() for df in inner.values()] == [5, 6]
        assert not any(os.path.exists(p) for p in places)
        place = folder(outer)
        assert outer.count() == 4
    assert not os.path.exists(place) and kept.count() == 3
