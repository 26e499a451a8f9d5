from deskrisk.operators.scratch import scratch_dir, together
from deskrisk.session import shuffle_partitions


def test_shuffles_are_sized_by_bytes():
    assert shuffle_partitions(1 << 20) == 200
    assert shuffle_partitions(1 << 40) == 8192
    assert shuffle_partitions(1 << 60) == 100_000


def test_scratch_is_where_the_session_says(spark):
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_jobs_run_side_by_side_and_failures_surface():
    assert together({"a": lambda: 1, "b": lambda: 2}) == {"a": 1, "b": 2}
    try:
        together({"a": lambda: 1 / 0})
    except ZeroDivisionError:
        return
    raise AssertionError("the failure was swallowed")
