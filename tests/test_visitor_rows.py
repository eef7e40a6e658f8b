"""The stateful step of visitors and sessions, key by key."""

from conftest import rows_of
from pyspark.sql import Row
from test_streaming import T0, feed, firsts_job  # noqa: F401

from rillhouse.streaming.visitors import DAY_MS, SESSION, FirstEvents

HOUR = 3_600_000


class State:
    def __init__(self, value=None):
        self.value, self.calls = value, []

    def get(self):
        self.calls.append("get")
        return None if self.value is None else (self.value,)

    def update(self, value):
        self.calls.append("update")
        self.value = value[0]

    def registerTimer(self, ms):
        self.calls.append("timer")


def run(kind, state, *rows):
    step = FirstEvents(["kind", "key", "ts", "et"], HOUR)
    step.handle = step.seen = state
    named = [Row(kind=kind, key="k", bucket=b, ts=ts, last_ts=last) for b, ts, last in rows]
    return [r.ts for r in step.handleInputRows((kind, "k", 0), iter(named), None)]


def test_a_key_takes_three_calls_and_no_frame():
    """Rows come and go as rows: a frame and its batch for each key took over two milliseconds a key."""
    state = State()
    assert run("day", state, (3, 3 * DAY_MS + 9, 3 * DAY_MS + 9), (3, 3 * DAY_MS + 5, 3 * DAY_MS + 7), (1, DAY_MS, DAY_MS)) == [DAY_MS, 3 * DAY_MS + 5]
    assert state.value == 0b1010 and state.calls == ["get", "update", "timer"]
    state.calls = []
    assert run("day", state, (3, 3 * DAY_MS, 3 * DAY_MS)) == [] and state.calls == ["get"]


def test_sessions_go_on_across_buckets_and_batches():
    state = State()
    assert run(SESSION, state, (0, 10, 20), (1, HOUR + 20, HOUR + 30), (2, 2 * HOUR, 2 * HOUR + 1)) == [10, HOUR + 20]
    assert state.value == 2 * HOUR + 1
    assert run(SESSION, state, (1, HOUR + 5, HOUR + 5), (3, 3 * HOUR, 3 * HOUR)) == []
    assert run(SESSION, state, (4, 4 * HOUR, 4 * HOUR)) == [4 * HOUR] and state.value == 4 * HOUR


def test_views_without_a_time_are_no_visits(spark, feed, pages):  # noqa: F811
    feed.add(pages(("a", "a", "0", "home", None), ("b", "b", "0", "home", T0)))
    feed.run(firsts_job(feed, "day"))
    assert rows_of(spark.read.parquet(feed.out), "key", "ts") == [("b", T0)]
