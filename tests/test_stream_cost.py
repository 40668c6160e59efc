"""What a batch of the refresh streams costs: round trips of the state, shuffles of the text."""

import datetime as dt

import pandas as pd

from freshet.plans import weather
from freshet.sources.landing import RESPONSE_SCHEMA
from freshet.streaming import state_stream, status_stream

DAY = dt.datetime(2024, 1, 1)
BIG = 2**53 + 1  # no float


class _Bucket:
    """One value state with its timers, and the calls made."""

    def __init__(self):
        self.value, self.timers, self.calls = None, [], 0

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls, self.value = self.calls + 1, value

    def clear(self):
        self.calls, self.value = self.calls + 1, None

    def registerTimer(self, ms):
        self.calls += 1
        self.timers.append(ms)

    def deleteTimer(self, ms):
        self.calls += 1
        self.timers.remove(ms)


class _Fired:
    def __init__(self, ms):
        self.ms = ms

    def getExpiryTimeInMs(self):
        return self.ms

    def getCurrentWatermarkInMs(self):
        return self.ms + 1


def _frame(rows):
    # (request, seq, n_chunks, chunk, ms), as Spark hands them over: integers beside NULLs are floats
    return pd.DataFrame({"request": [r and str(r) for r, *_ in rows], "location": [f"L/{r}" if r else None for r, *_ in rows], "status": [200.0 if r else None for r, *_ in rows],
                         "seq": [r[1] for r in rows], "chunk": [r[3] for r in rows], "received_us": [r[4] * 1000 for r in rows], "n_chunks": [r[2] for r in rows]})


def _batch(bucket, *frames):
    bucket.calls = 0
    task = state_stream.RequestChunks(1000)
    task.init(bucket)
    return {r.request_id: r for out in task.handleInputRows((7,), iter(frames), None) for r in out.itertuples()}


def test_a_batch_asks_the_state_once_for_many_requests():
    bucket = _Bucket()
    ids = range(BIG, BIG + 500)
    assert _batch(bucket, _frame([(r, 1, 2.0, "b", 10) for r in ids])) == {}
    assert bucket.calls == 3  # read, timer, write
    got = _batch(bucket, _frame([(r, 0, 2.0, "a", 20) for r in ids[:250]]), _frame([(r, 0, 2.0, "a", 20) for r in ids[250:499]] + [(None, 0, None, "x", 5)]))
    assert bucket.calls <= 4 and bucket.timers == [1005]  # an earlier timer takes the place of the first
    assert got.pop(None)[3:] == (None, None, "x", 5_000)
    assert set(got) == set(ids[:499]) and got[BIG + 1][2:] == (None, f"L/{BIG + 1}", 200, "ab", 20_000)
    assert _batch(bucket, _frame([(r, 0, 2.0, "late", 30) for r in ids[:499]])) == {}  # landed twice
    # One is still incomplete when the timer goes off for what has been due before it.
    task, lost = state_stream.RequestChunks(1000), []
    while bucket.timers:
        bucket.calls, now = 0, bucket.timers.pop()
        task.init(bucket)
        lost += [(now, r.request_id, r.event) for out in task.handleExpiredTimer((7,), _Fired(now), _Fired(now)) for r in out.itertuples()]
        assert bucket.calls <= 3
    assert lost == [(1010, BIG + 499, "incomplete_response")] and bucket.value is None


def _at(hours):
    return DAY + dt.timedelta(hours=hours)


def test_the_text_of_a_batch_is_shuffled_once(spark):
    rows = [(1, "L/A", 200, 1, "b", _at(1), 2), (1, "L/A", 200, 0, "a", _at(2), 2), (2, "L/B", 200, 0, "half", _at(1), 2), (2, "L/B", 200, 0, "half", _at(3), 2),
            (3, "L/C", 200, 0, "x", _at(1), 2), (3, "L/C", 503, 1, None, _at(2), None), (4, "L/D", 200, 0, "open", _at(1), None),
            (None, "L/E", 200, 0, "n", _at(1), 9), (None, "L/F", 200, 0, "m", _at(1), 9), (5, None, 200, 0, "q", None, 3)]
    chunks = spark.createDataFrame(rows, RESPONSE_SCHEMA)
    got = status_stream._responses(chunks)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Join" not in plan, plan
    found = got.collect()
    whole = {(r.request_id, r.location, r.status, r.body, r.received_at) for r in found if not r.waiting}
    assert whole == {(1, "L/A", 200, "ab", _at(2)), (3, "L/C", 200, "x", _at(1)), (3, "L/C", 503, None, _at(2)), (4, "L/D", 200, "open", _at(1)),
                     (None, "L/E", 200, "n", _at(1)), (None, "L/F", 200, "m", _at(1))}
    assert whole == {(r.request_id, r.location, r.status, r.body, r.received_at) for r in weather.parsed_bodies(chunks).collect() if r.request_id not in (2, 5)}
    waiting = {r.request_id: (r.body, r.newest, sorted((c.seq, c.chunk, c.received_at, c.n_chunks) for c in r.chunks)) for r in found if r.waiting}
    assert waiting == {2: (None, _at(3), [(0, "half", _at(1), 2), (0, "half", _at(3), 2)]), 5: (None, None, [(0, "q", None, 3)])}
