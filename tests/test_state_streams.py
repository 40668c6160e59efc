"""Keyed state and time limits in streams, on small landed files."""

import datetime as dt

from freshet.session import work_path
from freshet.sources.landing import RESPONSE_SCHEMA
from freshet.streaming.state_stream import current_status, read_state, run_responses, run_status
from freshet.streaming.unanswered import run_unanswered

DAY = dt.datetime(2024, 1, 1)


def _at(hours):
    return DAY + dt.timedelta(hours=hours)


def _chunk(request, seq, n, text, hours, location="L/A", status=200):
    row = {"request_id": request, "location": location, "status": status, "seq": seq, "chunk": text, "received_at": _at(hours), "n_chunks": n}
    return tuple(row[f] for f in RESPONSE_SCHEMA.fieldNames())


def _body(city, weather):
    text = f'{{"current_observation":{{"display_location":{{"city":"{city}"}},"weather":"{weather}"}}}}'
    return text[:20], text[20:]


def _land(spark, root, n, rows):
    spark.createDataFrame(rows, RESPONSE_SCHEMA).coalesce(1).write.parquet(f"{root}/landing/part={n}")


def _respond(spark, root, **kw):
    stream = spark.readStream.schema(RESPONSE_SCHEMA).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", "1").parquet(f"{root}/landing")
    run_responses(stream, f"{root}/whole", f"{root}/log", f"{root}/audit", f"{root}/_whole", state_partitions=2, **kw).awaitTermination()


def _status(spark, root, locations):
    run_status(spark, f"{root}/whole", locations, f"{root}/state", f"{root}/_state", state_partitions=2, max_files=1, fold_every=2).awaitTermination()
    status = spark.createDataFrame([("A", "L/A", None, None, None), ("B", "L/B", "old", "Success", _at(0)), ("C", "L/C", None, None, None)],
                                   "key string, location string, data string, update_status string, last_update timestamp")
    return {r.key: (r.data, r.update_status, r.last_update) for r in current_status(status, read_state(spark, f"{root}/state")).collect()}


def test_responses_meet_over_batches_and_late_ones_expire(spark):
    root = work_path(spark, "state_small")
    a1, a2 = _body("A", "rain")
    b1, b2 = _body("B", "sun")
    z1, z2 = _body("Nowhere", "fog")
    _land(spark, root, 0, [_chunk(1, 0, 2, a1, 1), _chunk(2, 1, 2, b2, 1), _chunk(4, 0, 2, "half", 1, "L/C")])
    _land(spark, root, 1, [_chunk(1, 1, 2, a2, 2), _chunk(1, 1, 2, a2, 2), _chunk(5, 0, 2, z1, 2), _chunk(5, 1, 2, z2, 2)])
    _land(spark, root, 2, [_chunk(1, 0, 2, a1, 3), _chunk(2, 0, 2, b1, 3), _chunk(6, 0, 1, None, 3, "L/C", 503), _chunk(7, 0, 1, "no json", 3)])
    _respond(spark, root, give_up_after="1 day", lateness="12 hours")
    whole = {r.request_id: r for r in spark.read.parquet(f"{root}/whole").where("event is null").collect()}
    assert set(whole) == {1, 2, 5, 6, 7}  # once each, the chunk that landed twice included
    assert spark.read.parquet(f"{root}/whole").count() == 5
    assert whole[1].body == a1 + a2 and whole[1].received_at == _at(2) and whole[2].body == b1 + b2
    locations = spark.createDataFrame([(f"L/{k}", k) for k in "ABC"], "location string, key string")
    got = _status(spark, root, locations)
    assert got == {"A": ("rain", "Success", _at(2)), "B": ("sun", "Success", _at(3)), "C": (None, "Failed", None)}

    # Days later: the half response is given up, and a chunk of it after that is too late.
    old1, old2 = _body("A", "snow")
    _land(spark, root, 3, [_chunk(8, 0, 1, _body("C", "wind")[0] + _body("C", "wind")[1], 72, "L/C")])
    _land(spark, root, 4, [_chunk(9, 0, 2, old1, 71), _chunk(9, 1, 2, old2, 71)])
    _land(spark, root, 5, [_chunk(4, 1, 2, "late", 2, "L/C")])
    _respond(spark, root, give_up_after="1 day", lateness="12 hours")
    audit = {(r.event, r.request_id, r.location) for r in spark.read.parquet(f"{root}/audit").collect()}
    assert audit == {("unparsable_body", 7, "L/A"), ("incomplete_response", 4, "L/C")}
    got = _status(spark, root, locations)
    assert got["C"] == ("wind", "Success", _at(72)) and got["A"] == ("snow", "Success", _at(71)) and got["B"] == ("sun", "Success", _at(3))
    assert sum("Successfully" in r.value for r in spark.read.text(f"{root}/log").collect()) == 5


def test_unanswered_requests_are_reported_once(spark):
    root = work_path(spark, "unanswered_small")
    polls, got = "request_id long, location string, polled_at timestamp", "request_id long, received_at timestamp"

    def land(n, p, r):
        spark.createDataFrame(p, polls).coalesce(1).write.parquet(f"{root}/polls/part={n}")
        spark.createDataFrame(r, got).coalesce(1).write.parquet(f"{root}/got/part={n}")

    def run():
        read = lambda name, schema: spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", "1").parquet(f"{root}/{name}")
        run_unanswered(read("polls", polls), read("got", got), f"{root}/out", f"{root}/_checkpoint", "1 HOUR", "30 MINUTES", state_partitions=2).awaitTermination()
        return sorted(r.request_id for r in spark.read.parquet(f"{root}/out").collect())

    land(0, [(1, "a", _at(0)), (2, "b", _at(0)), (3, "c", _at(0))], [(1, _at(0.5)), (1, _at(0.6)), (99, _at(0.5))])
    assert run() == []  # nobody can know yet
    land(1, [(4, "d", _at(2))], [(2, _at(1)), (3, _at(2.0))])
    land(2, [(5, "e", _at(9))], [(5, _at(9))])
    assert run() == [3, 4]  # 2 was answered at the limit, 3 after it, 4 never
    land(3, [(6, "f", _at(20))], [(4, _at(20)), (6, _at(20))])
    assert run() == [3, 4]  # a late answer takes nothing back, nothing is told twice
