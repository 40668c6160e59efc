"""Weather ingest, sentinel casts and the status refresh on invented fixtures."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from freshet.functions.payload import number, rfc822, to_json_text
from freshet.functions.text import oracle_concat
from freshet.plans import weather
from freshet.session import work_path
from freshet.sources.landing import (
    LOCATION_SCHEMA, RESPONSE_SCHEMA, STATUS_SCHEMA, read_landed, read_landed_stream,
)
from freshet.sources.response_log import read_response_log, write_response_log
from tests.fixtures.weather_samples import HARBOR_1, RIVERTON_1, RIVERTON_2, body, log_text

UTC = dt.timezone.utc


def _local_file(spark, name, text):
    path = work_path(spark, "fixtures", unique=True)
    os.makedirs(path.replace("file:", ""), exist_ok=True)
    with open(os.path.join(path.replace("file:", ""), name), "w") as f:
        f.write(text)
    return path


@pytest.fixture(scope="module")
def log_dir(spark):
    text = log_text([
        ("Riverton", "Sat May 04 2024 19:15:10 GMT+0700", RIVERTON_1),
        ("Harbor City", "Sat May 04 2024 19:16:20 GMT+0700", HARBOR_1),
        ("Riverton", "Sat May 04 2024 19:17:30 GMT+0700", RIVERTON_2),
    ])
    return _local_file(spark, "file", text)


def test_number_sentinels(spark):
    cases = ["58%", "240 ft", " 0", "--", "", "NA", "-9999.00", "-9999.00 in (-9999.00 mm)",
             "2.5", "0", "-95.9", None, ".5", "1e3", "1.5E-5", "-2.0E+7", "3 east", "4e"]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = [r.n for r in df.select(number(F.col("t")).alias("n")).collect()]
    assert got == [58.0, 240.0, 0.0, None, None, None, None, None, 2.5, 0.0, -95.9, None, 0.5, 1000.0, 1.5e-5, -2.0e7, 3.0, 4.0]


def test_rfc822(spark):
    df = spark.createDataFrame([("Sat, 04 May 2024 07:15:00 -0500",), ("junk",)], "t string")
    got = [r.ts for r in df.select(rfc822(F.col("t")).alias("ts")).collect()]
    assert got[1] is None
    assert got[0].replace(tzinfo=UTC) == dt.datetime(2024, 5, 4, 12, 15, tzinfo=UTC)


def test_to_json_keeps_null_fields(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert df.select(to_json_text(F.struct("x", "y")).alias("j")).first().j == '{"x":"a","y":null}'


def test_oracle_concat_treats_null_as_empty(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert df.select(oracle_concat(F.col("x"), F.lit("/"), F.col("y")).alias("c")).first().c == "a/"


def test_read_log_records(spark, log_dir):
    recs = read_response_log(spark, log_dir).collect()
    assert [r.city for r in recs] == ["Riverton", "Harbor City", "Riverton"]
    assert recs[0].logged_at.replace(tzinfo=UTC) == dt.datetime(2024, 5, 4, 12, 15, 10, tzinfo=UTC)
    assert recs[1].body == body(HARBOR_1)


def test_ingest_typed_columns(spark, log_dir):
    rows = {(r.city, r.weather): r for r in weather.ingest_log(spark, log_dir).collect()}
    r1 = rows[("Riverton", "Clear")]
    assert (r1.wind_gust_mph, r1.heat_index_f, r1.relative_humidity) == (2.5, None, 58.0)
    assert (r1.precip_1hr_in, r1.precip_1hr_metric, r1.precip_today_in, r1.solarradiation) == (None, 0.0, None, None)
    assert (r1.longitude, r1.station_elevation_ft, r1.temp_f) == (-95.9, 240.0, 68.25)
    assert r1.observed_at.replace(tzinfo=UTC) == dt.datetime.fromtimestamp(1714806900, UTC)
    h = rows[("Harbor City", "Haze")]
    assert (h.wind_gust_mph, h.heat_index_f, h.state, h.temp_f) == (0.0, 99.0, "", 88.0)


def test_latest_reading(spark, log_dir):
    latest = {r.city: r.weather for r in weather.latest_reading(weather.ingest_log(spark, log_dir)).collect()}
    assert latest == {"Riverton": "Mostly Cloudy", "Harbor City": "Haze"}


def test_log_write_read_round_trip(spark):
    at = dt.datetime(2024, 5, 4, 12, 0, 1)
    df = spark.createDataFrame([("Riverton", at, body(RIVERTON_1))], "city string, at timestamp, b string")
    path = work_path(spark, "log_rt")
    write_response_log(df, path, F.col("city"), F.col("at"), F.col("b"))
    write_response_log(df, path, F.col("city"), F.col("at"), F.col("b"))  # second append
    recs = read_response_log(spark, path).collect()
    assert len(recs) == 2 and all(r.body == body(RIVERTON_1) and r.city == "Riverton" for r in recs)


def _t(minute):
    return dt.datetime(2024, 5, 4, 12, minute, tzinfo=UTC)


def _responses(spark):
    b1, b2, bh = body(RIVERTON_1), body(RIVERTON_2), body(HARBOR_1)
    atl = body({"current_observation": {"display_location": {"city": "Atlantis"}, "weather": "Rain"}})
    third = len(b2) // 3
    rows = [
        (1, "RV/Riverton", 200, 0, b1, _t(1)),
        # later response for the same key, body in three chunks out of order
        (5, "RV/Riverton", 200, 2, b2[2 * third:], _t(5)),
        (5, "RV/Riverton", 200, 0, b2[:third], _t(5)),
        (5, "RV/Riverton", 200, 1, b2[third:2 * third], _t(5)),
        (2, "HC/Harbor_City", 200, 0, bh, _t(2)),
        (6, "HC/Harbor_City", 503, 0, None, _t(6)),          # non-200: only status changes
        (3, "NW/Northwick", None, 0, None, _t(3)),            # transport error: nothing changes
        (4, "AT/Atlantis", 200, 0, atl, _t(4)),               # unknown key: never inserted
    ]
    return spark.createDataFrame([(*r, None) for r in rows], RESPONSE_SCHEMA)


def _state(spark):
    status = spark.createDataFrame([
        ("Riverton", "Riverton,RV", None, None, None),
        ("Harbor City", "HC/Harbor_City", "Fog", "Success", _t(0)),
        ("Northwick", "NW/Northwick", "Snow", "Success", _t(0)),
    ], STATUS_SCHEMA)
    locations = spark.createDataFrame([
        ("RV/Riverton", "Riverton"), ("HC/Harbor_City", "Harbor City"),
        ("NW/Northwick", "Northwick"), ("AT/Atlantis", "Atlantis"),
    ], LOCATION_SCHEMA)
    return status, locations


def _check_refreshed(rows):
    got = {r.key: (r.location, r.data, r.update_status, r.last_update) for r in rows}
    assert set(got) == {"Riverton", "Harbor City", "Northwick"}
    assert got["Riverton"][:3] == ("Riverton,RV", "Mostly Cloudy", "Success")
    assert got["Riverton"][3].replace(tzinfo=UTC) == _t(5)
    assert got["Harbor City"][:3] == ("HC/Harbor_City", "Haze", "Failed")
    assert got["Harbor City"][3].replace(tzinfo=UTC) == _t(2)
    assert got["Northwick"][:3] == ("NW/Northwick", "Snow", "Success")


def test_refresh_batch(spark):
    status, locations = _state(spark)
    new_status, parsed, errors = weather.refresh(status, _responses(spark), locations)
    _check_refreshed(new_status.collect())
    assert [r.request_id for r in errors.collect()] == [3]
    listing = weather.status_listing(new_status).collect()
    assert [(r.ordinal, r.location) for r in listing] == [
        (1, "HC/Harbor_City"), (2, "NW/Northwick"), (3, "Riverton,RV")]
    path = work_path(spark, "weather_log")
    weather.append_log(parsed, path)
    assert sorted(r.city for r in read_response_log(spark, path).collect()) == [
        "Atlantis", "Harbor City", "Riverton", "Riverton"]


def test_landed_batch_read(spark):
    path = work_path(spark, "landed_batch")
    _responses(spark).write.json(path)
    back = read_landed(spark, path, fmt="json")
    assert back.schema == RESPONSE_SCHEMA
    status, locations = _state(spark)
    new_status, _, _ = weather.refresh(status, back, locations)
    _check_refreshed(new_status.collect())


def test_request_paths(spark):
    _, locations = _state(spark)
    paths = {r.key: r.request_path for r in weather.request_paths(locations, F.lit("KEY")).collect()}
    assert paths["Riverton"] == "/api/KEY/conditions/q/RV/Riverton.json"


def test_status_refresh_stream(spark):
    from freshet.operators.snapshot import publish, read_current, write_version
    from freshet.streaming.status_stream import run_status_refresh

    status, locations = _state(spark)
    root = work_path(spark, "stream_status")
    status_root = f"{root}/status"
    publish(spark, status_root, write_version(status, status_root))
    landing = f"{root}/landing"
    resp = _responses(spark)
    # two polls land as two files; the second holds the later responses
    resp.filter(F.col("request_id") <= 3).coalesce(1).write.json(f"{landing}/poll=1")
    resp.filter(F.col("request_id") > 3).coalesce(1).write.json(f"{landing}/poll=2")
    stream = read_landed_stream(spark, f"{landing}/*", fmt="json", max_files_per_trigger=1)
    q = run_status_refresh(spark, stream, locations, status_root, f"{root}/log", f"{root}/audit",
                           f"{root}/_checkpoint")
    q.awaitTermination()
    _check_refreshed(read_current(spark, status_root).collect())
    assert spark.read.parquet(f"{root}/audit").count() == 1


def test_reassemble_across_blocks(spark):
    from freshet.operators.reassemble import reassemble

    rows = [(1, s, f"<{s}>") for s in range(700)] + [(2, 0, None), (3, 5, "x"), (3, 1, None), (3, 0, "w")]
    df = spark.createDataFrame(rows, "k long, s int, t string").repartition(4)
    out = {r.k: (r.body, r.n) for r in
           reassemble(df, ["k"], "s", "t", extra={"n": (F.count(F.lit(1)), F.sum)}, block=64).collect()}
    assert out[1] == ("".join(f"<{s}>" for s in range(700)), 700)
    assert out[2] == (None, 1)
    assert out[3] == ("wx", 3)


def test_crlf_log(spark):
    text = log_text([("Riverton", "Sat May 04 2024 19:15:10 GMT-0400", RIVERTON_1),
                     ("Harbor City", "Sat May 04 2024 19:16:20 GMT+0800", HARBOR_1)]).replace("\n", "\r\n")
    rows = {r.city: r for r in weather.ingest_log(spark, _local_file(spark, "crlf", text)).collect()}
    assert set(rows) == {"Riverton", "Harbor City"}
    assert rows["Riverton"].logged_city == "Riverton" and rows["Riverton"].temp_f == 68.25
    assert rows["Harbor City"].logged_at.replace(tzinfo=UTC) == dt.datetime(2024, 5, 4, 11, 16, 20, tzinfo=UTC)


def test_header_text_format(spark):
    from freshet.sources.response_log import record_text

    df = spark.createDataFrame([("Riverton", dt.datetime(2016, 8, 29, 1, 58, 43, tzinfo=UTC), "{}")],
                               "city string, at timestamp, b string")
    text = df.select(record_text(F.col("city"), F.col("at"), F.col("b")).alias("t")).first().t
    assert text == "Successfully get new data for Riverton on Mon Aug 29 2016 01:58:43 GMT+0000\n{}"


def test_a_bad_header_leaves_nulls(spark):
    text = log_text([("Riverton", "Sat May 04 2024 19:15:10 GMT+0700", RIVERTON_1)])
    path = _local_file(spark, "bad", text + "Successfully get new data for nowhere in time\n{}\n")
    recs = {r.body: (r.city, r.logged_at is None) for r in read_response_log(spark, path).collect()}
    assert recs["{}"] == (None, True) and recs[body(RIVERTON_1)] == ("Riverton", False)
