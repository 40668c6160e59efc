"""Command-line entry points on parquet tables."""

import datetime as dt

from freshet.__main__ import main
from freshet.operators.snapshot import publish, read_current, write_version
from freshet.session import work_path
from tests.test_renewal_fixtures import tables  # noqa: F401  (fixture)
from tests.test_weather_fixtures import _check_refreshed, _responses, _state


def test_renewal_command(spark, tables):  # noqa: F811
    root = work_path(spark, "cli_renewal")
    names = ("tariff", "tariff_domain", "tariff_data", "apply_result", "approve_result")
    for name, df in zip(names, tables):
        df.write.parquet(f"{root}/in/{name}")
    from freshet.sources.tables import save_bucketed

    save_bucketed(tables[2], "cli_tariff_data", "id", 4)
    spark.createDataFrame([(1, dt.date(2020, 1, 1), None)], "id long, date_from date, date_to date") \
        .write.parquet(f"{root}/in/constants")
    args = ["renewal", "--out", f"{root}/out", "--ldate", "2024-12-31"]
    for name in names + ("constants",):
        ref = "table:cli_tariff_data" if name == "tariff_data" else f"{root}/in/{name}"
        args += [f"--{name.replace('_', '-')}", ref]
    assert main(args) == 0
    tariff = {r.id: r.is_ready for r in read_current(spark, f"{root}/out/tariff").collect()}
    assert tariff[10] == "Y"


def test_refresh_and_listing_commands(spark, capsys):
    status, locations = _state(spark)
    root = work_path(spark, "cli_status")
    publish(spark, f"{root}/status", write_version(status, f"{root}/status"))
    locations.write.parquet(f"{root}/locations")
    _responses(spark).write.json(f"{root}/landed")
    assert main(["refresh", "--status-root", f"{root}/status", "--locations", f"{root}/locations",
                 "--responses", f"{root}/landed", "--log", f"{root}/log", "--audit", f"{root}/audit"]) == 0
    _check_refreshed(read_current(spark, f"{root}/status").collect())
    assert main(["listing", "--status-root", f"{root}/status", "--rows", "5"]) == 0
    assert "HC/Harbor_City" in capsys.readouterr().out


def test_listing_writes_every_row(spark, capsys):
    root = work_path(spark, "cli_listing")
    status = spark.range(150).selectExpr("lpad(id, 3, '0') AS key", "'L' || id AS location", "CAST(NULL AS STRING) AS data",
                                         "CAST(NULL AS STRING) AS updateStatus", "CAST(NULL AS TIMESTAMP) AS lastUpdate")
    publish(spark, f"{root}/status", write_version(status, f"{root}/status"))
    assert main(["listing", "--status-root", f"{root}/status", "--out", f"{root}/out"]) == 0
    assert [r.location for r in spark.read.parquet(f"{root}/out").orderBy("ordinal").collect()] == [f"L{i}" for i in range(150)]
    assert "L1" not in capsys.readouterr().out


def test_seed_command(spark):
    from freshet.sources.landing import STATUS_SCHEMA

    _, locations = _state(spark)
    root = work_path(spark, "cli_seed")
    locations.write.parquet(f"{root}/locations")
    assert main(["seed", "--status-root", f"{root}/status", "--locations", f"{root}/locations"]) == 0
    seeded = read_current(spark, f"{root}/status")
    assert seeded.schema == STATUS_SCHEMA
    assert sorted(r.key for r in seeded.collect()) == ["Atlantis", "Harbor City", "Northwick", "Riverton"]


def test_ingest_command(spark):
    from tests.fixtures.weather_samples import HARBOR_1, RIVERTON_1, RIVERTON_2, log_text
    from tests.test_weather_fixtures import _local_file

    log = _local_file(spark, "file", log_text([
        ("Riverton", "Sat May 04 2024 19:15:10 GMT+0700", RIVERTON_1),
        ("Harbor City", "Sat May 04 2024 19:16:20 GMT+0700", HARBOR_1),
        ("Riverton", "Sat May 04 2024 19:17:30 GMT+0700", RIVERTON_2),
    ]))
    out = work_path(spark, "cli_ingest")
    assert main(["ingest", "--log", log, "--out", out, "--latest"]) == 0
    latest = {r.city: r.weather for r in spark.read.parquet(out).collect()}
    assert latest == {"Riverton": "Mostly Cloudy", "Harbor City": "Haze"}


def test_stream_command(spark):
    status, locations = _state(spark)
    root = work_path(spark, "cli_stream")
    publish(spark, f"{root}/status", write_version(status, f"{root}/status"))
    locations.write.parquet(f"{root}/locations")
    _responses(spark).coalesce(1).write.json(f"{root}/landing")
    assert main(["stream", "--status-root", f"{root}/status", "--locations", f"{root}/locations",
                 "--landing", f"{root}/landing", "--checkpoint", f"{root}/_checkpoint",
                 "--log", f"{root}/log", "--audit", f"{root}/audit"]) == 0
    _check_refreshed(read_current(spark, f"{root}/status").collect())
