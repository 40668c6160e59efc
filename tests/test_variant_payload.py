"""Fields that change type, read as variants."""

from freshet.functions.variant_payload import field_kinds, variant_body, variant_conditions
from pyspark.sql import functions as F

BODIES = [
    '{"current_observation":{"display_location":{"city":"A"},"temp_f":86,"wind_gust_mph":"2.5","UV":null,"flag":true,"list":[1]}}',
    '{"current_observation":{"display_location":{"city":"B"},"temp_f":"74.5","wind_gust_mph":0,"UV":"-9999.00","relative_humidity":"66%"}}',
    '{"current_observation":{"temp_f":1.5e2,"UV":"NA"}}', "{broken", None, "[]", '{"current_observation":7}',
]


def _bodies(spark):
    return spark.createDataFrame([(b,) for b in BODIES], "body string")


def test_kinds_of_fields(spark):
    got = {(r.field, r.kind): (r.n, r.drifts) for r in field_kinds(_bodies(spark)).collect()}
    assert got == {
        ("display_location", "object"): (2, False), ("temp_f", "number"): (2, True), ("temp_f", "text"): (1, True), ("wind_gust_mph", "text"): (1, True),
        ("wind_gust_mph", "number"): (1, True), ("UV", "null"): (1, False), ("UV", "text"): (2, False), ("flag", "boolean"): (1, False), ("list", "array"): (1, False),
        ("relative_humidity", "text"): (1, False),
    }
    assert field_kinds(_bodies(spark).limit(0)).count() == 0


def test_typed_whatever_was_sent(spark):
    rows = _bodies(spark).withColumn("v", variant_body(F.col("body"))).select(*variant_conditions(F.col("v"))).collect()
    assert [(r.city, r.temp_f, r.wind_gust_mph, r.UV, r.relative_humidity) for r in rows] == [
        ("A", 86.0, 2.5, None, None), ("B", 74.5, 0.0, None, 66.0), (None, 150.0, None, None, None), *[(None,) * 5] * 4]
