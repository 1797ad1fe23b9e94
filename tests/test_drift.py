from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from feedweave.operators import drift as D

CASES = [
    ({"id": "str", "name": "str", "value": "float"}, '{"id":"1","name":"t"}', ["value"], [], 0, 0.267),
    ({"id": "str", "name": "str"}, '{"id":"1","name":"t","extra_field":"x"}', [], ["extra_field"], 0, 0.3),
    ({"id": "str", "name": "str", "value": "float"}, '{"id":"1","name":"t","value":"not_a_float"}', [], [], 1, 0.2),
    ({"user_id": "str", "user_name": "str"}, '{"usr_id":"1","user_name":"x"}', ["user_id"], ["usr_id"], 0, 0.7),
    ({"field1": "str", "field2": "str", "field3": "str"}, '{"field1":"a","field2":"b","field3":"c"}', [], [], 0, 0.0),
    ({"field1": "str", "field2": "str", "field3": "str"}, "{}", ["field1", "field2", "field3"], [], 0, 0.4),
    ({"id": "str", "name": "str"}, '{"id":"1"}', ["name"], [], 0, 0.4),
    ({"n": "int", "f": "float", "s": "str"}, '{"n":1.5,"f":3,"s":{"a":1}}', [], [], 0, 0.0),
    ({"n": "int"}, '{"n":true}', [], [], 1, 0.3),
    ({"n": "int"}, '{"n":null}', [], [], 0, 0.0),
]


def detected(spark, expected, raw):
    df = spark.createDataFrame([(raw,)], "raw_data string").withColumn(
        "fields", F.json_object_keys("raw_data")
    )
    record = F.try_parse_json("raw_data")
    return D.detect(df, expected, mismatches=D.json_mismatches(record, expected))


@pytest.mark.parametrize("expected,raw,missing,extra,mismatched,confidence", CASES)
def test_goldens(spark, expected, raw, missing, extra, mismatched, confidence):
    row = detected(spark, expected, raw).first()
    assert row["missing_fields"] == missing
    assert row["extra_fields"] == extra
    assert len(row["type_mismatches"]) == mismatched
    assert row["confidence_score"] == pytest.approx(confidence, abs=0.001)
    assert row["has_drift"] == (confidence > 0)


def test_mismatch_details(spark):
    row = detected(spark, {"n": "int"}, '{"n":"' + "z" * 80 + '"}').first()
    assert row["type_mismatches"][0].asDict() == {
        "field": "n", "expected_type": "int", "actual_type": "str", "value": "z" * 50,
    }
    row = detected(spark, {"n": "int"}, '{"n":true}').first()
    assert row["type_mismatches"][0]["value"] == "True"


def test_no_expected_schema(spark):
    row = detected(spark, {"a": "str"}, "{}").select("raw_data", "fields").transform(
        lambda d: D.detect(d, None)
    ).first()
    assert (row["has_drift"], row["confidence_score"], row["missing_fields"]) == (False, 0.0, [])


def test_suggestions(spark):
    df = detected(spark, {"user_id": "str", "user_name": "str"}, '{"usr_id":"1","user_name":"x"}')
    row = D.with_suggestions(df).first()
    assert [s.asDict() for s in row["fuzzy_suggestions"]] == [
        {"missing_field": "user_id", "suggested_field": "usr_id", "similarity": 0.923}
    ]
    log = D.log_rows(D.with_suggestions(df), F.lit("s"), F.lit("r"), F.lit("2024-01-01")).first()
    assert (log["source_name"], log["confidence_score"]) == ("s", 0.7)
    assert D.detect(df.select("raw_data", "fields"), {"usr_id": "str", "user_name": "str"}).filter("has_drift").isEmpty()


def test_best_suggestion_per_missing_field_matches_brute_force(spark):
    expected = {n: "str" for n in ["price_usd", "description", "market_cap", "created_at"]}
    shapes = [
        ["price", "desc", "market_caps", "create_at", "created"],
        ["summary", "price_eur", "price_us", "marketcap"],
        ["description", "created_on", "created_by", "market_cap"],
    ]
    df = spark.createDataFrame([(s,) for s in shapes], "fields array<string>")
    rows = D.with_suggestions(D.detect(df, expected)).collect()
    for row in rows:
        wanted = []
        for m in row["missing_fields"]:
            scored = [(SequenceMatcher(None, m, e).ratio(), e) for e in row["extra_fields"]]
            good = sorted(((-r, e) for r, e in scored if r > 0.6))
            if good:
                wanted.append((m, good[0][1], round(-good[0][0], 3)))
        assert [tuple(s) for s in row["fuzzy_suggestions"]] == wanted


def test_severity(spark):
    rows = spark.createDataFrame([(0.5,), (0.501,)], "c double").select(D.severity(F.col("c"))).collect()
    assert [r[0] for r in rows] == ["INFO", "WARNING"]
