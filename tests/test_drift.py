from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from parcelight.operators import drift

SCHEMA = "export_id long, building_id string, module string, run_no int, exported_at timestamp_ntz, rec_no int, payload string, field string, v int"


def exports(spark, *runs, building="B"):
    """Each run: a list of payloads (objects or texts)."""
    rows = []
    for i, payloads in enumerate(runs, 1):
        for n, p in enumerate(payloads):
            rows.append((i, building, "m", i * 3, datetime(2024, 1, 30 - i), n, p if p is None or isinstance(p, str) else json.dumps(p), "clash", 1))
    return spark.createDataFrame(rows, SCHEMA)


def changes(ws, df):
    return sorted(tuple(r) for r in drift.field_changes(ws, df).collect())


def test_added_removed_retyped(spark, ws):
    df = exports(spark, [{"detection_id": 1, "a": 1, "b": "x", "c": 1}], [{"detection_id": 1, "a": "1", "c": None, "d": [1, 2]}])
    assert changes(ws, df) == [(2, "added", "", "d"), (2, "removed", "b", ""), (2, "removed", "c", ""), (2, "retyped", "a", "a")]


@pytest.mark.parametrize("new", [0.5, "0.5", "0,5", " 0.50 ", [0.5], ["0,5"], {"value": 0.5}, {"value": "0.5", "unit": "x"}])
def test_renamed_by_value(spark, ws, new):
    df = exports(spark, [{"detection_id": 1, "score": 0.5}, {"detection_id": 2, "score": 0.25}], [{"detection_id": 2, "avg": None}, {"detection_id": 1, "avg": new}])
    got = changes(ws, df)
    kind = {float: "number", str: "string", list: "array", dict: "object"}[type(new)]
    assert (2, "renamed", "score", "avg") in got
    assert ((2, "retyped", "score", "avg") in got) == (kind != "number")
    assert len(got) == (1 if kind == "number" else 2)


def test_one_disagreement_is_no_renaming(spark, ws):
    df = exports(spark, [{"detection_id": i, "a": i} for i in range(4)], [{"detection_id": i, "b": i if i else 9} for i in range(4)])
    assert changes(ws, df) == [(2, "added", "", "b"), (2, "removed", "a", "")]


def test_no_common_detection_is_no_renaming(spark, ws):
    df = exports(spark, [{"detection_id": 1, "a": 1}], [{"detection_id": 2, "b": 1}])
    assert changes(ws, df) == [(2, "added", "", "b"), (2, "removed", "a", "")]


def test_each_field_is_used_once(spark, ws):
    df = exports(spark, [{"detection_id": i, "a": i, "c": 5} for i in range(3)], [{"detection_id": i, "b": i} | ({"d": i} if i < 2 else {}) for i in range(3)])
    assert changes(ws, df) == [(2, "added", "", "d"), (2, "removed", "c", ""), (2, "renamed", "a", "b")]


def test_unreadable_and_repeated_records_change_nothing(spark, ws):
    good = {"detection_id": 1, "a": 1}
    df = exports(spark, [good, good, '{"detection_id": 1, "z":', None, "", "[1]", "7"], [good, '{"q": 1}x'])
    assert changes(ws, df.unionAll(df)) == []


def test_series_stay_apart_and_the_first_has_none(spark, ws):
    a = exports(spark, [{"detection_id": 1, "a": 1}], building="A")
    b = exports(spark, [{"detection_id": 1, "b": 1}], building="B").withColumn("export_id", F.lit(9).cast("long"))
    assert changes(ws, a.unionAll(b)) == []
    assert changes(ws, a.limit(0)) == []


def test_a_long_text_and_unusual_names(spark, ws):
    long = "y" * 200_000
    df = exports(spark, [{"detection_id": 1, "a.b c": long}], [{"detection_id": 1, "ü`": long}])
    assert changes(ws, df) == [(2, "renamed", "a.b c", "ü`")]


def test_unified_table(spark, ws):
    first = [{"detection_id": i, "score": i / 10, "prompt": "p", "flag": True, "run_no": "own"} for i in range(1, 6)]
    second = [{"detection_id": i, "avg_score": [f"0,{i}"], "Prompt": ["p"], "flag": False} for i in range(1, 6)]
    df = exports(spark, first, second, first)
    rows = drift.unify(ws, df.unionAll(df)).orderBy("export_id", "rec_no")
    assert rows.count() == 15
    assert dict(rows.dtypes)["score"] == "double" and dict(rows.dtypes)["flag"] == "boolean"
    assert "avg_score" not in rows.columns and "run_no_field" in rows.columns
    got = {(r.export_id, r.detection_id): (r.score, r.prompt, r.flag) for r in rows.collect()}
    assert got[2, 3] == (0.3, "p", False) and got[1, 3] == (0.3, "p", True)


def test_families_refuse_fields_that_stand_side_by_side():
    names = {"score": 100, "avg": 50, "raw": 40}
    links = {("score", "avg"): 9, ("avg", "raw"): 1}
    assert drift._families(names, links, {("raw", "score"): 30}) == {"score": "score", "avg": "score", "raw": "raw"}
    assert drift._families(names, links, {}) == {"score": "score", "avg": "score", "raw": "score"}


def test_promotion(spark):
    rows = [(["number"], "number"), (["number", "string"], "string"), (["array", "object"], "string"), (["boolean", "number"], "string"), (["object"], "object")]
    bit = F.create_map(*[F.lit(x) for kv in drift.TYPES.items() for x in kv])[F.col("t")]
    df = spark.createDataFrame([(i, t, want) for i, (types, want) in enumerate(rows) for t in types * 2], "i int, t string, want string")
    folded = df.groupBy("i", "want").agg(drift.promote(bit).alias("types"))
    assert [(r.got, r.want) for r in folded.select(drift.named(F.col("types")).alias("got"), "want").collect() if r.got != r.want] == []
    assert folded.agg(drift.promote("types").alias("all")).first()["all"] == sum(drift.TYPES.values())


def test_the_log_is_ordered(spark, ws):
    a = exports(spark, *[[{"detection_id": 1, f"f{i}": i, f"g{i % 2}": "x"}] for i in range(5)], building="B")
    b = exports(spark, *[[{"detection_id": 1, f"f{i}": i}] for i in range(5)], building="A").withColumn("export_id", F.col("export_id") + 100)
    log = [tuple(r) for r in drift.change_log(ws, a.unionAll(b)).collect()]
    assert log == sorted(log) and {r[0] for r in log} == {"A", "B"} and len(log) == 4 * 3 + 4 * 2
