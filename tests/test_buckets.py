"""Requirement evaluation and the bucket cascade."""

import json

import pytest
from pyspark.sql import functions as F

from listmill.functions import rules

PREFS = {"things": {"Python": "have", "Java": "lack", "Go": "other", "Clearance": "wall"}, "kinds": {"data": "preferred", "web": "yes", "qa": "limited", "sales": "no"}, "years": {"*": [3, 5, 7]}, "currency": "SGD", "salary_floor": 5000}
OK = {"verdict": "accept"}


def line(kind="tool", things=(), status="required", **more):
    return {"type": kind, "things": list(things), "status": status, "quote": "", **more}


@pytest.mark.parametrize(
    "row,triage,extraction,expected",
    [
        ({"history": True}, None, None, "not_sorted"),
        ({"title_reason": "sales assistant"}, OK, None, "title_filter"),
        ({"language_reason": "Thai script"}, OK, None, "ineligible"),
        ({}, {"verdict": "non_technical"}, None, "non_tech"),
        ({}, {"verdict": "language"}, None, "ineligible"),
        ({}, None, None, "not_sorted"),
        ({}, OK, {"kinds": ["data"], "lines": [line("internship")]}, "tech_not_for_me"),
        ({}, OK, {"kinds": ["sales"]}, "tech_not_for_me"),
        ({}, OK, {"kinds": ["data"], "lines": [line(things=["clearance"])]}, "ineligible"),
        ({}, OK, {"kinds": ["data"], "lines": [line(things=["Java"]), line(things=["Rust"])]}, "ineligible"),
        ({}, OK, {"kinds": ["data"], "lines": [line("years", number=8)]}, "ineligible"),
        ({"salary_max": 48000, "salary_currency": "SGD", "salary_period": "Annual"}, OK, {"kinds": ["data"]}, "less_interested"),
        ({}, OK, {"kinds": ["data", "qa"]}, "less_interested"),
        ({}, OK, {"kinds": ["data"], "lines": [line("years", number=6)]}, "less_interested"),
        ({}, OK, {"kinds": ["data"], "lines": [line(things=["Python", "Java"], needs="any")]}, "top_picks"),
        ({}, OK, {"kinds": ["data"], "lines": [line(things=["Java"])]}, "in_lane"),
        ({}, OK, {"kinds": ["web"]}, "in_lane"),
    ],
)
def test_cascade(row, triage, extraction, expected):
    assert rules.bucket(row, triage, extraction, PREFS).bucket == expected


def test_requirements():
    got = rules.evaluate([line(things=["java"]), line(things=["JAVA"]), line(things=["Python"], status="preferred"), line("years", status="unknown", number=4), line(things=["Go", "Java"], needs="all")], PREFS)
    assert (got.lacks, got.zone, got.excess, got.preferred_held) == (("java",), 1, 1.0, 1)
    assert rules.effective_status({"status": "required", "quote": "Python is a bonus"}) == "preferred"
    assert rules.effective_status({"status": "required", "quote": "not essential but must learn"}) == "required"
    assert rules.repeat_key("x", ["B", "a"]) == rules.repeat_key("x", ["A", "b", "b"])


def test_udf_and_closure(spark):
    df = spark.createDataFrame([(json.dumps({}), json.dumps(OK), json.dumps({"kinds": ["data"]})), (None, None, None)], "r string, t string, e string")
    assert [r.b.bucket for r in df.select(rules.bucketed(PREFS)("r", "t", "e").alias("b")).collect()] == ["top_picks", "not_sorted"]
    with pytest.raises(ValueError):
        rules.bucketed({"things": {"x": "maybe"}})
    rows = spark.createDataFrame([("mcf", "open", 2), ("mcf", "Active", 1), ("linkedin", "closed", 9), ("seek", None, 0)], "b string, s string, n int")
    assert [r[0] for r in rows.select(rules.closed(F.col("b"), F.col("s"), F.col("n"))).collect()] == [True, False, None, None]
