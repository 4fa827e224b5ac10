"""Answers, people, markup, reports, batches: worked cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from listmill.functions import answers, markup, names, people, vacancy
from listmill.operators import candidates, extract, history, merge, quality, reports, review

LINE = {"quote": "5 years of SQL", "type": "years", "status": "required", "detail": "SQL", "things": ["SQL"], "needs": "all", "number": 5, "years_of": ["thing"], "level": None}
TEXT = "We need 5 years of SQL , and • “good” English"


def extraction(**line):
    return {"kinds": ["data"], "lines": [LINE | line], "recruitment_firm": False, "public_sector": True}


@pytest.mark.parametrize(
    "answer,error",
    [
        (extraction(), None),
        (extraction(quote="5 years of SQL, and"), None),
        (extraction(quote="6 years"), "quote exceeds 60 words or was not found"),
        (extraction(number=51), "years need a number from 0 to 50 and years_of"),
        (extraction(number=True), "number must be finite or null"),
        (extraction(years_of=["impossible", "thing"]), "impossible years stand alone"),
        (extraction(things=[]), "years of a thing need its name"),
        (extraction(type="tool"), "years_of is for years only"),
        (extraction(type="contract", years_of=[], number=1.5), "months of a contract are whole, from 1 to 120"),
        (extraction(type="tool", years_of=[], number=1), "number is for years and contracts only"),
        (extraction(type="language", years_of=[], number=None), "a language needs a name and a level"),
        (extraction(type="language", years_of=[], number=None, level="basic_spoken"), None),
        (extraction(type="education", years_of=[], number=None), "education needs a level"),
        (extraction(level="degree"), "level is for languages and education only"),
        (extraction(extra=1), "a line needs exactly nine fields"),
        (extraction() | {"kinds": ["data", "data"]}, "needs one to three different known kinds"),
        (extraction() | {"public_sector": 1}, "flags must be true or false"),
        (extraction() | {"lines": None}, "lines must be a list"),
        ("text", "needs exactly kinds, lines, recruitment_firm and public_sector"),
    ],
)
def test_extraction_contract(answer, error):
    assert answers.extraction_error(answer, "Title", TEXT, ["data", "web"]) == error


def test_triage_contract():
    good = {"profession": "data engineer", "quote": '- "GOOD" english', "verdict": "yes"}
    assert answers.triage_error(good, "T", TEXT, ["yes", "no"]) is None
    assert answers.triage_error(good | {"verdict": "maybe"}, "T", TEXT, ["yes", "no"]) == "unknown verdict"
    assert answers.triage_error(good | {"profession": "w " * 13}, "T", TEXT, ["yes"]) == "profession exceeds 12 words"
    assert answers.triage_error(good | {"quote": "x" * 5}, "T", None, ["yes"]) == "quote was not found"
    assert answers.triage_error({}, "T", TEXT, ["yes"]) == "needs exactly profession, quote and verdict"
    assert answers.shortened("w " * 40) == " ".join(["w"] * 30)
    schema = answers.response_schema(["data"], ["team"])
    assert schema["properties"]["lines"]["items"]["required"] == list(answers.LINE_FIELDS) and "team" in schema["properties"]["lines"]["items"]["properties"]["years_of"]["items"]["enum"]


def test_safe_markup():
    assert markup.safe("<p onclick=x>A<script>x<b>y</b></script><a href='javascript:x'>l</a><a href=\"https://x/?a=1&b='\">m</a><img src=x><br/>1 < 2") == (
        '<p>A<a>l</a><a href="https://x/?a=1&amp;b=&#x27;" target="_blank" rel="noopener noreferrer">m</a><br>1 &lt; 2'
    )
    assert markup.safe(None) == "" and markup.changed_lines("a\nold line\n\n", "a\nold lime\n") == ["- old line", "+ old lime"]


def test_names_and_people(spark):
    assert people.alike("Zoë Groß", "zoe gross") is (names.plain_letters("Zoë Groß") == "zoe gross")
    assert people.alike("Jane D.", "Jane Doe") and not people.alike("Jane D.", "Jane Roe") and people.alike("Doe Jane", "Jane Doe", any_order=True) and not people.alike("Doe Jane", "Jane Doe")
    assert people.completed("Jane D.", "jane-doe-12a") == "Jane Doe" and people.completed("Jane D.", "jane-roe") == "Jane D."
    rows = [
        (1, 1, "Jane D.", "Head", None, None, "listing", "provider_inferred", True, False), (1, 2, "Jane Doe", "Other", "jdoe", "j@x", "web", "publicly_observed", False, True),
        (1, 3, "Other Person", None, "jdoe", None, "sgdi", "provider_observed", False, False), (2, 1, "Jane Doe", None, None, None, "web", "publicly_observed", False, False),
    ]
    got = sorted(map(tuple, people.merged_people(spark.createDataFrame(rows, people.PERSON)).collect()))
    assert got == [(1, 1, "Jane Doe", "Head", "jdoe", "j@x", "listing", "publicly_observed", False, True), (2, 1, "Jane Doe", None, None, None, "web", "publicly_observed", False, False)]


def test_reports():
    now = dt.datetime(2024, 1, 1, 20, 30, 5, tzinfo=dt.timezone.utc)
    assert reports.new_id("mcf", "sg", now=now).startswith("mcf_sg_20240102_043005_") and reports.new_id("a") != reports.new_id("a")


def test_reasons_hold_no_secrets(spark):
    df = spark.createDataFrame([("see https://x/?key=abc&b=1 for batches/1234 at 2024-01-02T03:04",)], "t string")
    assert df.select(reports.short_reason(F.col("t"))).first()[0] == "see https://x/?key=[private]&b=1 for [private provider reference] at [saved time]"


def test_ledger_goes_on_where_it_was(spark, tmp_path):
    ledger, did = extract.Ledger(spark, f"file://{tmp_path}/done"), []

    def work(name):
        if name == "c" and "c" not in did:
            did.append("c")
            raise RuntimeError("lost")
        did.append(name)

    with pytest.raises(RuntimeError):
        ledger.run("abcd", work)
    assert extract.Ledger(spark, f"file://{tmp_path}/done").run("abcd", work) == ["c", "d"] and did == ["a", "b", "c", "c", "d"]
    assert extract.unchanged({"status": "complete", "v": 3}, {"v": 3}) and not extract.unchanged({"status": "complete", "v": 3}, {"v": 4}) and not extract.unchanged({"status": "complete", "v": 3}, {"v": 3}, 1)


def test_checks_refuse(spark):
    found = merge.invariants({"a": spark.range(0), "b": spark.range(2)})
    with pytest.raises(quality.Violated, match="b: 2"):
        quality.require(found, "staged")
    quality.require(found.where("name = 'a'"), "staged")


def test_filters_that_cannot_be_read_are_left_out(spark):
    assert list(review.predicates(review.Filters(description="(a", title="x"))) == ["title"]
    assert review.chips(review.Filters(markets=("SG",), exclude="a")) == [("market", "SG"), ("exclude", "not a")]
    with pytest.raises(ValueError):
        review.kept_ids("1,x")
    assert review.kept_ids("") == []


def test_blocks_refuse_too_many_pairs(spark):
    rows = spark.createDataFrame([(i, i % 2 if i < 40 else None) for i in range(50)], "id long, k int")
    assert candidates.block_pairs(rows, "id", ["k"], most=14).count() == 2 * 190
    with pytest.raises(candidates.TooManyPairs):
        candidates.block_pairs(rows, "id", ["k"], most=5)
    assert candidates.block_links(rows, "id", ["k"]).count() == 38


def test_earlier_copy_against_all_pairs(spark):
    import random

    rnd = random.Random(2)
    day = dt.date(2024, 1, 1)
    rows = [(i, rnd.choice(["a", "b", None]), rnd.choice([1, 2]), day + dt.timedelta(rnd.randrange(20)), rnd.choice(["x", "y", "z", None])) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, k string, m int, day date, other string")
    got = {r.id: r.repeat_of for r in history.earlier_copy(df, "id", ["k", "m"], "day", "other", 5).collect()}
    for i, k, m, d, o in rows:
        found = [(e, j) for j, k2, m2, e, p in rows if (k2, m2) == (k, m) and o is not None and p is not None and p != o and 1 <= (d - e).days <= 5]
        assert got[i] == (min(found)[1] if found else None)


def test_vacancy_titles(spark):
    cases = [("Senior Data Engineer (Remote)", "Data Engineer, Payments", True), ("Data Platform Engineer", "Cook", False), ("Data Engineer", " ", True), ("Engineer", "Analyst", True)]
    df = spark.createDataFrame(cases, "a string, b string, ok boolean")
    assert all(r.ok == r.got for r in df.select("ok", vacancy.title_agrees(F.col("a"), F.col("b")).alias("got")).collect())
