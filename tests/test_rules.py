"""Row rules on worked cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from listmill.functions import dates, html, salary, text, titles
from listmill.operators.ranking import page_buttons


@pytest.mark.parametrize(
    "given,expected",
    [
        ("<p>Company:<br>Example Ltd</p><div>Remote</div>", "Company:\nExample Ltd\nRemote"),
        ("<ul><li>Build APIs</li><li><ol><li>Review</li><li>Ship</li></ol></li></ul>", "Build APIs\n  1. Review\n  2. Ship"),
        ("Software Enginee<strong>r</strong> / <strong>Senior</strong><em>Engineer</em>", "Software Engineer / SeniorEngineer"),
        ("A&nbsp;&amp;&nbsp;B; &amp;#x41; and &lt;person&gt;", "A & B; &#x41; and <person>"),
        ("<p>ID <R123456></p>", "ID <R123456>"),
        ("jobs@exam​ple.com Café A⁠B", "jobs@example.com Café AB"),
        ("A<script>hidden()</script><style>p{}</style><!-- hidden -->B", "AB"),
        ("a‌b‍c‏d", "a‌b‍c‏d"),
        ("", None),
        (None, None),
    ],
)
def test_html_to_text(given, expected):
    assert html.to_text(given) == (expected, None)


@pytest.mark.parametrize("given,reason", [("<p>Before</p><table></table>", "table"), ("<ol start=3><li>x</ol>", "ol[start]"), ("<ul><li value=2>x</ul>", "li[value]"), ("<img src=x>", "img")])
def test_html_refusals(given, reason):
    assert html.to_text(given) == (None, reason)


@pytest.mark.parametrize(
    "label,code,expected",
    [
        ("S$4,200 – S$6,300 per month", None, (4200, 6300, "SGD", "Monthly")),
        ("US$4,200 - US$6,300 per month", None, (4200, 6300, "USD", "Monthly")),
        ("$70-$95K p.a.", "AUD", (70000, 95000, "AUD", "Annual")),
        ("$4500 to $5k per month", "sgd", (4500, 5000, "SGD", "Monthly")),
        ("SGD 4000 ~ 7000 per month", None, (4000, 7000, "SGD", "Monthly")),
        ("Up to HK$28,000 per month", None, (None, 28000, "HKD", "Monthly")),
        ("from RM3k monthly + 2 bonuses", None, (3000, None, "MYR", "Monthly")),
        ("฿24,000 – ฿29,000 ต่อเดือน", None, (24000, 29000, "THB", "Monthly")),
        ("฿24,000 per month", None, (None, None, "THB", "Monthly")),
        ("$90,000 per year", None, (None, None, None, "Annual")),
        ("S$4,000 - S$5,000", None, (None, None, "SGD", None)),
        ("£20 - £30 or £40 per hour", None, (None, None, "GBP", "Hourly")),
        ("AUD or NZD 5 - 6 per day", None, (None, None, None, "Daily")),
        ("฿40,000 - ฿30,000 per month", None, (None, None, "THB", "Monthly")),
        ("  ", "AUD", (None, None, None, None)),
        (None, None, (None, None, None, None)),
    ],
)
def test_salary(label, code, expected):
    assert tuple(salary.parse(label, code)) == expected


def test_nights(spark):
    got = spark.sql("select timestamp_ntz'2024-01-01 18:59:59' a, timestamp_ntz'2024-01-01 19:00:00' b").select(dates.night(F.col("a")), dates.night(F.col("b"))).first()
    assert tuple(got) == (dt.date(2024, 1, 1), dt.date(2024, 1, 2))


def test_title_rules(spark):
    rows = [("Senior Data Engineer", "Data Engineer", True), ("Data Analyst", "Data Engineer", False), ("", "", False)]
    df = spark.createDataFrame(rows, "a string, b string, fits boolean")
    assert all(r.fits == r.got for r in df.select("fits", titles.compatible(titles.tokens(F.col("a")), titles.tokens(F.col("b"))).alias("got")).collect())
    pairs = [("Back-End Developer", "BE Developer", True), ("Head of Data Science", "HODS lead", True), ("Data Analyst", "Data Engineer", False), ("Vice President", "VP", False), (None, "x", False)]
    df = spark.createDataFrame(pairs, "a string, b string, same boolean")
    assert all(r.same == r.got for r in df.select("same", titles.continuous(F.col("a"), F.col("b")).alias("got")).collect())
    stages = spark.createDataFrame([("Graduate Internship",), ("Intern",), ("GRAD Programme",), ("Clerk",), ("Interns and graduates",)], "t string").select(titles.stage(F.col("t"))).collect()
    assert [r[0] for r in stages] == [None, "intern", "graduate", None, None]


def test_first_phrase(spark):
    rows = ["Sales Assistants", "sales/assistant", "Sales-  assistant", "Saless assistant", "Software Sales Assistant", "Data Entry Clerk", "Data-entries", "Data Engineer", "data entry of data", "Deputies", "Deputys", "Tax Clerks", "Taxes Clerk", None]
    df = spark.createDataFrame([(t,) for t in rows], "t string")
    got = [r[0] for r in df.select(titles.first_phrase(F.col("t"), ["sales assistant", "data entry", "deputy", "tax"], ["software", "data"])).collect()]
    assert got == ["sales assistant", "sales assistant", "sales assistant", None, None, "data entry", "data entry", None, None, "deputy", None, "tax", "tax", None]


def test_verdicts(spark):
    cases = [
        (0.72, ["lsh"], False, "Back-End Developer", "BE", True, False, "high", False),
        (0.72, ["lsh"], True, "Data Engineer", "Cook", True, False, None, True),
        (0.72, ["lsh"], False, "Data Engineer", "Cook", False, False, "high", False),
        (0.72, ["lsh"], False, "Data Engineer", "Cook", True, False, None, True),
        (0.72, ["lsh"], False, "Data Engineer", "Cook", True, True, "high", False),
        (0.55, ["lsh"], False, "Data Engineer", "Senior Data Engineer", False, False, "medium_title", False),
        (0.40, ["advertiser_title"], False, "Cook", "Data Engineer", False, False, "advertiser_title", False),
        (0.10, ["listing_history"], True, "Data Engineer", "Senior Data Engineer", True, False, "listing_history", False),
        (0.90, ["lsh"], False, "Software Intern", "Graduate Software Engineer", False, False, None, False),
    ]
    df = spark.createDataFrame(cases, "j double, routes array<string>, cont boolean, a string, b string, same boolean, equal boolean, lane string, veto boolean")
    v = titles.verdict(*(F.col(c) for c in ("j", "routes", "cont", "a", "b", "same", "equal")))
    for r in df.select("lane", "veto", v.alias("v")).collect():
        assert (r.v.lane, r.v.slot_veto) == (r.lane, r.veto)


def test_shingles(spark):
    df = spark.createDataFrame([("a b c",), ("a b c d e f g",), ("x x x x x x x",)], "d string").select(text.shingles(F.col("d")).alias("s"))
    assert [r.s for r in df.collect()] == [["a b c"], ["a b c d e", "b c d e f", "c d e f g"], ["x x x x x"]]


def test_search_refuses():
    for bad in ("(a", "a)", "AND b", "NOT", '"a'):
        with pytest.raises(ValueError):
            text.search(bad, F.lit("x"))


def test_page_buttons():
    assert page_buttons(5, 10) == [1, 0, 4, 5, 6, 0, 10]
    assert page_buttons(1, 1) == [1]


def test_language(spark):
    said = ["Привет мир " * 40, "the work is to be done for you and us " * 10, "lorem ipsum dolor sit amet " * 20, None, "short", "漢字仮名 かな " * 60, "漢字 Latin words " * 40, "สวัสดี " * 60, "𝔸𝔹" * 150]
    df = spark.createDataFrame([(t,) for t in said], "t string")
    got = [r[0] for r in df.select(text.not_english(F.col("t"))).collect()]
    few = "JD not in English: few common English words"
    assert got == ["JD not in English: 100% Cyrillic letters", None, few, None, None, "JD not in English: 100% Chinese letters", few, "JD not in English: 100% Thai letters", "JD not in English: 100% non-Latin letters"]


def test_matching_text(spark):
    cases = [("plain  text\n 1 2", "plain  text\n 1 2"), ("née мир x\n12 ！\nмир", "née x"), ("漢字", None), ("", None), (None, None), ("a\u00a0é\tб1 c\nвг d", "a é c\nd"), ("ﬁne ＡＢ ª", "ﬁne")]
    df = spark.createDataFrame([(t, w) for t, w in cases], "t string, w string")
    assert [r.got for r in df.select(text.matching_text(F.col("t")).alias("got")).collect()] == [w for _, w in cases]
    docs = df.select(text.document(F.lit("Title"), F.col("t")).alias("d")).collect()
    assert [r.d for r in docs] == ["title plain text 1 2", "title née x", None, "title", "title", "title a é c d", "title ﬁne"]


def test_shingle_ids(spark):
    import hashlib

    df = spark.createDataFrame([("a b c d e f",), ("a b",), (None,)], "d string").select(text.shingle_ids(F.col("d")).alias("i")).collect()
    one = lambda s: int.from_bytes(hashlib.blake2b(s.encode(), digest_size=8).digest(), "big", signed=True)
    assert [r.i for r in df] == [sorted([one("a b c d e"), one("b c d e f")]), [one("a b")], None]
