"""Source families as one wide table."""

import datetime as dt

from listmill.sources import standard

MCF = """board string, market string, board_job_id string, run_id string, content_hash string, title string, description string, postedCompany struct<uen: string, name: string, companyUrl: string, employeeCount: int>, hiringCompany struct<name: string>,
metadata struct<newPostingDate: date, expiryDate: date, isPostedOnBehalf: boolean, totalNumberOfView: int>, status struct<jobStatus: string>, salary struct<minimum: double, maximum: double, type: struct<salaryType: string>>, minimumYearsExperience int,
categories array<struct<category: string>>, employmentTypes array<struct<employmentType: string>>, positionLevels array<struct<position: string>>, skills array<struct<skill: string>>, screeningQuestions array<struct<question: string>>,
flexibleWorkArrangements array<struct<flexibleWorkArrangement: string>>, address struct<districts: array<struct<location: string>>, isOverseas: boolean>""".replace("\n", " ")
SEEK = """board string, market string, board_job_id string, run_id string, content_hash string, job struct<title: string, content: string, status: string, listedAt: struct<dateTimeUtc: timestamp>, expiresAt: struct<dateTimeUtc: timestamp>, advertiser: struct<id: string, name: string>,
location: struct<label: string>, workTypes: struct<label: string>, classifications: array<struct<label: string>>, salary: struct<label: string, currencyLabel: string>, products: struct<questionnaire: struct<questions: array<string>>>, contactMatches: array<struct<type: string, value: string>>>,
gfjInfo struct<location: struct<countryCode: string>>""".replace("\n", " ")
INDEED = """board string, market string, board_job_id string, run_id string, content_hash string, title string, jobDescriptionHTML string, salary struct<min: double, max: double, currencyCode: string, type: string>, location struct<countryCode: string, formatted: struct<long: string>>,
companyDetails struct<name: string, websiteUrl: string>, companyOverviewLink string, attributes array<struct<label: string>>, occupations array<struct<label: string>>, jobTypes array<string>, pubDate bigint, expirationDate bigint, jobSourceName string, originalApplyUrl string""".replace("\n", " ")
LINKEDIN = """board string, market string, board_job_id string, run_id string, content_hash string, jobTitle string, jobDescription string, location string, sector string, contractType string, workType string, experienceLevel string, salaryInfo array<string>, posterFullName string,
posterProfileUrl string, publishedAt string, applyType string, companyId string, companyName string, companyWebsite string, companyEmployeeCount bigint""".replace("\n", " ")


def test_families(spark):
    day = dt.date(2024, 1, 2)
    mcf = [
        ("mcf", "sg", "1", "r", "h", " Data Engineer ", "<p>A</p>", ("u", "Acme", "", 5), None, (day, day, True, 3), ("Open",), (1.0, 2.0, ("MONTHLY",)), 2, [("IT",), (" ",)], [], None, [("SQL",)], None, None, ([("East",), ("West",)], False)),
        ("mcf", "sg", "2", "r", None, "gone", "x", None, None, None, None, None, None, None, None, None, None, None, None, None),
        ("mcf", "sg", "3", "r", "h", "T", "<table></table>", None, None, None, None, None, None, None, None, None, None, None, None, (None, True)),
    ]
    now = dt.datetime(2024, 1, 2, 3)
    seek = [("jobstreet", "sg", "4", "r", "h", ("Clerk", "<b>x</b>", "Active", (now,), (now,), ("7", "Acme"), ("Here",), ("Full time, Part time",), [("Admin",)], ("S$5,000 – S$7,000 per month", None), None, [("Email", "a@b.c"), ("Phone", " ")]), None)]
    indeed = [("indeed", "us", "5", "r", "h", "Cook", "<p>Soup</p>", (1.0, 2.0, "USD", "YEARLY"), ("us", ("Here",)), ("Acme", None), "https://x/cmp/Acme-Co?x", [], [("Food",)], ["Full-time"], 1704164400000, 1600000000000, None, None)]
    linkedin = [("linkedin", "hk", "6", "r", "h", "Dev", "Build.\nShow more   Show less", "HK", "IT", "", None, "Senior", ["1", "", "2"], None, None, "2024-01-02T00:00", None, "9", "Acme", None, 8)]
    frames = {n: spark.createDataFrame(rows, s) for n, rows, s in (("mcf", mcf, MCF), ("seek", seek, SEEK), ("indeed", indeed, INDEED), ("linkedin", linkedin, LINKEDIN))}
    got = {r.board_job_id: r for r in standard.union(frames).collect()}
    assert (got["1"].title, got["1"].categories, got["1"].employment_types, got["1"].job_location, got["1"].salary_period, got["1"].company_website) == ("Data Engineer", ["IT"], None, "East; West", "Monthly", None)
    assert got["2"].title is None and got["2"].job_url.endswith("/2") and got["2"].fingerprint is None
    assert (got["3"].quarantine, got["3"].fingerprint, got["3"].description_text, got["3"].job_location) == ("table", None, None, "overseas")
    assert (got["4"].job_country_code, got["4"].salary_min, got["4"].salary_currency, got["4"].employment_types, len(got["4"].contacts)) == ("SG", 5000.0, "SGD", ["Full time", "Part time"], 1)
    assert (got["5"].posted_date, got["5"].expiry_date, got["5"].board_company_id, got["5"].job_url, got["5"].job_country_code, got["5"].salary_period) == (day, None, "Acme-Co", "https://www.indeed.com/viewjob?jk=5", "US", "Annual")
    assert (got["6"].description_text, got["6"].salary_raw, got["6"].employment_types, got["6"].position_levels, got["6"].posted_date) == ("Build.", "1 – 2", None, ["Senior"], day)
    t = {(r.board, r.market): r for r in standard.tallies(standard.union(frames)).collect()}
    assert (t["mcf", "sg"].n, t["mcf", "sg"].identity_only, t["mcf", "sg"].quarantined) == (3, 1, 1)
    assert standard.refused(standard.union(frames)).collect() == []
