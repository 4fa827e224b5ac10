"""Observations of four source families as one wide table.

Each family is a table from columns to expressions over its nested rows; a column it doesn't name is null. Rows without a payload (null content_hash)
keep only their identity. A description that can't be turned into text leaves text and fingerprint null and says why in `quarantine`.
"""

from __future__ import annotations

from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import html, salary, text

#: The wide table.
WIDE = """run_id string, board string, market string, board_job_id string, content_hash string, title string, description_html string, description_text string,
posted_date date, expiry_date date, board_status string, views_count int, advertiser_name string, hiring_company_name string, company_registry_id string, board_company_id string,
is_agency_posting boolean, company_website string, company_employee_count int, job_country_code string, job_location string, salary_raw string, salary_min double, salary_max double,
salary_currency string, salary_period string, categories array<string>, employment_types array<string>, job_function string, position_levels array<string>, min_years_experience int,
skills array<string>, flexible_work_arrangements array<string>, screening_questions array<string>, board_attributes array<string>, job_url string, apply_url string, apply_type string,
poster_name string, poster_profile_url string, contacts array<struct<type: string, value: string>>, job_source_name string, fingerprint string, quarantine string"""
IDENTITY = ("run_id", "board", "market", "board_job_id", "content_hash")
#: Addresses of listings, by board; countries of one family's markets; periods by another's names.
ADDRESSES = {
    "mcf": "https://www.mycareersfuture.gov.sg/job/%s", "jobstreet": "https://%s.jobstreet.com/job/%s", "jobsdb": "https://%s.jobsdb.com/job/%s", "seek": "https://%s.seek.com/job/%s",
    "indeed": "https://%s.indeed.com/viewjob?jk=%s", "linkedin": "https://%s.linkedin.com/jobs/view/%s",
}
COUNTRIES = {"sg": "SG", "hk": "HK", "th": "TH", "au": "AU", "nz": "NZ", "my": "MY"}
PERIODS = {"YEAR": "Annual", "YEARLY": "Annual", "MONTH": "Monthly", "MONTHLY": "Monthly", "WEEK": "Weekly", "WEEKLY": "Weekly", "DAY": "Daily", "DAILY": "Daily", "HOUR": "Hourly", "HOURLY": "Hourly"}
_PAY = T.StructType([T.StructField("low", T.DoubleType()), T.StructField("high", T.DoubleType()), T.StructField("currency", T.StringType()), T.StructField("period", T.StringType())])


@F.pandas_udf(_PAY)
def pay(label: pd.Series, currency: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([salary.parse(x, c) for x, c in zip(label, currency, strict=True)], columns=["low", "high", "currency", "period"])


def address(board: Column, market: Column, job: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, form in ADDRESSES.items():
        host = F.when((board == "indeed") & (market == "us"), F.lit("www")).otherwise(market)
        out = F.when(board == name, F.format_string(form, *([host] if form.count("%s") == 2 else []), job)).otherwise(out)
    return out


def s(path: str) -> Column:
    return text.norm_scalar(F.col(path).cast("string"))


def each(path: str, field: str) -> Column:
    return text.norm_array(F.transform(F.col(path), lambda x: x[field]))


def one(path: str) -> Column:
    return text.norm_array(F.array(F.col(path)))


def looked_up(c: Column, table: Mapping[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for key, value in table.items():
        out = F.when(c == key, value).otherwise(out)
    return out


def alpha2(c: Column) -> Column:
    code = F.upper(F.trim(c))
    return F.when(code.rlike("^[A-Z]{2}$"), code)


def day_of_ms(c: Column) -> Column:
    """The UTC date of milliseconds, null outside the years 1970 to 9999."""
    return F.when(c.between(0, 253402300799999), F.to_date(F.timestamp_millis(c)))


def mcf(overseas: Column) -> dict[str, Column]:
    abroad = F.coalesce(F.col("address.isOverseas"), F.lit(False))
    kind = F.initcap(s("salary.type.salaryType"))
    return {
        "title": s("title"), "description_html": s("description"), "posted_date": F.col("metadata.newPostingDate"), "expiry_date": F.col("metadata.expiryDate"), "board_status": s("status.jobStatus"), "views_count": F.col("metadata.totalNumberOfView"),
        "advertiser_name": s("postedCompany.name"), "hiring_company_name": s("hiringCompany.name"), "company_registry_id": s("postedCompany.uen"), "is_agency_posting": F.col("metadata.isPostedOnBehalf"), "company_website": s("postedCompany.companyUrl"),
        "company_employee_count": F.col("postedCompany.employeeCount"), "job_country_code": F.when(abroad, overseas).otherwise("SG"), "job_location": F.when(abroad, "overseas").otherwise(F.array_join(each("address.districts", "location"), "; ")),
        "salary_min": F.col("salary.minimum"), "salary_max": F.col("salary.maximum"), "salary_currency": F.lit("SGD"), "salary_period": F.when(kind.isin("Annual", "Monthly", "Weekly", "Daily", "Hourly"), kind),
        "categories": each("categories", "category"), "employment_types": each("employmentTypes", "employmentType"), "position_levels": each("positionLevels", "position"), "min_years_experience": F.col("minimumYearsExperience"), "skills": each("skills", "skill"),
        "flexible_work_arrangements": each("flexibleWorkArrangements", "flexibleWorkArrangement"), "screening_questions": each("screeningQuestions", "question"),
    }


def seek() -> dict[str, Column]:
    got = pay(F.col("job.salary.label"), F.col("job.salary.currencyLabel"))
    stub = F.col("job").isNotNull() & F.col("gfjInfo").isNull() & (F.col("board") == "jobstreet") & (F.col("market") == "sg")
    people = F.filter(F.transform(F.col("job.contactMatches"), lambda x: F.struct(text.norm_scalar(x["type"]).alias("type"), text.norm_scalar(x["value"]).alias("value"))), lambda x: x["value"].isNotNull())
    return {
        "title": s("job.title"), "description_html": s("job.content"), "posted_date": F.to_date("job.listedAt.dateTimeUtc"), "expiry_date": F.to_date("job.expiresAt.dateTimeUtc"), "board_status": s("job.status"), "advertiser_name": s("job.advertiser.name"),
        "board_company_id": s("job.advertiser.id"), "job_country_code": F.coalesce(alpha2(F.col("gfjInfo.location.countryCode")), F.when(stub, "SG")), "job_location": s("job.location.label"), "salary_raw": s("job.salary.label"), "salary_min": got["low"], "salary_max": got["high"],
        "salary_currency": got["currency"], "salary_period": got["period"], "categories": each("job.classifications", "label"), "employment_types": text.norm_array(F.split("job.workTypes.label", ",")), "screening_questions": text.norm_array(F.col("job.products.questionnaire.questions")),
        "contacts": F.when(F.size(people) > 0, people),
    }


def indeed() -> dict[str, Column]:
    posted, expires = F.col("pubDate"), F.col("expirationDate")
    return {
        "title": s("title"), "description_html": s("jobDescriptionHTML"), "posted_date": day_of_ms(posted), "expiry_date": F.when(expires >= posted, day_of_ms(expires)), "advertiser_name": s("companyDetails.name"),
        "board_company_id": F.nullif(F.regexp_extract(s("companyOverviewLink"), "/cmp/([^/?#]+)", 1), F.lit("")), "company_website": s("companyDetails.websiteUrl"), "job_country_code": alpha2(F.col("location.countryCode")), "job_location": s("location.formatted.long"),
        "salary_min": F.col("salary.min"), "salary_max": F.col("salary.max"), "salary_currency": s("salary.currencyCode"), "salary_period": looked_up(F.upper(s("salary.type")), PERIODS), "categories": each("occupations", "label"), "employment_types": text.norm_array(F.col("jobTypes")),
        "board_attributes": each("attributes", "label"), "apply_url": s("originalApplyUrl"), "job_source_name": s("jobSourceName"),
    }


def linkedin() -> dict[str, Column]:
    return {
        "title": s("jobTitle"), "posted_date": F.to_date(F.try_to_timestamp(F.substring("publishedAt", 1, 10), F.lit("yyyy-MM-dd"))), "advertiser_name": s("companyName"), "board_company_id": s("companyId"), "company_website": s("companyWebsite"),
        "company_employee_count": F.col("companyEmployeeCount"), "job_country_code": looked_up(F.col("market"), COUNTRIES), "job_location": s("location"), "salary_raw": F.array_join(text.norm_array(F.col("salaryInfo")), " – "), "categories": one("sector"), "employment_types": one("contractType"),
        "job_function": s("workType"), "position_levels": one("experienceLevel"), "apply_type": s("applyType"), "poster_name": s("posterFullName"), "poster_profile_url": s("posterProfileUrl"),
        "description_text": text.norm_scalar(F.regexp_replace("jobDescription", r"(?U)Show more\s+Show less\s*$", "")),
    }


#: What is read of each family's payloads.
PAYLOADS = {
    "mcf": (
        "title string, description string, postedCompany struct<uen: string, name: string, companyUrl: string, employeeCount: int>, hiringCompany struct<name: string>, "
        "metadata struct<newPostingDate: date, expiryDate: date, isPostedOnBehalf: boolean, totalNumberOfView: int>, status struct<jobStatus: string>, "
        "salary struct<minimum: double, maximum: double, type: struct<salaryType: string>>, minimumYearsExperience int, categories array<struct<category: string>>, "
        "employmentTypes array<struct<employmentType: string>>, positionLevels array<struct<position: string>>, skills array<struct<skill: string>>, "
        "screeningQuestions array<struct<question: string>>, flexibleWorkArrangements array<struct<flexibleWorkArrangement: string>>, "
        "address struct<districts: array<struct<location: string>>, isOverseas: boolean>"
    ),
    "seek": (
        "job struct<title: string, content: string, status: string, listedAt: struct<dateTimeUtc: timestamp>, expiresAt: struct<dateTimeUtc: timestamp>, "
        "advertiser: struct<id: string, name: string>, location: struct<label: string>, workTypes: struct<label: string>, classifications: array<struct<label: string>>, "
        "salary: struct<label: string, currencyLabel: string>, products: struct<questionnaire: struct<questions: array<string>>>, contactMatches: array<struct<type: string, "
        "value: string>>>, gfjInfo struct<location: struct<countryCode: string>>"
    ),
    "indeed": (
        "title string, jobDescriptionHTML string, salary struct<min: double, max: double, currencyCode: string, type: string>, location struct<countryCode: string, "
        "formatted: struct<long: string>>, companyDetails struct<name: string, websiteUrl: string>, companyOverviewLink string, attributes array<struct<label: string>>, "
        "occupations array<struct<label: string>>, jobTypes array<string>, pubDate bigint, expirationDate bigint, jobSourceName string, originalApplyUrl string"
    ),
    "linkedin": (
        "jobTitle string, jobDescription string, location string, sector string, contractType string, workType string, experienceLevel string, salaryInfo array<string>, "
        "posterFullName string, posterProfileUrl string, publishedAt string, applyType string, companyId string, companyName string, companyWebsite string, "
        "companyEmployeeCount bigint"
    ),
}


def parsed(rows: DataFrame, family: str, payload: str = "payload") -> DataFrame:
    """Identity columns and the family's columns of a JSON payload; one that doesn't fit fails the load."""
    return rows.select(*IDENTITY, F.from_json(payload, PAYLOADS[family], {"mode": "FAILFAST"}).alias("_p")).select(*IDENTITY, "_p.*")


def standardized(rows: DataFrame, family: str, overseas: Column | None = None) -> DataFrame:
    """One family's rows as WIDE. overseas: the country code of listings abroad, where the source says only that they are."""
    given = {"mcf": lambda: mcf(overseas if overseas is not None else F.lit(None).cast("string")), "seek": seek, "indeed": indeed, "linkedin": linkedin}[family]()
    paid = F.col("content_hash").isNotNull()
    wide = T.StructType.fromDDL(" ".join(WIDE.split()))
    made = rows.select(*IDENTITY, address(F.col("board"), F.col("market"), F.col("board_job_id")).alias("job_url"), *(F.when(paid, c).alias(n) for n, c in given.items()))
    if "description_html" in given:
        made = made.withColumn("_text", html.normalized("description_html")).withColumn("description_text", F.col("_text.text")).withColumn("quarantine", F.col("_text.reason"))
    else:
        made = made.withColumn("quarantine", F.lit(None).cast("string"))
    made = made.withColumn("fingerprint", F.when(F.col("quarantine").isNull(), text.fingerprint(text.document(F.col("title"), F.col("description_text")))))
    return made.select(*((F.col(f.name) if f.name in made.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wide))


def union(families: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for family, rows in families.items():
        one_ = standardized(rows, family)
        out = one_ if out is None else out.unionByName(one_)
    return out


def tallies(wide: DataFrame) -> DataFrame:
    """Rows, those without payload, quarantined ones and those with only a title, by board and market."""
    paid = F.col("content_hash").isNotNull()
    return wide.groupBy("board", "market").agg(F.count("*").alias("n"), F.count_if(~paid).alias("identity_only"), F.count_if(F.col("quarantine").isNotNull()).alias("quarantined"), F.count_if(paid & F.col("quarantine").isNull() & F.col("description_text").isNull() & F.col("title").isNotNull()).alias("title_only"))


def refused(wide: DataFrame) -> DataFrame:
    """Boards and markets all of whose payloads are quarantined: something has changed at the source."""
    return tallies(wide).where("n > identity_only and quarantined = n - identity_only")
