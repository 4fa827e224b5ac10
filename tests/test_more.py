"""Streams, JSON, names and budgets."""

import json

import pytest
from pyspark.sql import functions as F

from listmill.functions import names
from listmill.operators import budget
from listmill.sources import json as strict
from listmill.sources.tables import Table
from listmill.streaming import incremental


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    for i in range(3):
        events.where(F.col("event_id") % 3 == i).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = incremental.observations(spark, f"{tmp_path}/in/*", events.schema.simpleString()[7:-1].replace(":", " "), 1)
    table = Table(spark, f"file://{tmp_path}/t")
    combine = incremental.memberships(["user_id", "event_type"], "ts", "event_id")
    incremental.merged_into(stream, table, f"{tmp_path}/ck", combine).awaitTermination()
    batch = combine(None, events)
    assert sorted(map(tuple, table.read().select("user_id", "event_type", "first_seen", "last_seen").collect())) == sorted(map(tuple, batch.select("user_id", "event_type", "first_seen", "last_seen").collect()))
    assert table.version() == 2
    incremental.merged_into(stream, table, f"{tmp_path}/ck", combine).awaitTermination()
    assert table.version() == 2


def test_out_of_order_batches_are_refused(spark):
    rows = spark.createDataFrame([("a", 5, 1)], "k string, t int, id int")
    late = spark.createDataFrame([("a", 4, 2)], "k string, t int, id int")
    combine = incremental.in_order("k", ["t", "id"], "id", incremental.insert_only(["id"]))
    with pytest.raises(incremental.OutOfOrder):
        combine(rows, late)
    assert combine(rows, late.withColumn("t", F.lit(6))).count() == 2


def test_strict_json(spark, tmp_path):
    df = spark.createDataFrame([('[{"a": 1, "b": ["x"]}, {"a": null}]',)], "j string")
    assert [(r.a, r.b) for r in strict.rows_of(df, "j", "a int, b array<string>").collect()] == [(1, ["x"]), (None, None)]
    with pytest.raises(Exception):  # noqa: B017  Spark's own
        strict.rows_of(spark.createDataFrame([('[{"a": "x"}]',)], "j string"), "j", "a int").collect()
    assert strict.canonical({"b": 1, "a": "é"}) == json.dumps({"a": "é", "b": 1}, separators=(",", ":"), ensure_ascii=False)
    with pytest.raises(ValueError):
        strict.append_with_run(spark.createDataFrame([("j1", "r1")], "board_job_id string, run_id string"), spark.createDataFrame([("j2", "r1")], "board_job_id string, prior_run_id string"), "r2")
    got = strict.unresolved(spark.createDataFrame([(1,), (2,), (2,), (9,)], "k int"), spark.createDataFrame([(1,), (2,), (3,)], "k int"), "k").collect()
    assert {r.k: r.problem for r in got} == {2: "repeated", 3: "missing", 9: "unknown"}


def test_names():
    assert names.same_name("José  Ng", "jose ng") and names.same_name("Ng José", "Jose Ng", any_order=True) and not names.same_name("", "")
    assert names.without_legal_ending("Example Holdings Pte. Ltd.") == "Example Holdings"
    assert names.named("Acme Asia (SG)", ["acme asia"]) and names.named("Acmeland", ["acme*"]) and not names.named("Acmeland", ["acme"]) and not names.named(None, ["x"])
    assert names.slug("Data Engineer / AI") == "data-engineer-ai" and names.slug("工程师").startswith("t")
    assert names.phones("Call +65 9123 4567 or 6123 4567, id 12345678901234567890", "SG") == [("+6591234567", "mobile"), ("+6561234567", "landline")]
    assert names.phones_near("Ann Lee, 91234567." + " " * 100 + "87654321", "Ann Lee", "SG") == ["+6591234567"]
    assert names.email("{f}{last}", "José", "De Silva", "Example.com") == "jdesilva@example.com"


def test_columns_of_names(spark):
    df = spark.createDataFrame([("Acme Pte. Ltd.", "ref REQ-12345, R1234, jr_99999"), (None, None)], "n string, t string")
    got = df.select(names.company_key(F.col("n")).alias("k"), names.requisitions(F.col("t")).alias("r")).collect()
    assert got[0].k == "acme" and got[0].r == ["REQ-12345", "R1234"] and got[1].k is None


def test_budgets(spark):
    df = spark.createDataFrame([(1, 40, 1.0), (2, 50, 1.0), (3, 20, 1.0), (4, 1, 1.0)], "id int, tokens int, usd double")
    assert sorted(r.id for r in budget.prefix_within(df, [F.asc("id")], {"tokens": 100, "usd": 10}).collect()) == [1, 2]
    r = budget.estimate(df, "tokens").first()
    assert (r.n, r.mean, r.at_share) == (4, 27.75, 50)
    tries = spark.createDataFrame([(1, "invalid"), (1, "valid"), (2, "failed"), (2, "failed"), (3, "missing")], "k int, status string")
    assert {r.k: r.outcome for r in budget.outcomes(tries, "k", 2).collect()} == {1: "valid", 2: "terminal", 3: "retry"}
