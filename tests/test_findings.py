"""Cases of the second round's findings."""

from listmill.operators import review


def test_requirement_rows_that_begin_at_one_place_are_in_the_order_of_quote_and_note(spark):
    lines = [(i, 1, quote, note, f"{quote}{note}") for i in range(50) for quote, note in (("R", "F"), ("A", "O"), ("N", "F"), ("A", "F"), (None, "F"))]
    lines += [(50, None, "A", "F", "x"), (50, 2, "R", "F", None), (50, None, "R", "F", "z"), (50, 2, "R", "F", "y"), (50, 1, "N", "O", None)]
    rows = spark.createDataFrame(lines, "id int, place int, quote string, note string, detail string").repartition(7)
    got = {(r.id, r.row): (r.quote, r.note, r.detail) for r in review.requirement_rows(rows, "id").collect()}
    for i in range(50):
        assert [got[i, n] for n in range(1, 6)] == [("A", "F", "AF"), ("A", "O", "AO"), ("N", "F", "NF"), ("R", "F", "RF"), (None, "F", "NoneF")]
    assert [got[50, n] for n in range(1, 4)] == [("N", "O", None), ("R", "F", "y, z"), ("A", "F", "x")]


def test_title_agreement_parts_titles_once_and_keeps_every_pair(spark, tmp_path, monkeypatch):
    from listmill.plans import research

    monkeypatch.setattr(research, "IDS", 3)
    names = ["hot bolt", "cold bolt", None, "large ring"]
    parts = [(i, names[i % 4], "Brand#1" if i % 9 else "Brand#2", "SMALL" if i else None, i % 2) for i in range(60)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    got = research.title_agreement(spark, str(tmp_path))
    above = got._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "regexp" not in above  # no pair of rows has its titles parted anew
    rows = {(r.id, r.other): r.agrees for r in got.collect()}
    same = {(a[0], b[0]) for a in parts for b in parts if a[2] == b[2] and a[3] and b[3]}
    assert set(rows) == same and got.count() == len(same)
    assert rows[4, 8] and not rows[4, 3]


def test_shingle_hashes_are_those_of_the_column_functions(spark):
    from pyspark.sql import functions as F

    from listmill.functions import text
    from listmill.operators import candidates

    docs = spark.createDataFrame([(t,) for t in ("a", "a b c d e", "a b c d e f a b c d e f", "é ü ß x y z " + "w " * 40 + "end", "a  b c d e f g")], "doc string")
    want = {r.doc: sorted(set(r.s)) for r in docs.select("doc", F.transform(text.shingles(F.col("doc")), lambda x: F.xxhash64(x)).alias("s")).collect()}
    got = candidates.hashed(docs.select("doc", F.col("doc").alias("d")), "d").collect()
    assert {r.doc: sorted(r.s) for r in got} == want and all(len(r.bands) == candidates.BANDS for r in got)


def test_unlike_listings_of_one_advertiser_and_title_make_no_pairs(spark):
    import random

    from listmill.operators import canonical

    rnd = random.Random(5)
    body = lambda: rnd.choices([f"w{i}" for i in range(5000)], k=60)
    first = body()
    texts = [body() for _ in range(150)] + [first, first[:36] + body()[:24]]  # the last two: 34 of 82 shingles with the title's
    rows = [("mcf", "SG", str(i), "r1", i, "Data Engineer", " ".join(t), "Acme") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "board string, market string, board_job_id string, run_id string, started_at int, title string, text string, advertiser string")
    f = canonical.frames(df)
    pairs = canonical.nominated(canonical.keys(f))
    assert pairs.count() < 10  # 11476 pairs share advertiser and title
    assert [r.lane for r in canonical.accepted(f, pairs).collect()] == ["advertiser_title"]


def test_a_batch_of_unlike_listings_of_one_advertiser_and_title_extends_the_mapping(spark):
    import random

    from listmill.operators import canonical

    rnd = random.Random(6)
    rows = [("mcf", "SG", str(i), "r1", i, "Data Engineer", " ".join(rnd.choices([f"w{j}" for j in range(5000)], k=60)), "Acme") for i in range(100)]
    df = spark.createDataFrame(rows, "board string, market string, board_job_id string, run_id string, started_at int, title string, text string, advertiser string")
    old, batch = df.where("started_at < 70"), df.where("started_at >= 70")
    got = canonical.extend(old, batch, canonical.build(old)).collect()  # 2535 pairs of one advertiser and title were over 14 for each wording: Rebuild
    assert len(got) == 100 and len({r.canonical_job_id for r in got}) == 100


def test_advertiser_history_has_every_pair_in_files_that_stay_small(spark, tmp_path):
    import os

    from pyspark.sql import functions as F

    from listmill.plans import reviews

    orders = spark.range(40_000).select(F.col("id").alias("o_orderkey"), F.expr("xxhash64(id) & 1023").alias("o_custkey"), F.lit("1-URGENT").alias("o_orderpriority"), F.lit("1997-01-01").cast("timestamp_ntz").alias("o_orderdate"), F.when(F.col("id") % 1000 == 0, 499000.0).otherwise(460000.0).alias("o_totalprice"))
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(1024).selectExpr("id as c_custkey", "'c' as c_name", "1 as c_nationkey", "0D as c_acctbal", "if(id % 50 = 0, null, 'HOUSEHOLD') as c_mktsegment").write.parquet(f"{tmp_path}/customer.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with large tables
    try:
        reviews.advertiser_history(spark, str(tmp_path)).write.parquet(f"{tmp_path}/out")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = spark.read.parquet(f"{tmp_path}/out")
    jobs = reviews._jobs(spark, str(tmp_path)).where("advertiser_name is not null")
    mine, chosen = jobs.where("canonical_job_id is not null").select("id", "canonical_job_id"), jobs.where("price > 495000").select(F.col("id").alias("selected"), F.col("canonical_job_id").alias("own"))
    want = chosen.crossJoin(mine).selectExpr("selected", "id", "canonical_job_id <=> own as this_job")
    summed = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("selected", "id", "this_job").cast("decimal(38)"))).first()
    assert summed(got) == summed(want) and summed(got)[0] > 1_000_000
    size = sum(os.path.getsize(f"{tmp_path}/out/{p}") for p in os.listdir(f"{tmp_path}/out") if p.endswith(".parquet"))
    assert size < summed(got)[0]  # a byte a row


def test_advertiser_history_keeps_rows_that_repeat_and_nulls(spark):
    from listmill.operators import review

    chosen = [(1, "A", "g1"), (1, "A", "g1"), (2, "A", None), (3, None, "g1"), (4, "B", "g9"), (None, "A", "g2"), *((i, "A", "g3") for i in range(1000, 1000 + review.CHOSEN + 2))]
    mine = [(7, "A", "g1"), (7, "A", "g1"), (8, "A", "g2"), (9, None, "g1"), (10, "C", "g1"), (None, "A", "g2"), *((i, "A", "g4") for i in range(2000, 2000 + review.LISTED + 2))]
    got = review.advertiser_history(spark.createDataFrame(chosen, "selected long, advertiser_name string, own string"), spark.createDataFrame(mine, "id long, advertiser_name string, canonical_job_id string"))
    want = [(s, i, own == group) for s, a, own in chosen for i, b, group in mine if a is not None and a == b]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_title_agreement_makes_pairs_in_steps_that_hold_few_of_them(spark, tmp_path, monkeypatch):
    from collections import Counter

    from listmill.plans import research

    monkeypatch.setattr(research, "IDS", 7)
    monkeypatch.setattr(research, "RUN", 3, raising=False)
    names = ["hot bolt", "cold bolt", None, "large ring"]
    parts = [(None if i % 13 == 0 else i % 50, names[i % 4], "Brand#1", "SMALL", i % 2) for i in range(120)]  # ids that repeat, and null ones
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    got = research.title_agreement(spark, str(tmp_path))
    above = got._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    steps = above.split("Generate ")[1:]  # from the last to the first
    assert len(steps) == 3 and all("lambda" in s for s in steps[1:])  # a step that isn't compiled stands between the two loops, and between them and the join

    def judged(mine, other):
        x, z = (set(mine[1].split()) if mine[1] else set()), (set(f"{other[1]} {'small' if other[4] % 2 == 0 else ''}".split()) if other[1] else set())
        both = len(x & z)
        return (not x or not z or both / len(x) >= 0.6), (round(both / len(x | z), 6) if x and z else 0.0)

    want = Counter((a[0], b[0], *judged(a, b)) for a in parts for b in parts)
    assert Counter(map(tuple, got.collect())) == want
