"""Each query with SQL gives what DuckDB gives on the smallest tables."""

import glob
import os

import duckdb
import pytest

from listmill import plans

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def norm(value):
    if isinstance(value, float):
        return round(value, 6)
    return tuple(map(norm, value)) if isinstance(value, list) else value


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_same_rows(spark, duck, name):
    df = plans.QUERIES[name](spark, DATA)
    names = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in names) for r in df.collect()), key=repr)
    result = duck.execute(plans.SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == names
    assert got == sorted((tuple(norm(r[columns.index(c)]) for c in names) for r in result.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.SQL)))
def test_runs(spark, name):
    assert plans.QUERIES[name](spark, DATA).count() >= 0


def test_similar_pairs_are_found(spark):
    """Of the pairs at 0.7 or more, the bands find at least nineteen of twenty."""
    from listmill.plans import texts

    rows = texts.signed(spark, "/root/testdata/sf0.01").select("doc_id", "s").collect()
    sets = {r.doc_id: set(r.s) for r in rows}
    where: dict = {}
    for i, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(i)
    shared: dict = {}
    for ids in where.values():
        for n, a in enumerate(sorted(ids)):
            for b in sorted(ids)[n + 1 :]:
                shared[a, b] = shared.get((a, b), 0) + 1
    true = {p for p, n in shared.items() if n / (len(sets[p[0]]) + len(sets[p[1]]) - n) >= 0.7}
    found = {(r.a, r.b) for r in plans.QUERIES["minhash_lsh_candidates"](spark, "/root/testdata/sf0.01").collect()}
    assert len(true & found) >= 0.95 * len(true)
