"""Tables written in parts, so that shuffle files of one part go before the next."""

from pathlib import Path

from listmill.operators import canonical
from listmill.sources import shared


def test_texts_and_sets_are_shuffled_in_parts(spark, monkeypatch):
    sizes, whole = {}, shared.stored_in_parts

    def counted(parts, name):
        parts = list(parts)
        sizes[name] = [p.count() for p in parts]
        return whole(parts, name)

    monkeypatch.setattr(canonical, "stored_in_parts", counted)
    body = [f"w{i}" for i in range(60)]
    rows = [("mcf", "SG", str(i), "r1", i, "Data Engineer", " ".join([*body, f"x{i}", f"y{i}"]), "Acme") for i in range(80)]
    df = spark.createDataFrame(rows, "board string, market string, board_job_id string, run_id string, started_at int, title string, text string, advertiser string")
    f = canonical.frames(df)
    ids = [r.id for r in f.wordings.collect()]
    assert len(ids) == len(set(ids)) == 80 and ids and {r.id for r in f.wordings.select("id").collect()} == set(ids)
    pairs = canonical.nominated(canonical.keys(f))
    assert canonical.accepted(f, pairs).count() == pairs.count() > 0
    for name in ("canonical-wordings", "canonical-sets"):
        assert sum(sizes[name]) == 80 and len(sizes[name]) == canonical.PARTS and max(sizes[name]) < 60


def test_a_table_in_parts_is_one_table_and_goes_as_one(spark):
    table = shared.stored_in_parts((spark.range(10).where(f"id % 3 = {i}") for i in range(3)), "parts")
    at = Path(shared._PATHS[table].removeprefix("file:"))
    assert sorted(r.id for r in table.collect()) == list(range(10)) and at.exists()
    shared.dropped(table)
    assert not at.exists()
