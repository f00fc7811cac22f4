import datetime as dt

import pytest
from pyspark.sql import functions as F

from paperloom.plans.buckets import BucketedPapers, BucketedStore
from paperloom.plans.run import run_window
from paperloom.plans.store import PaperStore

MARCH = (dt.date(2026, 3, 1), dt.date(2026, 3, 31))
SCHEMA = "paper_id string, title string, run_id bigint"


def rows_of(df):
    return sorted((r.paper_id, r.title, r.run_id) for r in df.collect())


def changes(spark, run_id, ids, title="t"):
    return spark.createDataFrame([(f"p{i}", f"{title}{run_id}", run_id) for i in ids], SCHEMA)


@pytest.fixture
def snapshot(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    return BucketedPapers(spark, str(tmp_path / "papers"), schema, 8)


def scans(plan):
    """For every bucketed scan the operators above it up to the first join or the root."""
    lines = plan.splitlines()
    depth = lambda line: next((i for i, c in enumerate(line) if c.isalpha() or c in "*("), 0)
    found = []
    for i, line in enumerate(lines):
        if "Bucketed: true" not in line:
            continue
        level, above = depth(line), []
        for upper in reversed(lines[:i]):
            if depth(upper) < level:
                level = depth(upper)
                above.append(upper)
                if "Join" in upper:
                    break
        found.append(above)
    return found


def test_upserts_read_back(spark, snapshot):
    assert snapshot.upsert(changes(spark, 1, [])) == 0
    assert rows_of(snapshot.current()) == []
    snapshot.upsert(changes(spark, 1, range(100)))
    assert snapshot.upsert(changes(spark, 3, [5, 200])) == 2
    # A late run does not replace what a newer one said; within a run the row is unique.
    snapshot.upsert(changes(spark, 2, [5, 6]))
    got = {p: (t, r) for p, t, r in rows_of(snapshot.current())}
    assert len(got) == 101
    assert (got["p5"], got["p6"], got["p7"], got["p200"]) == (("t3", 3), ("t2", 2), ("t1", 1), ("t3", 3))
    ids = spark.createDataFrame([("p5",), ("p7",), ("x",), ("p5",), (None,)], "paper_id string")
    assert rows_of(snapshot.of_ids(ids)) == [("p5", "t3", 3), ("p7", "t1", 1)]


def test_only_changed_buckets_are_read_and_written(spark, snapshot, tmp_path):
    snapshot.upsert(changes(spark, 1, range(100)))
    one = changes(spark, 2, [7])
    bucket = one.select(snapshot.bucket_of(F.col("paper_id"))).first()[0]
    parts = tmp_path / "papers" / "papers" / "generation=1"
    others = [f for f in parts.glob("bucket=*/*.parquet") if f.parent.name != f"bucket={bucket}"]
    kept = {f: f.read_bytes() for f in others}
    assert len(others) >= 6
    for f in others:
        f.write_bytes(b"not parquet")
    assert rows_of(snapshot.of_ids(one)) == [("p7", "t1", 1)]
    assert snapshot.upsert(one) == 2
    for f, data in kept.items():
        f.write_bytes(data)
    written = {f.parent.name for f in (parts.parent / "generation=2").glob("bucket=*/*.parquet")}
    assert written == {f"bucket={bucket}"}
    assert {p: t for p, t, _ in rows_of(snapshot.current())}["p7"] == "t2"


def test_stored_rows_are_not_shuffled(spark, snapshot):
    snapshot.upsert(changes(spark, 1, range(100)))
    new = changes(spark, 2, range(50, 150))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        merged = snapshot.merged(new, list(range(8)))
        plan = merged._jdf.queryExecution().executedPlan().toString()
        found = scans(plan)
        assert len(found) == 2, plan
        for above in found:
            assert "Join" in above[-1] and not any("Exchange" in line for line in above), plan
        assert len(rows_of(merged)) == 150
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_one_file_per_bucket_and_side(spark, snapshot, tmp_path):
    snapshot.upsert(changes(spark, 1, range(200)))
    snapshot.upsert(changes(spark, 2, range(100, 300)))
    for generation in (1, 2):
        for folder in (tmp_path / "papers" / "papers" / f"generation={generation}").glob("bucket=*"):
            assert len(list(folder.glob("*.parquet"))) <= 2


def test_a_generation_that_was_not_listed_is_not_seen(spark, snapshot):
    snapshot.upsert(changes(spark, 1, range(20)))

    def die(generation):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        snapshot.upsert(changes(spark, 2, range(20)), before_listing=die)
    assert {t for _, t, _ in rows_of(snapshot.current())} == {"t1"}
    assert snapshot.upsert(changes(spark, 2, [1])) == 3
    assert {p: t for p, t, _ in rows_of(snapshot.current())}["p1"] == "t2"


def test_another_session_and_another_number_of_buckets(spark, snapshot, tmp_path):
    snapshot.upsert(changes(spark, 1, range(20)))
    spark.sql(f"DROP TABLE {snapshot.table}")
    again = BucketedPapers(spark, str(tmp_path / "papers"), snapshot.schema, 8)
    assert len(rows_of(again.current())) == 20
    with pytest.raises(ValueError):
        BucketedPapers(spark, str(tmp_path / "papers"), snapshot.schema, 16)


def test_a_bucketed_store_gives_what_a_plain_one_does(spark, make_papers, small_config, tmp_path):
    stores = [PaperStore(spark, str(tmp_path / "plain")).create(), BucketedStore(spark, str(tmp_path / "b"), 4).create()]
    assert stores[1].compact() == 0 and stores[1].papers().count() == 0
    runs = [
        make_papers({"title": "a", "pdf_url": "https://p"}, {"title": "a"}, {"title": "z"}),
        make_papers({"title": "a b", "published": "2026-03-01T00:00:00Z"}, {"title": "z"}, {"paper_id": "p3", "title": "b"}),
        make_papers({"title": "a a b"}, {"paper_id": "p9", "title": "b"}),
    ]
    for i, rows in enumerate(runs):
        seen = []
        for store in stores:
            run_window(rows, small_config, store, *MARCH, collected_at=f"t{i}")
            if i != 1:
                store.compact()
            seen.append(sorted(map(str, store.papers().collect())))
        assert seen[0] == seen[1]


def test_a_repeated_run_makes_the_snapshot_anew(spark, make_papers, small_config, tmp_path):
    from paperloom.plans.run import STAGED_COLUMNS, record
    from paperloom.operators.score import score_papers
    from paperloom.operators.windows import single_window

    store = BucketedStore(spark, str(tmp_path / "b"), 4).create()

    def run(papers, batch):
        claim = store.claim(1, "w", batch)
        rows = score_papers(papers, small_config).withColumns(
            {"window_slug": F.lit("s"), "window_ordinal": F.lit(0).cast("long"), "sources": F.array(F.lit("s"))}
        )
        window = single_window(spark, *MARCH).withColumn("window_slug", F.lit("s"))
        record(rows.select(*STAGED_COLUMNS), window, store, claim, collected_at=f"t{batch}")

    run(make_papers({"title": "a"}, {"title": "a"}), 1)
    run(make_papers({"paper_id": "q", "title": "b"}), 2)
    assert store.compact() == 1
    run(make_papers({"title": "a"}), 1)
    assert sorted(r.paper_id for r in store.papers().collect()) == ["p0", "q"]
    assert store.compact() == 2
    assert sorted(r.paper_id for r in store.papers().collect()) == ["p0", "q"]
    assert store.compact() == 2
