from pyspark.sql import functions as F

from paperloom.operators.candidates import union_candidates
from paperloom.operators.merge import in_merged_order, merge_papers
from tests.conftest import plan_text


def arrivals(papers, *rows):
    spark = papers.sparkSession
    table = spark.createDataFrame(
        rows, "paper_id string, source_ordinal int, page_start long, pos int, title string, sources array<string>"
    )
    return papers.drop("title").join(table, "paper_id")


def test_first_arrival_wins_and_sources_unite(make_papers):
    rows = arrivals(
        make_papers({}, {"published": "2026-03-22T00:00:00Z"}),
        ("p0", 1, 0, 0, "later source", ["s1"]),
        ("p0", 0, 100, 0, "later page", ["s0"]),
        ("p0", 0, 0, 7, "first", ["s0", "s9"]),
        ("p0", 0, 0, 8, "later entry", ["s0"]),
        ("p1", 1, 0, 1, "other", ["s1"]),
    )
    merged = in_merged_order(merge_papers(rows)).collect()
    assert [(r.paper_id, r.title, r.sources) for r in merged] == [
        ("p1", "other", ["s1"]), ("p0", "first", ["s0", "s1", "s9"]),
    ]


def test_hot_id_is_combined_before_the_shuffle(spark):
    n = 30_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("paper_id"),
        F.concat(F.lit("t"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("title"),
        (n - F.col("id")).cast("int").alias("source_ordinal"),
        F.lit(0).alias("page_start"),
        F.lit(0).alias("pos"),
        F.array(F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("sources"),
    )
    merged = merge_papers(rows)
    hot = merged.filter("paper_id = 'hot'").first()
    assert hot.title == "t029997"
    assert hot.sources == [f"s{i}" for i in range(7)]
    assert merged.count() == n - n // 3 + 1
    plan = plan_text(merged)
    assert "partial_min_by" in plan and "partial_collect_set" in plan
    assert plan.count("Exchange hashpartitioning") + plan.count("hashpartitioning(paper_id") >= 1


def test_bag_union_keeps_copies(make_papers):
    papers = make_papers({}, {})
    assert union_candidates(papers, papers, papers.limit(1)).count() == 5
