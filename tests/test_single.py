import json

import pytest
from pyspark.sql import functions as F

from paperloom.operators.score import score_papers
from paperloom.operators.windows import in_month_weeks, month_windows
from paperloom.plans import exports, single
from paperloom.sources.positions import with_positions
from tests.conftest import read_parts


def scored(papers, config):
    return in_month_weeks(score_papers(papers, config).withColumn("sources", F.array(F.lit("s"))))


def test_single_files_are_the_parts_joined(spark, make_papers, small_config, tmp_path):
    rows = scored(
        make_papers(
            *[
                {"title": f'a "{i}", é', "summary": "b" * (i % 3), "published": f"2026-03-{i % 28 + 1:02d}T00:00:00Z", "pdf_url": "u" if i % 2 else None}
                for i in range(60)
            ]
        ),
        small_config,
    ).repartition(4)
    weeks = month_windows(spark, ["2026-03"])
    exports.write_exports(rows, weeks, str(tmp_path / "parts"))
    for _ in range(2):
        single.write_single_exports(rows, weeks, str(tmp_path / "single"))
    slugs = sorted(r.window_slug for r in weeks.collect())
    for kind, name in single.NAMES.items():
        files = sorted(p.name for p in (tmp_path / "single" / kind).iterdir())
        assert files == sorted(name.format(s) for s in slugs)
        for slug in slugs:
            whole = (tmp_path / "single" / kind / name.format(slug)).read_text(encoding="utf-8")
            parts = read_parts(tmp_path / "parts" / kind / f"window_slug={slug}")
            if kind == "csv":
                assert whole.startswith(single.CSV_HEADER)
                assert whole.replace(single.CSV_HEADER, "") == parts.replace(single.CSV_HEADER, "")
                assert whole.count(single.CSV_HEADER) == 1
            else:
                assert whole == parts


def test_a_window_without_papers(spark, make_papers, small_config, tmp_path):
    rows = scored(make_papers({"published": "2026-03-01T00:00:00Z"}), small_config)
    single.write_single_exports(rows, month_windows(spark, ["2026-03"]), str(tmp_path))
    assert (tmp_path / "csv" / "2026_Mar_Wk3.csv").read_text() == single.CSV_HEADER
    assert (tmp_path / "jsonl" / "2026_Mar_Wk3.jsonl").read_text() == ""
    assert "- None" in (tmp_path / "digest" / "2026_Mar_Wk3.md").read_text()


def test_one_bibliography(spark, make_papers, tmp_path):
    papers = make_papers(*[{"published": f"2026-03-{i + 1:02d}T00:00:00Z"} for i in range(20)]).repartition(5)
    exports.write_bibtex(papers, str(tmp_path / "parts"))
    single.write_single_bibtex(papers, str(tmp_path / "out" / "all.bib"))
    text = (tmp_path / "out" / "all.bib").read_text()
    assert text == read_parts(tmp_path / "parts")
    assert text.index("arXiv:p19") < text.index("arXiv:p0\n")
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["all.bib"]


def test_runs_write_single_files(spark, make_papers, small_config, tmp_path):
    import datetime as dt

    from paperloom.plans.run import run_window
    from paperloom.plans.store import PaperStore

    store = PaperStore(spark, str(tmp_path / "store")).create()
    window = (dt.date(2026, 3, 16), dt.date(2026, 3, 22))
    run_window(make_papers({"title": "a"}), small_config, store, *window, out_dir=str(tmp_path / "out"), single_files=True)
    (file,) = (tmp_path / "out" / "jsonl").iterdir()
    assert json.loads(file.read_text())["title"] == "a"


def test_file_systems_that_cannot_join_are_refused(spark, tmp_path, monkeypatch):
    spark.range(10).select(F.col("id").cast("string")).repartition(3).write.text(str(tmp_path / "p"))

    class Files:
        def __init__(self, real):
            self.real = real

        def hasPathCapability(self, place, name):
            return False

        def __getattr__(self, name):
            return getattr(self.real, name)

    real = single.file_system
    monkeypatch.setattr(single, "is_checksummed", lambda spark, files: False)
    monkeypatch.setattr(single, "file_system", lambda spark, path: (real(spark, path)[0], Files(real(spark, path)[1])))
    with pytest.raises(NotImplementedError):
        single.join_parts(spark, str(tmp_path / "p"), str(tmp_path / "whole.txt"))


def test_positions_over_splits(spark, tmp_path):
    """Files cut into many splits, read by tasks that hold splits of several files."""
    for name, n in (("a", 3000), ("b", 1), ("c", 500)):
        (tmp_path / name).write_text("".join(f"{name} {i} {'x' * (i % 50)}\n" for i in range(n)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = spark.read.text([str(tmp_path / n) for n in "abc"])
        assert lines.rdd.getNumPartitions() > 3
        out = tmp_path / "staged"

        def put(rows, name):
            rows.write.parquet(str(out))
            return spark.read.parquet(str(out))

        got = with_positions(lines, put, path="path").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert len(got) == 3501
    for r in got:
        name, i, _ = r.value.split(" ")
        assert r.position == int(i) and r.path.endswith("/" + name)
