import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from paperloom.functions import dates
from paperloom.operators.windows import month_windows, with_week

D = dt.date


def test_window_rules():
    assert dates.resolve_window("2027-02-03", "2027-03-04") == (D(2027, 2, 3), D(2027, 3, 4))
    assert dates.resolve_window(as_of=D(2026, 3, 25)) == (D(2026, 3, 19), D(2026, 3, 25))
    assert dates.resolve_window(end="2026-03-01", days=1) == (D(2026, 3, 1), D(2026, 3, 1))
    assert dates.resolve_window(start="2026-03-01", as_of=D(2026, 3, 1), days=0)[0] == D(2026, 3, 1)
    start, end = dates.resolve_window()
    assert (end - start).days == 6
    with pytest.raises(ValueError):
        dates.resolve_window("2027-03-04", "2027-02-03")
    with pytest.raises(ValueError):
        dates.resolve_window(end="2026-03-25", days=0)


@pytest.mark.parametrize("raw", ["2026/03/25", "2026-13-01", "x", "2026-03-25T00"])
def test_bad_dates(spark, raw):
    with pytest.raises(ValueError):
        dates.iso_date(raw)
    row = spark.range(1).select(F.lit(raw).alias("raw"))
    assert row.select(dates.try_parse_iso_date(F.col("raw"))).first()[0] is None
    with pytest.raises(PySparkException):
        row.select(dates.parse_iso_date(F.col("raw"))).collect()


def test_good_dates(spark):
    for raw in ("2026-03-25", "2026-3-5"):
        row = spark.range(1).select(F.lit(raw).alias("raw")).select(dates.parse_iso_date(F.col("raw")))
        assert row.first()[0] == dates.iso_date(raw)


@pytest.mark.parametrize(
    "month, ends",
    [
        ("2026-02", [7, 14, 21, 28]),
        ("2024-02", [7, 14, 21, 28, 29]),
        ("2026-12", [7, 14, 21, 28, 31]),
        ("2026-04", [7, 14, 21, 28, 30]),
    ],
)
def test_month_windows(spark, month, ends):
    rows = month_windows(spark, [month]).orderBy("window_ordinal").collect()
    assert [r.window_end.day for r in rows] == ends
    assert [r.window_start.day for r in rows] == [1, 8, 15, 22, 29][: len(ends)]
    assert [r.window_ordinal for r in rows] == list(range(len(ends)))
    abbreviation = dt.date.fromisoformat(f"{month}-01").strftime("%b")
    assert rows[1].window_slug == f"{month[:4]}_{abbreviation}_Wk2"


def test_several_months_are_numbered_in_order(spark):
    rows = month_windows(spark, ["2025-01", "2024-12"]).orderBy("window_ordinal").collect()
    assert [r.window_start for r in rows] == sorted(r.window_start for r in rows)
    assert rows[5].window_start == D(2025, 1, 1)


def test_every_day_is_in_its_week(spark):
    days = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2025-12-31')) AS day")
    odd = with_week(days).filter("NOT day BETWEEN window_start AND window_end OR datediff(window_end, window_start) > 6")
    assert odd.count() == 0
    assert dates.range_slug(D(2026, 3, 1), D(2026, 3, 7)) == "20260301_20260307"
