import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from paperloom import schemas
from paperloom.config import FilterConfig

SF_DIR = "/root/testdata/sf0.01"

FEED = """<?xml version="1.0" encoding="UTF-8"?>
<feed xmlns="http://www.w3.org/2005/Atom"
      xmlns:opensearch="http://a9.com/-/spec/opensearch/1.1/"
      xmlns:arxiv="http://arxiv.org/schemas/atom">
  <title>search results</title><id>http://x.example/feed</id>
  <opensearch:totalResults>{total}</opensearch:totalResults>
  {entries}
</feed>
"""


def feed_page(*entries: str, total: object = None) -> str:
    return FEED.format(total=len(entries) if total is None else total, entries="\n".join(entries))


def feed_entry(
    number: str = "2601.00001",
    title: str = "A title",
    summary: str = "A summary",
    published: str = "2026-03-20T12:00:00Z",
    primary: str = "k",
    authors: tuple = ("Ada Lovelace",),
    extra: str = "",
) -> str:
    names = "".join(f"<author><name>{a}</name></author>" for a in authors)
    return f"""<entry><id>http://x.example/abs/{number}v1</id><updated>{published}</updated>
    <published>{published}</published><title>{title}</title><summary>{summary}</summary>{names}
    <arxiv:primary_category term="{primary}"/><category term="{primary}"/>{extra}</entry>"""


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_config():
    return FilterConfig(
        categories=("k",), core_terms=("a",), adjacent_terms=("b",), exclude_terms=("x",)
    )


@pytest.fixture
def make_papers(spark):
    def make(*rows: dict):
        full = []
        for i, row in enumerate(rows):
            base = {
                "paper_id": f"p{i}",
                "title": "z",
                "summary": "z",
                "published": "2026-03-20T12:00:00Z",
                "updated": "2026-03-21T12:00:00Z",
                "primary_category": "k",
                "categories": ["k"],
                "authors": ["Ada Lovelace", "Grace Hopper"],
                "abs_url": f"http://x.example/abs/p{i}",
                "pdf_url": None,
            }
            full.append(tuple({**base, **row}[c] for c in schemas.PAPER_COLUMNS))
        return spark.createDataFrame(full, schemas.PAPER)

    return make


@pytest.fixture
def make_pages(spark):
    def make(*pages):
        rows = [(xml, i, f"source{i}", 0) if isinstance(xml, str) else xml for i, xml in enumerate(pages)]
        return spark.createDataFrame(rows, schemas.FEED_PAGE)

    return make


def plan_text(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def read_parts(folder) -> str:
    """Part files of an export joined in name order."""
    return "".join(p.read_text(encoding="utf-8") for p in sorted(Path(folder).glob("part-*")))
