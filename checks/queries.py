"""Every operator as a query over the given tables.

Results hold no arrays: lists come out joined with ``|``.  Counts are BIGINT.
"""

from __future__ import annotations

import datetime as dt
import json
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from checks.fixture import CONFIG, CONTEXT_GATES, OTHER_CONFIG, WINDOW, papers
from paperloom import schemas
from paperloom.config import read_term_table, term_chunks
from paperloom.functions import bibtex, dates, text
from paperloom.operators import candidates, evaluate, intervals, merge, rescore, score, term_index, terms, windows
from paperloom.operators.select import SCAN_COLUMNS, select_papers
from paperloom.plans import buckets, exports, single, store
from paperloom.plans.run import run_rows, run_window, triage_documents, undated
from paperloom.plans.staging import shared_dir, write_text
from paperloom.sources import feed, feed_entries
from paperloom.sources.documents import read_documents
from paperloom.sources.ids import id_list
from paperloom.sources.positions import with_positions
from paperloom.streaming.arrivals import first_arrivals

YEAR_MONTHS = [f"2024-{m:02d}" for m in range(1, 13)]
FEED_BLOCK = 200


def bar(column: str) -> Column:
    return F.array_join(column, "|").alias(column)


def long_count(name: str) -> Column:
    return F.count("*").alias(name)


def scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share."""
    return f"{shared_dir(spark, tempfile.gettempdir())}/checks-{uuid.uuid4().hex}"


def staged(rows: DataFrame) -> DataFrame:
    path = scratch(rows.sparkSession)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def with_position(ordered: DataFrame) -> DataFrame:
    """Place of every row, from 1, in files written in order and read in name order."""
    spark, path = ordered.sparkSession, scratch(ordered.sparkSession)
    ordered.write.parquet(path)
    rows = spark.read.schema(ordered.schema).parquet(path).select(
        "*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    # One row per file.
    sizes = sorted((r[0], r[1]) for r in rows.groupBy("file").count().collect())
    before, at = {}, 1
    for name, n in sizes:
        before[name], at = at, at + n
    first = F.element_at(F.from_json(F.lit(json.dumps(before)), "map<string,bigint>"), F.col("file"))
    return rows.select(*ordered.columns, (first + F.col("row")).alias("position"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.score_papers(papers(spark, sf_dir), CONFIG)


def triaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triage_documents(papers(spark, sf_dir), CONFIG, unique=True)


# Scans and sources


def feed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Atom pages built from the papers: one per source and block of 200 ids."""
    rows = papers(spark, sf_dir)

    def escaped(column: str) -> Column:
        out = F.replace(F.col(column), F.lit("&"), F.lit("&amp;"))
        out = F.replace(out, F.lit("<"), F.lit("&lt;"))
        return F.replace(out, F.lit(">"), F.lit("&gt;"))

    def element(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))

    entry = F.concat(
        F.lit("<entry>"),
        element("id", F.col("abs_url")),
        element("published", F.col("published")),
        element("updated", F.col("updated")),
        element("title", escaped("title")),
        element("summary", escaped("summary")),
        F.array_join(
            F.transform("authors", lambda a: element("author", element("name", a))), ""
        ),
        F.lit('<link rel="alternate" type="text/html" href="'),
        F.col("abs_url"),
        F.lit('"/>'),
        F.when(
            F.col("pdf_url").isNotNull(),
            F.concat(
                F.lit('<link rel="related" title="pdf" type="application/pdf" href="'),
                F.replace(F.col("pdf_url"), F.lit("https:"), F.lit("http:")),
                F.lit('"/>'),
            ),
        ).otherwise(""),
        F.lit('<arxiv:primary_category term="'),
        F.col("primary_category"),
        F.lit('"/>'),
        F.array_join(
            F.transform(
                "categories", lambda c: F.concat(F.lit('<category term="'), c, F.lit('"/>'))
            ),
            "",
        ),
        F.lit("</entry>"),
    )
    number = F.col("paper_id").cast("long")
    keyed = rows.select(
        F.substring("primary_category", 4, 10).cast("int").alias("source_ordinal"),
        F.concat(F.lit("category:"), "primary_category").alias("source_name"),
        (F.floor(number / FEED_BLOCK) * FEED_BLOCK).cast("long").alias("page_start"),
        number.alias("number"),
        entry.alias("entry"),
    )
    # A page holds at most one block of ids, whatever the share of its source.
    return (
        keyed.groupBy("source_ordinal", "source_name", "page_start")
        .agg(F.array_sort(F.collect_list(F.struct("number", "entry"))).alias("entries"))
        .select(
            *feed.PAGE_COLUMNS,
            F.concat(
                F.lit(
                    '<?xml version="1.0" encoding="UTF-8"?>'
                    '<feed xmlns="http://www.w3.org/2005/Atom"'
                    ' xmlns:opensearch="http://a9.com/-/spec/opensearch/1.1/"'
                    ' xmlns:arxiv="http://arxiv.org/schemas/atom">'
                    "<opensearch:totalResults>"
                ),
                F.size("entries").cast("string"),
                F.lit("</opensearch:totalResults>"),
                F.array_join(F.transform("entries", lambda e: e["entry"]), ""),
                F.lit("</feed>"),
            ).alias("value"),
        )
    )


def damaged_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pages with every third block cut short and every fourth total unreadable."""
    block = F.col("page_start") / FEED_BLOCK
    return feed_pages(spark, sf_dir).withColumn(
        "value",
        F.when(block % 3 == 1, F.left("value", F.length("value") - 9))
        .when(
            block % 4 == 2,
            F.replace("value", F.lit("<opensearch:totalResults>"), F.lit("<opensearch:totalResults>n")),
        )
        .otherwise(F.col("value")),
    )


def feed_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feed.valid_papers(feed.page_entries(feed.parse_pages(feed_pages(spark, sf_dir))))
    return rows.withColumns({c: bar(c) for c in ("categories", "authors", "sources")})


def feed_entries_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of ``feed_ingest`` as files, read entry by entry."""
    path = scratch(spark)
    feed_entries.write_pages(feed_pages(spark, sf_dir), path)
    rows = feed.valid_papers(feed_entries.stream_entries(spark, path, lambda rows, name: staged(rows)))
    return rows.withColumns({c: bar(c) for c in ("categories", "authors", "sources")})


def landed_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of 400 ids in pages of 50; by rule pages are missing, cut short, landed twice, or behind the end."""
    number = F.col("doc_id")
    docs = read_documents(spark, f"{sf_dir}/documents.parquet", "doc_id")
    source = F.floor(number / 400).cast("int").alias("source_ordinal")
    blocks = docs.groupBy(source, (F.floor(number % 400 / 50) * 50).cast("long").alias("page_start")).agg(
        F.array_sort(F.collect_list("doc_id")).alias("ids")
    )
    totals = docs.groupBy(source).agg(long_count("total"))
    pages = blocks.unionByName(
        totals.filter("source_ordinal % 2 = 0").select(
            "source_ordinal", F.lit(400).cast("long").alias("page_start"), F.array().cast("array<bigint>").alias("ids")
        )
    ).join(totals, "source_ordinal")
    block = F.col("source_ordinal") * 9 + F.col("page_start") / 50
    copies = F.when(block % 7 == 3, 0).when(block % 5 == 1, 2).otherwise(1)
    landed = pages.withColumn("copy", F.explode(F.sequence(F.lit(0), copies))).filter("copy > 0")
    entry = lambda i: F.concat(F.lit("<entry><id>"), i.cast("string"), F.lit("</id></entry>"))
    value = F.concat(
        F.lit("<feed><totalResults>"), F.col("total").cast("string"), F.lit("</totalResults>"),
        F.array_join(F.transform("ids", entry), ""), F.lit("</feed>"),
    )
    value = F.when(block % 11 == 5, F.left(value, F.length(value) - 3)).otherwise(value)
    named = landed.select(
        "source_ordinal", F.concat(F.lit("range:"), F.col("source_ordinal").cast("string")).alias("source_name"),
        "page_start", value.alias("value"),
    )
    return named


def ingest_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.ingest_completeness(feed.parse_pages(landed_ranges(spark, sf_dir)), page_size=50)


def missing_page_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.missing_page_ranges(feed.parse_pages(landed_ranges(spark, sf_dir)), page_size=50)


def quarantined_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    corrupt = feed.corrupt_pages(feed.parse_pages(damaged_pages(spark, sf_dir)))
    return corrupt.select(*feed.PAGE_COLUMNS)


def quarantined_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unreadable pages and, in the others, entries whose title was taken out by rule."""
    pages = damaged_pages(spark, sf_dir)
    gone = F.regexp_replace("value", r"<title>[^<]*</title>(?=<summary>[^<]{0,40}</summary>)", "")
    return feed.quarantine(feed.parse_pages(pages.withColumn("value", gone)))


def config_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seven lists, read from a file, with the number of papers each term or category is in."""
    path = f"{scratch(spark)}/filters.json"
    write_text(spark, path, json.dumps({n: list(getattr(CONFIG, n)) for n in schemas.FILTER_FILE.fieldNames()}))
    found = (
        terms.match_terms(papers(spark, sf_dir), CONFIG)
        .select(F.explode("term_hits.term").alias("lowered"))
        .groupBy("lowered")
        .agg(long_count("n"))
    )
    filed = papers(spark, sf_dir).select(F.explode("categories").alias("lowered")).groupBy("lowered").agg(long_count("n"))
    kinds = found.select(F.lit(True).alias("terms"), "*").unionByName(filed.select(F.lit(False).alias("terms"), "*"))
    dimension = read_term_table(spark, path).withColumn("is_term", F.col("tier").endswith("terms"))
    same = (F.lower("term") == F.col("lowered")) & (F.col("is_term") == F.col("terms"))
    return dimension.join(kinds, same, "left").select(
        "tier", "ordinal", "term", F.coalesce("n", F.lit(0)).alias("papers")
    )


def config_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of each keyword chunk with the candidates of its source."""
    found = (
        candidates.keyword_candidates(papers(spark, sf_dir), CONFIG)
        .groupBy("source_name")
        .agg(long_count("n"))
    )
    chunks = term_chunks(CONFIG.term_table(spark))
    name = F.concat(F.lit("keyword_chunk_"), F.col("chunk").cast("string"))
    return chunks.join(found, name == F.col("source_name"), "left").select(
        "chunk", "ordinal", "term", F.coalesce("n", F.lit(0)).alias("candidates")
    )


def papers_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = select_papers(papers(spark, sf_dir)).select(*SCAN_COLUMNS)
    return rows.withColumn("authors", bar("authors"))


# Projections


def extract_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids out of paper and page URLs, with and without trailing slashes."""
    urls = papers(spark, sf_dir).select("abs_url").unionByName(
        read_documents(spark, f"{sf_dir}/pages.parquet", "page_id", "url").select(
            F.concat("url", F.when(F.col("page_id") % 2 == 0, "//").otherwise("")).alias("abs_url")
        )
    )
    return urls.select("abs_url", text.paper_id_from_url(F.col("abs_url")).alias("paper_id"))


def compact_whitespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, f"{sf_dir}/documents.parquet", "doc_id", "text")
    html = read_documents(spark, f"{sf_dir}/pages.parquet", "page_id", "html")
    both = docs.select(F.lit("documents").alias("origin"), F.col("doc_id").alias("id"), "text")
    both = both.unionByName(
        html.select(F.lit("pages").alias("origin"), F.col("page_id").alias("id"), F.col("html").alias("text"))
    )
    return both.select("origin", "id", text.compact_whitespace(F.col("text")).alias("compacted"))


def pdf_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link lists built from the papers, with the PDF marked in a different way per id."""
    number = F.col("paper_id").cast("long")
    kind = number % 5

    def link(href: Column, rel: Column, title: Column, mime: Column) -> Column:
        return F.struct(
            href.alias("_href"), rel.alias("_rel"), title.alias("_title"), mime.alias("_type")
        )

    none = F.lit(None).cast("string")
    links = F.array(
        link(F.lit(""), F.lit("related"), F.lit("pdf"), none),
        link(F.col("abs_url"), F.lit("alternate"), none, F.lit("text/html")),
        link(
            F.concat(F.lit("http://x.example/pdf/"), "paper_id"),
            F.when(kind == 2, "Related").otherwise("self"),
            F.when(kind == 0, "PDF"),
            F.when(kind == 1, "Application/PDF"),
        ),
        link(
            F.concat(F.lit("https://y.example/PDF/http://"), "paper_id"),
            F.lit("related"),
            F.when(kind == 3, "pdf"),
            none,
        ),
    )
    return papers(spark, sf_dir).select("paper_id", text.pdf_link(links).alias("pdf_url"))


def json_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authors to JSON text and back; every seventh text is cut to be unreadable."""
    written = text.json_list(F.col("authors"))
    broken = F.col("paper_id").cast("long") % 7 == 0
    rows = papers(spark, sf_dir).select(
        "paper_id",
        written.alias("authors_json"),
        F.when(broken, F.left(written, F.lit(5))).otherwise(written).alias("stored"),
    )
    parsed = text.parse_json_list(F.col("stored"))
    return rows.select(
        "paper_id",
        "authors_json",
        F.size(parsed).cast("long").alias("n_authors"),
        F.array_join(parsed, "|").alias("authors"),
    )


def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of published dates cut to 0 to 19 characters."""
    cut = F.left("published", (F.col("paper_id").cast("long") % 20).cast("int"))
    rows = papers(spark, sf_dir).select("paper_id", cut.alias("published"))
    published = F.col("published")
    return rows.select(
        "paper_id",
        dates.year_part(published).alias("year"),
        dates.month_part(published).alias("month"),
        dates.day_part(published).alias("day"),
    )


def citation_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys with first words of titles as last names; every sixth paper has no author."""
    name = F.concat(F.lit(" Ada "), F.substring_index("title", " ", 1), F.lit(" "))
    number = F.col("paper_id").cast("long")
    authors = F.when(number % 6 == 0, F.array().cast("array<string>")).otherwise(F.array(name))
    old_id = F.concat(F.lit("math.AG/"), "paper_id")
    return papers(spark, sf_dir).select(
        "paper_id", bibtex.citation_key(authors, old_id).alias("citation_key")
    )


def truncate_abstract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return papers(spark, sf_dir).select(
        "paper_id", bibtex.truncate_abstract(F.col("summary")).alias("abstract")
    )


def bibtex_escape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Escaped texts of all documents, pages and event properties."""
    docs = read_documents(spark, f"{sf_dir}/documents.parquet", "doc_id", "text")
    html = read_documents(spark, f"{sf_dir}/pages.parquet", "page_id", "html")
    events = read_documents(spark, f"{sf_dir}/events.parquet", "event_id", "props")
    every = None
    for origin, rows in (("documents", docs), ("pages", html), ("events", events)):
        key, value = rows.columns
        part = rows.select(
            F.lit(origin).alias("origin"),
            F.col(key).alias("id"),
            bibtex.bibtex_escape(F.col(value)).alias("escaped"),
        )
        every = part if every is None else every.unionByName(part)
    return every


def iso_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates parsed from published texts; every ninth uses slashes and is refused."""
    number = F.col("paper_id").cast("long")
    raw = F.left("published", F.lit(10))
    raw = F.when(number % 9 == 0, F.translate(raw, "-", "/")).otherwise(raw)
    return papers(spark, sf_dir).select(
        "paper_id", dates.try_parse_iso_date(raw).alias("parsed")
    )


# Record rules and candidates


def invalid_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that lack fields by rule, with the first rule each one breaks."""
    number = F.col("paper_id").cast("long")

    def blank(column: str, every: int) -> Column:
        return F.when(number % every == 0, "").otherwise(F.col(column)).alias(column)

    raw = papers(spark, sf_dir).select(
        number.alias("number"),
        blank("paper_id", 11),
        blank("title", 7),
        blank("published", 5),
        F.when(number % 3 == 0, F.array().cast("array<string>"))
        .when(number % 3 == 1, F.array(F.lit("")))
        .otherwise(F.col("authors"))
        .alias("authors"),
    )
    reason = feed.skip_reason({c: F.col(c) for c in raw.columns})
    return feed.invalid_records(raw.withColumn("skip_reason", reason)).select(
        "number", "skip_reason"
    )


def window_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    inside = candidates.in_window(F.col("published"), *WINDOW)
    return papers(spark, sf_dir).filter(inside).select("paper_id", "published")


CANDIDATE_COLUMNS = ["paper_id", "published", "source_ordinal", "source_name"]


def category_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = candidates.category_candidates(papers(spark, sf_dir), CONFIG, *WINDOW)
    return rows.select(*CANDIDATE_COLUMNS)


def keyword_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = candidates.keyword_candidates(papers(spark, sf_dir), CONFIG, *WINDOW)
    return rows.select(*CANDIDATE_COLUMNS)


def keyword_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword candidates of a config without query terms: core, then adjacent terms stand in."""
    rows = candidates.keyword_candidates(papers(spark, sf_dir), OTHER_CONFIG)
    return rows.select(*CANDIDATE_COLUMNS)


def all_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = candidates.all_candidates(papers(spark, sf_dir), CONFIG, *WINDOW)
    return rows.select(*CANDIDATE_COLUMNS)


def tagged_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = candidates.tagged_candidates(papers(spark, sf_dir), CONFIG, *WINDOW)
    return rows.select("paper_id", "source_ordinal", bar("sources"))


def merge_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of all sources merged; each source reports its own URL version."""
    rows = candidates.all_candidates(papers(spark, sf_dir), CONFIG)
    versions = rows.select(
        "paper_id",
        "title",
        "published",
        F.concat("abs_url", F.lit("."), F.col("source_ordinal").cast("string")).alias("abs_url"),
        F.array("source_name").alias("sources"),
        "source_ordinal",
        F.lit(0).alias("page_start"),
        F.lit(0).alias("pos"),
    )
    merged = staged(merge.merge_papers(versions))
    return with_position(merge.in_merged_order(merged.withColumn("sources", bar("sources"))))


def streamed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidates of ``merge_papers`` landing on four days in turn, each day a micro-batch."""
    rows = candidates.all_candidates(papers(spark, sf_dir), CONFIG)
    day = F.col("source_ordinal") % 4
    landed = staged(
        rows.select(
            "paper_id",
            "title",
            "published",
            F.concat("abs_url", F.lit("."), F.col("source_ordinal").cast("string")).alias("abs_url"),
            F.array("source_name").alias("sources"),
            "source_ordinal",
            F.lit(0).cast("bigint").alias("page_start"),
            F.lit(0).alias("pos"),
            F.timestamp_add("DAY", day, F.lit("2024-06-01 00:00:00").cast("timestamp")).alias("landed_at"),
        )
    )
    folder = scratch(spark)
    landed.where("false").write.parquet(f"{folder}/landing")
    stream = spark.readStream.schema(landed.schema).parquet(f"{folder}/landing")

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{folder}/out/part={number}")

    # A day's files, however many, are one batch; the next start goes on from the state of the last.
    for i in range(4):
        landed.where(day == i).write.mode("append").parquet(f"{folder}/landing")
        first_arrivals(stream).writeStream.foreachBatch(keep).outputMode("update").option(
            "checkpointLocation", f"{folder}/progress"
        ).trigger(availableNow=True).start().awaitTermination()
    seen = spark.read.parquet(f"{folder}/out").drop("part")
    rest = [c for c in seen.columns if c not in ("paper_id", "batch")]
    last = seen.groupBy("paper_id").agg(F.max_by(F.struct(*rest), "batch").alias("last")).select("paper_id", "last.*")
    return last.withColumn("sources", bar("sources"))


def merge_table_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All papers and altered copies of some: the earliest source wins, then the copy that sorts first."""
    rows, number = papers(spark, sf_dir), F.col("paper_id").cast("long")
    later = rows.filter(number % 2 == 0).withColumn("title", F.concat(F.lit("Zz "), "title"))
    sooner = rows.filter(number % 3 == 0).withColumn("title", F.concat(F.lit("A in the "), "title"))
    moved = rows.filter(number % 5 == 0).withColumn("categories", F.array(F.lit("src0"), F.col("primary_category")))
    every = rows.unionByName(later).unionByName(sooner).unionByName(moved)
    merged = triage_documents(every, CONFIG, unique=False)
    return merged.select("paper_id", "title", bar("categories"), "score", "label", bar("sources"))


# Scoring


def score_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).select("paper_id", "score", "label")


def score_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).select("paper_id", bar("reasons"))


def anchor_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    matched = terms.match_terms(papers(spark, sf_dir), CONFIG, terms.SCORING_TIERS)
    return score.with_scores(matched, CONFIG).select("paper_id", "has_anchor", "raw_score", "score")


def label_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(spark, sf_dir)
    return rows.select("paper_id", "label", score.label_rank(F.col("label")).alias("label_rank"))


def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.label_counts(scored(spark, sf_dir))


def relevant_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.relevant(scored(spark, sf_dir)).select("paper_id", "title", "score", "label")


def term_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.term_matches(papers(spark, sf_dir), CONFIG)


def many_terms(rows: DataFrame) -> DataFrame:
    """Twelve pieces of every summary, cut by rule, as terms."""
    number = F.col("paper_id").cast("int")
    pieces = [F.substring("summary", 1 + (number * 7 + k * 61) % 400, 8 + (number + k) % 9) for k in range(12)]
    return rows.select(F.explode(F.array(*[F.lower(p) for p in pieces])).alias("term")).where("term <> ''").distinct()


def many_term_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = papers(spark, sf_dir)
    return term_index.find_terms(rows, staged(many_terms(rows)))


def score_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores by the index that serves configs of thousands of terms."""
    return term_index.score_many(papers(spark, sf_dir), CONFIG).select("paper_id", "score", "label", bar("reasons"))


def rescore_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers scored by one config, then by another from the stored hits of the first."""
    stored = staged(terms.match_terms(papers(spark, sf_dir), CONFIG, terms.SCORING_TIERS))
    return rescore.rescore(stored, CONFIG, OTHER_CONFIG).select("paper_id", "score", "label")


def context_gated_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = terms.context_gated_terms(papers(spark, sf_dir), CONTEXT_GATES)
    return rows.select("paper_id", "term", bar("contexts"))


# Windows


def trailing_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = dates.resolve_window(days=14, as_of=WINDOW[1])
    inside = candidates.in_window(F.col("published"), start, end)
    return papers(spark, sf_dir).filter(inside).select(
        "paper_id",
        "published",
        F.lit(start).alias("window_start"),
        F.lit(end).alias("window_end"),
    )


def month_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Week windows of all events and all orders, with the rows in each."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    days = events.select(F.col("ts").cast("date").alias("day")).unionByName(
        orders.select(F.col("o_orderdate").cast("date").alias("day"))
    )
    return windows.with_week(days).groupBy(*windows.WINDOW_COLUMNS).agg(long_count("n"))


def monthly_digest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label counts of every week window of the year, in one job."""
    rows = triage_documents(papers(spark, sf_dir), CONFIG, unique=True)
    weekly = windows.with_published_week(rows)
    return score.label_counts(weekly, *windows.WINDOW_COLUMNS)


# Selection


def _selected(spark: SparkSession, sf_dir: str, **filters) -> DataFrame:
    rows = select_papers(papers(spark, sf_dir), **filters)
    return rows.select("paper_id", "title", "published", "primary_category")


def filter_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selected(spark, sf_dir, categories=["src1", "src7"])


def filter_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selected(spark, sf_dir, start=dt.date(2024, 2, 10), end=dt.date(2024, 3, 20))


def filter_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selected(spark, sf_dir, title_contains="THE")


def filter_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selected(spark, sf_dir, summary_contains="CIÓN")


def filter_author(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selected(spark, sf_dir, author_name_contains="ada k1")


def filter_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selected(spark, sf_dir, text_contains="SRC1")


def filter_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers whose id is on a list of padded, repeated and blank lines."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id")
    number = F.col("doc_id").cast("string")
    lines = labels.select(
        F.explode(F.array(F.concat(F.lit(" "), number, F.lit("\t")), number, F.lit("  "))).alias("value")
    )
    return _selected(spark, sf_dir, ids=id_list(lines))


def filter_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selected(
        spark,
        sf_dir,
        categories=[f"src{i}" for i in range(10)],
        start=dt.date(2024, 1, 15),
        end=dt.date(2024, 11, 30),
        title_contains="e",
        summary_contains="The",
        author_name_contains="ada",
        text_contains="ing",
    )


# Exports


def export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Stored before the sort, which samples its input.
    rows = exports.in_export_order(staged(exports.export_rows(triaged(spark, sf_dir))))
    lists = {c: bar(c) for c in ("categories", "authors", "source_queries")}
    return with_position(rows.withColumns(lists))


def exported_weeks(spark: SparkSession, sf_dir: str) -> str:
    """Exports of every week of the year, written twice and in two calls; returns the folder."""
    rows = staged(windows.in_month_weeks(triaged(spark, sf_dir)))
    folder = scratch(spark)
    for months in (YEAR_MONTHS[:6], YEAR_MONTHS[6:], YEAR_MONTHS[:6]):
        weeks = windows.month_windows(spark, months)
        inside = rows.filter(F.left("published", F.lit(7)).isin(months))
        exports.write_exports(inside, weeks, folder)
    return folder


def csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CSV exports of all weeks, read back."""
    cells = spark.read.csv(f"{exported_weeks(spark, sf_dir)}/csv", header=True, escape='"')
    return cells.na.fill("")


def jsonl_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the JSON Lines exports of all weeks, read back."""
    lines = spark.read.text(f"{exported_weeks(spark, sf_dir)}/jsonl")
    return lines.select("window_slug", F.get_json_object("value", "$.arxiv_id").alias("arxiv_id"), F.from_json("value", "title string, summary string, source_queries array<string>, label string").alias("v")).select(
        "window_slug", "arxiv_id", "v.title", "v.summary", F.array_join("v.source_queries", "|").alias("source_queries"), "v.label"
    )


def single_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV, JSON Lines and digest of every week as one file each, read back line by line with positions."""
    rows, folder = staged(windows.in_month_weeks(triaged(spark, sf_dir))), scratch(spark)
    single.write_single_exports(rows, windows.month_windows(spark, YEAR_MONTHS), folder)
    lines = spark.read.text([f"{folder}/{kind}" for kind in single.NAMES])
    placed = with_positions(lines, lambda rows, name: staged(rows), path="path")
    kind = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    return placed.select(
        kind.alias("kind"),
        F.regexp_extract("path", r"([^/]+)\.[a-z]+$", 1).alias("window_slug"),
        "position",
        F.when(kind == "csv", F.split("value", ",")[1])
        .when(kind == "jsonl", F.get_json_object("value", "$.arxiv_id"))
        .otherwise(F.col("value"))
        .alias("content"),
    )


def undated_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers whose published text is cut by rule: those without a full date go to the quarantine."""
    cut = F.left("published", (F.col("paper_id").cast("long") % 14).cast("int"))
    return undated(papers(spark, sf_dir).withColumn("published", cut)).select("abs_url", "reason")


def export_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exports.csv_rows(exports.export_rows(triaged(spark, sf_dir)))


def export_jsonl_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exports.export_rows(triaged(spark, sf_dir))
    return rows.select("arxiv_id", exports.jsonl_lines(rows).alias("line"))


def digest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every week of the year; weeks without papers have one too."""
    rows = staged(
        windows.in_month_weeks(triaged(spark, sf_dir)).select(
            "window_slug", "label", "title", "abs_url", "paper_id", "published"
        )
    )
    weeks = windows.month_windows(spark, YEAR_MONTHS)
    return exports.in_digest_order(exports.digest_lines(rows, weeks))


def bibtex_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of all papers; by rule some lack title, author, category or date parts."""
    number = F.col("paper_id").cast("long")
    rows = papers(spark, sf_dir).withColumns(
        {
            "title": F.when(number % 5 != 0, F.concat("title", F.lit(' {"x"} \\'))).otherwise(""),
            "authors": F.when(number % 3 != 0, F.col("authors")).otherwise(
                F.array().cast("array<string>")
            ),
            "published": F.left("published", (number % 12).cast("int")),
            "primary_category": F.when(number % 4 != 0, F.col("primary_category")),
        }
    )
    return exports.bibtex_entries(rows).select("paper_id", "entry")


def bibliography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all papers in the bibliography."""
    entries = exports.in_bibliography_order(exports.bibtex_entries(papers(spark, sf_dir)))
    return with_position(entries.select("paper_id", "published"))


# Store


def year_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triage of the whole year as weekly runs, numbered from 1 in time order."""
    rows = triage_documents(papers(spark, sf_dir), CONFIG, unique=True)
    dated = windows.in_month_weeks(rows)
    month = F.substring("published", 6, 2).cast("long") - 1
    return dated.withColumn("run_id", month * 5 + F.col("window_ordinal") + 1)


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = year_runs(spark, sf_dir)
    weeks = windows.month_windows(spark, YEAR_MONTHS)
    return run_rows(rows, weeks, 1, "2024-12-31T00:00:00+00:00", "filters.json")


def run_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return year_runs(spark, sf_dir).select("run_id", "paper_id", "label", bar("sources"))


# Windows of three overlapping runs; the later two use another config and newer titles.
RUN_WINDOWS = {1: (None, None), 2: (dt.date(2024, 2, 1), None), 3: (dt.date(2024, 3, 1), dt.date(2024, 3, 31))}


def three_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of the three runs, narrow, from one scan: both configs score every paper."""
    both = terms.match_terms(papers(spark, sf_dir), CONFIG, terms.SCORING_TIERS, "old_hits")
    both = terms.match_terms(both, OTHER_CONFIG, terms.SCORING_TIERS, "new_hits")
    both = score.with_scores(both, CONFIG, "old_hits").withColumnRenamed("score", "old_score")
    both = both.drop("label", "reasons", "has_anchor", "raw_score")
    both = score.with_scores(both, OTHER_CONFIG, "new_hits").withColumnRenamed("score", "new_score")

    def seen(run_id: int) -> Column:
        points = F.col("old_score" if run_id == 1 else "new_score")
        suffix = "" if run_id == 1 else f" (v{run_id})"
        row = F.struct(
            F.lit(run_id).cast("long").alias("run_id"),
            F.concat("title", F.lit(suffix)).alias("title"),
            points.alias("score"),
            score.label_of(points).alias("label"),
            F.lit(f"2024-12-0{run_id}T00:00:00+00:00").alias("latest_seen_at"),
        )
        return F.when(candidates.in_window(F.col("published"), *RUN_WINDOWS[run_id]), row)

    rows = F.array_compact(F.array(*map(seen, RUN_WINDOWS)))
    return staged(both.select("paper_id", "published", "primary_category", F.inline(rows)))


STORED = ["paper_id", "title", "published", "primary_category", "latest_seen_at", "run_id"]


def stored_papers(runs: DataFrame) -> DataFrame:
    """Relevant papers of all runs as a change log, newest run on top."""
    return store.latest_changes(score.relevant(runs).select(*STORED))


def upsert_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_papers(three_runs(spark, sf_dir))


def upsert_onto_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run 1 as a compacted base, the changes of runs 2 and 3 applied to it."""
    kept = score.relevant(three_runs(spark, sf_dir)).select(*STORED)
    return store.apply_changes(kept.filter("run_id = 1"), kept.filter("run_id > 1"))


def upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three runs as upserts into a bucketed snapshot."""
    kept = staged(score.relevant(three_runs(spark, sf_dir)).select(*STORED))
    snapshot = buckets.BucketedPapers(spark, scratch(spark), kept.schema, buckets=16)
    for run_id in RUN_WINDOWS:
        snapshot.upsert(kept.filter(F.col("run_id") == run_id))
    return snapshot.current()


def ids_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers of a list of ids out of a bucketed snapshot; some ids are listed twice, some are not stored."""
    rows = papers(spark, sf_dir).select("paper_id", "title", F.lit(1).cast("bigint").alias("run_id"))
    snapshot = buckets.BucketedPapers(spark, scratch(spark), rows.schema, buckets=64)
    snapshot.upsert(staged(rows))
    number = F.col("paper_id").cast("bigint")
    ids = rows.filter(number % 50 < 2).select(F.explode(F.array((number - number % 2).cast("string"), F.concat(F.lit("x"), number))).alias("paper_id"))
    return snapshot.of_ids(ids).select("paper_id", "title")


def label_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.label_intervals(three_runs(spark, sf_dir))


def labels_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of all papers before, between and after the runs."""
    runs = three_runs(spark, sf_dir)
    log = runs.groupBy("run_id").agg(F.max("latest_seen_at").alias("collected_at"))
    dates_ = F.explode(F.array(*[F.lit(f"2024-12-0{d}T00:00:00+00:00") for d in (0, 1, 2, 9)])).alias("as_of")
    return intervals.labels_as_of(runs, log, papers(spark, sf_dir).select("paper_id", dates_))


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = three_runs(spark, sf_dir)
    log = runs.groupBy("run_id").agg(
        F.left(F.min("published"), F.lit(10)).alias("window_start"),
        F.left(F.max("published"), F.lit(10)).alias("window_end"),
    )
    return store.run_history(runs, log, stored_papers(runs))


def run_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = three_runs(spark, sf_dir)
    seen = runs.select("run_id", "paper_id", "label")
    return store.run_orphans(seen, stored_papers(runs))


def store_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over all papers through a store, compacted after the first: papers, history and run log, read back."""
    kept = store.PaperStore(spark, scratch(spark)).create()
    rows = papers(spark, sf_dir)
    for run_id, (start, end) in RUN_WINDOWS.items():
        suffix = "" if run_id == 1 else f" (v{run_id})"
        run_window(
            rows.withColumn("title", F.concat("title", F.lit(suffix))),
            CONFIG if run_id == 1 else OTHER_CONFIG,
            kept,
            start or dt.date(2024, 1, 1),
            end or dt.date(2024, 12, 31),
            collected_at=f"t{run_id}",
        )
        if run_id == 1:
            kept.compact()
    none = F.lit(None).cast("string")
    stored = kept.papers().select(F.lit("paper").alias("kind"), "run_id", "paper_id", "title", none.alias("detail"))
    seen = kept.history().select(F.lit("seen").alias("kind"), "run_id", "paper_id", "title", F.col("label").alias("detail"))
    counts = F.concat_ws("/", "total_candidates", "core_count", "adjacent_count", "window_start")
    log = kept.runs().select(F.lit("run").alias("kind"), "run_id", none.alias("paper_id"), none.alias("title"), counts.alias("detail"))
    return stored.unionByName(seen).unionByName(log)


# Reports


def shortlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.shortlist(scored(spark, sf_dir))


def label_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth = spark.read.parquet(f"{sf_dir}/labels.parquet").select(
        F.col("doc_id").cast("string").alias("paper_id"), "quality"
    )
    return evaluate.label_confusion(scored(spark, sf_dir), truth, F.col("quality") == 1)


def threshold_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision and recall against the quality labels from each score on."""
    truth = spark.read.parquet(f"{sf_dir}/labels.parquet").withColumn("paper_id", F.col("doc_id").cast("string"))
    return evaluate.threshold_curve(scored(spark, sf_dir), truth, F.col("quality") == 1)


def config_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.config_diff(papers(spark, sf_dir), CONFIG, OTHER_CONFIG)


QUERIES = {
    query.__name__: query
    for query in (
        feed_ingest,
        feed_entries_streamed,
        ingest_completeness,
        missing_page_ranges,
        quarantined_pages,
        quarantined_records,
        config_terms,
        config_chunks,
        papers_scan,
        extract_id,
        compact_whitespace,
        pdf_link,
        json_lists,
        date_parts,
        citation_key,
        truncate_abstract,
        bibtex_escape,
        iso_dates,
        invalid_records,
        window_filter,
        category_candidates,
        keyword_candidates,
        keyword_fallback,
        all_candidates,
        tagged_candidates,
        merge_papers,
        streamed_merge,
        merge_table_copies,
        score_papers,
        score_reasons,
        anchor_gate,
        label_papers,
        label_counts,
        relevant_papers,
        term_matches,
        many_term_matches,
        score_indexed,
        rescore_delta,
        context_gated_terms,
        trailing_window,
        month_weeks,
        monthly_digest_counts,
        filter_category,
        filter_date,
        filter_title,
        filter_summary,
        filter_author,
        filter_text,
        filter_ids,
        filter_combined,
        export_rows,
        export_csv_rows,
        export_jsonl_rows,
        csv_files,
        single_files,
        jsonl_files,
        undated_records,
        digest_lines,
        bibtex_entries,
        bibliography,
        run_log,
        run_papers,
        upsert_papers,
        upsert_bucketed,
        ids_bucketed,
        label_intervals,
        labels_as_of,
        upsert_onto_base,
        run_history,
        run_orphans,
        store_roundtrip,
        shortlist,
        label_confusion,
        threshold_curve,
        config_diff,
    )
}
