"""Landed Atom feed pages.

Pages land as files under ``source_ordinal=<n>/source_name=<name>/page_start=<k>/``
(names percent-encoded as Spark itself writes them), or as rows of any table with the
same columns.  Page, position and source travel with every record: together they are
the arrival order that decides which duplicate wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import DataStreamReader

from paperloom import defaults, schemas
from paperloom.functions.text import compact_whitespace, paper_id_from_url, pdf_link

PAGE_COLUMNS = ["source_ordinal", "source_name", "page_start"]

FEED_OPTIONS = {
    "ignoreNamespace": "true",
    "ignoreSurroundingSpaces": "false",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_bad",
}

# A child element inside a title or summary: text before it, the rest, the closing tag.
INLINE_MARKUP = (
    r"(?s)(<(?:\w+:)?(title|summary)(?:\s[^<>]*)?(?<!/)>"
    r"[^<]*+(?:(?:<!--.*?-->|<!\[CDATA\[.*?\]\]>)[^<]*+)*+)"
    r"<(?!/).*?(</(?:\w+:)?\2\s*>)"
)


def read_feed_pages(spark: SparkSession, path: str) -> DataFrame:
    """Whole pages, one per file, with their place taken from the directory names."""
    return spark.read.schema(schemas.FEED_PAGE).text(path, wholetext=True)


def feed_page_stream(spark: SparkSession) -> DataStreamReader:
    return (
        spark.readStream.format("text")
        .schema(schemas.FEED_PAGE)
        .option("wholetext", True)
    )


def parse_pages(pages: DataFrame, *further: str) -> DataFrame:
    """Declared total and raw entries of every page; unreadable pages stay, flagged.

    Text of a title or summary ends at its first child element.  The parsed page
    comes out of a one-element ``explode``, so filters on it never parse twice.
    ``further`` columns of the pages are kept.
    """
    page = F.from_xml(
        F.regexp_replace("value", INLINE_MARKUP, "$1$3"), schemas.FEED_XML, FEED_OPTIONS
    )
    blank = F.trim(F.coalesce(F.col("value"), F.lit(""))) == ""
    return (
        pages.select(*PAGE_COLUMNS, *further, "value", F.explode(F.array(page)).alias("page"))
        .withColumn("corrupt", blank | F.col("page").isNull() | F.col("page._bad").isNotNull())
        .select(
            *PAGE_COLUMNS,
            *further,
            "corrupt",
            F.when(F.col("corrupt"), F.col("value")).alias("raw_page"),
            F.when(
                ~F.col("corrupt"), F.coalesce(F.col("page.totalResults"), F.lit(0))
            ).alias("declared_total"),
            F.when(~F.col("corrupt"), F.col("page.entry")).alias("entries"),
        )
    )


def corrupt_pages(parsed: DataFrame) -> DataFrame:
    """Pages that are not well-formed or declare a total that is no number."""
    return parsed.filter("corrupt").select(*PAGE_COLUMNS, "raw_page")


def _first_text(element: Column) -> Column:
    return F.coalesce(F.get(element, F.lit(0)), F.lit(""))


def skip_reason(record: dict[str, Column]) -> Column:
    """First rule a record breaks, or null for a valid one.

    An author without a name is still an author.
    """

    def absent(text: Column) -> Column:
        return F.coalesce(text, F.lit("")) == ""

    return F.coalesce(
        F.when(absent(record["paper_id"]), "no id"),
        F.when(absent(record["title"]), "no title"),
        F.when(absent(record["published"]), "no published date"),
        F.when(F.coalesce(F.size(record["authors"]), F.lit(0)) <= 0, "no authors"),
    )


def paper_fields(entry: Column) -> dict[str, Column]:
    """The fields of a paper out of a raw entry."""
    abs_url = _first_text(entry["id"])
    strings = "array<string>"
    return {
        "paper_id": paper_id_from_url(abs_url),
        "title": compact_whitespace(_first_text(entry["title"])),
        "summary": compact_whitespace(_first_text(entry["summary"])),
        "published": _first_text(entry["published"]),
        "updated": _first_text(entry["updated"]),
        "primary_category": F.coalesce(
            F.get(entry["primary_category"], F.lit(0))["_term"], F.lit("")
        ),
        "categories": F.coalesce(
            F.transform(
                entry["category"], lambda c: F.coalesce(c["_term"], F.lit(""))
            ),
            F.array().cast(strings),
        ),
        "authors": F.coalesce(
            F.transform(
                entry["author"], lambda a: compact_whitespace(_first_text(a["name"]))
            ),
            F.array().cast(strings),
        ),
        "abs_url": abs_url,
        "pdf_url": pdf_link(entry["link"]),
    }


def page_entries(parsed: DataFrame, *further: str) -> DataFrame:
    """One paper row per entry with its position and, if invalid, the reason."""
    rows = parsed.select(*PAGE_COLUMNS, *further, F.posexplode("entries").alias("pos", "entry"))
    columns = paper_fields(F.col("entry"))
    placed = rows.select(
        *PAGE_COLUMNS, *further, "pos", *[columns[c].alias(c) for c in schemas.PAPER_COLUMNS]
    )
    return placed.withColumn(
        "skip_reason", skip_reason({c: F.col(c) for c in schemas.PAPER_COLUMNS})
    )


def valid_papers(entries: DataFrame, *further: str) -> DataFrame:
    """Candidate rows: valid entries with their source as a one-name array."""
    return entries.filter(F.col("skip_reason").isNull()).select(
        *further,
        *schemas.ARRIVAL_COLUMNS,
        *schemas.PAPER_COLUMNS,
        F.array("source_name").alias("sources"),
    )


def invalid_records(entries: DataFrame) -> DataFrame:
    return entries.filter(F.col("skip_reason").isNotNull())


def quarantine(parsed: DataFrame) -> DataFrame:
    """Everything that was not taken in: unreadable pages and invalid entries.

    A page yields itself or its invalid entries, so it is parsed once.
    """
    kind = "array<struct<pos:int,abs_url:string,reason:string>>"

    def refused(pos: Column, abs_url: Column, reason: Column) -> Column:
        return F.struct(pos.alias("pos"), abs_url.alias("abs_url"), reason.alias("reason"))

    def of_entry(entry: Column, pos: Column) -> Column:
        fields = paper_fields(entry)
        return refused(pos, fields["abs_url"], skip_reason(fields))

    none = F.lit(None)
    page = F.array(refused(none.cast("int"), none.cast("string"), F.lit("unreadable page"))).cast(kind)
    entries = F.filter(F.transform("entries", of_entry), lambda e: e["reason"].isNotNull()).cast(kind)
    return parsed.select(*PAGE_COLUMNS, F.inline(F.when(F.col("corrupt"), page).otherwise(entries)))


def ingest_completeness(
    parsed: DataFrame, page_size: int = defaults.FEED_PAGE_SIZE
) -> DataFrame:
    """Per source: the pages its declared total calls for against those that landed in place.

    A page that landed several times counts once, by the copy with most entries.  Pages are called for at 0,
    ``page_size``, and so on below the total; what landed elsewhere is not counted.
    """
    source = ["source_name", "source_ordinal"]
    per_page = parsed.groupBy(*source, "page_start").agg(
        F.max("declared_total").alias("declared_total"),
        F.max(F.coalesce(F.size("entries"), F.lit(0)).cast("long")).alias("entries"),
        F.count_if("corrupt").alias("corrupt_copies"),
        (~F.bool_and("corrupt")).alias("readable"),
    )
    totals = per_page.groupBy(*source).agg(
        F.coalesce(F.max("declared_total"), F.lit(0).cast("long")).alias("declared_total"),
    )
    # A source has few pages beside its entries, so both aggregates are small.
    placed = per_page.drop("declared_total").join(totals, source)
    wanted = (F.col("page_start") % page_size == 0) & (F.col("page_start") >= 0)
    wanted = wanted & (F.col("page_start") < F.col("declared_total")) & F.col("readable")
    counts = placed.groupBy(*source, "declared_total").agg(
        F.sum(F.when(wanted, F.col("entries")).otherwise(0)).alias("landed_entries"),
        F.count_if(wanted).alias("landed_pages"),
        F.sum("corrupt_copies").alias("corrupt_pages"),
    )
    expected = F.ceil(F.col("declared_total") / page_size).cast("long")
    gap = F.col("landed_pages") < expected
    return counts.withColumns(
        {
            "expected_pages": expected,
            "has_gap": gap,
            "complete": ~gap & (F.col("landed_entries") >= F.col("declared_total")),
        }
    )


def missing_page_ranges(parsed: DataFrame, page_size: int = defaults.FEED_PAGE_SIZE) -> DataFrame:
    """Per source the ranges of pages that its declared total calls for and that did not land readable.

    A range goes from the first to the last missing page start.  Ranges are the gaps between neighbouring pages that
    landed, with the ends of the source as neighbours too, so a source without a single page costs one row.
    """
    source = ["source_name", "source_ordinal"]
    per_page = parsed.groupBy(*source, "page_start").agg(
        F.max("declared_total").alias("declared_total"), (~F.bool_and("corrupt")).alias("readable")
    )
    totals = per_page.groupBy(*source).agg(F.coalesce(F.max("declared_total"), F.lit(0).cast("long")).alias("_total"))
    end = F.ceil(F.col("_total") / page_size).cast("long") * page_size
    edges = totals.select(*source, "_total", F.explode(F.array(F.lit(-page_size).cast("long"), end)).alias("page_start"))
    on_grid = F.col("readable") & (F.col("page_start") % page_size == 0) & (F.col("page_start") >= 0)
    landed = per_page.filter(on_grid).join(totals, source).filter(F.col("page_start") < F.col("_total"))
    known = landed.select(*edges.columns).unionByName(edges)
    following = F.lead("page_start").over(Window.partitionBy(*source).orderBy("page_start"))
    gaps = known.withColumn("_next", following).filter(F.col("_next") - F.col("page_start") > page_size)
    return gaps.select(
        *source,
        (F.col("page_start") + page_size).alias("first_missing"),
        (F.col("_next") - page_size).alias("last_missing"),
        F.floor((F.col("_next") - F.col("page_start")) / page_size - 1).cast("long").alias("pages"),
    )
