"""Filter configuration: seven term and category lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom import defaults, schemas
from paperloom.functions.literals import small_table


@dataclass(frozen=True)
class FilterConfig:
    """The lists that drive collection and scoring.

    ``anchor_categories`` falls back to ``categories`` and ``query_terms`` to the
    core terms followed by the adjacent terms, each only when it is absent.
    """

    categories: tuple[str, ...]
    core_terms: tuple[str, ...]
    adjacent_terms: tuple[str, ...]
    exclude_terms: tuple[str, ...]
    anchor_categories: tuple[str, ...] | None = None
    anchor_terms: tuple[str, ...] = ()
    query_terms: tuple[str, ...] | None = None

    @classmethod
    def from_mapping(cls, lists: Mapping[str, Sequence[str] | None]) -> FilterConfig:
        required = ("categories", "core_terms", "adjacent_terms", "exclude_terms")
        missing = [name for name in required if lists.get(name) is None]
        if missing:
            raise KeyError(f"filter config lacks {', '.join(missing)}")
        return cls(
            **{
                name: tuple(lists[name])
                for name in schemas.FILTER_FILE.fieldNames()
                if lists.get(name) is not None
            }
        )

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FilterConfig:
        """Read one JSON object; the file is a parameter of the job, not data."""
        row = filter_file(spark, path).first()
        if row is None:
            raise ValueError(f"no filter config in {path}")
        return cls.from_mapping(row.asDict())

    @classmethod
    def shipped(cls) -> FilterConfig:
        return cls.from_mapping(defaults.FILTERS)

    @property
    def anchors(self) -> tuple[str, ...]:
        return self.categories if self.anchor_categories is None else self.anchor_categories

    @property
    def keywords(self) -> tuple[str, ...]:
        if self.query_terms is None:
            return self.core_terms + self.adjacent_terms
        return self.query_terms

    def keyword_chunk(self, ordinal: int) -> int:
        return ordinal // defaults.KEYWORD_CHUNK_SIZE + 1

    def source_names(self) -> list[str]:
        """Candidate sources in arrival order: categories, then keyword chunks."""
        chunks = {self.keyword_chunk(i) for i in range(len(self.keywords))}
        return [f"category:{c}" for c in self.categories] + [
            f"keyword_chunk_{k}" for k in sorted(chunks)
        ]

    def term_table(self, spark: SparkSession) -> DataFrame:
        """The lists as a ``terms(tier, ordinal, term)`` dimension."""
        lists = {name: getattr(self, name) for name in schemas.FILTER_FILE.fieldNames()}
        fields = ",".join(f"{name}:array<string>" for name in lists)
        return unpivot_filters(small_table(spark, [lists], fields))


def filter_file(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.FILTER_FILE).option("multiLine", True).json(path)


def read_term_table(spark: SparkSession, path: str) -> DataFrame:
    """``terms(tier, ordinal, term)`` straight from a JSON config file."""
    return unpivot_filters(filter_file(spark, path))


def unpivot_filters(lists: DataFrame) -> DataFrame:
    tiers = F.array(
        *[
            F.struct(F.lit(name).alias("tier"), F.col(name).alias("terms"))
            for name in schemas.FILTER_FILE.fieldNames()
        ]
    )
    return (
        lists.select(F.inline(tiers))
        .select("tier", F.posexplode("terms").alias("ordinal", "term"))
        .select("tier", "ordinal", "term")
    )


def term_chunks(terms: DataFrame, tier: str = "query_terms") -> DataFrame:
    """Chunk number (from 1) of every term of one tier, by position in its list."""
    chunk = F.floor(F.col("ordinal") / defaults.KEYWORD_CHUNK_SIZE).cast("int") + 1
    return terms.filter(F.col("tier") == tier).select(
        chunk.alias("chunk"), "ordinal", "term"
    )
