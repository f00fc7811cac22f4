"""A corpus pipeline of five stages, each one operator of ``paperloom.llm``.

Rows that a stage rejects are gone for the next one.  All stages but the last return the columns they were given;
between stages rows are written to the shared folder and read again.

Defined results: null, blank and letterless texts go in the first stage; rows without an id are treated like others; repeated
rows and similar texts leave one row; an empty table passes through; further columns are kept up to the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom.llm import bpe, decontaminate, jaccard, langid, quality
from paperloom.llm.common import stage

#: Below this calibrated score no language is taken as recognized.
LEAST_SCORE = 0.5

#: Learned models, similarity joins and token merges: not expressible in SQL.
ORACLE_SQL = None


def _numbered(docs: DataFrame) -> tuple[DataFrame, list[str], list]:
    """Rows with numbered copies of all columns but the text, their names, and how to name them back."""
    names = ["text" if c == "text" else f"_c{i}" for i, c in enumerate(docs.columns)]
    copies = [F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names) if c != "text"]
    back = [F.col(n).alias(c) for c, n in zip(docs.columns, names)]
    return docs.select("doc_id", "text", "lang", *copies), names, back


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts whose language is recognized."""
    rows, names, back = _numbered(docs)
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    told = langid.predict(rows, model, names)
    return told.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*back)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts that pass the base rules and lie in the band of their language."""
    rows, names, back = _numbered(docs)
    return quality.judge(rows, names).where("kept").select(*back)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one text of each class of similar ones."""
    return jaccard.keep_one(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts that hold no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontaminate.drop_contaminated(docs, items)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit), ids_sha256."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rows = bpe.encode_texts(docs, path, public_tokenizers.PATTERN, ["doc_id"])
    n_tokens = (F.octet_length("ids") / 4).cast("bigint")
    return rows.select("doc_id", n_tokens.alias("n_tokens"), "ids", F.sha2("ids", 256).alias("ids_sha256"))


STAGES = [
    ("language ID", identify_language),
    ("quality rules", apply_quality_rules),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_passages),
    ("byte-level BPE", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
