"""Words and rolling word k-grams as built-in expressions."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from paperloom.llm.common import held

#: Everything that is not part of a word once A to Z are lower case.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, BREAKS), "")


def gram_hashes(of: Column | str, k: int) -> Column:
    """Hash of every k consecutive elements; empty below k of them."""
    array = F.col(of) if isinstance(of, str) else of
    last = F.size(array) - k
    hashes = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(array, i + 1, k)))
    return F.when(last >= 0, hashes).otherwise(F.array().cast("array<bigint>"))


def gram_positions(rows: DataFrame, k: int) -> DataFrame:
    """Rows with a column ``words`` times their k-grams: pos, h.  A row without a gram stays, with nulls."""
    hashed = held(rows, _hashes=gram_hashes("words", k))
    kept = [F.col(f"`{c}`") for c in rows.columns]
    return hashed.select(*kept, F.posexplode_outer("_hashes").alias("pos", "h"))
