"""License scan by diagonal voting.

All rolling word k-grams of the texts are joined by hash to the k-grams of license templates; a match also has to agree word by
word, so hash collisions cast no vote.  Matches vote for diagonals (word place in the text less place in the template).  A diagonal
with every vote of its template is a verbatim place of it.  Diagonals at most ``SLACK`` apart are merged, which carries a
match over inserted or missing words; a merged match counts when its votes cover ``COVER`` of the template and its span is
not stretched.

Templates are a parameter of bounded size (checked), so their k-grams are broadcast; beyond the bound they are joined like any
table.  The shuffles carry only matches and one row per text.

Defined results: null and empty texts have no words and no labels; repeated rows are scanned each; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paperloom.functions.literals import small_table
from paperloom.llm.common import held
from paperloom.llm.grams import gram_positions, words

GRAM = 3
SLACK = 2
COVER = 0.8
#: Template k-grams that may be broadcast.
BROADCAST_GRAMS = 100_000


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    #: Whether verbatim places are reported as such.
    phrase: bool = False


# Phrases and sentences of public licenses.
TEMPLATES = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Template("apache-2", "licensed under the apache license version 2.0 you may not use this file except in compliance with the license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("gpl", "this program is free software you can redistribute it and/or modify it under the terms of the gnu general public license"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v. 2.0"),
    Template("isc", "permission to use copy modify and/or distribute this software for any purpose with or without fee is hereby granted"),
    Template("cc-by", "this work is licensed under a creative commons attribution 4.0 international license"),
    Template("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4.0 international license"),
)


def template_grams(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """h, gram, template, label, phrase, length, t_pos."""
    rows = [
        {"template": i, "label": t.label, "phrase": t.phrase, "text": t.text} for i, t in enumerate(templates)
    ]
    table = small_table(spark, rows, "template:int, label:string, phrase:boolean, text:string")
    split = held(table, words=words(F.col("text"))).drop("text")
    grams = gram_positions(split, GRAM).where("h IS NOT NULL")
    return grams.select(
        "h", F.slice("words", F.col("pos") + 1, GRAM).alias("gram"), "template", "label", "phrase",
        F.size("words").alias("length"), F.col("pos").alias("t_pos"),
    )


def scan_licenses(docs: DataFrame, keep: list[str], templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Per row: ``keep`` columns, n_words, and the array ``matches``.

    A match is (template, label, phrase, places, first_word, last_word, cover): ``places`` counts verbatim places of a phrase, with
    the smallest and largest start; ``cover`` is the share of the template's votes in its best merged match.
    """
    grams = template_grams(docs.sparkSession, templates)
    if sum(len(t.text.split()) for t in templates) <= BROADCAST_GRAMS:
        grams = F.broadcast(grams)
    # The row number only tells rows of one task apart inside this plan.
    own = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)])
    rows = held(docs.select(own.alias("own"), F.monotonically_increasing_id().alias("row"), "text"), words=words(F.col("text"))).drop("text")
    placed = gram_positions(rows.withColumn("n_words", F.size("words").cast("long")), GRAM)
    here = F.slice(F.col("words"), F.col("pos") + 1, GRAM)
    g = grams.select(F.col("h").alias("g_h"), *[c for c in grams.columns if c != "h"])
    met = placed.join(g, (F.col("h") == F.col("g_h")) & (here == F.col("gram")), "left")
    # One row stays of a text without matches.
    met = met.where(F.col("g_h").isNotNull() | F.col("pos").isNull() | (F.col("pos") == 0))
    # Only matches are left, so they go to their text's task at once; all that follows stays there.
    own = ["row", "own", "n_words"]
    placed = met.select(*own, "template", "label", "phrase", "length", (F.col("pos") - F.col("t_pos")).alias("diagonal"), "pos", "g_h")
    a_diagonal = placed.repartition("row").groupBy(*own, "template", "label", "phrase", "length", "diagonal").agg(
        F.count("g_h").alias("votes"), F.min("pos").alias("lo"), F.max("pos").alias("hi")
    )
    vote = F.struct("template", "diagonal", "label", "phrase", "length", "votes", "lo", "hi")
    of_text = a_diagonal.groupBy(*own).agg(F.collect_list(F.when(F.col("template").isNotNull(), vote)).alias("votes"))
    sorted_ = held(of_text, votes=F.sort_array("votes"))
    at = lambda i: F.get("votes", i)
    apart = lambda i: (i == 0) | (at(i)["template"] != at(i - 1)["template"]) | (at(i)["diagonal"] - at(i - 1)["diagonal"] > SLACK)
    clusters = held(_starts(sorted_, "votes", "starts", apart), clusters=_per_run("votes", "starts", _cluster))
    changed = lambda i: (i == 0) | (F.get("clusters", i)["template"] != F.get("clusters", i - 1)["template"])
    best = held(_starts(clusters, "clusters", "firsts", changed), matches=_per_run("clusters", "firsts", _best))
    return best.select(*[F.col("own")[f"c{i}"].alias(c) for i, c in enumerate(keep)], "n_words", "matches")


def _starts(rows: DataFrame, array: str, name: str, first) -> DataFrame:
    """Adds the places of an array at which a run begins."""
    places = F.when(F.size(array) > 0, F.sequence(F.lit(0), F.size(array) - 1)).otherwise(F.array().cast("array<int>"))
    return held(rows, **{name: F.filter(places, first)})


def _per_run(array: str, starts: str, summary) -> Column:
    """One value for each run of an array, from its slice."""
    stop = lambda j: F.coalesce(F.get(starts, j + 1), F.size(array))
    return F.transform(starts, lambda s, j: summary(F.slice(array, s + 1, stop(j) - s)))


def _fold(items: Column, value, combine) -> Column:
    return combine(F.transform(items, value))


def _sum(items: Column) -> Column:
    return F.aggregate(items, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _cluster(votes: Column) -> Column:
    """Neighbouring diagonals of one template as one match."""
    head = F.get(votes, F.lit(0))
    grams = head["length"] - GRAM + 1
    whole = F.transform(F.filter(votes, lambda v: v["phrase"] & (v["votes"] == grams)), lambda v: v["diagonal"].cast("bigint"))
    span = _fold(votes, lambda v: v["hi"], F.array_max) - _fold(votes, lambda v: v["lo"], F.array_min) + GRAM
    # Repeats that touch make a long span out of whole matches; others may be stretched by the slack only.
    fits = (span <= head["length"] + SLACK) | (F.size(whole) > 0)
    cover = F.when(fits, F.least(F.lit(1.0), _fold(votes, lambda v: v["votes"], _sum) / grams)).otherwise(0.0)
    return F.struct(
        head["template"].alias("template"),
        head["label"].alias("label"),
        head["phrase"].alias("phrase"),
        F.size(whole).cast("bigint").alias("places"),
        F.array_min(whole).alias("first_word"),
        F.array_max(whole).alias("last_word"),
        cover.alias("cover"),
    )


def _best(clusters: Column) -> Column:
    """The matches of one template as one."""
    head = F.get(clusters, F.lit(0))
    return F.struct(
        head["template"].alias("template"),
        head["label"].alias("label"),
        head["phrase"].alias("phrase"),
        _fold(clusters, lambda c: c["places"], _sum).alias("places"),
        _fold(clusters, lambda c: c["first_word"], F.array_min).alias("first_word"),
        _fold(clusters, lambda c: c["last_word"], F.array_max).alias("last_word"),
        _fold(clusters, lambda c: c["cover"], F.array_max).alias("cover"),
    )


def labels_of(matches: Column | str, chosen) -> Column:
    """Distinct labels of the matches that ``chosen`` accepts, sorted and joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(F.filter(matches, chosen), lambda m: m["label"]))), ",")
