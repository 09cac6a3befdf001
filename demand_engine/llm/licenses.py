"""License scans by diagonal voting, in DataFrame operations only.

Every text becomes words; the hash of each run of two words (the rolling
k-gram) is joined to the places of the templates' k-grams. A hit votes for
its offset diagonal (word position minus template position). On one
document and template, neighbouring diagonals are merged, so inserted or
lost words do not break a match, and a merged span is verified by the share
of the template's k-grams in it and by its length. Phrases are templates
that must match whole, on one diagonal.

The template table is fixed and small, so its join is a broadcast; the
documents are read once, and only hits are shuffled. Each document also
carries one end mark, which brings its word count to the result.

Cases: null or empty texts have no words, no places and score 0; rows of
equal id and text give equal result rows; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import materialise

#: Text between words: all of ASCII but digits and letters (the text is lower-cased).
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_END = -1


@dataclass(frozen=True)
class Template:
    """A phrase or a text that stands for a label. ``base`` phrases give
    places; ``exact`` templates must match whole."""

    label: str
    text: str
    base: bool = False
    exact: bool = False

    def words(self) -> list[str]:
        return re.findall(r"[a-z0-9]+", self.text.lower())


#: The phrases of the contract, and public license notices.
TEMPLATES = (
    Template("mit", "mit license", base=True, exact=True),
    Template("apache", "apache license", base=True, exact=True),
    Template("gpl", "general public license", base=True, exact=True),
    Template("cc-by-nc", "licensed under cc by nc", exact=True),
    Template("cc-by-sa", "licensed under cc by sa", exact=True),
    Template("proprietary", "all rights reserved", exact=True),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software",
    ),
    Template(
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at",
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ),
    Template("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
)


def template_places(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """(h, tpl, tpos): the k-grams of the templates, and the end mark."""
    rows = [(t, i, a, b) for t, x in enumerate(templates) for i, (a, b) in enumerate(zip(x.words(), x.words()[1:], strict=False))]
    grams = F.array(*(F.struct(F.lit(t).alias("tpl"), F.lit(i).alias("tpos"), F.xxhash64(F.lit(a), F.lit(b)).alias("h")) for t, i, a, b in rows))
    end = F.struct(F.lit(_END).alias("tpl"), F.lit(0).alias("tpos"), F.lit(_END).cast("long").alias("h"))
    return spark.range(1).select(F.explode(F.concat(grams, F.array(end))).alias("g")).select("g.h", "g.tpl", "g.tpos")


def _facts(templates: tuple[Template, ...]) -> dict[str, F.Column]:
    """Label, kind and k-grams of the template numbered by column ``tpl``."""
    at = F.col("tpl") + 1
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), at)
    return {
        "label": pick([t.label for t in templates]), "base": pick([t.base for t in templates]), "exact": pick([t.exact for t in templates]),
        "grams": pick([len(t.words()) - 1 for t in templates]),
    }


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES, shift: int = 4, coverage: float = 0.5
) -> tuple[DataFrame, DataFrame]:
    """Documents (id, th, n_words, n_rows) and verified spans (id, th, tpl,
    label, base, start, end, share), start and end in words."""
    text = F.coalesce(docs[text_col], F.lit(""))
    words = F.array_remove(F.split(F.lower(text), _BETWEEN), "")
    src = docs.select(docs[id_col].alias("id"), F.xxhash64(text).alias("th"), words.alias("words"))
    grams = F.zip_with("words", F.slice("words", 2, F.greatest(F.size("words"), F.lit(1))), lambda a, b: F.xxhash64(a, b))
    rolled = src.select("id", "th", F.size("words").cast("long").alias("n_words"), F.posexplode(F.concat(grams, F.array(F.lit(_END).cast("long")))).alias("pos", "h"))
    # written once: both the documents' end marks and the votes are read from it
    hits = materialise(rolled.join(F.broadcast(template_places(docs.sparkSession, templates)), "h").drop("h"), "hits").repartition("id", "th")

    ends = hits.where((F.col("tpl") == _END) & (F.col("pos") == F.col("n_words"))).groupBy("id", "th").agg(F.max("n_words").alias("n_words"), F.count("*").alias("n_rows"))

    diagonals = hits.where(F.col("tpl") != _END).groupBy("id", "th", "tpl", (F.col("pos") - F.col("tpos")).alias("diagonal")).agg(F.collect_set("tpos").alias("at"))
    diagonals = diagonals.withColumns(_facts(templates))
    by_diagonal = Window.partitionBy("id", "th", "tpl").orderBy("diagonal")
    apart = F.col("exact") | (F.col("diagonal") - F.lag("diagonal").over(by_diagonal) > shift)
    groups = diagonals.withColumn("part", F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(by_diagonal))
    start = F.col("diagonal") + F.array_min("at")
    end = F.col("diagonal") + F.array_max("at") + 2
    merged = groups.groupBy("id", "th", "tpl", "part", "label", "base", "exact", "grams").agg(
        F.min(start).cast("long").alias("start"), F.max(end).cast("long").alias("end"), F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("found")
    )
    share = F.col("found") / F.col("grams")
    length = F.col("end") - F.col("start")
    whole = F.when(F.col("exact"), F.col("found") == F.col("grams")).otherwise((share >= coverage) & (length <= 2 * (F.col("grams") + 1)))
    return ends, merged.withColumn("share", share).where(whole).select("id", "th", "tpl", "label", "base", "start", "end", "share")


def license_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: words, places of base phrases, labels, score."""
    ends, spans = scan_licenses(docs, id_col, text_col, **options)
    at = F.when(F.col("base"), F.col("start"))
    per_doc = spans.groupBy("id", "th").agg(
        F.count(at).alias("n_base"), F.min(at).alias("first_word"), F.max(at).alias("last_word"), F.sort_array(F.collect_set(F.when(F.col("base"), F.col("label")))).alias("base_labels"),
        F.sort_array(F.collect_set("label")).alias("labels"), F.max("share").alias("score"),
    ).withColumnsRenamed({"id": "its_id", "th": "its_th"})
    out = ends.join(per_doc, F.col("id").eqNullSafe(F.col("its_id")) & (F.col("th") == F.col("its_th")), "left")
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_rows"))))
    none = F.lit("")
    return out.select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        F.coalesce(F.array_join("base_labels", ","), none).alias("base_labels"), F.coalesce(F.array_join("labels", ","), none).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
