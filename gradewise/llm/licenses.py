"""License notices in texts: exact phrases, and templates by an exact set-similarity join.

Base labels come from phrases whose words stand consecutively. The method's own labels
come from templates. A text carries a template's label if some run of ``BLOCK``
consecutive words, wherever it starts (or the whole text, if shorter), holds at least the
share ``threshold`` of the template's distinct words and the template's telling wording.
The telling wording is what sets a license apart from its siblings: "attribution
sharealike 4" against "attribution 4", "lesser general public license" against "general
public license", "version 2" against "version 3". Sets of words alone cannot tell these.

Runs are sought in blocks of ``BLOCK + STEP - 1`` words that start every ``STEP`` words,
so each run lies whole in a block. The join of blocks and templates is exact:

1. The template words are counted in the whole corpus and ordered from rare to frequent.
2. Prefix filter: of a template of r words, a block with an overlap of at least
   a = ceil(threshold r) holds one of the r - a + 1 rarest. Blocks are made only around
   such words.
3. Length filter: a block with fewer than a template words of any kind drops out.
4. Positional filter: the rarest common word at place i of the template and j of the
   block's template words leaves an overlap of at most 1 + min(r - i, x - j) (0-based,
   words after it); less than a drops out.
5. The overlap itself is counted for what is left, then that of each run in the block,
   and the telling wording is looked for in the runs that meet the threshold.

Words outside all templates change no overlap, so they are never counted or sorted.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradewise.functions import column
from gradewise.llm.text import fold_case, hash_pair

# What separates words, the base phrases and their labels.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}


@dataclass(frozen=True)
class Template:
    """``telling`` is a pattern that a run's words, each with a space on both sides, must hold."""

    label: str
    wording: str
    telling: str = ""


# The wording by which public licenses are commonly given, and by which siblings differ.
VERSIONED = r"(\d|license|international|unported|generic)"
TEMPLATES = (
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files to deal in the software without restriction",
        " deal in the software ",
    ),
    Template(
        "apache-2",
        "licensed under the apache license version 2 0 you may not use this file except in compliance with "
        "the license you may obtain a copy of the license at",
        " apache license (version |v ?)?2 ",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation",
        " gnu general public license ",
    ),
    Template(
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu "
        "lesser general public license as published by the free software foundation",
        " gnu (lesser|library) general public license ",
    ),
    Template(
        "agpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "affero general public license as published by the free software foundation",
        " gnu affero general public license ",
    ),
    Template(
        "gpl-2",
        "licensed under the gnu general public license version 2",
        " gnu general public license (version |v ?)?2 ",
    ),
    Template(
        "gpl-3",
        "licensed under the gnu general public license version 3",
        " gnu general public license (version |v ?)?3 ",
    ),
    Template(
        "lgpl-2.1",
        "licensed under the gnu lesser general public license version 2 1",
        " gnu lesser general public license (version |v ?)?2 1 ",
    ),
    Template(
        "lgpl-3",
        "licensed under the gnu lesser general public license version 3",
        " gnu lesser general public license (version |v ?)?3 ",
    ),
    Template(
        "agpl-3",
        "licensed under the gnu affero general public license version 3",
        " gnu affero general public license (version |v ?)?3 ",
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee "
        "is hereby granted provided that the above copyright notice",
        " with or without fee ",
    ),
    Template(
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the "
        "mpl was not distributed with this file",
        " mozilla public license (version |v ?)?2 ",
    ),
    Template(
        "cc-by",
        "this work is licensed under a creative commons attribution 4 0 international license",
        f" commons attribution {VERSIONED} ",
    ),
    Template(
        "cc-by-nc",
        "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
        f" attribution non ?commercial {VERSIONED} ",
    ),
    Template(
        "cc-by-nc",
        "noncommercial you may not use the material for commercial purposes",
        " not use the material for commercial purposes ",
    ),
    Template(
        "cc-by-sa",
        "this work is licensed under a creative commons attribution sharealike 4 0 international license",
        f" attribution share ?alike {VERSIONED} ",
    ),
    Template(
        "cc-by-nd",
        "this work is licensed under a creative commons attribution noderivatives 4 0 international license",
        f" attribution no ?deriv(ative)?s( works)? {VERSIONED} ",
    ),
    Template(
        "cc-by-nd",
        "this work is licensed under a creative commons attribution noderivs 3 0 unported license",
        f" attribution no ?deriv(ative)?s( works)? {VERSIONED} ",
    ),
    Template(
        "cc-by-nc-sa",
        "this work is licensed under a creative commons attribution noncommercial sharealike 4 0 international "
        "license",
        f" attribution non ?commercial share ?alike {VERSIONED} ",
    ),
    Template(
        "cc-by-nc-nd",
        "this work is licensed under a creative commons attribution noncommercial noderivatives 4 0 "
        "international license",
        f" attribution non ?commercial no ?deriv(ative)?s( works)? {VERSIONED} ",
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        " unencumbered ",
    ),
    Template(
        "all-rights-reserved",
        "all rights reserved no part of this publication may be reproduced distributed",
        " all rights reserved ",
    ),
)

#: Words of a run, and how far apart the blocks start that runs are sought in.
BLOCK, STEP = 64, 32


def words_of(text: Column) -> Column:
    """Lower-cased words of the text; null and wordless texts have none."""
    return F.filter(F.split(fold_case(text), BREAKS, -1), lambda w: w != "")


def _places_of(words: Column, phrase: str) -> Column:
    parts = phrase.split(" ")

    def here(word: Column, place: Column) -> Column:
        ahead = [F.get(words, place + i) == part for i, part in enumerate(parts) if i]
        return F.when(reduce(lambda a, b: a & b, ahead, word == parts[0]), place)

    found = F.filter(F.transform(words, here), lambda place: place.isNotNull())
    return F.transform(found, lambda place: F.struct(place.alias("place"), F.lit(phrase).alias("phrase")))


def phrase_places(words: Column, phrases: list[str]) -> Column:
    """Where a phrase starts: array of (place, phrase)."""
    return F.concat(*[_places_of(words, phrase) for phrase in phrases])


def _scan(docs: DataFrame, text: str, key: str) -> DataFrame:
    t0, t1 = hash_pair(F.coalesce(column(text), F.lit("")))
    return docs.select(
        column(key).alias("id"), t0.alias("t0"), t1.alias("t1"), words_of(column(text)).alias("words")
    )


def rare_first(rows: DataFrame, vocabulary: list[str]) -> list[str]:
    """The template words from rare to frequent in the corpus; ties by the word."""
    counted = (
        rows.select(F.explode(F.filter("words", lambda w: w.isin(vocabulary))).alias("word"))
        .groupBy("word")
        .count()
        .collect()  # at most one row per template word
    )
    known = {r["word"]: r["count"] for r in counted}
    return sorted(vocabulary, key=lambda w: (known.get(w, 0), w))


def prefixes(templates: Sequence[Template], order: list[str], threshold: float) -> list[tuple]:
    """Per template and word of its prefix: rank, place in the template, the template's number, r, a and all ranks."""
    place = {w: i for i, w in enumerate(order)}
    rows = []
    for number, template in enumerate(templates):
        ranks = sorted({place[w] for w in template.wording.split(" ")})
        need = ceil(threshold * len(ranks) - 1e-9)
        rows += [(ranks[i], i, number, len(ranks), need, ranks) for i in range(len(ranks) - need + 1)]
    return rows


def _as_table(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A small table as one literal, since a column per cell would take seconds to plan."""
    names = [field.split(" ")[0] for field in schema.split(", ")]
    text = json.dumps([dict(zip(names, row)) for row in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{schema}>>")))


def candidate_blocks(
    rows: DataFrame, templates: Sequence[Template], threshold: float = 0.8, block: int = BLOCK, step: int = STEP
) -> DataFrame:
    """``id, t0, t1, own, number, r, need`` of every block that meets a template's threshold as a whole.

    ``rows`` has id, t0, t1 and words; ``own`` are the block's words. Blocks have block +
    step - 1 words and start at words 0, step, 2 step, ..., up to the last run's start.
    """
    vocabulary = sorted({w for t in templates for w in t.wording.split(" ")})
    order = rare_first(rows, vocabulary)
    listed = prefixes(templates, order, threshold)
    schema = "rank int, i int, number int, r int, need int, ranks array<int>"
    index = _as_table(rows.sparkSession, listed, schema)  # as many rows as the templates' prefixes have words
    prefix = sorted({order[row[0]] for row in listed})
    wide = block + step - 1

    # Blocks that hold a prefix word: those that start at most a block's length before it.
    hits = F.filter(
        F.transform("words", lambda w, i: F.when(w.isin(prefix), i)),
        lambda i: i.isNotNull(),
    )
    last_block = F.floor(F.greatest(F.lit(0), F.size("words") - block) / step).cast("int")
    around = F.flatten(
        F.transform(
            hits,
            lambda i: F.sequence(
                F.least(F.greatest(F.lit(0), F.ceil((i - (wide - 1)) / step).cast("int")), last_block),
                F.least(F.floor(i / step).cast("int"), last_block),
            ),
        )
    )
    likely = rows.filter(F.exists("words", lambda w: w.isin(prefix)))
    blocks = likely.select(
        "id", "t0", "t1", "words", F.explode(F.array_distinct(around)).alias("block")
    ).select("id", "t0", "t1", F.slice("words", F.col("block") * step + 1, wide).alias("own"))
    ordered = F.array(*[F.lit(w) for w in order])
    held = F.filter(F.array_distinct("own"), lambda w: w.isin(order))
    ranked = F.array_sort(F.transform(held, lambda w: (F.array_position(ordered, w) - 1).cast("int")))
    x = blocks.select("id", "t0", "t1", "own", ranked.alias("x"))
    least = min(row[4] for row in listed)
    starts = F.filter(
        F.transform("x", lambda rank, j: F.struct(j.alias("j"), rank.alias("rank"))),
        lambda s: s["rank"].isin(sorted({row[0] for row in listed})),
    )
    tokens = x.filter(F.size("x") >= least).select("id", "t0", "t1", "own", "x", F.inline(starts))
    candidates = tokens.join(F.broadcast(index), "rank").filter(
        (F.size("x") >= F.col("need"))
        & (1 + F.least(F.col("r") - 1 - F.col("i"), F.size("x") - 1 - F.col("j")) >= F.col("need"))
    )
    common = F.array_intersect("x", "ranks")
    first = F.element_at(common, 1) == F.col("rank")  # else the pair comes once per common prefix word
    return candidates.filter(first & (F.size(common) >= F.col("need"))).select(
        "id", "t0", "t1", "own", "number", "r", "need"
    )


def matching_runs(
    rows: DataFrame, templates: Sequence[Template], threshold: float = 0.8, block: int = BLOCK, step: int = STEP
) -> DataFrame:
    """``id, t0, t1, label, share`` per block and template that one of the block's runs meets."""
    blocks = candidate_blocks(rows, templates, threshold, block, step)
    known = _as_table(
        rows.sparkSession,
        [(i, t.label, sorted(set(t.wording.split(" "))), t.telling) for i, t in enumerate(templates)],
        "number int, label string, wording array<string>, telling string",
    )
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("own") - (block - 1)))
    overlap = F.transform(
        starts,
        lambda s: F.struct(
            F.size(F.array_intersect(F.slice("own", s, block), "wording")).alias("n"),
            F.concat(F.lit(" "), F.array_join(F.slice("own", s, block), " "), F.lit(" ")).alias("run"),
        ),
    )
    met = F.filter(overlap, lambda o: (o["n"] >= F.col("need")) & F.regexp_like(o["run"], F.col("telling")))
    best = F.array_max(F.transform(met, lambda o: o["n"]))
    return (
        blocks.join(F.broadcast(known), "number")
        .select("id", "t0", "t1", "label", (best / F.col("r")).alias("share"))
        .filter(F.col("share").isNotNull())
    )


def scan_licenses(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    phrases: dict[str, str] = PHRASES,
    templates: Sequence[Template] = TEMPLATES,
    threshold: float = 0.8,
) -> DataFrame:
    """One row per row of ``docs``: the key, ``n_words``, ``places``, ``base_labels``, ``labels``, ``score``.

    ``places`` are the starts (words from 0) of all phrase occurrences, overlapping ones
    too. ``base_labels`` and ``labels`` are sorted arrays without repeats; labels are the
    base ones and those of templates. ``score`` is 1 with a phrase, else the largest share
    of a template that a run meeting threshold and telling wording holds, else 0. A null or wordless
    text has no words, places or labels. Rows that repeat key and text get the same
    result. Other columns play no part.
    """
    rows = _scan(docs, text, key)
    named = (
        matching_runs(rows, templates, threshold)
        .groupBy(F.col("id").alias("gid"), F.col("t0").alias("g0"), F.col("t1").alias("g1"))
        .agg(F.collect_set("label").alias("found"), F.max("share").alias("share"))
    )
    label_of = F.create_map(*[F.lit(x) for pair in phrases.items() for x in pair])
    anchors = sorted({p.split(" ")[0] for p in phrases})
    likely = F.arrays_overlap("words", F.array(*[F.lit(p.split(" ")[-1]) for p in phrases])) & F.arrays_overlap(
        "words", F.array(*[F.lit(a) for a in anchors])
    )
    none = F.array().cast("array<struct<place:int,phrase:string>>")
    hits = F.when(likely, phrase_places(F.col("words"), list(phrases))).otherwise(none)
    based = rows.select("id", "t0", "t1", F.size("words").cast("long").alias("n_words"), hits.alias("hits"))
    same = F.col("id").eqNullSafe(F.col("gid")) & (F.col("t0") == F.col("g0")) & (F.col("t1") == F.col("g1"))
    base = F.array_sort(F.array_distinct(F.transform("hits", lambda h: label_of[h["phrase"]])))
    own = F.coalesce(F.col("found"), F.array().cast("array<string>"))
    return based.join(named, same, "left").select(
        F.col("id").alias(key),
        "n_words",
        F.array_sort(F.col("hits.place")).alias("places"),
        base.alias("base_labels"),
        F.array_sort(F.array_union(base, own)).alias("labels"),
        F.when(F.size("hits") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
